"""Wide models, checks that stop a job, inferred CSV files and command-line options."""

from __future__ import annotations

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import write_file
from linclass.operators.checks import DataCheckError
from linclass.operators.columns import ColumnError, resolve_columns
from linclass.operators.linear import LinearModel
from linclass.operators.score import score
from linclass.operators.sgd import NullRowsError, sgd_fit
from linclass.plans import cli
from linclass.plans.jobs import enet_job, logistic_job, ridge_job, svm_job
from linclass.sources.delimited import CORRUPT, load_csv_inferred


def wide_table(spark, rows: int, d: int):
    values = F.transform(F.sequence(F.lit(1), F.lit(d)), lambda i: ((F.col("id") * 31 + i * 17) % 101) / 50.0 - 1)
    base = spark.range(rows).select("id", values.alias("v")).withColumn("y", ((F.col("v")[0] + F.col("v")[1]) > 0).cast("double")).cache()
    return base.select("id", "y", *[F.col("v")[i].alias(f"f{i}") for i in range(d)])


@pytest.mark.parametrize("d", [1000, 3000])
def test_wide_models_are_scored(spark, d):
    df = wide_table(spark, 1000, d)
    w = [((i * 37) % 11 - 5) / 10 for i in range(d)]
    began = time.time()
    got = score(LinearModel([f"f{i}" for i in range(d)], w, 0.25), df).select("id", "margin").toPandas().set_index("id").margin
    assert time.time() - began < 60
    ids, i = np.arange(1000)[:, None], np.arange(1, d + 1)[None, :]
    x = ((ids * 31 + i * 17) % 101) / 50.0 - 1
    assert np.abs(got.loc[range(1000)].to_numpy() - (x @ np.array(w) + 0.25)).max() < 1e-9


def test_wide_job_under_a_minute(spark):
    df = wide_table(spark, 1000, 1000)
    began = time.time()
    res = enet_job(spark, df, target="y", excluded=["id"], key="id", save=False)
    assert time.time() - began < 60 and res.metrics.count() == 2


@pytest.mark.parametrize("job", [logistic_job, enet_job, svm_job])
def test_a_one_class_train_fold_stops_a_strict_run(spark, job):
    rows = spark.range(400).select("id", (F.col("id") * 1.0).alias("x"), F.lit(1.0).alias("y"))
    from linclass.operators.split import hash_split

    folds = hash_split(rows, "id", seed=11)
    one = folds.withColumn("y", F.when(F.col("fold") == "test", (F.col("id") % 2).cast("double")).otherwise(1.0)).drop("fold")
    with pytest.raises(DataCheckError, match="single_class_fold"):
        job(spark, one, target="y", excluded=["id"], key="id", save=False)


def test_permissive_mode_checks_the_rows_it_keeps(spark):
    rows = spark.range(400).select("id", F.when(F.col("id") % 2 == 0, F.col("id") * 1.0).alias("x"), (F.col("id") % 2).cast("double").alias("y"))
    with pytest.raises(DataCheckError, match="after bad rows were set aside"):
        logistic_job(spark, rows, target="y", excluded=["id"], key="id", strict=False, save=False)


def test_null_keys_are_counted(spark):
    rows = spark.range(500).select(F.when(F.col("id") % 5 > 0, F.col("id")).alias("id"), (F.col("id") % 7 * 1.0).alias("x"), (F.col("id") % 2).cast("double").alias("y"))
    res = logistic_job(spark, rows, target="y", excluded=["id"], key="id", save=False)
    assert {(r.check, r.column): r.n_bad for r in res.checks.collect()}["null_key", "id"] == 100
    assert "null_key(id)" in res.run.first().checks_failed


def test_nulls_stop_a_gradient_fit_at_any_width(spark):
    for d in (1, 40):
        df = spark.range(4).select((F.col("id") % 2).cast("double").alias("label"), *[F.when(F.col("id") != 1, F.col("id") * 1.0).alias(f"f{i}") for i in range(d)])
        with pytest.raises(NullRowsError) as e:
            sgd_fit(df, [f"f{i}" for i in range(d)], "label", "logistic", "l2", 0.01, 3)
        assert e.value.n_rows == 1


def test_all_rows_decide_the_types_and_bad_rows_are_marked(spark, workdir):
    lines = ["Creditability,Age_years", *[f"{k % 2},{20 + k % 40}" for k in range(1500)], "1,30.5", "0,31,7", "1"]
    path = write_file(workdir, "c.csv", "\n".join(lines) + "\n")
    df = load_csv_inferred(spark, path)
    assert dict(df.dtypes)["Age_years"] == "double"
    got = df.select("Age_years", CORRUPT).collect()
    assert len(got) == 1503 and sum(r[1] is not None for r in got) == 2 and any(r[0] == 30.5 for r in got)
    with pytest.raises(DataCheckError, match="corrupt"):
        ridge_job(spark, path, save=False)


def test_names_are_compared_as_spark_does():
    with pytest.raises(ColumnError, match="duplicate"):
        resolve_columns(["Target", "Age", "age"], "Target")


def test_a_job_leaves_its_configuration_alone(spark):
    rows = spark.range(200).select("id", (F.col("id") % 13 * 1.0).alias("x"), (F.col("id") % 2).cast("double").alias("y"))
    res = svm_job(spark, rows, target="y", excluded=["id"], key="id", penalty="l1", iterations=3, save=False)
    assert res.config.mode == "converged" and res.config.iterations == 3 and '"mode": "converged"' in res.run.first().parameters


@pytest.mark.parametrize("argv", [["ridge", "-p", "l1"], ["ridge", "--mode", "sgd"], ["enet", "-p", "l2"], ["enet", "--mode", "sgd"], ["logistic", "-l", "0.5"], ["svm", "--profile", "x"], ["svm", "--iterations", "0"]])
def test_options_that_a_job_lacks_are_refused(argv, capsys):
    with pytest.raises(SystemExit):
        cli.options([*argv, "-f", "x.csv"])
    assert "option" in capsys.readouterr().err or "--iterations" in argv


@pytest.mark.parametrize("job", ["ridge", "logistic", "enet", "svm"])
def test_options_act(spark, workdir, job):
    lines = ["y;k;a;b", *[f"{k % 2};{k};{k % 7};{(k * 13) % 11}" for k in range(300)]]
    path = write_file(workdir, "d.csv", "\n".join(lines) + "\n")
    args = ["-f", path, "-s", ";", "-t", "y", "-c", "k", "--key", "k", "--iterations", "4", "-r", "0.05"]
    if job in ("logistic", "svm"):
        args += ["-p", "l1", "--mode", "sgd"]
    if job == "enet":
        args += ["-l", "0.3"]
    rec = cli.run(spark, cli.options([job, *args])).run.first()
    assert rec.rows == 300 and '"iterations": 4' in rec.parameters and '"reg": 0.05' in rec.parameters
    assert job != "enet" or '"elastic_net": 0.3' in rec.parameters
    assert job not in ("logistic", "svm") or rec.penalty == "l1" and '"mode": "sgd"' in rec.parameters
