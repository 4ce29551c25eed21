"""Jobs end to end on small delimited files and on the driver's tables."""

from __future__ import annotations

import os

import numpy as np
import pytest
from conftest import SF001, write_file
from pyspark.sql import functions as F

from linclass import enet_job, logistic_job, ridge_job, svm_job
from linclass.operators.checks import DataCheckError


def credit_file(folder, n=600, seed=5, sep=",", neg_labels=True):
    rng = np.random.default_rng(seed)
    lines = [sep.join(["Creditability", "Purpose", "Age_years", "Amount", "Duration"])]
    for i in range(n):
        age = rng.integers(19, 75)
        amount = rng.normal(3000, 1500)
        dur = rng.integers(4, 60)
        z = 0.04 * (age - 35) - 0.0004 * (amount - 3000) - 0.03 * (dur - 20) + rng.normal()
        y = 1 if z > 0 else (-1 if neg_labels else 0)
        lines.append(sep.join(str(v) for v in [y, rng.integers(0, 10), age, round(amount, 2), dur]))
    return write_file(folder, "credit.csv", "\n".join(lines) + "\n")


def test_logistic_job_writes_model_and_reports(spark, workdir):
    path = credit_file(workdir)
    res = logistic_job(spark, path, target="Creditability", excluded=["Purpose"], reg=0.05, out_dir=workdir)
    run = res.run.first()
    assert run.rows == 600 and run.columns == 5 and run.excluded == ["Purpose"]
    assert run.train_rows + run.test_rows == 600
    assert run.auc_test > 0.7 and run.balanced_accuracy_test > 0.6
    assert os.path.basename(res.model_path).startswith("model.lr.")
    assert os.path.isdir(res.model_path)
    coeffs = [r.variable for r in res.coefficients.collect()]
    assert sorted(coeffs) == ["Age_years", "Amount", "Duration", "Intercept"]
    counts = {(r.fold, r["class"]): r.n for r in res.class_counts.collect()}
    assert sum(counts.values()) == 600 and counts[("train", 1)] > 0 and counts[("test", 0)] > 0
    for name in ("run", "coefficients", "checks", "class_counts"):
        assert os.path.isdir(f"{workdir}/report.logistic/{name}")


def test_sgd_mode_logistic_job(spark, workdir):
    res = logistic_job(spark, credit_file(workdir), target="Creditability", excluded=["Purpose"], mode="sgd", save=False)
    assert 1 <= res.sgd_iterations <= 100
    assert res.run.first().parameters.find('"mode": "sgd"') >= 0


def test_enet_job_saves_model(spark, workdir):
    res = enet_job(spark, credit_file(workdir), target="Creditability", excluded=["Purpose"], out_dir=workdir)
    assert res.model_path.endswith("model.reglog") and os.path.isdir(res.model_path)
    assert res.run.first().auc_test > 0.7


@pytest.mark.parametrize("penalty", ["l2", "l1"])
def test_svm_job_penalties(spark, workdir, penalty):
    res = svm_job(spark, credit_file(workdir), target="Creditability", excluded=["Purpose"], penalty=penalty, out_dir=workdir)
    run = res.run.first()
    assert run.penalty == penalty and run.auc_test > 0.7
    intercept = [r.coefficient for r in res.coefficients.collect() if r.variable == "Intercept"]
    assert intercept == [0.0]


def test_ridge_job_with_inferred_csv_and_profile(spark, workdir):
    res = ridge_job(spark, credit_file(workdir, neg_labels=False), profile_column="Age_years", save=False)
    prof = {r["class"]: r for r in res.profile.collect()}
    assert set(prof) == {0, 1} and all(18 < r["mean"] < 76 for r in prof.values())
    run = res.run.first()
    assert set(res.metrics.toPandas()["fold"]) == {"training", "test"}
    assert run.auc_test > 0.7


def test_permissive_mode_sets_rows_aside(spark, workdir):
    path = credit_file(workdir)
    with open(path, "a") as f:
        f.write("1,2,abc,3,4\n1,2,3\n")
    with pytest.raises(DataCheckError):
        logistic_job(spark, path, target="Creditability", excluded=["Purpose"], save=False)
    res = logistic_job(spark, path, target="Creditability", excluded=["Purpose"], save=False, strict=False)
    assert res.set_aside.count() == 2
    assert res.run.first().rows == 602


def test_one_class_test_fold_gives_null_auc(spark):
    from linclass.plans.catalogue import doc_table

    res = enet_job(spark, doc_table(spark, SF001), target="quality", excluded=["doc_id"], key="doc_id", save=False)
    run = res.run.first()
    assert run.auc_test is None
    assert "single_class_fold(test)" in run.checks_failed


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    rows = df.collect()
    assert {r.fold for r in rows} == {"train", "test"}
    assert set(df.columns) >= {"fold", "n_rows", "n_pos", "auc", "balanced_accuracy", "n_nonzero"}
    assert set(E.oracle_sql()) <= set(E.queries())
    from linclass.plans import catalogue

    assert set(catalogue.QUERIES) <= set(E.oracle_sql())


def test_columnar_table_input(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet").select(
        (F.col("l_returnflag") == "R").cast("double").alias("y"), "l_quantity", "l_discount", "l_tax", "l_orderkey"
    )
    res = logistic_job(spark, li, target="y", excluded=["l_orderkey"], key="l_orderkey", save=False)
    assert res.run.first().rows == li.count()


def test_cli_main(spark, workdir, capsys):
    import json

    from linclass.plans.cli import main

    path = credit_file(workdir)
    assert main(["svm", "-f", path, "-t", "Creditability", "-c", "Purpose", "-p", "l1", "-r", "0.01", "-d", workdir]) == 0
    rec = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert rec["job"] == "svm" and rec["penalty"] == "l1" and rec["rows"] == 600
    assert os.path.isdir(f"{workdir}/model.svm") and os.path.isdir(f"{workdir}/report.svm/run")


def test_checkpoint_stage(spark, workdir):
    res = logistic_job(
        spark, credit_file(workdir), target="Creditability", excluded=["Purpose"], save=False, stage="checkpoint"
    )
    assert res.run.first().rows == 600


def test_pandas_source(spark):
    import pandas as pd

    rng = np.random.default_rng(1)
    x = rng.normal(size=300)
    pdf = pd.DataFrame({"x": x, "Creditability": (x + rng.normal(size=300) > 0).astype(int)})
    res = ridge_job(spark, pdf, save=False)
    assert res.run.first().rows == 300


def test_awkward_feature_names(spark, workdir):
    rng = np.random.default_rng(2)
    lines = ['"a.b","label","x`y",fold,Target']
    for _ in range(400):
        a, b, c, d = rng.normal(size=4)
        lines.append(f"{a},{b},{c},{d},{1 if a + b - c + rng.normal() > 0 else 0}")
    path = write_file(workdir, "odd.csv", "\n".join(lines) + "\n")
    for job in (logistic_job, svm_job):
        res = job(spark, path, save=False)
        names = sorted(r.variable for r in res.coefficients.collect())
        assert names == sorted(["a.b", "label", "x`y", "fold", "Intercept"])
        assert res.run.first().auc_test > 0.7
        assert {r.column for r in res.checks.collect()} >= {"a.b", "x`y", "label", "fold"}


def test_split_key_that_is_a_feature(spark, workdir):
    res = logistic_job(spark, credit_file(workdir), target="Creditability", key="Age_years", save=False)
    run = res.run.first()
    assert run.train_rows + run.test_rows == 600 and run.train_rows > run.test_rows


def test_rebalance_gives_the_same_fit(spark, workdir):
    path = credit_file(workdir)
    args = dict(target="Creditability", excluded=["Purpose"], mode="sgd", save=False, key="Age_years")
    a = logistic_job(spark, path, **args)
    b = logistic_job(spark, path, rebalance=True, **args)
    wa = {r.variable: r.coefficient for r in a.coefficients.collect()}
    wb = {r.variable: r.coefficient for r in b.coefficients.collect()}
    assert wa.keys() == wb.keys() and all(abs(wa[k] - wb[k]) < 1e-9 for k in wa)
    assert a.run.first().auc_test == pytest.approx(b.run.first().auc_test, abs=1e-12)


@pytest.mark.parametrize("mode", ["converged", "sgd"])
def test_stage_none_same_result(spark, workdir, mode):
    path = credit_file(workdir)
    args = dict(target="Creditability", excluded=["Purpose"], mode=mode, save=False)
    a = logistic_job(spark, path, **args).run.first()
    b = logistic_job(spark, path, stage="none", **args).run.first()
    assert a.rows == b.rows and a.auc_test == pytest.approx(b.auc_test, abs=1e-9)
