
from __future__ import annotations

import hashlib

from conftest import SF01
from pyspark.sql import functions as F

from linclass.operators.scale import apply_scaler, fit_scaler
from linclass.functions.expressions import hash_unit
from linclass.operators import split
from linclass.operators.split import hash_split, random_folds, random_split


def test_hash_split_matches_python_md5(spark):
    df = spark.range(0, 2000).withColumnRenamed("id", "k")
    got = {r.k: r.fold for r in hash_split(df, "k", seed=11).collect()}
    for k, fold in got.items():
        u = int(hashlib.md5(f"11:{k}".encode()).hexdigest()[:8], 16) / 2**32
        assert fold == ("train" if u < 0.8 else "test")
    share = sum(f == "train" for f in got.values()) / len(got)
    assert 0.75 < share < 0.85


def test_hash_split_stable_under_repartition(spark):
    orders = spark.read.parquet(f"{SF01}/orders.parquet").select("o_orderkey")
    a = hash_split(orders, "o_orderkey")
    b = hash_split(orders.repartition(7), "o_orderkey")
    c = hash_split(orders.coalesce(1), "o_orderkey")
    assert a.exceptAll(b).count() == 0 and a.exceptAll(c).count() == 0
    folds = a.groupBy("fold").count().collect()
    assert sum(r["count"] for r in folds) == orders.count()
    assert {r.fold for r in folds} == {"train", "test"}


def test_without_key_equal_rows_are_not_tied(spark):
    df = spark.range(0, 10_000).select((F.col("id") % 10).cast("double").alias("x"))
    out = hash_split(df, None)
    train = out.groupBy("x").agg(F.count_if(F.col("fold") == "train").alias("n")).collect()
    assert len(train) == 10 and all(740 < r.n < 860 for r in train)


def test_rows_without_key_are_spread(spark):
    df = spark.range(0, 2000).select(F.lit(None).cast("string").alias("k"), "id")
    n = hash_split(df, "k").where("fold = 'train'").count()
    assert 1500 < n < 1700


def counts(rows) -> dict:
    return {tuple(r)[:-1]: r["count"] for r in rows.groupBy(*rows.columns).count().collect()}


def test_folds_without_key_do_not_depend_on_the_layout(spark):
    rows = spark.range(0, 20_000, 1, 4).select((F.col("id") % 15_000).alias("x"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"))
    layouts = [rows, rows.repartition(7), rows.coalesce(1), rows.orderBy(F.desc("x"))]
    for split_rows in (random_folds, lambda r: hash_split(r, "k"), lambda r: hash_split(r, ["k", "x"])):
        first, *others = [counts(split_rows(r)) for r in layouts]
        assert all(c == first for c in others) and sum(first.values()) == 20_000
        train = sum(n for r, n in first.items() if r[-1] == "train")
        assert 15_700 < train < 16_300


def test_many_equal_rows_are_written_out_in_chunks(spark, monkeypatch):
    rows = spark.range(0, 3000, 1, 3).select(F.lit("same").alias("x"), F.lit(None).cast("double").alias("y"))
    whole = counts(random_folds(rows))
    monkeypatch.setattr(split, "CHUNK", 7)
    assert counts(random_folds(rows)) == whole and sum(whole.values()) == 3000
    assert 2300 < whole["same", None, "train"] < 2500


def test_contents_differ_by_any_column_of_any_type(spark):
    schema = "`a.b` int, _digest string, _row binary, l array<string>, m map<string,int>, s struct<u:double>"
    data = [(1, None, b"x", ["null"], {"a": None}, (0.0,)), (1, None, b"x", [None], {"a": None}, (0.0,)), (None, "1", b"x", [None], {"a": None}, (0.0,)), (1, "\\N", b"x", [None], {"a": None}, (0.0,)), (1, None, b"y", [None], {}, (0.0,)), (1, None, b"y", [None], {}, None)]
    rows = spark.createDataFrame(data * 2, schema)
    got = random_folds(rows, {"a": 1, "b": 1}, fold_col="part")
    assert got.columns == [*rows.columns, "part"] and got.count() == 12
    assert rows.select(split.content_digest(rows).alias("d")).distinct().count() == 6
    assert sorted(map(repr, got.drop("part").collect())) == sorted(map(repr, rows.collect()))


def test_an_empty_table_has_no_folds(spark):
    rows = spark.createDataFrame([], "x double, k long")
    assert random_folds(rows).count() == 0 and hash_split(rows, "k").count() == 0


def test_lists_of_keys_do_not_share_a_text(spark):
    df = spark.createDataFrame([("a:b", "c"), ("a", "b:c"), ("a\\", "b"), ("a", "\\b")], "x string, y string")
    assert df.select(hash_unit(["x", "y"], 1).alias("u")).distinct().count() == 4


def test_named_partition_weights(spark):
    df = spark.range(0, 3000).withColumnRenamed("id", "k")
    out = hash_split(df, "k", weights={"training": 0.8, "test": 0.2}, seed=1099)
    names = {r.fold for r in out.select("fold").distinct().collect()}
    assert names == {"training", "test"}


def test_random_split_covers_all_rows(spark):
    df = spark.range(0, 1000)
    parts = random_split(df, seed=11)
    assert parts["train"].count() + parts["test"].count() == 1000
    assert parts["train"].intersect(parts["test"]).count() == 0


def test_scaler_train_moments_and_constant_column(spark):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet").select("l_quantity", "l_discount", F.lit(3.0).alias("flat"))
    stats = fit_scaler(li, ["l_quantity", "l_discount", "flat"])
    z = apply_scaler(li, stats)
    m = z.agg(
        F.avg("l_quantity").alias("m"), F.stddev_samp("l_quantity").alias("s"), F.max(F.abs("flat")).alias("f")
    ).first()
    assert abs(m.m) < 1e-9 and abs(m.s - 1.0) < 1e-9 and m.f == 0.0


def test_scaler_matches_spark_ml(spark):
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    li = spark.read.parquet(f"{SF01}/lineitem.parquet").select("l_quantity", "l_tax")
    vec = VectorAssembler(inputCols=["l_quantity", "l_tax"], outputCol="v").transform(li)
    model = StandardScaler(inputCol="v", outputCol="z", withMean=True, withStd=True).fit(vec)
    stats = fit_scaler(li, ["l_quantity", "l_tax"])
    assert max(abs(a - b) for a, b in zip(stats.means, model.mean.toArray())) < 1e-9
    assert max(abs(a - b) for a, b in zip(stats.stds, model.std.toArray())) < 1e-9
    ml = model.transform(vec).select(vector_to_array("z")[0].alias("z0"), "l_quantity").limit(50).collect()
    for r in ml:
        assert abs(r.z0 - (r.l_quantity - stats.means[0]) / stats.stds[0]) < 1e-9
