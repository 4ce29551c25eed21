"""Exact AUC and balanced accuracy against brute force and Spark's own evaluator."""

from __future__ import annotations

import random

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from linclass.operators.evaluate import auc, balanced_accuracy, binary_metrics, evaluator_auc


def brute_auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    if not pos or not neg:
        return None
    credit = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return credit / (len(pos) * len(neg))


@pytest.fixture(scope="module")
def sample(spark):
    rnd = random.Random(7)
    data = []
    for i in range(1500):
        y = 1.0 if rnd.random() < 0.35 else 0.0
        s = round(rnd.gauss(0.6 if y else 0.0, 1.0), 1) + 0.0  # rounded: many ties; no -0.0
        data.append((i % 3, y, s))
    return data, spark.createDataFrame(data, "g int, label double, score double")


@pytest.mark.parametrize("bins", [1, 4, 37, 500])
def test_auc_equals_brute_force_any_bins(sample, bins):
    data, df = sample
    got = auc(df, "label", "score", bins=bins).first()
    assert got.auc == pytest.approx(brute_auc([(s, y) for _, y, s in data]), abs=1e-12)
    assert got.n_pos + got.n_neg == len(data)


def test_auc_by_group(sample):
    data, df = sample
    got = {r.g: r.auc for r in auc(df, "label", "score", by=["g"], bins=8).collect()}
    for g in range(3):
        assert got[g] == pytest.approx(brute_auc([(s, y) for gg, y, s in data if gg == g]), abs=1e-12)


def test_auc_properties(sample):
    _, df = sample
    base = auc(df, "label", "score").first().auc
    neg = auc(df.withColumn("score", -F.col("score")), "label", "score").first().auc
    mono = auc(df.withColumn("score", F.exp(F.col("score") * 3.0)), "label", "score").first().auc
    assert neg == pytest.approx(1.0 - base, abs=1e-12)
    assert mono == pytest.approx(base, abs=1e-12)


def test_auc_matches_spark_evaluator_without_bins(spark, sample):
    # (the evaluator keys thresholds by Double.equals, so -0.0 and 0.0 would be two
    # thresholds there; the sample has no -0.0)
    data, _ = sample
    vec = spark.createDataFrame([(y, Vectors.dense([-s, s])) for _, y, s in data], ["label", "rawPrediction"])
    mine = auc(spark.createDataFrame([(y, s) for _, y, s in data], "label double, score double")).first().auc
    assert mine == pytest.approx(evaluator_auc(vec), abs=1e-12)


def test_one_class_gives_null(spark):
    df = spark.createDataFrame([(1.0, 0.3), (1.0, 0.5)], "label double, score double")
    r = binary_metrics(df, "label", "score", None).first()
    assert r.auc is None and r.n_pos == 2 and r.n_neg == 0


def test_balanced_accuracy_is_hard_label_auc(spark):
    rows = [(1.0, 1.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0), (0.0, 1.0), (0.0, 0.0), (0.0, 0.0)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    ba = balanced_accuracy(df).first().balanced_accuracy
    assert ba == pytest.approx((2 / 3 + 3 / 4) / 2)
    hard = auc(df.withColumn("score", F.col("prediction")), "label", "score").first().auc
    assert hard == pytest.approx(ba)


@pytest.mark.parametrize("bins", [1, 2, 16, 300])
def test_any_number_of_buckets_is_exact(sample, bins):
    data, df = sample
    got = auc(df, "label", "score", bins=bins).first().auc
    assert got == pytest.approx(brute_auc([(s, y) for _, y, s in data]), abs=1e-12)


def test_rows_without_score_label_or_prediction_are_counted(spark):
    rows = [(1.0, 0.9, 1.0), (0.0, 0.1, 0.0), (None, 0.5, 1.0), (2.0, 0.5, 1.0), (1.0, None, 1.0), (0.0, 0.3, None)]
    df = spark.createDataFrame(rows, "label double, score double, prediction double")
    r = auc(df).first()
    assert (r.n_rows, r.n_dropped, r.auc) == (3, 3, 1.0)
    m = binary_metrics(df).first()
    assert (m.n_rows, m.n_dropped, m.auc, m.balanced_accuracy) == (2, 4, 1.0, 1.0)
    b = balanced_accuracy(df).first()
    assert (b.n_rows, b.n_dropped) == (3, 3)


def test_groups_of_any_key_and_ties_across_batches(spark):
    """One score over many Arrow batches and ranges, null and text keys, nan and signed zeros."""
    from pyspark.sql import functions as F

    rows = spark.range(0, 6000, 1, 5).select(
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("g"), F.col("id") % 3)).alias("g"),
        (F.col("id") % 7).cast("int").alias("h"),
        F.when(F.col("id") % 2 == 0, 0.5).when(F.col("id") % 5 == 0, F.lit("NaN").cast("double")).when(F.col("id") % 11 == 0, -0.0).when(F.col("id") % 13 == 0, 0.0).otherwise((F.col("id") % 101) / 100).alias("score"),
        (F.xxhash64("id") % 2 != 0).cast("double").alias("label"),
    )
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    try:
        got = {(r.g, r.h): r for r in auc(rows, "label", "score", by=["g", "h"], bins=9).collect()}
        whole = auc(rows, "label", "score").first()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    data = [(r.g, r.h, float("inf") if r.score != r.score else r.score + 0.0, r.label) for r in rows.collect()]

    def brute(some):
        pos, neg = [s for *_, s, y in some if y], [s for *_, s, y in some if not y]
        return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))

    assert len(got) == 21 and abs(whole.auc - brute(data)) < 1e-12
    for (g, h), r in got.items():
        own = [d for d in data if d[:2] == (g, h)]
        assert r.n_rows == len(own) and abs(r.auc - brute(own)) < 1e-12
