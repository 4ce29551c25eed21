"""Packed blocks and what is summed over them."""

from __future__ import annotations

import math
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linclass.operators import blocks, scale
from linclass.operators.scale import ScalerStats, fit_scaler, merge_moments, moments_frame


def test_blocks_hold_all_whole_rows(spark):
    data = [(k, float(k % 2) if k % 10 else None, k / 3, -k * 1.0 if k % 7 else None) for k in range(500)]
    rows = spark.createDataFrame(data, "id long, y double, a double, b double").repartition(3)
    packed = blocks.packed_blocks(rows, ["a", F.col("b") * 2], "y")
    got = sorted((y, *x) for r in packed.collect() for y, x in zip(np.frombuffer(r.y), np.frombuffer(r.x).reshape(-1, 2), strict=True))
    assert got == sorted((y, a, 2 * b) for _, y, a, b in data if y is not None and b is not None)
    assert packed.agg(F.sum("n"), F.sum("n_null")).first() == (len(got), 500 - len(got))


def test_sums_over_blocks_and_over_none(spark):
    rows = spark.range(1000).select((F.col("id") % 2).alias("y"), F.col("id").cast("double").alias("a"))

    def add(total, y, x):
        total += [len(y), y.sum(), x.sum()]

    sums = lambda df: blocks.collect_vector(blocks.block_sums(blocks.packed_blocks(df, ["a"], "y"), 1, 3, add), 3).tolist()
    assert sums(rows) == [1000, 500, 499_500] and sums(rows.where("a < 0")) == [0, 0, 0]


def test_a_loop_frame_leaves_the_session_as_it_is(spark):
    data = blocks.packed_blocks(spark.range(10).select("id"), ["id"], "id").persist()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    frame, release = blocks.loop_frame(data)
    assert frame.sparkSession.conf.get("spark.sql.shuffle.partitions") == "1" and frame.agg(F.sum("n")).first()[0] == 10
    release()
    data.unpersist()
    assert spark.conf.get("spark.sql.shuffle.partitions") == before and not spark.catalog.listTables("global_temp")


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.floats(-1e6, 1e6), max_size=12), min_size=1, max_size=5))
def test_merged_moments_are_those_of_all_values(parts):
    total = tuple(np.zeros((3, 1)))
    for p in parts:
        v = np.array(p)
        m = v.mean() if p else 0.0
        total = merge_moments(total, (np.array([float(len(p))]), np.array([m]), np.array([((v - m) ** 2).sum()])))
    flat = np.array([x for p in parts for x in p])
    assert total[0][0] == len(flat)
    if len(flat):
        assert total[1][0] == pytest.approx(flat.mean(), abs=1e-6) and total[2][0] == pytest.approx(((flat - flat.mean()) ** 2).sum(), rel=1e-6, abs=1e-3)


def test_moments_leave_nulls_out_and_keep_small_spreads(spark, monkeypatch):
    data = [(None, 5.0, 1e9 + k % 3, None if k else 2.0, float("nan") if k == 3 else 1.0) for k in range(40)]
    rows = spark.createDataFrame(data, "none double, same double, shifted double, one double, nan double").repartition(4)
    for stretch in (512, 2):
        monkeypatch.setattr(scale, "STRETCH", stretch)
        got = {r.i: r for r in moments_frame(rows, rows.columns).collect()}
        assert [got[k].n for k in range(5)] == [0, 40, 40, 1, 40]
        assert (got[0].mean, got[0].std, got[3].mean, got[3].std) == (None, None, 2.0, None)
        assert (got[1].mean, got[1].std) == (5.0, 0.0) and math.isnan(got[4].mean)
        assert got[2].std == pytest.approx(np.std([k % 3 for k in range(40)], ddof=1), rel=1e-7)  # a mean of 1e9 has 7 digits behind the point
    stats = fit_scaler(rows, ["same", "one"])
    assert (stats.means, stats.stds, stats.inverse_stds()) == ([5.0, 2.0], [0.0, 0.0], [0.0, 0.0])
    assert fit_scaler(rows, []) == ScalerStats([], [], [])
    assert fit_scaler(rows.where("same < 0"), ["same"]).stds == [0.0]


def test_a_thousand_features_take_seconds(spark):
    rows = spark.range(1000).select(*[(F.rand(k) * (k + 1) + 1e6).alias(f"f{k}") for k in range(1000)]).persist()
    rows.count()
    began = time.time()
    stats = fit_scaler(rows, rows.columns)
    assert time.time() - began < 20  # some 4 s on an idle machine
    assert stats.stds[999] == pytest.approx(1000 / 12**0.5, rel=0.05)
    rows.unpersist()
