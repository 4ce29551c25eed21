"""The SVM by planes and the optimality certificate."""

from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from linclass import enet_job, logistic_job, svm_job
from linclass.operators import svm
from linclass.operators.certificate import logistic_residual
from linclass.operators.sgd import NullRowsError


@pytest.fixture(scope="module")
def data(spark):
    r = np.random.default_rng(4)
    x = r.normal(size=(1500, 4)) * [1, 1, 3, 1]
    y = (x @ [1.0, -2.0, 0.3, 0.0] + r.normal(size=1500) * 2 > 0).astype(float)
    rows = spark.createDataFrame([(float(b), *map(float, a), k) for k, (a, b) in enumerate(zip(x, y, strict=True))], "y double, a double, b double, c double, d double, id long").repartition(3)
    rows.persist().count()
    return rows, x, y


def objective(x, y, w, penalty, reg):
    loss = np.maximum(0, 1 - (2 * y - 1) * (x @ w)).mean()
    return loss + {"l1": reg * np.abs(w).sum(), "l2": reg / 2 * w @ w, "none": 0.0}[penalty]


@pytest.mark.parametrize(("penalty", "reg"), [("l2", 0.01), ("l1", 0.05), ("none", 0.3)])
def test_no_other_weights_are_better_than_the_gap_allows(data, penalty, reg):
    rows, x, y = data
    model, trace = svm.bundle_fit(rows, ["a", "b", "c", "d"], "y", penalty, reg, tol=1e-7)
    w = np.array(model.weights)
    assert trace.converged and trace.rows == 1500 and trace.gap <= 1e-7 * trace.objective
    assert trace.objective == pytest.approx(objective(x, y, w, penalty, reg), abs=1e-12)
    r = np.random.default_rng(5)
    for size in (1e-3, 1e-2, 0.1, 1.0):
        others = w + size * r.normal(size=(300, 4))
        assert min(objective(x, y, v, penalty, reg) for v in others) >= trace.bound - 1e-12
    if penalty == "l1":
        assert (w == 0).any()


@pytest.mark.parametrize(("l1", "l2"), [(0.0, 0.0), (0.2, 0.0), (0.0, 0.5)])
def test_the_model_of_planes_is_solved(l1, l2):
    r = np.random.default_rng(6)
    slopes, offsets, centre = r.normal(size=(12, 5)), r.random(12), r.normal(size=5)
    cost = lambda w: (offsets + slopes @ w).max() + l1 * np.abs(w).sum() + l2 / 2 * w @ w + 0.35 * ((w - centre) ** 2).sum()
    share, w = svm.solve_model(slopes, offsets, centre, 0.7, l1, l2)
    assert share.min() >= 0 and share.sum() == pytest.approx(1)
    dual = share @ (offsets + slopes @ w) + l1 * np.abs(w).sum() + l2 / 2 * w @ w + 0.35 * ((w - centre) ** 2).sum()
    assert cost(w) - dual < 1e-9
    assert all(cost(w + d) > cost(w) - 1e-9 for d in r.normal(size=(200, 5)) * 0.01)


def test_edges(spark, data):
    rows, _, _ = data
    assert svm.bundle_fit(rows.where("id < 0"), ["a"], "y")[1].rows == 0
    with pytest.raises(NullRowsError):
        svm.bundle_fit(rows.withColumn("a", F.when(F.col("id") > 5, F.col("a"))), ["a"], "y")
    with pytest.raises(ValueError, match="penalty"):
        svm.bundle_fit(rows, ["a"], "y", penalty="l3")
    few = svm.bundle_fit(rows, ["a", "b"], "y", "l1", 0.01, passes=2)[1]
    assert few.passes == 2 and not few.converged and few.gap > 0


def test_residual_is_zero_at_the_optimum_only(data):
    rows, x, y = data
    z = (x[:, :1] - 0) / x[:, 0].std(ddof=1)
    w, b = 0.0, 0.0
    for _ in range(60):  # Newton steps of the ridge fit of one standardised feature
        q = 1 / (1 + np.exp(-(z[:, 0] * w + b)))
        g = np.array([(z[:, 0] @ (q - y)) / 1500 + 0.1 * w, (q - y).mean()])
        h = np.array([[(z[:, 0] ** 2 @ (q * (1 - q))) / 1500 + 0.1, (z[:, 0] @ (q * (1 - q))) / 1500], [(z[:, 0] @ (q * (1 - q))) / 1500, (q * (1 - q)).mean()]])
        w, b = np.array([w, b]) - np.linalg.solve(h, g)
    own = w / x[:, 0].std(ddof=1)
    assert logistic_residual(rows, ["a"], [own], b, "y", l2=0.1) < 1e-10
    assert logistic_residual(rows, ["a"], [own + 0.1], b, "y", l2=0.1) > 1e-3
    assert logistic_residual(rows, ["a"], [0.0], float(np.log(y.mean() / (1 - y.mean()))), "y", l1=10.0) < 1e-10
    assert logistic_residual(rows.where("id < 0"), ["a"], [0.0], 0.0, "y") is None


def test_jobs_record_how_they_ended(spark, data):
    rows, _, _ = data
    own = {"target": "y", "excluded": ["id"], "key": "id", "save": False}
    end = lambda res: json.loads(res.run.first()["parameters"])
    l1 = end(svm_job(spark, rows, penalty="l1", reg=0.02, **own))
    assert l1["mode"] == "converged" and l1["converged"] and 0 <= l1["optimality"] < 1e-5 and l1["iterations_run"] > 2
    ten = end(enet_job(spark, rows, reg=0.01, mix=0.5, **own))
    assert ten["iterations_run"] <= 10 and ten["optimality"] >= 0
    whole = end(logistic_job(spark, rows, penalty="none", **own))
    assert whole["converged"] and whole["optimality"] < 1e-4
    steps = end(logistic_job(spark, rows, penalty="l1", mode="sgd", reg=0.01, iterations=5, **own))
    assert steps["iterations_run"] == 5 and not steps["converged"] and steps["optimality"] > 0
    assert end(svm_job(spark, rows, **own))["optimality"] is None
    with pytest.raises(ValueError, match="mode"):
        svm_job(spark, rows, mode="quick", **own)
