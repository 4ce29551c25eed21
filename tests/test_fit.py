"""Trainers: gradient-descent rules against a NumPy imitation, closed forms, save / load."""

from __future__ import annotations

import math

import numpy as np
import pytest
from conftest import SF01
from pyspark.sql import functions as F

from linclass.operators.fit import coefficients, fit_pipeline, logistic_pipeline, penalised_logistic
from linclass.operators.linear import LinearModel
from linclass.operators.score import score
from linclass.operators.sgd import sgd_fit
from linclass.sources.models import load_model, save_model


def numpy_sgd(x, y, loss, penalty, reg, iters, intercept, tol=0.001):
    n, d = x.shape
    if intercept:
        x = np.column_stack([x, np.ones(n)])
    w = np.zeros(x.shape[1])
    if intercept:
        w[-1] = 1.0
    prev = None
    for t in range(1, iters + 1):
        m = x @ w
        if loss == "logistic":
            mult = 1.0 / (1.0 + np.exp(-m)) - y
        else:
            s = 2 * y - 1
            mult = np.where(s * m < 1.0, -s, 0.0)
        g = mult @ x / n
        st = 1.0 / math.sqrt(t)
        if penalty == "l2":
            w = w * (1 - st * reg) - st * g
        else:
            w = w - st * g
            if penalty == "l1":
                w = np.sign(w) * np.maximum(0.0, np.abs(w) - reg * st)
        if prev is not None and np.linalg.norm(w - prev) < tol * max(np.linalg.norm(w), 1.0):
            break
        prev = w.copy()
    return w


@pytest.fixture(scope="module")
def small(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 3))
    y = (x @ np.array([1.0, -2.0, 0.5]) + rng.normal(size=400) > 0).astype(float)
    df = spark.createDataFrame([(float(a), float(b), float(c), float(t)) for (a, b, c), t in zip(x, y)], "a double, b double, c double, label double")
    return x, y, df


@pytest.mark.parametrize(
    "loss,penalty,intercept",
    [("logistic", "l2", True), ("logistic", "l1", True), ("logistic", "none", True), ("hinge", "l2", False), ("hinge", "l1", False)],
)
def test_sgd_matches_numpy(small, loss, penalty, intercept):
    x, y, df = small
    model, trace = sgd_fit(df, ["a", "b", "c"], "label", loss, penalty, 0.01, 30, intercept=intercept)
    ref = numpy_sgd(x, y, loss, penalty, 0.01, 30, intercept)
    got = np.array(model.weights + ([model.intercept] if intercept else []))
    assert np.max(np.abs(got - ref)) < 1e-9
    assert trace.rows == 400


def test_sgd_l1_large_lambda_zeroes_all(small):
    _, _, df = small
    model, _ = sgd_fit(df, ["a", "b", "c"], "label", "logistic", "l1", 10.0, 20)
    assert model.weights == [0.0, 0.0, 0.0] and model.intercept == 0.0


def test_closed_form_logistic_one_binary_feature(spark):
    od = spark.read.parquet(f"{SF01}/orders.parquet").select(
        (F.col("o_orderstatus") == "F").cast("double").alias("label"),
        (F.col("o_orderpriority") == "1-URGENT").cast("double").alias("x"),
    )
    c = {(r.x, r.label): r["count"] for r in od.groupBy("x", "label").count().collect()}
    odds1 = c[(1.0, 1.0)] / c[(1.0, 0.0)]
    odds0 = c[(0.0, 1.0)] / c[(0.0, 0.0)]
    w, b = coefficients(fit_pipeline(penalised_logistic(["x"], "none", tol=1e-12), od))
    assert w[0] == pytest.approx(math.log(odds1 / odds0), abs=1e-6)
    assert b == pytest.approx(math.log(odds0), abs=1e-6)


def test_heavy_penalty_leaves_log_odds_intercept(spark):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet").select(
        (F.col("l_returnflag") == "R").cast("double").alias("label"), "l_quantity", "l_tax"
    )
    p = li.agg(F.avg("label")).first()[0]
    w, b = coefficients(fit_pipeline(logistic_pipeline(["l_quantity", "l_tax"], reg=0.5, elastic_net=1.0, max_iter=10), li))
    assert w == [0.0, 0.0]
    assert b == pytest.approx(math.log(p / (1 - p)), abs=1e-12)


def test_save_load_same_scores(spark, workdir, small):
    _, _, df = small
    pipe_model = fit_pipeline(logistic_pipeline(["a", "b", "c"], reg=0.01, elastic_net=0.5), df)
    sgd_model, _ = sgd_fit(df, ["a", "b", "c"], "label", "hinge", "l2", 0.01, 10, intercept=False)
    sgd_model.means, sgd_model.stds = [0.1, 0.2, 0.3], [1.0, 2.0, 0.0]
    for i, model in enumerate([pipe_model, sgd_model]):
        path = save_model(model, f"{workdir}/m{i}", spark)
        loaded = load_model(spark, path)
        a = score(model, df).select("margin", "prediction").collect()
        b = score(loaded, df).select("margin", "prediction").collect()
        assert a == b


def test_linear_model_scoring_rules(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,)], "x double")
    lg = LinearModel(["x"], [2.0], -2.0, "logistic").transform(df).orderBy("x").collect()
    assert [r.prediction for r in lg] == [0.0, 0.0, 1.0]  # probability 0.5 is not above 0.5
    assert lg[1].probability == pytest.approx(0.5)
    hg = LinearModel(["x"], [1.0], -1.0, "hinge").transform(df).orderBy("x").collect()
    assert [r.prediction for r in hg] == [0.0, 0.0, 1.0]


@pytest.mark.parametrize(
    "loss,penalty", [("logistic", "l2"), ("logistic", "l1"), ("logistic", "none"), ("hinge", "l2"), ("hinge", "l1")]
)
def test_sgd_matches_spark_library_trainers(spark, small, loss, penalty):
    """Same numbers as the RDD trainers the reference calls (intercept only for logistic)."""
    import warnings

    from pyspark.mllib.classification import LogisticRegressionWithSGD, SVMWithSGD
    from pyspark.mllib.regression import LabeledPoint

    x, y, df = small
    rdd = spark.sparkContext.parallelize([LabeledPoint(t, row.tolist()) for row, t in zip(x, y)], 4)
    reg_type = None if penalty == "none" else penalty
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        if loss == "logistic":
            lib = LogisticRegressionWithSGD.train(rdd, iterations=40, regParam=0.01, regType=reg_type, intercept=True)
        else:
            lib = SVMWithSGD.train(rdd, iterations=40, regParam=0.01, regType=reg_type)
    model, _ = sgd_fit(df, ["a", "b", "c"], "label", loss, penalty, 0.01, 40, intercept=(loss == "logistic"))
    assert np.max(np.abs(np.array(model.weights) - lib.weights.toArray())) < 1e-9
    assert model.intercept == pytest.approx(lib.intercept, abs=1e-9)


def test_scaled_svm_matches_library_flow(spark, small):
    """The SVM job's steps (train statistics, standardise, 100 hinge steps, no intercept)
    against mllib's StandardScaler + SVMWithSGD on the same rows."""
    from pyspark.mllib.classification import SVMWithSGD
    from pyspark.mllib.feature import StandardScaler as OldScaler
    from pyspark.mllib.regression import LabeledPoint

    from linclass.operators.scale import fit_scaler, scaled_expr

    x, y, df = small
    x = x * np.array([10.0, 0.1, 3.0]) + np.array([5.0, -1.0, 0.0])
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, c double, label double")
    feats = spark.sparkContext.parallelize([r.tolist() for r in x], 3)
    labels = spark.sparkContext.parallelize(y.tolist(), 3)
    scaler = OldScaler(withMean=True, withStd=True).fit(feats)
    rdd = labels.zip(scaler.transform(feats)).map(lambda p: LabeledPoint(p[0], p[1]))
    lib = SVMWithSGD.train(rdd, iterations=100)

    stats = fit_scaler(df, ["a", "b", "c"])
    inputs = [scaled_expr(stats, i) for i in range(3)]
    model, _ = sgd_fit(df, ["a", "b", "c"], "label", "hinge", "l2", 0.01, 100, intercept=False, inputs=inputs)
    assert np.max(np.abs(np.array(model.weights) - lib.weights.toArray())) < 1e-9


@pytest.mark.parametrize("kind", ["logistic", "svm", "svm_unscaled"])
def test_expression_scoring_equals_spark_transform(spark, small, kind):
    from linclass.operators.fit import svm_pipeline
    from linclass.operators.score import linear_view

    _, _, df = small
    if kind == "logistic":
        pipe = logistic_pipeline(["a", "b", "c"], reg=0.01, elastic_net=0.3)
    else:
        pipe = svm_pipeline(["a", "b", "c"], reg=0.01, scale=(kind == "svm"))
    model = fit_pipeline(pipe, df)
    assert linear_view(model) is not None
    fast = score(model, df).select("margin", "prediction", *(["probability"] if kind == "logistic" else [])).collect()
    slow = score(model, df, native=False).select("margin", "prediction", *(["probability"] if kind == "logistic" else [])).collect()
    for f, s_ in zip(fast, slow):
        assert f.margin == pytest.approx(s_.margin, abs=1e-12) and f.prediction == s_.prediction
        if kind == "logistic":
            assert f.probability == pytest.approx(s_.probability, abs=1e-12)


def test_ml_transform_still_works_after_sgd_fit(spark, small):
    """A gradient-descent fit must leave the session able to run Spark ML transforms of
    models that keep their training summary."""
    _, _, df = small
    model = fit_pipeline(logistic_pipeline(["a", "b", "c"], reg=0.01), df)
    sgd_fit(df, ["a", "b", "c"], "label", "logistic", "l2", 0.01, 3)
    assert score(model, df, native=False).count() == df.count()


def test_sgd_leaves_session_untouched(spark, small):
    _, _, df = small
    db = spark.conf.get("spark.sql.globalTempDatabase", "global_temp")
    before = {t.name for t in spark.catalog.listTables(db)}
    aqe = spark.conf.get("spark.sql.adaptive.enabled")
    sgd_fit(df, ["a", "b", "c"], "label", "logistic", "l2", 0.01, 3)
    sgd_fit(df, ["a", "b", "c"], "label", "logistic", "l2", 0.01, 3)
    assert {t.name for t in spark.catalog.listTables(db)} == before
    assert spark.conf.get("spark.sql.adaptive.enabled") == aqe
