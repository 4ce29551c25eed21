"""Built-in fits as Spark ML pipelines: assembler -> (scaler) -> estimator.

* ``logistic_pipeline``: ridge / lasso / elastic-net logistic regression (L-BFGS or
  OWL-QN in the JVM, one distributed aggregate per evaluation). ``family="binomial"`` is
  always set, so a label outside 0/1 can never turn the fit multinomial.
* ``svm_pipeline``: standardise with train statistics, then a linear SVM with an L2
  penalty and no intercept on the scaled features.

Training rows are persisted around the fit (iterative optimisers read them many times)
and released afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.feature import StandardScaler
from pyspark.sql import DataFrame

from linclass.operators.columns import FEATURES, LABEL, assembler

PENALTY_MIX = {"l2": 0.0, "l1": 1.0}


def logistic_pipeline(
    features: Sequence[str],
    reg: float = 0.01,
    elastic_net: float = 0.0,
    max_iter: int = 100,
    tol: float = 1e-6,
    standardization: bool = True,
    fit_intercept: bool = True,
    label: str = LABEL,
) -> Pipeline:
    lr = LogisticRegression(
        featuresCol=FEATURES,
        labelCol=label,
        family="binomial",
        maxIter=max_iter,
        regParam=reg,
        elasticNetParam=elastic_net,
        tol=tol,
        standardization=standardization,
        fitIntercept=fit_intercept,
    )
    return Pipeline(stages=[assembler(features), lr])


def penalised_logistic(features: Sequence[str], penalty: str = "l2", reg: float = 0.01, **kw) -> Pipeline:
    """Logistic regression with penalty 'l1', 'l2' or 'none' (lambda 0)."""
    if penalty == "none":
        return logistic_pipeline(features, reg=0.0, elastic_net=0.0, **kw)
    if penalty not in PENALTY_MIX:
        raise ValueError(f"penalty must be 'l1', 'l2' or 'none', got {penalty!r}")
    return logistic_pipeline(features, reg=reg, elastic_net=PENALTY_MIX[penalty], **kw)


def svm_pipeline(
    features: Sequence[str],
    reg: float = 0.01,
    max_iter: int = 100,
    tol: float = 1e-6,
    scale: bool = True,
    label: str = LABEL,
) -> Pipeline:
    svc = LinearSVC(
        featuresCol=FEATURES,
        labelCol=label,
        regParam=reg,
        maxIter=max_iter,
        tol=tol,
        fitIntercept=False,
        standardization=False,
    )
    if not scale:
        return Pipeline(stages=[assembler(features), svc])
    return Pipeline(
        stages=[
            assembler(features, output="raw_features"),
            StandardScaler(inputCol="raw_features", outputCol=FEATURES, withMean=True, withStd=True),
            svc,
        ]
    )


def fit_pipeline(pipeline: Pipeline, train: DataFrame, persist: bool = True) -> PipelineModel:
    data = train.persist(StorageLevel.MEMORY_AND_DISK) if persist else train
    try:
        return pipeline.fit(data)
    finally:
        if persist:
            data.unpersist()


def coefficients(model) -> tuple[list[float], float]:
    """(weights, intercept) of the last stage of a pipeline model, or of a LinearModel."""
    from linclass.operators.linear import LinearModel

    if isinstance(model, LinearModel):
        return list(model.weights), float(model.intercept)
    last = model.stages[-1]
    return [float(v) for v in last.coefficients.toArray()], float(last.intercept)
