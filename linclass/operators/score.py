"""Scoring: one call for pipeline models and weight models alike.

The result keeps the input columns and adds ``margin`` (w.x + b), ``probability`` (logistic
models) and ``prediction`` (0.0 / 1.0) as plain doubles. Scoring is a projection, so
filters and column pruning of the input still reach the scan.

A fitted pipeline of the shapes this package builds - assembler, optional standard
scaler, binomial logistic regression or linear SVM - is scored through its weights as
plain column expressions (one whole-stage-codegen projection: no per-row vector, no model
UDF), with the model's own threshold. Margins equal Spark ML's ``transform`` up to
floating-point summation order (about 1e-16). Any other pipeline goes through
``transform``. Unlike the assembler, the expression path does not raise on a null or NaN
input: the row gets a null / NaN margin (the data checks catch such rows first).
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LinearSVCModel, LogisticRegressionModel
from pyspark.ml.feature import StandardScalerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linclass.operators.linear import LinearModel


def linear_view(model: PipelineModel) -> LinearModel | None:
    """The pipeline's scoring rule as a weight model, or None for another shape."""
    stages = list(model.stages)
    if len(stages) not in (2, 3) or not isinstance(stages[0], VectorAssembler):
        return None
    last = stages[-1]
    if isinstance(last, LogisticRegressionModel):
        if last.numClasses != 2 or last.isSet(last.thresholds):
            return None
        loss, threshold = "logistic", float(last.getThreshold())
    elif isinstance(last, LinearSVCModel):
        loss, threshold = "hinge", float(last.getThreshold())
    else:
        return None
    features = list(stages[0].getInputCols())
    means = stds = None
    if len(stages) == 3:
        scaler = stages[1]
        if not isinstance(scaler, StandardScalerModel):
            return None
        d = len(features)
        means = [float(v) for v in scaler.mean.toArray()] if scaler.getWithMean() else [0.0] * d
        stds = [float(v) for v in scaler.std.toArray()] if scaler.getWithStd() else [1.0] * d
    return LinearModel(
        features=features,
        weights=[float(v) for v in last.coefficients.toArray()],
        intercept=float(last.intercept),
        loss=loss,
        threshold=threshold,
        means=means,
        stds=stds,
    )


def score(model, df: DataFrame, native: bool = True) -> DataFrame:
    """Add ``margin``, ``probability`` (logistic) and ``prediction``.

    ``native=False`` forces Spark ML's ``transform`` for a pipeline model.
    """
    if isinstance(model, LinearModel):
        return model.transform(df)
    if not isinstance(model, PipelineModel):
        raise TypeError(f"cannot score with {type(model).__name__}")
    view = linear_view(model) if native else None
    if view is not None:
        return view.transform(df)
    out = model.transform(df)
    out = out.withColumn("margin", vector_to_array(F.col("rawPrediction"))[1])
    if isinstance(model.stages[-1], LogisticRegressionModel):
        out = out.withColumn("probability", vector_to_array(F.col("probability"))[1])
    drop = [c for c in ("features", "raw_features", "rawPrediction") if c in out.columns]
    return out.drop(*drop)
