"""Coefficient table and run record as DataFrames.

The coefficient table has d + 1 rows (the features and ``Intercept``): its size is the
model's, not the data's, and the values are already on the driver, so they are ranked
there: largest coefficient first, the variable name breaking ties, flagged non-zero.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTERCEPT = "Intercept"

COEFFICIENT_SCHEMA = T.StructType(
    [T.StructField("variable", T.StringType(), False), T.StructField("coefficient", T.DoubleType(), False)]
)


def coefficient_frame(
    spark: SparkSession, features: Sequence[str], weights: Sequence[float], intercept: float | None
) -> DataFrame:
    """DataFrame[variable, coefficient]: one row per feature, plus ``Intercept``."""
    if len(features) != len(weights):
        raise ValueError(f"{len(features)} names against {len(weights)} weights")
    rows = [(n, float(w)) for n, w in zip(features, weights)]
    if intercept is not None:
        rows.append((INTERCEPT, float(intercept)))
    return spark.createDataFrame(rows, COEFFICIENT_SCHEMA)


REPORT_SCHEMA = T.StructType(
    [
        *COEFFICIENT_SCHEMA.fields,
        T.StructField("is_nonzero", T.BooleanType(), False),
        T.StructField("rank", T.LongType(), False),
    ]
)


def coefficient_table(
    spark: SparkSession, features: Sequence[str], weights: Sequence[float], intercept: float | None
) -> DataFrame:
    """DataFrame[variable, coefficient, is_nonzero, rank]: rank 1 = largest coefficient,
    the name breaking ties; ``Intercept`` is ranked with the rest.

    The d + 1 model parameters are already on the driver, so they are ranked there.
    """
    if len(features) != len(weights):
        raise ValueError(f"{len(features)} names against {len(weights)} weights")
    pairs = [(n, float(w)) for n, w in zip(features, weights)]
    if intercept is not None:
        pairs.append((INTERCEPT, float(intercept)))
    ordered = sorted(pairs, key=lambda p: (-p[1], p[0]))
    rows = [(n, w, w != 0.0, i + 1) for i, (n, w) in enumerate(ordered)]
    return spark.createDataFrame(rows, REPORT_SCHEMA)


RUN_SCHEMA = T.StructType(
    [
        T.StructField("job", T.StringType()),
        T.StructField("input", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("columns", T.IntegerType()),
        T.StructField("target", T.StringType()),
        T.StructField("excluded", T.ArrayType(T.StringType())),
        T.StructField("started_at", T.StringType()),
        T.StructField("finished_at", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("penalty", T.StringType()),
        T.StructField("parameters", T.StringType()),
        T.StructField("model_path", T.StringType()),
        T.StructField("train_rows", T.LongType()),
        T.StructField("test_rows", T.LongType()),
        T.StructField("auc_train", T.DoubleType()),
        T.StructField("auc_test", T.DoubleType()),
        T.StructField("balanced_accuracy_train", T.DoubleType()),
        T.StructField("balanced_accuracy_test", T.DoubleType()),
        T.StructField("split_ratio", T.ArrayType(T.DoubleType())),
        T.StructField("n_nonzero", T.LongType()),
        T.StructField("checks_failed", T.ArrayType(T.StringType())),
    ]
)


def run_record(spark: SparkSession, fields: Mapping) -> DataFrame:
    """One-row DataFrame of the run (parameters as a JSON text)."""
    values = dict(fields)
    if isinstance(values.get("parameters"), Mapping):
        values["parameters"] = json.dumps(values["parameters"], sort_keys=True)
    row = tuple(values.get(f.name) for f in RUN_SCHEMA.fields)
    return spark.createDataFrame([row], RUN_SCHEMA)
