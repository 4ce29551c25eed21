"""Dimensions, class profile and class counts: single aggregations (partial + final)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linclass.functions.expressions import col


def dimensions(df: DataFrame, n_columns: int | None = None) -> DataFrame:
    """One row: data rows and columns (all header columns, target and excluded included)."""
    n_cols = len(df.columns) if n_columns is None else n_columns
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(n_cols).alias("n_columns"))


def class_profile(df: DataFrame, label: str, column: str) -> DataFrame:
    """Mean, min and max of one column per class."""
    x = col(column)
    return df.groupBy(col(label).alias("class")).agg(
        F.avg(x).alias("mean"), F.min(x).alias("min"), F.max(x).alias("max")
    )


def class_counts(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per class (and per ``by`` group, e.g. the fold)."""
    return df.groupBy(*[col(b) for b in by], col(label).alias("class")).agg(F.count(F.lit(1)).alias("n"))
