"""Standardisation with train statistics, column form: (x - mean) / sample std.

One pass over the train fold gives count, mean and sum of squared deviations of every feature.
The features of a row travel as one array; each task keeps three vectors and merges the blocks
it sees into them, and vectors of tasks are merged the same way, a stretch of ``STRETCH``
features by a reducer. So the plan is the same for any number of features, the merge is
numerically stable, and no task holds more than its vectors. The driver gets d means and
d sample standard deviations, which are applied as literals: the transform is a plain
projection inside codegen with no join. Nulls are left out feature by feature. A column with
zero variance scales to 0.0, as Spark ML's ``StandardScaler`` does. Pipelines on vectors use
``pyspark.ml.feature.StandardScaler`` instead (see ``fit.svm_pipeline``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linclass.functions.expressions import col

#: Features whose vectors of all tasks one reducer merges.
STRETCH = 512
MOMENTS = "stretch int, n binary, mean binary, m2 binary"


@dataclass(frozen=True)
class ScalerStats:
    features: list[str]
    means: list[float]
    stds: list[float]

    def inverse_stds(self) -> list[float]:
        return [1.0 / s if s not in (0.0, None) and s == s else 0.0 for s in self.stds]


def merge_moments(a: tuple, b: tuple) -> tuple:
    """Count, mean and sum of squared deviations of two sets of values, from those of either."""
    n = a[0] + b[0]
    share = np.divide(b[0], n, out=np.zeros(len(n)), where=n > 0)
    with np.errstate(invalid="ignore"):
        step = np.where((a[0] > 0) & (b[0] > 0), b[1] - a[1], 0.0)
        mean = np.where(a[0] > 0, a[1] + step * share, b[1])
        return n, mean, a[2] + b[2] + step * step * a[0] * share


def _moments(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[pa.RecordBatch]:
    """The three vectors of a task's rows, cut into stretches."""
    total = tuple(np.zeros((3, d)))
    for batch in batches:
        x = batch.column("x").flatten()
        value = x.to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, d)
        given = x.is_valid().to_numpy(zero_copy_only=False).reshape(batch.num_rows, d) if x.null_count else np.ones_like(value, bool)
        n = given.sum(0).astype(np.float64)
        with np.errstate(invalid="ignore", over="ignore"):
            mean = np.where(given, value, 0.0).sum(0) / np.maximum(n, 1)
            off = np.where(given, value - mean, 0.0)
            rest = off.sum(0) / np.maximum(n, 1)  # what rounding left of the mean
            total = merge_moments(total, (n, mean + rest, (off * off).sum(0) - rest * rest * n))
    for k in range(0, d, STRETCH):
        yield _stretch(k // STRETCH, [v[k : k + STRETCH] for v in total])


def _stretch(k: int, vectors: Sequence[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), *(pa.array([v.tobytes()], pa.binary()) for v in vectors)], names=["stretch", "n", "mean", "m2"])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of all tasks, merged."""
    held: dict[int, tuple] = {}
    for batch in batches:
        for r in batch.to_pylist():
            new = tuple(np.frombuffer(r[c], np.float64) for c in ("n", "mean", "m2"))
            held[r["stretch"]] = merge_moments(held[r["stretch"]], new) if r["stretch"] in held else new
    for k, (n, mean, m2) in held.items():
        with np.errstate(invalid="ignore", divide="ignore"):
            std = np.sqrt(m2 / (n - 1))
        number = np.arange(len(n), dtype=np.int32) + k * STRETCH
        yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(n.astype(np.int64)), pa.array(mean, mask=n == 0), pa.array(std, mask=n < 2)], names=["i", "n", "mean", "std"])


def moments_frame(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """DataFrame[i, n, mean, std]: number of values, mean and sample standard deviation of each
    feature; a feature without values has no mean, one with a single value no deviation."""
    d = len(features)
    rows = df.select(F.array(*[col(c).cast("double") for c in features]).alias("x"))
    parts = rows.mapInArrow(lambda b: _moments(b, d), MOMENTS)
    return parts.repartition("stretch").sortWithinPartitions("stretch", "n", "mean", "m2").mapInArrow(_merged, "i int, n long, mean double, std double")


def scaler_stats_frame(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """DataFrame[feature, mean, std]: one pass, one row per feature."""
    names = F.array(*map(F.lit, features)) if features else F.array().cast("array<string>")
    return moments_frame(df, features).select(F.get(names, F.col("i")).alias("feature"), "mean", "std")


def fit_scaler(df: DataFrame, features: Sequence[str]) -> ScalerStats:
    """Train means and sample standard deviations (one job, 2d numbers to the driver)."""
    features = list(features)
    means, stds = [0.0] * len(features), [0.0] * len(features)
    for r in moments_frame(df, features).collect() if features else ():
        means[r["i"]] = 0.0 if r["mean"] is None else r["mean"]
        stds[r["i"]] = 0.0 if r["std"] is None else r["std"]
    return ScalerStats(features, means, stds)


def scaled_expr(stats: ScalerStats, i: int):
    c = stats.features[i]
    inv = stats.inverse_stds()[i]
    return (col(c).cast("double") - F.lit(stats.means[i])) * F.lit(inv)


def apply_scaler(df: DataFrame, stats: ScalerStats, prefix: str = "") -> DataFrame:
    """Replace (or add, with ``prefix``) each feature by its standardised value."""
    scaled = {prefix + c: scaled_expr(stats, i).alias(prefix + c) for i, c in enumerate(stats.features)}
    kept = [scaled.pop(c) if c in scaled else col(c) for c in df.columns]
    return df.select(*kept, *scaled.values())
