"""Training rows as packed blocks: what passes over a matrix read again and again.

A block is one row that holds the labels and the features of up to an Arrow batch of samples as
two packed arrays of doubles. A pass over cached blocks converts no rows: each task maps the
bytes as a NumPy matrix. Rows with a null label or feature are left out and counted.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linclass.functions.expressions import col

BLOCKS = "n long, n_null long, y binary, x binary"


def _pack(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        y, rows = batch.column("y"), batch.column("x")
        x = rows.flatten()
        bad = np.zeros(batch.num_rows, bool)
        if y.null_count or x.null_count:
            bad |= y.is_null().to_numpy(zero_copy_only=False)
            bad |= x.is_null().to_numpy(zero_copy_only=False).reshape(-1, d).any(1) if d else False
            y, x = y.fill_null(0.0), x.fill_null(0.0)
        matrix = x.to_numpy(zero_copy_only=False).reshape(batch.num_rows, d)[~bad]
        label = y.to_numpy(zero_copy_only=False)[~bad]
        yield pa.RecordBatch.from_arrays(
            [pa.array([len(label)], pa.int64()), pa.array([int(bad.sum())], pa.int64()), pa.array([label.tobytes()], pa.binary()), pa.array([matrix.tobytes()], pa.binary())], names=["n", "n_null", "y", "x"]
        )


def packed_blocks(rows: DataFrame, inputs: Sequence[str | Column], label: str) -> DataFrame:
    """Blocks of ``label`` and ``inputs`` (columns or expressions) of each row."""
    x = F.array(*[col(c).cast("double") for c in inputs]) if len(inputs) else F.array().cast("array<double>")
    return rows.select(col(label).cast("double").alias("y"), x.alias("x")).mapInArrow(lambda b, d=len(inputs): _pack(b, d), BLOCKS)


def matrices(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Label vector and feature matrix of each block, without a copy."""
    for batch in batches:
        y, x = batch.column("y"), batch.column("x")
        for k in range(batch.num_rows):
            label = np.frombuffer(y[k].as_buffer(), np.float64)
            yield label, np.frombuffer(x[k].as_buffer(), np.float64).reshape(len(label), d)


def block_sums(blocks: DataFrame, d: int, size: int, add: Callable[[np.ndarray, np.ndarray, np.ndarray], None]) -> DataFrame:
    """DataFrame[i, s]: vectors of ``size`` numbers summed over all blocks. ``add(total, y, x)``
    adds those of a block; a task gives one partial vector, which a shuffle of ``size`` rows a
    task sums by index."""

    def part(batches):
        total = np.zeros(size)
        for y, x in matrices(batches, d):
            add(total, y, x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], names=["i", "s"])

    return blocks.select("y", "x").mapInArrow(part, "i int, s double").groupBy("i").agg(F.sum("s").alias("s"))


def collect_vector(sums: DataFrame, size: int) -> np.ndarray:
    out = np.zeros(size)
    for r in sums.collect():
        out[r["i"]] = r["s"]
    return out


def loop_frame(data: DataFrame) -> tuple[DataFrame, Callable[[], None]]:
    """Cached rows as seen from a sibling session made for repeated passes: the caller's
    settings, but adaptive execution off (there is nothing to re-plan, and it would split
    every pass into two jobs) and one reducer for the sums.

    The sibling shares the SparkContext and the cache, so the caller's session stays as it
    is. Returns (frame, cleanup); a session kind without siblings gives ``data`` itself.
    """
    spark = data.sparkSession
    if not hasattr(spark, "_jsparkSession"):
        return data, lambda: None
    name = f"linclass_blocks_{uuid.uuid4().hex}"
    data.createOrReplaceGlobalTempView(name)
    try:
        loop = spark.newSession()
        for key, value in spark.conf.getAll.items():
            if spark.conf.isModifiable(key):
                loop.conf.set(key, value)
        loop.conf.set("spark.sql.adaptive.enabled", "false")
        loop.conf.set("spark.sql.shuffle.partitions", "1")
        return loop.table(f"{spark.conf.get('spark.sql.globalTempDatabase', 'global_temp')}.{name}"), lambda: loop.catalog.dropGlobalTempView(name)
    except BaseException:
        spark.catalog.dropGlobalTempView(name)
        raise
