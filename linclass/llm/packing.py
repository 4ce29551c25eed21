"""Optimal length buckets (operator 4).

Token lengths of all documents form one global histogram. Dynamic programming over it chooses
the bucket boundaries that minimise total padding (every document is padded to the boundary of
its bucket); batches of a fixed token budget then form inside each bucket.

The histogram has at most ``budget`` cells, because a document longer than the budget needs no
bucket: it is a batch of its own at its own length. Nothing is cut or dropped. Batches are
numbered inside salted parts of a bucket, so a bucket with a third of all rows is not one
task; each part may end with one batch that is not full.

Defined cases: null or empty text has the end id alone (length 1); null and repeated ids are
rows like others (ties in a batch are ordered by id, nulls first); an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linclass.llm.text import id_text, scratch_folder, slices, staged, tidy
from linclass.llm.tokenize import TOKENS, default_tokenizer, encoder

#: Rows in a salted part of a bucket, about.
PART_ROWS = 8192


@partial(tidy, kind=TOKENS)
def _lengths(batches: Iterator[pa.RecordBatch], tokenizer: str) -> Iterator[pa.RecordBatch]:
    coder = encoder(tokenizer)
    for rows, _, _ in slices(batches):
        n = [len(g) // 4 + 1 for g in coder.ids([t or "" for t in rows.column("text").to_pylist()])]
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(n, pa.int64())], names=["doc_id", "n_tokens"])
    coder.trim()


def token_lengths(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id`` and ``n_tokens`` (end id included) of every whole text."""
    return id_text(docs).mapInArrow(partial(_lengths, tokenizer=tokenizer), "doc_id long, n_tokens long")


def optimal_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets over ascending distinct lengths that
    minimise total padding. The cost obeys the quadrangle inequality, so each layer of the
    dynamic programme is solved by divide and conquer over monotone split points."""
    m = len(lengths)
    if not m:
        return []
    length = lengths.astype(np.float64)
    rows = np.concatenate([[0], np.cumsum(counts, dtype=np.float64)])
    tokens = np.concatenate([[0], np.cumsum(counts * length)])
    k = min(buckets, m)
    best = np.concatenate([[0], length * rows[1:] - tokens[1:]])  # one bucket for the first j lengths
    splits = []
    for _ in range(1, k):
        new, choice = best.copy(), np.zeros(m + 1, np.int64)
        todo = [(1, m, 0, m)]
        while todo:
            lo, hi, a, b = todo.pop()
            if lo > hi:
                continue
            j = (lo + hi) // 2
            i = np.arange(a, min(j - 1, b) + 1)
            cost = best[i] + length[j - 1] * (rows[j] - rows[i]) - (tokens[j] - tokens[i])
            at = int(np.argmin(cost))
            new[j], choice[j] = cost[at], i[at]
            todo += [(lo, j - 1, a, int(i[at])), (j + 1, hi, int(i[at]), b)]
        splits.append(choice)
        best = new
    out, j = [], m
    for choice in reversed(splits):
        out.append(int(lengths[j - 1]))
        j = int(choice[j])
        if not j:
            break
    if j:
        out.append(int(lengths[j - 1]))
    return out[::-1]


def pack(lengths: DataFrame, buckets: int = 16, budget: int = 65_536) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``bucket``, ``boundary``, ``batch`` and ``slot`` of every row of
    a table of lengths (which is read twice, so pass a written one)."""
    cells = lengths.where(F.col("n_tokens") <= budget).groupBy("n_tokens").count().orderBy("n_tokens").collect()  # at most budget cells
    size, count = np.array([r[0] for r in cells], np.int64), np.array([r[1] for r in cells], np.int64)
    bounds = optimal_boundaries(size, count, buckets)
    home = np.searchsorted(bounds, size) if bounds else np.zeros(0, np.int64)
    rows = [int(count[home == b].sum()) for b in range(len(bounds))]
    n = F.col("n_tokens")
    bucket, boundary, parts = F.lit(-1), n, F.lit(1).cast("long")
    for b in reversed(range(len(bounds))):
        here = n <= bounds[b]
        bucket, boundary = F.when(here, F.lit(b)).otherwise(bucket), F.when(here, F.lit(bounds[b]).cast("long")).otherwise(boundary)
        parts = F.when(here, F.lit(-(-rows[b] // PART_ROWS)).cast("long")).otherwise(parts)
    # a row's own number spreads rows of one id and length, and tells them apart
    marked = lengths.withColumn("row", F.monotonically_increasing_id()).select("doc_id", "n_tokens", bucket.alias("bucket"), boundary.alias("boundary"), F.pmod(F.xxhash64("row"), parts).alias("part"), "row")
    inside = marked.where("bucket >= 0").withColumn("at", F.row_number().over(Window.partitionBy("bucket", "part").orderBy(F.desc("n_tokens"), "doc_id", "row")) - 1)
    per = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.col("boundary")))
    inside = inside.select("doc_id", "n_tokens", "bucket", "boundary", F.concat_ws("-", "bucket", "part", F.floor(F.col("at") / per)).alias("batch"), F.pmod(F.col("at").cast("long"), per).alias("slot"))
    alone = marked.where("bucket < 0").select("doc_id", "n_tokens", "bucket", "boundary", F.concat_ws("-", F.lit("long"), "row").alias("batch"), F.lit(0).cast("long").alias("slot"))
    return inside.unionByName(alone)


def length_buckets(docs: DataFrame, tokenizer: str | None = None, buckets: int = 16, budget: int = 65_536) -> DataFrame:
    """Token lengths of a documents table, packed (see :func:`pack`)."""
    spark = docs.sparkSession
    lengths = staged(token_lengths(docs, tokenizer or default_tokenizer()), scratch_folder(spark, "op4"), "lengths")
    return pack(lengths, buckets, budget)


def op4_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_buckets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
