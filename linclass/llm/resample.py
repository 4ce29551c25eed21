"""Importance resampling towards a target distribution, over deduplicated lines (operator 12).

A document's features are its runs of one and two consecutive words, hashed into buckets. The
gain of a bucket is the log of its share in the target over its share in the corpus; a
document's weight is its mean gain, and Gumbel noise from its id turns weights into a draw
without replacement.

Newlines separate words, so they cut a text into lines whose features can be counted apart:

* *Lines*: equal lines of the corpus become one row with the number of times it stands there.
  The buckets of a distinct line are computed once and written; corpus counts multiply them by
  the occurrences, and so does every later use.
* *Bridges*: the runs that go from the last word of a line to the first of the next line with
  words are added apart, from a pass over the documents that looks at these places alone. It
  also notes the ids of each document's lines.
* *Weights*: a line's gains are added up once and joined to the documents that have the line.
  Lines that make up a thousandth of all occurrences or more are broadcast (a thousand rows at
  most); every other line is a small group of the shuffled join, so a line in every document
  costs no more than others.

The rank is a sort over range partitions (``ranks.numbered``), not a window over all rows. A
line's id is the first half of its SHA-256.

Defined cases: null, empty and wordless texts have no features, weight 0 and no rank; a null id
is an empty text behind the colon and comes last among ties; repeated rows are rows of their
own, repeated ids among ties in any order; other columns are ignored; an empty table gives an
empty result, an empty target leaves the corpus shares alone to decide.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linclass.llm.crc import crc_byte, crc_spans
from linclass.llm.ranks import numbered
from linclass.llm.text import FOLDED, id_text, list_array, scratch_folder, slices, staged, word_spans

BUCKETS = 10_000
PERCENT = 25
LEAST_WORDS = 20
SEED = 7
#: Lines that are one in so many of all line occurrences are broadcast: so many rows at most.
HEAVY = 1000
#: Bytes that stand between words: all of ASCII but digits and letters (capitals are folded first).
BETWEEN = np.zeros(256, bool)
BETWEEN[:128] = True
BETWEEN[48:58] = BETWEEN[97:123] = False


def word_features(raw: np.ndarray, off: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of each feature, text by text, their offsets, and the number of words of each text."""
    low = FOLDED[raw]
    start, end, doc = word_spans(low, off, BETWEEN)
    one = crc_spans(low, start, end)
    inside = np.flatnonzero(doc[1:] == doc[:-1])
    two = crc_spans(low, start[inside + 1], end[inside + 1], crc_byte(one[inside], 32))
    of = np.concatenate([doc, doc[inside]])
    order = np.argsort(of, kind="stable")
    words = np.bincount(doc, minlength=len(off) - 1)
    cuts = np.concatenate([[0], np.cumsum(words + np.maximum(words - 1, 0))])
    return (np.concatenate([one, two])[order] % np.uint32(buckets)).astype(np.int64), cuts, words


def _line_features(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Id, occurrences and feature buckets of each line that has words."""
    for rows, raw, off in slices(batches, "line"):
        bucket, cuts, words = word_features(raw, off, buckets)
        some = pa.array(words > 0)
        yield pa.RecordBatch.from_arrays([rows.column("line_id"), rows.column("times"), list_array(bucket, cuts, pa.int32())], names=["line_id", "times", "buckets"]).filter(some)


def _outlines(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Number of words, ids of the lines with words, and buckets of the bridges of each document."""
    for rows, raw, off in slices(batches):
        low = FOLDED[raw]
        start, end, doc = word_spans(low, off, BETWEEN)
        breaks = np.flatnonzero(raw == 10)
        line = np.searchsorted(breaks, start)  # numbered over the whole slice
        over = np.flatnonzero((doc[1:] == doc[:-1]) & (line[1:] != line[:-1]))
        crc = crc_spans(low, start[over + 1], end[over + 1], crc_byte(crc_spans(low, start[over], end[over]), 32))
        first = np.ones(len(start), bool)  # the first word of each line of each document
        first[1:] = (line[1:] != line[:-1]) | (doc[1:] != doc[:-1])
        at = np.flatnonzero(first)
        fences = np.concatenate([[-1], breaks, [len(raw)]])
        left = np.maximum(fences[line[at]] + 1, off[doc[at]])
        right = np.minimum(fences[line[at] + 1], off[doc[at] + 1])
        ids = [hashlib.sha256(raw[a:b].tobytes()).digest()[:16] for a, b in zip(left.tolist(), right.tolist(), strict=True)]
        n = rows.num_rows
        cut = lambda of: np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n))]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [rows.column("uid"), rows.column("doc_id"), pa.array(np.bincount(doc, minlength=n)), pa.ListArray.from_arrays(pa.array(cut(doc[at])), pa.array(ids, pa.binary())), list_array((crc % np.uint32(buckets)).astype(np.int64), cut(doc[over]), pa.int32())],
            names=["uid", "doc_id", "n_words", "lines", "bridges"],
        )


def _ragged(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the row of each."""
    size = np.diff(column.offsets.to_numpy())
    return column.flatten().to_numpy(), np.repeat(np.arange(len(column)), size)


def _bucket_sums(batches: Iterator[pa.RecordBatch], column: str, buckets: int) -> Iterator[pa.RecordBatch]:
    """Occurrences of each bucket among the rows of a task, each row counted ``times`` times."""
    total = np.zeros(buckets, np.int64)
    for batch in batches:
        value, row = _ragged(batch.column(column))
        times = batch.column("times").to_numpy()
        total += np.bincount(value, times[row], buckets).astype(np.int64)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])


def _gain_sums(batches: Iterator[pa.RecordBatch], column: str, keep: list[str], gains: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The columns ``keep`` and the sum of each row's gains."""
    for batch in batches:
        value, row = _ragged(batch.column(column))
        total = np.zeros(batch.num_rows, np.int64)
        np.add.at(total, row, gains[value])
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(total)], names=[*keep, "gain"])


def _counts(parts: list[tuple[DataFrame, str]], buckets: int) -> np.ndarray:
    """Occurrences of each bucket over the rows of all parts; the driver gets a row for each bucket."""
    each = [rows.select("times", column).mapInArrow(lambda b, c=column: _bucket_sums(b, c, buckets), "bucket long, n long") for rows, column in parts]
    both = each[0]
    for more in each[1:]:
        both = both.union(more)
    out = np.zeros(buckets, np.int64)
    for bucket, n in both.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def _lines(texts: DataFrame) -> DataFrame:
    """Distinct lines of the column ``text`` and how often each stands there."""
    cut = texts.select(F.explode(F.split("text", "\n")).alias("line")).groupBy("line").agg(F.count("*").alias("times"))
    return cut.select("line", "times", F.substring(F.unhex(F.sha2("line", 256)), 1, 16).alias("line_id"))


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's smoothed shares, rounded down."""
    size, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    ratio = lambda s, t: ((t + 1) * (s_all + size)) / ((s + 1) * (t_all + size))
    return np.array([math.floor(1000 * math.log(ratio(s, t))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def importance_resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED, buckets: int = BUCKETS) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every document; ``rank`` is null for those
    that are not drawn. ``target`` has a ``text`` column."""
    folder = scratch_folder(docs.sparkSession, "resample")
    features = lambda texts: _lines(texts).mapInArrow(lambda b: _line_features(b, buckets), "line_id binary, times long, buckets array<int>")
    outlined = lambda rows: rows.mapInArrow(lambda b: _outlines(b, buckets), "uid long, doc_id long, n_words long, lines array<binary>, bridges array<int>")
    numbers = F.monotonically_increasing_id()
    lines = staged(features(id_text(docs)), folder, "lines")
    outlines = staged(outlined(id_text(docs).withColumn("uid", numbers)), folder, "outlines")
    wanted = target.select(F.lit(0).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    once = lambda rows: rows.withColumn("times", F.lit(1).cast("long"))
    gains = bucket_gains(_counts([(lines, "buckets"), (once(outlines), "bridges")], buckets), _counts([(features(wanted), "buckets"), (once(outlined(wanted.withColumn("uid", numbers))), "bridges")], buckets))

    valued = staged(lines.mapInArrow(lambda b: _gain_sums(b, "buckets", ["line_id", "times"], gains), "line_id binary, times long, gain long"), folder, "valued")
    total = valued.agg(F.sum("times")).first()[0] or 0
    is_heavy = F.col("times") * HEAVY >= total
    heavy = valued.where(is_heavy).select("line_id", F.col("gain").alias("heavy_gain"))
    held = outlines.select("uid", F.explode("lines").alias("line_id")).join(F.broadcast(heavy), "line_id", "left")  # HEAVY rows at most
    often = held.where("heavy_gain is not null").select("uid", F.col("heavy_gain").alias("gain"))
    seldom = held.where("heavy_gain is null").select("uid", "line_id").join(valued.where(~is_heavy).select("line_id", "gain"), "line_id").select("uid", "gain")
    bridged = outlines.mapInArrow(lambda b: _gain_sums(b, "bridges", ["uid", "doc_id", "n_words"], gains), "uid long, doc_id long, n_words long, gain long")
    sums = often.union(seldom).union(bridged.select("uid", "gain")).groupBy("uid").agg(F.sum("gain").alias("gain"))
    known = outlines.select("uid", "doc_id", "n_words", F.expr("n_words + greatest(n_words - 1, 0)").alias("n_features")).join(sums, "uid")
    weighed = known.withColumn("weight", F.expr("if(n_features > 0, (gain - pmod(gain, n_features)) div n_features, 0L)"))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    scored = staged(weighed.withColumn("score", F.col("weight") + F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")).select("uid", "doc_id", "n_words", "n_features", "weight", "score"), folder, "scored")
    able = scored.where(F.col("n_words") >= least_words).select("uid", "doc_id", "score")
    drawn = able.count() * percent // 100
    ranked = numbered(able, [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("uid")], folder, "sorted").where(F.col("rank") <= drawn).select("uid", "rank")
    return scored.join(ranked, "uid", "left").select("doc_id", "n_features", "weight", "score", F.col("rank").cast("long").alias("rank"))


def drawn_documents(docs: DataFrame, scored: DataFrame) -> DataFrame:
    """The documents whose id has a rank, with all their columns."""
    return docs.join(scored.where("rank is not null").select(F.col("doc_id").alias("drawn_doc_id")).distinct(), F.col("doc_id").cast("long").eqNullSafe(F.col("drawn_doc_id")), "left_semi")


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
