"""Factorisation-machine quality classifier (operator 8).

Features of a text: hashed words (share of the text's words), structure statistics in buckets
(letters, digits, capitals, marks, repeated words and lines, lengths) and metadata of the text
itself (its size). A factorisation machine adds a low-rank weight for every pair of features;
all pairs are scored in linear time by the sum-of-squares identity
``sum_{i<j} <v_i, v_j> x_i x_j = ((sum_i v_i x_i)**2 - sum_i (v_i x_i)**2) / 2`` per factor.

Bounds: ``SAMPLE_ROWS`` training rows (documented limit of the fit) and a fixed number of
parameters. Scoring is one pass without a shuffle over whole texts.

Defined cases: null and empty texts are scored from the buckets of an empty text; null ids are
held out; repeated rows are scored alike; an empty table gives an empty result; without
training rows every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linclass.llm.labels import SAMPLE_ROWS, held_out, sigmoid, training_rows
from linclass.llm.text import Sums, distinct_by_doc, id_text, list_array, slices, word_spans

WORD_BITS = 14
FACTORS = 8
#: Buckets of each statistic.
BUCKETS = 24
STATS = ("letters", "digits", "capitals", "marks", "odd_words", "distinct_words", "same_as_before", "distinct_lines", "word_size", "line_size", "size")
N_FEATURES = (1 << WORD_BITS) + BUCKETS * len(STATS)


def structure(raw: np.ndarray, off: np.ndarray, start: np.ndarray, end: np.ndarray, doc: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Statistics of each document, each between 0 and 1: one row a document."""
    n = len(off) - 1
    size = np.maximum(np.diff(off), 1)

    def share(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return (sums[off[1:]] - sums[off[:-1]]) / size

    capital, digit = (raw >= 65) & (raw <= 90), (raw >= 48) & (raw <= 57)
    letter = capital | ((raw >= 97) & (raw <= 122)) | (raw >= 128)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    letters, digits, capitals, marks = share(letter), share(digit), share(capital), share(~(letter | digit | space))
    words = np.bincount(doc, minlength=n)
    some = np.maximum(words, 1)
    # words that end in or consist of marks other than a comma or full stop
    last = raw[np.maximum(end - 1, 0)] if len(end) else np.zeros(0, np.uint8)
    odd = ~(np.isin(last, (44, 46)) | ((last >= 48) & (last <= 57)) | ((last | 32) >= 97) & ((last | 32) <= 122) | (last >= 128))
    distinct = np.bincount(distinct_by_doc(doc, word)[0], minlength=n)
    same = np.zeros(len(word), bool)
    same[1:] = (word[1:] == word[:-1]) & (doc[1:] == doc[:-1])
    line_off = np.flatnonzero(raw == 10) + 1
    cuts = np.unique(np.concatenate([off[:-1], line_off, off[1:]]))
    a, b = cuts[:-1], cuts[1:]
    line_doc = np.searchsorted(off, a, "right") - 1
    trim = b - (raw[b - 1] == 10) if len(b) else b
    lines = np.bincount(line_doc, minlength=n)
    kinds = np.bincount(distinct_by_doc(line_doc, Sums(raw).span(a, trim))[0], minlength=n)
    log = lambda x, most: np.minimum(np.log2(1 + x) / most, 1)
    return np.stack(
        [letters, digits, capitals, marks, np.bincount(doc, weights=odd, minlength=n) / some, np.where(words, distinct / some, 1), np.bincount(doc, weights=same, minlength=n) / some]
        + [np.where(lines, kinds / np.maximum(lines, 1), 1), log(size / some, 8), log(size / np.maximum(lines, 1), 16), log(np.diff(off), 24)],
        axis=1,
    )


def features(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document number, feature number and value of each non-zero feature of a slice."""
    n = len(off) - 1
    start, end, doc = word_spans(raw, off)
    word = Sums(raw).span(start, end)
    words = np.maximum(np.bincount(doc, minlength=n), 1)
    key, count = np.unique(doc << WORD_BITS | (word >> np.uint64(64 - WORD_BITS)).astype(np.int64), return_counts=True)
    word_doc = key >> WORD_BITS
    stats = structure(raw, off, start, end, doc, word)
    bucket = np.minimum((stats * BUCKETS).astype(np.int64), BUCKETS - 1)
    fixed = (1 << WORD_BITS) + np.arange(len(STATS)) * BUCKETS + bucket
    at = np.concatenate([key & ((1 << WORD_BITS) - 1), fixed.ravel()])
    docs = np.concatenate([word_doc, np.repeat(np.arange(n), len(STATS))])
    value = np.concatenate([np.sqrt(count / words[word_doc]), np.full(fixed.size, 0.5)])
    order = np.argsort(docs, kind="stable")
    return docs[order], at[order], value[order].astype(np.float32)


@dataclass
class Machine:
    """Intercept, weights and factors of every feature."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def margin(self, doc: np.ndarray, at: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
        """Scores before the sigmoid; every document has at least its structure features and
        ``doc`` is ascending."""
        first = np.searchsorted(doc, np.arange(n))
        xv = self.factors[at] * x[:, None]
        total = np.add.reduceat(xv, first, axis=0)
        own = np.add.reduceat(xv * xv, first, axis=0)
        return self.bias + np.add.reduceat(self.weights[at] * x, first) + 0.5 * (total * total - own).sum(1)


def train(rows: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray, epochs: int = 12, rate: float = 0.05, l2: float = 1e-5, batch: int = 128) -> Machine:
    """Adaptive-gradient steps on the logistic loss."""
    rng = np.random.default_rng(11)
    model = Machine(float(np.log((label.mean() + 1e-3) / (1 - label.mean() + 1e-3))), np.zeros(N_FEATURES, np.float32), rng.normal(0, 0.05, (N_FEATURES, FACTORS)).astype(np.float32))
    gw, gv, gb = np.full(N_FEATURES, 1e-6, np.float32), np.full((N_FEATURES, FACTORS), 1e-6, np.float32), 1e-6
    for _ in range(epochs):
        turn = rng.permutation(len(rows))
        for a in range(0, len(turn), batch):
            part = turn[a : a + batch]
            at = np.concatenate([rows[k][0] for k in part])
            x = np.concatenate([rows[k][1] for k in part])
            doc = np.repeat(np.arange(len(part)), [len(rows[k][0]) for k in part])
            first = np.searchsorted(doc, np.arange(len(part)))
            v = model.factors[at]
            total = np.add.reduceat(v * x[:, None], first, axis=0)
            err = (sigmoid(model.margin(doc, at, x, len(part))) - label[part]).astype(np.float32) / len(part)
            e = err[doc]
            dw = e * x
            dv = dw[:, None] * (total[doc] - v * x[:, None])
            ids, where = np.unique(at, return_inverse=True)
            order = np.argsort(where, kind="stable")
            cut = np.searchsorted(where[order], np.arange(len(ids)))
            sw = np.add.reduceat(dw[order], cut) + l2 * model.weights[ids]
            sv = np.add.reduceat(dv[order], cut, axis=0) + l2 * model.factors[ids]
            gw[ids] += sw * sw
            gv[ids] += sv * sv
            model.weights[ids] -= rate * sw / np.sqrt(gw[ids])
            model.factors[ids] -= rate * 0.5 * sv / np.sqrt(gv[ids])
            gb += float(err.sum()) ** 2
            model.bias -= rate * float(err.sum()) / gb**0.5
    return model


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, raw, off in slices(batches):
        doc, at, x = features(raw, off)
        cut = np.searchsorted(doc, np.arange(rows.num_rows + 1))
        yield pa.RecordBatch.from_arrays([rows.column("label"), list_array(at, cut, pa.int32()), list_array(x, cut, pa.float32())], names=["label", "at", "x"])


def fit(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE_ROWS) -> Machine:
    """Train on the bounded sample of labelled rows outside the held-out fifth."""
    got = training_rows(docs, labels, "quality", limit).mapInArrow(_sample, "label int, at array<int>, x array<float>").toArrow()  # at most limit rows
    if not got.num_rows:
        return Machine(0.0, np.zeros(N_FEATURES, np.float32), np.zeros((N_FEATURES, FACTORS), np.float32))
    at, x = got.column("at").combine_chunks(), got.column("x").combine_chunks()
    cut = at.offsets.to_numpy()
    ats, xs = at.values.to_numpy(), x.values.to_numpy()
    rows = [(ats[a:b], xs[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
    return train(rows, got.column("label").to_numpy())


def _score(batches: Iterator[pa.RecordBatch], model: Machine) -> Iterator[pa.RecordBatch]:
    for rows, raw, off in slices(batches):
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(sigmoid(model.margin(*features(raw, off), rows.num_rows)).astype(np.float64))], names=["doc_id", "score"])


def score(docs: DataFrame, model: Machine) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of parameters
    scored = id_text(docs).mapInArrow(lambda batches: _score(batches, shared.value), "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
