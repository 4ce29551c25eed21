"""Weakly supervised toxicity classifier (operator 6).

Lexicon voters (a word) and pattern voters (words that begin with the same letters) are drawn
from the training rows. A generative label model estimates by expectation maximisation how
often each voter fires on toxic and on other texts, and how voters are correlated given the
class; correlated voters share their weight. Its posterior labels train a sparse logistic
classifier over the presence of chosen words and prefixes, which scores every whole text.

Bounds: ``SAMPLE_ROWS`` labelled rows, ``TERMS`` features, ``VOTERS`` voters; the model of a
few thousand numbers is what the tasks get. Scoring is one pass without a shuffle.

Defined cases: null and empty texts get the score of a text without any known term; null ids
are held out; repeated rows are scored alike; an empty table gives an empty result; without
training rows of both classes every score is the share of toxic training rows (0 if none).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linclass.llm.labels import SAMPLE_ROWS, held_out, sigmoid, trimmed, training_rows
from linclass.llm.text import SMALL_SLICE, Sums, distinct_by_doc, id_text, list_array, scratch_folder, slices, staged, tidy, word_spans

#: Lengths (bytes) of the word beginnings that are terms beside the whole word.
PREFIXES = (4, 5, 6)
TERMS = 4096
VOTERS = 192
#: A term needs so many training texts; a voter, so large a share of the toxic ones and of all it fires on.
MIN_TEXTS = 4
VOTER_REACH, VOTER_PRECISION = 0.01, 0.9


@dataclass
class LinearModel:
    """Sorted term hashes, their weights, the intercept."""

    terms: np.ndarray
    weights: np.ndarray
    bias: float


def text_terms(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Document number and hash of every term occurrence: words and word beginnings."""
    start, end, doc = word_spans(raw, off)
    start, end = trimmed(raw, start, end) if len(start) else (start, end)
    keep = end - start >= 3
    start, end, doc = start[keep], end[keep], doc[keep]
    sums = Sums(raw)
    docs, terms = [doc], [sums.span(start, end)]
    for n in PREFIXES:
        longer = end - start > n
        docs.append(doc[longer])
        terms.append(sums.span(start[longer], start[longer] + n) ^ np.uint64(n))
    return np.concatenate(docs), np.concatenate(terms)


@tidy
def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each term: texts with label 1 and 0, summed within a slice."""
    for rows, raw, off in slices(batches, limit=SMALL_SLICE):
        doc, term = distinct_by_doc(*text_terms(raw, off))
        label = rows.column("label").to_numpy(zero_copy_only=False)[doc]
        value, at = np.unique(term, return_inverse=True)
        pos = np.bincount(at, weights=label, minlength=len(value)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(pos), pa.array(np.bincount(at, minlength=len(value)) - pos)], names=["term", "pos", "neg"])


class Matcher:
    """Occurrences of known terms, found through a small table before the exact search."""

    def __init__(self, terms: np.ndarray):
        self.terms = terms
        self.table = np.zeros(1 << 18, bool)
        self.table[(terms >> np.uint64(46)).astype(np.int64)] = True

    def __call__(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (document, term number) pairs of a slice."""
        doc, term = text_terms(raw, off)
        maybe = self.table[(term >> np.uint64(46)).astype(np.int64)]
        doc, term = doc[maybe], term[maybe]
        at = np.minimum(np.searchsorted(self.terms, term), max(0, len(self.terms) - 1))
        hit = self.terms[at] == term if len(self.terms) else np.zeros(0, bool)
        return distinct_by_doc(doc[hit], at[hit])


@tidy
def _sample_rows(batches: Iterator[pa.RecordBatch], terms: np.ndarray) -> Iterator[pa.RecordBatch]:
    match = Matcher(terms)
    for rows, raw, off in slices(batches, limit=SMALL_SLICE):
        doc, at = match(raw, off)
        yield pa.RecordBatch.from_arrays([rows.column("label"), list_array(at, np.searchsorted(doc, np.arange(rows.num_rows + 1)), pa.int32())], names=["label", "at"])


def label_model(votes: np.ndarray, prior: float, rounds: int = 50) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior P(toxic) of each row of a 0/1 vote matrix, and each voter's rate of firing in
    either class. Only the share ``prior`` of toxic rows is given; the accuracies come from
    how the voters agree (expectation maximisation).

    A voter that doesn't fire abstains; that no voter fires at all is a vote for the other
    class. The correlation of two voters is that of their residuals given the class; voters
    correlated above 0.5 are taken as repeats of one another and share their weight."""
    n, v = votes.shape
    some = (votes.sum(1) > 0).astype(np.float32)
    post = np.where(some > 0, 0.9, 0.1 * prior)
    share = np.ones(v)
    for step in range(rounds):
        p, q = post.sum(), (1 - post).sum()
        hit = (votes.T @ post + 0.5 * prior) / (p + 1)
        false = (votes.T @ (1 - post) + 0.5 * (1 - prior)) / (q + 1000)
        any_hit, any_false = (some @ post + 1) / (p + 2), (some @ (1 - post) + 1) / (q + 2)
        if step % 10 == 0:
            resid = votes - post[:, None] * hit - (1 - post)[:, None] * false
            cov = resid.T @ resid / n
            sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
            rho = np.clip(cov / sd[:, None] / sd, 0, 1)
            np.fill_diagonal(rho, 0)
            share = 1 / (1 + np.where(rho > 0.5, rho, 0).sum(1))
        fired = votes @ (share * np.log(hit / false))
        none = (1 - some) * np.log((1 - any_hit) / (1 - any_false))
        new = sigmoid(np.log(prior / (1 - prior)) + fired + none)
        done = np.abs(new - post).max() < 1e-6
        post = new
        if done and step > 11:
            break
    return post, hit, false


def sparse_logistic(rows: list[np.ndarray], target: np.ndarray, n_terms: int, epochs: int = 8, alpha: float = 0.3, l1: float = 1.0, l2: float = 1.0) -> tuple[np.ndarray, float]:
    """Logistic weights of present terms on soft labels (follow-the-regularised-leader steps,
    whose l1 part keeps the weights of mere noise at zero)."""
    z, g2 = np.zeros(n_terms + 1), np.zeros(n_terms + 1)
    rng = np.random.default_rng(7)
    pen = np.full(n_terms + 1, l1)
    pen[n_terms] = 0

    def weight(i: np.ndarray) -> np.ndarray:
        zi = z[i]
        return np.where(np.abs(zi) <= pen[i], 0, -(zi - np.sign(zi) * pen[i]) / ((1 + np.sqrt(g2[i])) / alpha + l2))

    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            i = np.append(rows[k], n_terms)
            w = weight(i)
            g = float(sigmoid(np.array(w.sum()))) - target[k]
            sigma = (np.sqrt(g2[i] + g * g) - np.sqrt(g2[i])) / alpha
            z[i] += g - sigma * w
            g2[i] += g * g
    w = weight(np.arange(n_terms + 1))
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE_ROWS) -> LinearModel:
    """Voters, label model and classifier from the training rows of ``labels``."""
    spark = docs.sparkSession
    sample = staged(training_rows(docs, labels, "toxic", limit), scratch_folder(spark, "toxic"), "sample")
    sizes = {r[0]: r[1] for r in sample.groupBy("label").count().collect()}
    pos, neg = sizes.get(1, 0), sizes.get(0, 0)
    if not pos or not neg:
        return LinearModel(np.zeros(0, np.uint64), np.zeros(0), 30.0 if pos else -30.0)
    counts = sample.mapInArrow(_count_terms, "term long, pos long, neg long").groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    odds = F.log((F.col("pos") + 0.1) / (pos + 0.2)) - F.log((F.col("neg") + 0.1) / (neg + 0.2))
    gain = F.abs(odds) * F.greatest(F.col("pos") / pos, F.col("neg") / neg)
    chosen = counts.where(F.col("pos") + F.col("neg") >= MIN_TEXTS).select("term", "pos", "neg", odds.alias("odds"), gain.alias("gain")).orderBy(F.desc("gain"), "term").limit(TERMS).collect()
    if not chosen:
        return LinearModel(np.zeros(0, np.uint64), np.zeros(0), float(np.log(pos / neg)))
    table = np.array([r["term"] for r in chosen], np.int64).view(np.uint64)
    order = np.argsort(table)
    terms = table[order]
    strength = np.array([r["gain"] if r["pos"] >= VOTER_REACH * pos and r["pos"] >= VOTER_PRECISION * (r["pos"] + r["neg"]) else 0.0 for r in chosen])[order]
    got = sample.mapInArrow(partial(_sample_rows, terms=terms), "label int, at array<int>").select("at").toArrow()  # at most limit rows
    at = got.column("at").combine_chunks()
    cut, values = at.offsets.to_numpy(), at.values.to_numpy()
    rows = [values[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
    voters = np.argsort(-strength)[:VOTERS]
    voters = voters[strength[voters] > 0]
    votes = np.zeros((len(rows), len(voters)), np.float32)
    column = np.full(len(terms), -1)
    column[voters] = np.arange(len(voters))
    for k, r in enumerate(rows):
        c = column[r]
        votes[k, c[c >= 0]] = 1
    prior = pos / (pos + neg)
    target = label_model(votes, prior)[0] if len(voters) else np.full(len(rows), prior)
    weights, bias = sparse_logistic(rows, target, len(terms))
    used = weights != 0
    return LinearModel(terms[used], weights[used], bias)


@tidy
def _score(batches: Iterator[pa.RecordBatch], model: LinearModel) -> Iterator[pa.RecordBatch]:
    match = Matcher(model.terms)
    for rows, raw, off in slices(batches, limit=SMALL_SLICE):
        doc, at = match(raw, off)
        margin = model.bias + np.bincount(doc, weights=model.weights[at], minlength=rows.num_rows)
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(sigmoid(margin))], names=["doc_id", "score"])


def score(docs: DataFrame, model: LinearModel) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row."""
    scored = id_text(docs).mapInArrow(partial(_score, model=model), "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@tidy
def _keep(batches: Iterator[pa.RecordBatch], model: LinearModel, column: str) -> Iterator[pa.RecordBatch]:
    match = Matcher(model.terms)
    for rows, raw, off in slices(batches, column, SMALL_SLICE):
        doc, at = match(raw, off)
        margin = model.bias + np.bincount(doc, weights=model.weights[at], minlength=rows.num_rows)
        yield rows.filter(pa.array(sigmoid(margin) < 0.5))


def drop_toxic(docs: DataFrame, model: LinearModel) -> DataFrame:
    """The rows that the classifier doesn't predict toxic, all columns as they are."""
    return docs.mapInArrow(partial(_keep, model=model, column="text"), docs.schema)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
