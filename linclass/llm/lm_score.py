"""Language-model scoring by deleted interpolation (operator 13).

The model mixes maximum-likelihood estimates of all orders from a uniform one up:
``P_m(w | c) = l_m(c) count(c w) / count(c) + (1 - l_m(c)) P_(m-1)(w | shorter c)``. The weight
``l_m`` depends on the context only through the bucket (bit length) of its count. Weights are
learned by expectation-maximisation: counts come from most of the training documents, and the
events of the rest, held out from those counts, say how far each order is to be trusted. After
that the held-out counts are added, and every document is scored. A document's first word
follows the end token, whose count is that of documents; unknown words share the one place that
the uniform estimate over the vocabulary has beyond it, so probabilities sum to 1.

Nothing about the corpus is held by the driver or by one task:

* *Blocks*: ``BLOCK_BYTES`` of consecutive texts of one kind (counted, held out, only scored) make a
  block. It asks for each n-gram of its texts once, with its own count, in as many parts as the
  n-gram names are dealt to.
* *Answers*: a part adds up the counts of a name over all blocks and answers each block in the
  order it asked. An n-gram in every text is one entry a block, so no name is a hot one.
* *Scores*: answers meet the block's texts, where counts of all orders are at hand at once.

An n-gram's name is a 64-bit hash, of which those of two and more words send 48 bits beside the
part's; the number of parts grows with the corpus, and with it the length of the names. If the
answers do not fit the texts of a block the job fails. The blocks follow the partitions of the
scan, whose number is therefore held while the operator runs; other inputs than files are
written first (``stage``).

Defined cases: null, empty and blank texts are the end token alone; a null id is held out;
repeated rows count as often as they stand there and are scored alike; other columns are
ignored; an empty table gives an empty result; without training rows every probability is 1
over the empty vocabulary's one place, so scores are 0; without held-out events weights are 1/2.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linclass.llm.text import Sums, mix64, scratch_folder, slices, staged, string_bytes, word_spans

#: Words of the longest n-gram. Two keep the shuffle of the whole job at some three times the size
#: of the compressed texts; three work alike and take half as much again.
ORDER = 2
#: Bytes of text of a block, and of the texts for whose n-grams there is a part.
BLOCK_BYTES = 16 << 20
PART_BYTES = 8 << 20
#: Of the training documents one in so many is held out from the counts for the weights.
WEIGHT_SHARE = 10
KEPT, HELD, SCORED = 0, 1, 2
#: Buckets of a context's count: its bit length.
CONTEXTS = 64
ROUNDS, ENOUGH = 20, 1e-5
END = np.uint64(0xD6E8FEB86659FD93)  # a hash that stands for the end token
_STEP = np.uint64(0x9E3779B97F4A7C15)


def held_out(doc_id: str = "doc_id", fold: int = 1, folds: int = 5) -> Column:
    """The fifth of the ids from which nothing is learned; null ids too."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(True))


def tokens(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, each ended by the end token, and the offsets of the texts."""
    start, end, doc = word_spans(raw, off)
    n = len(off) - 1
    cuts = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n) + 1)])
    out = np.full(len(start) + n, END, np.uint64)
    out[np.arange(len(start)) + doc] = Sums(raw).span(start, end)
    return out, cuts


def names(token: np.ndarray, cuts: np.ndarray, order: int, bits: int) -> list[np.ndarray]:
    """For each n-gram length, the name of the n-gram that ends at each token. Where a text has too
    few tokens before, the name means nothing (see ``reaches``)."""
    one = mix64(token)
    out, prefix = [one], one
    lead = cuts[:-1]
    for m in range(2, order + 1):
        before = np.roll(prefix, 1)
        if m == 2:
            before[lead] = mix64(np.array([END]))[0]
        prefix = mix64(before * _STEP + one + np.uint64(m))
        out.append((prefix >> np.uint64(16 - bits)) << np.uint64(16 - bits))
    return out


def reaches(cuts: np.ndarray, m: int) -> np.ndarray:
    """Whether the n-gram of ``m`` tokens that ends at each token lies in its text or begins with
    the end token before it."""
    at = np.arange(cuts[-1]) - np.repeat(cuts[:-1], np.diff(cuts))
    return at >= m - 2


def _pack(name: np.ndarray, m: int, bits: int) -> bytes:
    """Names of one part; those of more than one word without the part's bits and the lowest."""
    if m == 1:
        return name.tobytes()
    short = (name << np.uint64(bits)) >> np.uint64(16)
    return short.view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack(data: bytes, m: int) -> np.ndarray:
    if m == 1:
        return np.frombuffer(data, np.uint64)
    wide = np.zeros((len(data) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return wide.reshape(-1).view(np.uint64)


def _small(values: np.ndarray) -> bytes:
    """Counts at the width of the largest; the reader has the width from the number of counts."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0)))).tobytes()


def _wide(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"u{len(data) // n}").astype(np.int64) if n else np.zeros(0, np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Rows with their block: partition of the scan, bytes of text before the row, and kind."""
    before, part = 0, TaskContext.get().partitionId()
    for batch in batches:
        _, off = string_bytes(batch.column("text"))
        block = ((part << 24) + (before + off[:-1]) // size) * 4 + batch.column("kind").to_numpy()
        before += int(off[-1])
        yield pa.RecordBatch.from_arrays([pa.array(block), batch.column("doc_id"), batch.column("text")], names=["block", "doc_id", "text"])


def _asks(batches: Iterator[pa.RecordBatch], size: int, order: int, bits: int) -> Iterator[pa.RecordBatch]:
    """For each block, length and part: the names of its n-grams in order, and their counts."""
    held: dict[int, list[list[np.ndarray]]] = {}
    fences = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(1, np.uint64)

    def asked(block: int) -> Iterator[pa.RecordBatch]:
        for m, parts in enumerate(zip(*held.pop(block), strict=True), 1):
            name, count = np.unique(np.concatenate(parts), return_counts=True)
            cut = [*np.searchsorted(name, fences).tolist(), len(name)]
            some = [(k, a, b) for k, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if a < b]
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([k for k, _, _ in some], pa.int32()),
                    "block": pa.array([block] * len(some), pa.int64()),
                    "m": pa.array([m] * len(some), pa.int32()),
                    "names": pa.array([_pack(name[a:b], m, bits) for _, a, b in some], pa.binary()),
                    "n": pa.array([b"" if block % 4 == SCORED else _small(count[a:b]) for _, a, b in some], pa.binary()),
                }
            )

    for batch in _blocks(batches, size):
        for rows, raw, off in slices([batch]):
            token, cuts = tokens(raw, off)
            named = names(token, cuts, order, bits)
            at = np.repeat(rows.column("block").to_numpy(), np.diff(cuts))
            use = [reaches(cuts, m) for m in range(1, order + 1)]
            for block in np.unique(at).tolist():
                mine = at == block
                held.setdefault(block, []).append([x[mine & u] for x, u in zip(named, use, strict=True)])
            for block in [b for b in held if b // 4 < at[-1] // 4]:
                yield from asked(block)
    for block in list(held):
        yield from asked(block)


ASKS = "part int, block long, m int, names binary, n binary"
ANSWERS = "block long, m int, part int, size long, kept binary, held binary, known long, total long"


def _answers(rows: pa.Table) -> pa.Table:
    """Counts of each asked name over all blocks, a row for each row of questions. The first row
    has the number of known words of the part and of their occurrences."""
    out = []
    m_of, block = (rows.column(c).to_numpy() for c in ("m", "block"))
    asked, counts = rows.column("names"), rows.column("n")
    for m in np.unique(m_of).tolist():
        at = np.flatnonzero(m_of == m).tolist()
        each = [_unpack(asked[k].as_py(), m) for k in at]
        name, which = np.unique(np.concatenate(each), return_inverse=True)
        cut = np.concatenate([[0], np.cumsum([len(x) for x in each])])
        sums = np.zeros((2, len(name)), np.int64)
        for k, a, b in zip(at, cut[:-1], cut[1:], strict=True):
            kind = int(block[k]) % 4
            if kind != SCORED:
                np.add.at(sums[kind], which[a:b], _wide(counts[k].as_py(), b - a))
        both = sums.sum(0)
        for j, (k, a, b) in enumerate(zip(at, cut[:-1], cut[1:], strict=True)):
            first = m == 1 and j == 0
            out.append((int(block[k]), m, rows.column("part")[k].as_py(), int(b - a), _small(sums[0][which[a:b]]), _small(sums[1][which[a:b]]), int((both > 0).sum()) if first else 0, int(both.sum()) if first else 0))
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
    return pa.Table.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["block", "m", "part", "size", "kept", "held", "known", "total"])


def _counts(texts: pa.Table, answers: pa.Table, order: int, bits: int, columns: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Offsets of a block's texts, and the counts of the n-grams that end at each of its tokens by
    length (0 where there is none), from the answers' ``columns`` added up."""
    raw, off = string_bytes(texts.column("text"))
    token, cuts = tokens(raw, off)
    answers = answers.sort_by("part")
    m_of, size = answers.column("m").to_numpy(), answers.column("size").to_numpy()
    out = []
    for m, name in enumerate(names(token, cuts, order, bits), 1):
        use = reaches(cuts, m)
        asked, which = np.unique(name[use], return_inverse=True)
        rows = np.flatnonzero(m_of == m).tolist()
        got = [sum(_wide(answers.column(c)[k].as_py(), int(size[k])) for c in columns) for k in rows]
        known = np.concatenate(got) if got else np.zeros(0, np.int64)
        if len(known) != len(asked):
            raise RuntimeError(f"a block's {len(asked)} n-grams of {m} words have {len(known)} answers: its texts have changed between two scans")
        count = np.zeros(len(name), np.int64)
        count[use] = known[which]
        out.append(count)
    return cuts, out


def _contexts(cuts: np.ndarray, counts: list[np.ndarray], documents: int) -> list[np.ndarray]:
    """Counts of the contexts of lengths 1, 2 ... of each token, 0 where there is no such context."""
    out = []
    for m in range(2, len(counts) + 1):
        context = np.roll(counts[m - 2], 1)
        context[cuts[:-1]] = documents if m == 2 else 0
        out.append(np.where(reaches(cuts, m), context, 0))
    return out


def _end_count(cuts: np.ndarray, counts: list[np.ndarray]) -> int:
    """How often the end token, the last of every text, was counted: the number of documents."""
    return int(counts[0][cuts[1] - 1])


def bucket(context: np.ndarray) -> np.ndarray:
    """Bit length of counts: 0 for 0, 1 for 1, 2 for 2 and 3 ..."""
    return np.where(context > 0, np.frexp(context.astype(np.float64))[1], 0)


def interpolate(counts: list[np.ndarray], contexts: list[np.ndarray], weights: np.ndarray, total: int, known: int) -> list[np.ndarray]:
    """Probability of each event at each level from the uniform one up. ``weights`` has a row for
    each n-gram length, that of one word in its column 0."""
    p = [np.full(len(counts[0]), 1 / (known + 1))]
    own = weights[0, 0] if total else 0.0
    p.append(own * counts[0] / max(total, 1) + (1 - own) * p[0])
    for m, (count, context) in enumerate(zip(counts[1:], contexts, strict=True), 2):
        w = np.where(context > 0, weights[m - 1, bucket(context)], 0)
        p.append(w * count / np.maximum(context, 1) + (1 - w) * p[-1])
    return p


def _events(texts: pa.Table, answers: pa.Table, order: int, bits: int) -> pa.Table:
    """Distinct events of a held-out block: counts and context counts in what was kept, times."""
    cuts, counts = _counts(texts, answers, order, bits, ["kept"])
    contexts = _contexts(cuts, counts, _end_count(cuts, counts))
    rows, n = np.unique(np.stack([*counts, *contexts], 1), axis=0, return_counts=True)
    c = rows.T
    return pa.Table.from_pydict({f"c{m}": c[m - 1] for m in range(1, order + 1)} | {f"x{m}": c[order + m - 2] for m in range(2, order + 1)} | {"n": n.astype(np.int64)})


def _expect(batches: Iterator[pa.RecordBatch], order: int, weights: np.ndarray, total: int, known: int) -> Iterator[pa.RecordBatch]:
    """For each weight: events that had the choice and the share of them that its level made; in
    bucket -1 the number of events and the log of their probability."""
    had, made = np.zeros((2, order, CONTEXTS + 1))
    events, log = 0, 0.0
    for batch in batches:
        col = lambda c: batch.column(c).to_numpy()  # noqa: B023, E731
        counts, contexts, n = [col(f"c{m}") for m in range(1, order + 1)], [col(f"x{m}") for m in range(2, order + 1)], col("n")
        p = interpolate(counts, contexts, weights, total, known)
        events, log = events + int(n.sum()), log + float((n * np.log(p[-1])).sum())
        left = n.astype(np.float64)
        for m in range(order, 0, -1):
            b = bucket(contexts[m - 2]) if m > 1 else np.zeros(len(n), np.int64)
            can = contexts[m - 2] > 0 if m > 1 else np.full(len(n), total > 0)
            below = np.where(can, (1 - weights[m - 1, b]) * p[m - 1] / p[m], 1)
            np.add.at(had[m - 1], b[can], left[can])
            np.add.at(made[m - 1], b[can], (left * (1 - below))[can])
            left = left * below
    at = np.argwhere(had > 0)
    yield pa.RecordBatch.from_arrays([pa.array([*at[:, 0], -1], pa.int32()), pa.array([*at[:, 1], -1], pa.int32()), pa.array([*had[had > 0], float(events)]), pa.array([*made[had > 0], log])], names=["m", "bucket", "had", "made"])


def learn_weights(events: DataFrame, order: int, total: int, known: int) -> np.ndarray:
    """Weights of each n-gram length and context bucket by expectation-maximisation. Each round is
    one aggregate over the events; the driver gets a row for each weight. One event for and one
    against each weight are added, which keeps it between 0 and 1."""
    weights = np.full((order, CONTEXTS + 1), 0.5)
    before = -math.inf
    for _ in range(ROUNDS):
        found = events.mapInArrow(lambda b, w=weights: _expect(b, order, w, total, known), "m int, bucket int, had double, made double").groupBy("m", "bucket").agg(F.sum("had").alias("had"), F.sum("made").alias("made")).collect()
        n, log = next(((r["had"], r["made"]) for r in found if r["m"] < 0), (0, 0.0))
        if not n or (log - before) / n < ENOUGH:
            break
        before, weights = log, weights.copy()
        for r in found:
            if r["m"] >= 0:
                weights[r["m"], r["bucket"]] = (r["made"] + 1) / (r["had"] + 2)
    return weights


def _scores(texts: pa.Table, answers: pa.Table, order: int, bits: int, weights: np.ndarray, total: int, known: int) -> pa.Table:
    cuts, counts = _counts(texts, answers, order, bits, ["kept", "held"])
    p = interpolate(counts, _contexts(cuts, counts, _end_count(cuts, counts)), weights, total, known)[-1]
    base = np.log10((counts[0] + 0.5) / (total + 0.5 * (known + 1)))
    sums = lambda x: np.add.reduceat(x, cuts[:-1])
    held = texts.column("block").to_numpy() % 4 == SCORED
    return pa.Table.from_pydict(
        {"doc_id": texts.column("doc_id"), "held_out": held, "n_tokens": np.diff(cuts), "n_known": sums((counts[0] > 0).astype(np.int64)), "train_tokens": np.full(len(held), total), "base_score": sums(base), "score": sums(np.log10(p))}
    )


@contextmanager
def _same_splits(spark: SparkSession):
    """Files are cut into the same partitions whatever number of executors there is just now."""
    key = "spark.sql.files.minPartitionNum"
    had = spark.conf.get(key, None)
    spark.conf.set(key, had or str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(key, had) if had else spark.conf.unset(key)


def score_corpus(docs: DataFrame, test: Column | None = None, order: int = ORDER, stage: bool = True, block_bytes: int = BLOCK_BYTES, part_bytes: int = PART_BYTES) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every document.

    ``test`` is true for rows that nothing is learned from (default: ``held_out()``). ``stage``
    writes the rows first; leave it out only for a table that is read from files as it stands."""
    spark = docs.sparkSession
    folder = scratch_folder(spark, "lm")
    for_weights = F.crc32(F.concat(F.lit("weights:"), F.col("doc_id").cast("string")).cast("binary")) % WEIGHT_SHARE == 0
    kind = F.when(held_out() if test is None else F.coalesce(test, F.lit(True)), SCORED).when(F.coalesce(for_weights, F.lit(False)), HELD).otherwise(KEPT)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), kind.alias("kind"))
    rows = staged(rows, folder, "rows") if stage else rows
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(16, max(0, math.ceil(math.log2(max(1, size / part_bytes)))))
    with _same_splits(spark):
        asks = rows.mapInArrow(lambda b: _asks(b, block_bytes, order, bits), ASKS)
        answers = staged(asks.groupBy("part").applyInArrow(_answers, ANSWERS), folder, "answers")
        known, total = (int(x or 0) for x in answers.agg(F.sum("known"), F.sum("total")).first())
        texts = rows.mapInArrow(lambda b: _blocks(b, block_bytes), "block long, doc_id long, text string")
        with_answers = lambda t, a: t.groupBy("block").cogroup(a.groupBy("block"))
        held_blocks = F.col("block") % 4 == HELD
        columns = [f"c{m} long" for m in range(1, order + 1)] + [f"x{m} long" for m in range(2, order + 1)]
        events = staged(with_answers(texts.where(held_blocks), answers.where(held_blocks)).applyInArrow(lambda t, a: _events(t, a, order, bits), ", ".join([*columns, "n long"])), folder, "events")
        weights = learn_weights(events, order, total, known)
        scored = with_answers(texts, answers).applyInArrow(lambda t, a: _scores(t, a, order, bits, weights, total, known), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
        return staged(scored, folder, "scores")


def op13_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_corpus(spark.read.parquet(f"{sf_dir}/documents.parquet"), stage=False)
