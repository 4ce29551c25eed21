"""Document fingerprints by locally consistent parsing (operator 1).

A text's bytes are parsed into phrases by deterministic coin tossing: every symbol is compared
with its left neighbour, reduced to the index and value of their lowest differing bit, again
and again until fewer than six labels are left; phrases begin at local maxima of the labels.
Where a boundary lies depends only on a few symbols around it, so equal substrings are parsed
alike inside, wherever they stand. Phrases are named by a hash of their symbols, the names are
the symbols of the next level, up to a single name for the whole text. Runs of one symbol
count as a symbol of their own before each level.

The fingerprint samples the names of the levels from ``LOWEST`` up (phrases of some tens of
bytes and more, and the name of the whole text) in ``SLOTS`` slots, the least name of each;
a slot without any takes the least name of the next finer level that has one for it, so short
texts are sampled by their short phrases. An empty slot borrows from the next. Each slot follows
this rule by itself, whatever the text's length. The likeness of two fingerprints is the share of equal
slots, an estimate of the Jaccard similarity of the two sets of phrases.

Defined cases: a null or empty text has the empty fingerprint (likeness 1 to another empty
one, 0 to others); rows without id come first in the order of ids; rows with the same id are
ordered by text; a table of one row is followed by itself; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linclass.llm.text import BYTE_VALUE, id_text, mix64, slices

SLOTS = 64
LOWEST = 3

_LOWEST_BIT = np.array([8] + [(i & -i).bit_length() - 1 for i in range(1, 256)], np.uint8)
_PLACE = mix64(np.arange(1, 65, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def _toss(label: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One reduction of byte labels; the first symbol of a text is compared with a neighbour
    that differs in its lowest bit."""
    left = np.empty_like(label)
    left[1:] = label[:-1]
    left[first] = label[first] ^ 1
    bit = _LOWEST_BIT[label ^ left]
    return (bit << 1) | ((label >> np.minimum(bit, 7)) & 1)


def _phrases(label: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Positions where a phrase begins: the first symbol and the local maxima of each text."""
    for _ in range(3):
        label = _toss(label, first)
    up = np.empty(len(label), bool)
    up[1:] = label[1:] > label[:-1]
    up[first] = True
    down = np.empty(len(label), bool)
    down[:-1] = label[:-1] > label[1:]
    down[last] = False
    starts = up & down
    starts[first] = True
    return np.flatnonzero(starts)


def _runs(symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal symbols begin, and their lengths."""
    new = np.empty(len(symbols), bool)
    new[1:] = symbols[1:] != symbols[:-1]
    new[first] = True
    at = np.flatnonzero(new)
    return at, np.diff(np.append(at, len(symbols)))


def parse(raw: np.ndarray, off: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Level by level, the texts that still have several symbols: (text number, name) of each
    phrase of the level; a text ends with the level at which it has a single name."""
    text = np.flatnonzero(np.diff(off))  # texts with symbols
    first = off[:-1][text]
    symbols, names = raw, None
    while len(text):
        at, size = _runs(symbols, first)
        first = np.searchsorted(at, first)
        last = np.append(first[1:], len(at)) - 1
        if names is None:
            label = raw[at]
            value = BYTE_VALUE[label]
        else:
            value = names[at]
            left = np.empty_like(value)
            left[1:] = value[:-1]
            left[first] = ~value[first]
            low = value ^ left
            low = np.bitwise_count((low & (~low + np.uint64(1))) - np.uint64(1))  # index of the lowest differing bit
            label = ((low.astype(np.uint64) << np.uint64(1)) | ((value >> np.minimum(low, 63).astype(np.uint64)) & np.uint64(1))).astype(np.uint8)
        value = np.where(size > 1, mix64(value ^ size.astype(np.uint64)), value)
        starts = _phrases(label, first, last)
        length = np.diff(np.append(starts, len(value)))
        place = np.arange(len(value)) - np.repeat(starts, length)
        names = mix64(np.add.reduceat(mix64(value) * _PLACE[place & 63], starts) + length.astype(np.uint64))
        first = np.searchsorted(starts, first)
        count = np.diff(np.append(first, len(names)))
        owner = np.repeat(text, count)
        yield owner, names
        more = count > 1
        names = names[np.repeat(more, count)]
        text, count = text[more], count[more]
        first = np.cumsum(count) - count
        symbols = names


def fingerprints(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """``SLOTS`` 16-bit values for each text (all zero for an empty one)."""
    n = len(off) - 1
    owners, names, finer = [], [], []
    for level, (owner, name) in enumerate(parse(raw, off), 1):
        single = np.bincount(owner, minlength=n) == 1
        keep = slice(None) if level >= LOWEST else single[owner]
        owners.append(owner[keep])
        names.append(name[keep])
        if level < LOWEST:
            finer.append((owner, name))
    out = np.zeros((n, SLOTS), np.uint64)
    if not owners:
        return out.astype(np.uint16)
    taken = np.zeros(n * SLOTS, bool)
    for owner, name in ((np.concatenate(owners), np.concatenate(names)), *finer[::-1]):
        short = ~taken.reshape(n, SLOTS).all(1)[owner]
        owner, name = owner[short], name[short]
        slot = owner * SLOTS + (name >> np.uint64(58)).astype(np.int64)
        free = ~taken[slot]
        slot, name = slot[free], name[free]
        order = np.lexsort((name, slot))
        slot, name = slot[order], name[order]
        head = np.ones(len(slot), bool)
        head[1:] = slot[1:] != slot[:-1]
        taken[slot[head]] = True
        out.reshape(-1)[slot[head]] = name[head]
    taken = taken.reshape(n, SLOTS)
    # an empty slot takes the value of the next taken one, marked with the distance
    full = np.flatnonzero(taken.any(1))
    twice = np.concatenate([taken[full], taken[full]], axis=1)
    place = np.where(twice, np.arange(2 * SLOTS), 4 * SLOTS)
    following = np.minimum.accumulate(place[:, ::-1], axis=1)[:, ::-1][:, :SLOTS]
    away = following - np.arange(SLOTS)
    value = np.take_along_axis(out[full], following % SLOTS, axis=1)
    out[full] = mix64(value + away.astype(np.uint64))
    out = (out & np.uint64(0xFFFF)).astype(np.uint16)
    return out


def likeness(a: np.ndarray, b: np.ndarray, a_empty: np.ndarray, b_empty: np.ndarray) -> np.ndarray:
    """Share of equal slots of the rows of two fingerprint arrays."""
    return np.where(a_empty | b_empty, (a_empty & b_empty).astype(float), (a == b).mean(1))


def as_hex(values: np.ndarray, empty: np.ndarray) -> list[str]:
    raw = values.astype(">u2").tobytes().hex()
    width = 4 * SLOTS
    return ["" if e else raw[k * width : (k + 1) * width] for k, e in enumerate(empty)]


def _bytes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    parts = [t.encode() for t in texts]
    return np.frombuffer(b"".join(parts), np.uint8), np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)])


def _fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, raw, off in slices(batches):
        empty = np.diff(off) == 0
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(as_hex(fingerprints(raw, off), empty))], names=["doc_id", "fingerprint"])


def fingerprint(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``fingerprint`` (hex) of every row, without a shuffle."""
    return id_text(docs).mapInArrow(_fingerprint, "doc_id long, fingerprint string")


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, ``part`` and ``halo``: rows dealt to parts that are ranges of
    ``doc_id``, each part ending with a copy of the row that follows its last (the first row
    of all for the last part). Sorted inside each part by halo, id and text.

    The driver gets one number for each cut point and part. Texts are shuffled once."""
    rows = id_text(docs)
    n = 8 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = sorted({int(c) for c in rows.stat.approxQuantile("doc_id", [i / n for i in range(1, n)], 0.1 / n)})
    part = F.lit(0)
    if cuts:
        part = F.when(F.col("doc_id").isNull(), 0).otherwise(_rank(F.col("doc_id"), cuts))
    marked = rows.withColumn("part", part)
    heads = sorted(marked.select("part", "doc_id").groupBy("part").agg(F.min(F.struct("doc_id")).alias("head")).select("part", "head.doc_id").collect())
    if not heads:
        return rows.select("doc_id", "text", F.lit(0).alias("part"), F.lit(0).alias("halo"))
    before = {p: heads[k - 1][0] for k, (p, _) in enumerate(heads)}
    none = [p for p, h in heads if h is None]
    is_head = F.col("doc_id").isin([h for _, h in heads if h is not None]) if len(none) < len(heads) else F.lit(False)
    if none:
        is_head = is_head | F.col("doc_id").isNull()
    previous = F.element_at(F.create_map(*[F.lit(x) for pair in before.items() for x in pair]), F.col("part"))
    own = F.struct(F.col("part").alias("part"), F.lit(0).alias("halo"))
    copy = F.struct(previous.alias("part"), F.lit(1).alias("halo"))
    dealt = marked.select("doc_id", "text", F.inline(F.when(F.coalesce(is_head, F.lit(False)), F.array(own, copy)).otherwise(F.array(own))))
    return dealt.repartition("part").sortWithinPartitions("part", "halo", "doc_id", "text")


def _rank(column, cuts: list[int]):
    """Number of ascending cut points at or below a value, as nested comparisons of depth log n."""
    if not cuts:
        return F.lit(0)

    def among(lo: int, hi: int):
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(column >= cuts[mid], among(mid + 1, hi)).otherwise(among(lo, mid))

    return among(0, len(cuts))


PAIRS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of whole parts in order: each row with the one after it."""
    held = None  # last row so far: id, text, part

    def flush(ids: list, texts: list[str], following: list[str]) -> pa.RecordBatch:
        edited = [t[: len(t) - len(t) // 2] + f[: len(t) // 2] for t, f in zip(texts, following, strict=True)]
        raw, off = _bytes(texts + edited)
        prints, empty = fingerprints(raw, off), np.diff(off) == 0
        n = len(texts)
        nexts = np.empty((n, SLOTS), np.uint16)
        next_empty = np.array([not f for f in following])
        nexts[:-1] = prints[1:n]
        other = [k for k in range(n) if k + 1 >= n or following[k] is not texts[k + 1]]  # where a part or the slice ends
        if other:
            nexts[other] = fingerprints(*_bytes([following[k] for k in other]))
        own, changed = slice(0, n), slice(n, 2 * n)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
                pa.array(as_hex(prints[own], empty[own])),
                pa.array(as_hex(prints[changed], empty[changed])),
                pa.array(likeness(prints[own], prints[changed], empty[own], empty[changed])),
                pa.array(likeness(prints[own], nexts, empty[own], next_empty)),
            ],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    for rows, _, _ in slices(batches):
        ids, texts, following = [], [], []
        for i, text, part, halo in zip(*(rows.column(c).to_pylist() for c in ("doc_id", "text", "part", "halo")), strict=True):
            text = text or ""
            if held is not None and held[2] == part and held[3] == 0:
                ids.append(held[0])
                texts.append(held[1])
                following.append(text)
            held = (i, text, part, halo) if halo == 0 or held is None or held[3] == 0 else held
        if texts:
            yield flush(ids, texts, following)


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likenesses."""
    return with_next(spark.read.parquet(f"{sf_dir}/documents.parquet")).mapInArrow(_compare, PAIRS)
