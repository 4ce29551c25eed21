"""Benchmark decontamination by the q-gram lemma (operator 2).

Benchmark items are cut into overlapping pieces. A piece of m characters that occurs in a text
with at most k edits shares at least ``m - q + 1 - k * q`` q-grams with it, all within k + 1
neighbouring diagonals. Shared q-grams are counted in overlapping diagonal bands; bands that
reach the bound are verified by alignment inside the band (edit distance, free start and end
in the text). So no occurrence within the edit budget is lost, and none beyond it is kept.

Case and kind of white space don't count: letters are folded and white space becomes a space,
character by character, so positions are code points of the text itself.

The benchmark is the stated query set: it is searched in blocks of at most ``BLOCK_CHARS``
characters, each broadcast by itself, against all documents in one pass without a shuffle.

Defined cases: null or empty texts and items match nothing, nor do items shorter than ``Q``
characters (every text would hold them); null and repeated ids are rows like others; empty
tables give an empty result; other columns are ignored or, in :func:`drop_contaminated`,
carried unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linclass.llm.text import SMALL_SLICE, mix64, slices, tidy

Q = 10
PIECE, STRIDE = 80, 40
#: Edits allowed, as a share of a piece's characters.
EDITS = 0.08
BLOCK_CHARS = 2_000_000
#: Meetings of a text's q-grams with the pieces' that are held at one time.
MEETINGS = 1 << 20

_LIMIT = 0x250
FOLD = np.arange(_LIMIT, dtype=np.uint32)
for _i in range(_LIMIT):
    _c = chr(_i)
    FOLD[_i] = 32 if _c.isspace() or _i == 0 else ord(_c.lower()) if len(_c.lower()) == 1 else _i


def code_points(text: str) -> np.ndarray:
    """Folded code points; NUL and white space read as a space."""
    cp = np.frombuffer(text.encode("utf-32-le"), "<u4")
    return np.where(cp < _LIMIT, FOLD[np.minimum(cp, _LIMIT - 1)], cp)


def grams(cp: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``Q`` characters from each position (characters reduced to bytes)."""
    if len(cp) < Q:
        return np.zeros(0, np.uint64)
    raw = (cp ^ cp >> np.uint32(8)).astype(np.uint8)
    eight = np.ndarray((len(raw) - 7,), "<u8", raw.tobytes(), strides=(1,))
    n = len(raw) - Q + 1
    return eight[:n] * np.uint64(0x9E3779B97F4A7C15) ^ mix64(eight[Q - 8 : Q - 8 + n])


@dataclass
class Index:
    """q-grams of the pieces of one benchmark block."""

    items: list  # item id of each item
    item: np.ndarray  # of each piece
    codes: list[np.ndarray]
    edits: np.ndarray
    least: np.ndarray  # shared q-grams that an occurrence has at least
    hashes: np.ndarray  # distinct, ascending
    first: np.ndarray  # where each hash's places begin
    piece: np.ndarray
    offset: np.ndarray
    table: np.ndarray

    @staticmethod
    def build(rows: list[tuple]) -> Index:
        items, item, codes = [], [], []
        for item_id, text in rows:
            cp = code_points(text or "")
            if len(cp) < Q:
                continue
            starts = sorted({*range(0, max(1, len(cp) - PIECE + 1), STRIDE), max(0, len(cp) - PIECE)})
            codes += [cp[a : a + PIECE] for a in starts]
            item += [len(items)] * len(starts)
            items.append(item_id)
        size = np.array([len(c) for c in codes], np.int64)
        edits = np.minimum((size * EDITS).astype(np.int64), np.maximum(0, (size - Q) // Q))
        got = [grams(c) for c in codes]
        h = np.concatenate([np.zeros(0, np.uint64), *got])
        piece = np.repeat(np.arange(len(codes)), [len(g) for g in got])
        offset = np.concatenate([np.zeros(0, np.int64), *[np.arange(len(g)) for g in got]])
        order = np.argsort(h, kind="stable")
        hashes, first = np.unique(h[order], return_index=True)
        table = np.zeros(1 << 20, bool)
        table[(hashes >> np.uint64(44)).astype(np.int64)] = True
        return Index(items, np.array(item, np.int64), codes, edits, size - Q + 1 - edits * Q, hashes, np.append(first, len(h)), piece[order], offset[order], table)


def _aligned(index: Index, cp: np.ndarray, piece: np.ndarray, low: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Least edits of each candidate's piece inside its band of diagonals, and the end in the
    text: one step a pattern character for all candidates at once."""
    size = np.array([len(index.codes[p]) for p in piece])
    m = int(size.max())
    pattern = np.zeros((len(piece), m), np.uint32)
    for k, p in enumerate(piece):
        pattern[k, : size[k]] = index.codes[p]
    x = np.arange(width)
    cost = np.zeros((len(piece), width), np.int64)
    best, end = np.zeros(len(piece), np.int64), np.zeros(len(piece), np.int64)
    for i in range(1, m + 1):
        at = low[:, None] + x + i - 1
        inside = (at >= 0) & (at < len(cp))
        same = inside & (cp[np.clip(at, 0, len(cp) - 1)] == pattern[:, i - 1 : i])
        new = cost + ~same
        new[:, :-1] = np.minimum(new[:, :-1], cost[:, 1:] + 1)  # a pattern character left out
        cost = np.minimum.accumulate(new - x, axis=1) + x  # text characters put in
        done = size == i
        if done.any():
            at_best = cost[done].argmin(1)
            best[done] = cost[done, at_best]
            end[done] = low[done] + at_best + i
    return best, end


def _shortened(cp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A text whose long runs of one character are cut in the middle, the places of the cuts in
    what is left and the characters left out up to each. A run keeps so many characters that
    every window as long as an occurrence is still there, at its first place."""
    most = 4 * PIECE
    edge = np.flatnonzero(np.diff(cp)) + 1
    start, end = np.concatenate([[0], edge]), np.concatenate([edge, [len(cp)]])
    long = np.flatnonzero(end - start > most)
    keep = np.ones(len(cp), bool)
    for k in long.tolist():
        keep[start[k] + most // 2 : end[k] - most // 2] = False
    out = (end - start)[long] - most
    before = np.cumsum(out)
    return cp[keep], start[long] + most // 2 - (before - out), before


def _candidates(index: Index, p: np.ndarray, at: np.ndarray, span: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pieces and bands of diagonals in which enough shared q-grams meet. Meetings are counted for
    ``MEETINGS`` at a time; a count goes on to the next part only while its band can still grow."""
    many = index.first[at + 1] - index.first[at]
    total = np.concatenate([[0], np.cumsum(many)])
    key, count = np.zeros(0, np.int64), np.zeros(0, np.int64)
    a = 0
    while a < len(p):
        b = max(a + 1, int(np.searchsorted(total, total[a] + MEETINGS, "right")) - 1)
        own = many[a:b]
        place = np.repeat(index.first[at[a:b]] - (total[a:b] - total[a]), own) + np.arange(total[b] - total[a])
        piece, diagonal = index.piece[place], np.repeat(p[a:b], own) - index.offset[place]
        band = np.floor_divide(diagonal, index.edits[piece] + 1)
        new, met = np.unique(np.concatenate([piece * span + band + 2 * PIECE, piece * span + band - 1 + 2 * PIECE]), return_counts=True)
        both, which = np.unique(np.concatenate([key, new]), return_inverse=True)
        sums = np.bincount(which, np.concatenate([count, met]), len(both)).astype(np.int64)
        piece, band = both // span, both % span - 2 * PIECE
        ended = (band + 2) * (index.edits[piece] + 1) <= p[b] - PIECE if b < len(p) else np.ones(len(both), bool)
        enough = ended & (sums >= np.maximum(1, index.least[piece]))
        yield piece[enough], band[enough]
        key, count, a = both[~ended], sums[~ended], b


def search(index: Index, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
    """(text number, item number, start, end, edits) of the best occurrence of each item that
    has one in each text; code points, start as if without indels."""
    if not len(index.codes):
        return []
    gap = np.zeros(int(index.edits.max()) + 1, np.uint32)  # NUL is in no piece: no match crosses it
    parts, off, cuts = [], [0], []
    for t in texts:
        cp, where, out = _shortened(code_points(t))
        cuts.append((where, np.concatenate([[0], out])))
        parts += [cp, gap]
        off.append(off[-1] + len(cp) + len(gap))
    cp = np.concatenate([np.zeros(0, np.uint32), *parts])
    h = grams(cp)
    p = np.flatnonzero(index.table[(h >> np.uint64(44)).astype(np.int64)])
    at = np.minimum(np.searchsorted(index.hashes, h[p]), len(index.hashes) - 1)
    hit = index.hashes[at] == h[p]
    p, at = p[hit], at[hit]
    # places where a window of the longest piece holds fewer hits than any bound can't matter
    least, reach = max(1, int(index.least.min())), PIECE + 2 * len(gap)
    ahead = np.searchsorted(p, p + reach) - np.arange(len(p))
    dense = np.zeros(len(p) + 1, np.int64)
    np.add.at(dense, np.flatnonzero(ahead >= least), 1)
    np.add.at(dense, np.flatnonzero(ahead >= least) + ahead[ahead >= least], -1)
    keep = np.cumsum(dense[:-1]) > 0
    p, at = p[keep], at[keep]
    if not len(p):
        return []
    found: dict[tuple[int, int], tuple[int, int, int]] = {}
    starts = np.array(off[:-1])
    for piece, band in _candidates(index, p, at, len(cp) + 4 * PIECE):
        for k in np.unique(index.edits[piece]):
            rows = np.flatnonzero(index.edits[piece] == k)
            for a in range(0, len(rows), 4096):
                r = rows[a : a + 4096]
                edits, end = _aligned(index, cp, piece[r], band[r] * (k + 1), 2 * int(k + 1))
                for i in np.flatnonzero(edits <= k):
                    begin = int(end[i]) - len(index.codes[piece[r[i]]])
                    text = int(np.searchsorted(starts, end[i] - 1, "right")) - 1
                    value = (int(edits[i]), max(0, begin - off[text]), int(end[i]) - off[text])
                    where = (text, int(index.item[piece[r[i]]]))
                    found[where] = min(found.get(where, value), value)
    whole = lambda text, at: at + int(cuts[text][1][np.searchsorted(cuts[text][0], at, "right")])
    return [(text, item, whole(text, v[1]), whole(text, v[2] - 1) + 1, v[0]) for (text, item), v in sorted(found.items())]


def blocks(benchmark: DataFrame) -> Iterator[Index]:
    """Indexes of the benchmark's blocks; only one block at a time is on the driver."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    chars = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n = -(-chars // BLOCK_CHARS)
    for b in range(n):
        yield Index.build([tuple(r) for r in rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).collect()])


HITS = "doc_id long, item_id long, start long, end long, edits long"


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each document and benchmark item that occurs in it: the best occurrence."""
    spark, out = docs.sparkSession, None
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    for index in blocks(benchmark):
        shared = spark.sparkContext.broadcast(index)

        @tidy
        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for part, _, _ in slices(batches, limit=SMALL_SLICE):
                got = search(shared.value, [t or "" for t in part.column("text").to_pylist()])
                ids, items = part.column("doc_id").to_pylist(), shared.value.items
                columns = [[ids[g[0]] for g in got], [items[g[1]] for g in got], *([g[j] for g in got] for j in (2, 3, 4))]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "item_id", "start", "end", "edits"])

        hits = rows.mapInArrow(run, HITS)
        out = hits if out is None else out.unionByName(hits)
    return spark.createDataFrame([], HITS) if out is None else out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows without any benchmark item, all columns as they are."""
    for index in blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        @tidy
        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for part, _, _ in slices(batches, limit=SMALL_SLICE):
                keep = np.ones(part.num_rows, bool)
                keep[[g[0] for g in search(shared.value, [t or "" for t in part.column("text").to_pylist()])]] = False
                yield part.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in ``documents``: one row for each document and item found in it."""
    return find_leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
