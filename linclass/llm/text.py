"""Helpers that the operators share: bounded slices of Arrow text, vectorised word hashes,
and the shared folder for tables between stages."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterable, Iterator
from functools import wraps
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linclass.session import checkpoint_root

#: Bytes of text that a task holds as NumPy arrays at one time (a single longer text is taken alone).
SLICE_BYTES = 1 << 20
#: The same in the pipeline's stages: 64-bit arrays of a slice are several times eight times its
#: size, and their tasks take no longer over smaller ones.
SMALL_SLICE = 1 << 18


def id_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` long and ``text`` string of a documents table; all other columns go, so
    clashing names in the input cannot matter."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


#: Bytes of rows that Spark hands to a Python worker at one time.
BATCH_BYTES = "4m"


def small_batches(spark: SparkSession) -> None:
    """Bound what a task holds of the rows on their way to Python. Whole texts make wide rows,
    and the default of 64 MB is held several times over (in the JVM, in Arrow, as lists)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """New folder name under the shared folder of ``spark.checkpoint.dir``."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


def fresh_name(name: str, taken: Iterable[str]) -> str:
    """A column name that a table does not have, whatever the case."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name += "_"
    return name


def staged(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write a table under a scratch folder and read it back: cuts the lineage, so that a lost
    executor costs a reread of files instead of the work before them."""
    df.write.parquet(f"{folder}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")


#: What a worker keeps between tasks of one kind, by the kind. Tasks of any other kind let it go.
KEPT: dict[str, dict] = {}


def give_back(kind: str = "") -> None:
    """Hand memory that is free, but still held by the allocators, back to the system, and with it
    what tasks of another kind than the given one have kept: a worker that waits for its next
    task counts against its executor with all it has ever touched."""
    others = KEPT.keys() - {kind}
    for other in others:
        del KEPT[other]
    if others:
        gc.collect()  # part of it is in cycles
    if any(len(table) > MOST_POWERS for table in _POWERS.values()):
        _POWERS.clear()  # of a single long text; made again where they are needed
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(f: Callable[..., Iterator], kind: str = "") -> Callable[..., Iterator]:
    """A task's generator that gives memory back before it starts and when its state is gone.
    What is :data:`KEPT` for its own kind stays."""

    @wraps(f)
    def run(*args, **named):
        give_back(kind)
        yield from f(*args, **named)
        give_back(kind)

    return run


def string_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string or binary column and its n + 1 offsets; null reads as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = col.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut Arrow batches into row slices of at most ``limit`` text bytes (one row at least)."""
    for batch in batches:
        raw, off = string_bytes(batch.column(column))
        a, n = 0, batch.num_rows
        while a < n:
            b = max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1)
            yield batch.slice(a, b - a), raw[off[a] : off[b]], off[a : b + 1] - off[a]
            a = b


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (the public splitmix64 constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: A fixed random 64-bit value for each byte, made by rule; its case-folded form for words.
BYTE_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
FOLDED = np.arange(256, dtype=np.uint8)
FOLDED[65:91] += 32
FOLDED_VALUE = BYTE_VALUE[FOLDED]
#: Bytes that end a word: space and tab to carriage return.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = 0x5851F42D4C957F2D
_POWERS: dict[str, np.ndarray] = {}
#: Longer tables aren't kept between tasks.
MOST_POWERS = 2 * SLICE_BYTES


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` (at least) powers of an odd base modulo 2**64 and of its inverse."""
    if len(_POWERS.get("up", ())) < n:
        size = -(-n // (1 << 16)) << 16
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _POWERS[name] = np.multiply.accumulate(table)
    return _POWERS["up"], _POWERS["down"]


#: Spans of more bytes have a cryptographic hash: sums modulo a power of two are equal for some
#: pairs of long regular spans, whatever the base.
LONG_SPAN = 64


class Sums:
    """Prefix sums of weighted byte values: the hash of any byte span of up to ``LONG_SPAN`` bytes
    in constant time."""

    def __init__(self, raw: np.ndarray, values: np.ndarray = FOLDED_VALUE):
        self.raw, self.folded = raw, values is FOLDED_VALUE
        up, self.down = powers(len(raw) + 1)
        self.at = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(values[raw] * up[: len(raw)], out=self.at[1:])

    def span(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = mix64((self.at[end] - self.at[start]) * self.down[start] + (end - start).astype(np.uint64))
        for k in np.flatnonzero(end - start > LONG_SPAN).tolist():
            own = self.raw[start[k] : end[k]]
            out[k] = int.from_bytes(blake2b((FOLDED[own] if self.folded else own).tobytes(), digest_size=8).digest(), "little")
        return out


def word_spans(raw: np.ndarray, off: np.ndarray, between: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document number of every word (maximal run without bytes ``between`` words)."""
    inside = np.zeros(len(raw) + 1, bool)
    np.logical_not(between[raw], out=inside[:-1])
    starts = inside[:-1].copy()
    starts[1:] &= ~inside[:-2]
    heads = off[:-1][off[:-1] < off[1:]]
    starts[heads] = inside[heads]
    ends = inside[:-1] & ~inside[1:]
    tails = off[1:][off[:-1] < off[1:]] - 1
    ends[tails] = inside[tails]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(off, start, "right") - 1


class Recent:
    """Rows of 64-bit keys that a task has met lately, in a table of fixed size: a key may be
    forgotten when another takes its place, but no other key is ever taken for it."""

    def __init__(self, columns: int = 1, slots: int = 1 << 18):
        self.table = np.zeros((columns, slots), np.uint64)
        self.used = np.zeros(slots, bool)

    def new(self, *keys: np.ndarray) -> np.ndarray:
        """Which rows are not known, the first of equal rows only; they are known from now on."""
        n = len(keys[0])
        order = np.lexsort(keys)
        same = np.logical_and.reduce([k[order][1:] == k[order][:-1] for k in keys]) if n else np.zeros(0, bool)
        first = np.zeros(n, bool)
        first[order[np.concatenate([[True], ~same])] if n else order] = True
        at = np.flatnonzero(first)
        slot = keys[0][at].copy()
        for k in keys[1:]:
            slot = mix64(slot) ^ k[at]
        slot = (mix64(slot) & np.uint64(len(self.used) - 1)).astype(np.int64)
        known = self.used[slot] & np.logical_and.reduce([t[slot] == k[at] for t, k in zip(self.table, keys, strict=True)])
        for t, k in zip(self.table, keys, strict=True):
            t[slot[::-1]] = k[at[::-1]]  # of rows with one slot the first stays, in all columns
        self.used[slot] = True
        first[at[known]] = False
        return first


def distinct(values: np.ndarray) -> np.ndarray:
    """Distinct values, ascending, by sorting (the library's unique() builds a hash table)."""
    values = np.sort(values)
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    return values[keep]


def values_met(parts: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Values that the parts hold ``least`` times or more, ascending, and how often. The parts are
    used up: one sorted copy of them is all that is held beside the result."""
    values = np.concatenate(parts)
    parts.clear()
    values.sort()
    often = values[least - 1 :] == values[: max(0, len(values) - least + 1)]
    often[1:] &= values[1 : len(often)] != values[: max(0, len(often) - 1)]  # the first of its value
    start = np.flatnonzero(often)
    return values[start], np.searchsorted(values, values[start], "right") - start


def distinct_by_doc(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, value) pairs, sorted by document, then value."""
    if len(doc) and (doc[1:] < doc[:-1]).any():
        order = np.argsort(doc, kind="stable")
        doc, value = doc[order], value[order]
    else:
        value = value.copy()
    edge = np.flatnonzero(np.diff(doc)) + 1
    for a, b in zip([0, *edge.tolist()], [*edge.tolist(), len(doc)], strict=True):
        value[a:b].sort()
    keep = np.ones(len(doc), bool)
    keep[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return doc[keep], value[keep]


def list_array(values: np.ndarray, off: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(values, type=kind))
