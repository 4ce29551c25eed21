"""Token-id files: patched frame-of-reference blocks (operator 3).

A file holds the ids of consecutive documents in ascending ``doc_id`` order, end id included,
cut into blocks of a fixed number of ids. Each block subtracts its minimum, packs the
differences at the smallest width that covers a chosen share of its values (the percentile),
and lists the rest as exceptions: position and high bits. A footer
gives the documents and the byte offset of every block, so a reader can start at any block.

Files are written by the tasks of one range-partitioned job through ``pyarrow.fs`` under a
shared folder: first under a name of the attempt, then renamed, so a repeated attempt after a
lost executor replaces the same file with the same bytes.

Defined cases: null text is empty (its document has the end id alone); null ``doc_id`` sorts
first and stays null; repeated ids are kept, ties ordered by text; an empty table gives no
files and an empty manifest; other columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linclass.llm.shared_files import file_system, qualified
from linclass.llm.text import id_text, scratch_folder, slices, staged
from linclass.llm.tokenize import encoder

MAGIC = b"PFORIDS1"
_HEAD = struct.Struct("<IBBHI")  # minimum, width, spare, exceptions, values
_TAIL = struct.Struct("<QQQQI")  # documents, ids, blocks, footer offset, block size
NO_ID = -(1 << 63)


def _pack(v: np.ndarray, w: int) -> np.ndarray:
    """The low ``w`` bits of each value, most significant first, row by row as bytes."""
    if w in (0, 8, 16, 32):
        return np.ascontiguousarray(v.astype(">u4").view(np.uint8).reshape(*v.shape, 4)[:, :, 4 - w // 8 :]).reshape(len(v), -1)
    bits = np.unpackbits(v.astype(">u4").view(np.uint8).reshape(*v.shape, 4), axis=2)[:, :, 32 - w :]
    return np.packbits(bits.reshape(len(v), -1), axis=1)


def _unpack(raw: np.ndarray, size: int, w: int) -> np.ndarray:
    """Reverse of :func:`_pack`."""
    wide = np.zeros((len(raw), size, 4), np.uint8)
    if w in (8, 16, 32):
        wide[:, :, 4 - w // 8 :] = raw.reshape(len(raw), size, w // 8)
    elif w:
        bits = np.zeros((len(raw), size, 32), np.uint8)
        bits[:, :, 32 - w :] = np.unpackbits(raw, axis=1).reshape(len(raw), size, w)
        wide = np.packbits(bits, axis=2)
    return wide.view(">u4")[:, :, 0].astype(np.uint32)


def pack_blocks(values: np.ndarray, size: int, percentile: float) -> list[bytes]:
    """Packed blocks of a run of unsigned 32-bit ids; the last may hold fewer than ``size``."""
    if not len(values):
        return []
    n = -(-len(values) // size)
    grid = np.full(n * size, values[-1], np.uint32)
    grid[: len(values)] = values
    grid = grid.reshape(n, size)
    low = grid.min(1)
    rest = grid - low[:, None]
    allowed = int((1 - percentile) * size)
    width = np.frexp(rest.max(1).astype(np.float64))[1].astype(np.int64)  # bits of the largest
    open_ = np.flatnonzero(width)
    while len(open_):  # narrower while no more than the allowed values are exceptions
        over = np.count_nonzero(rest[open_] >> (width[open_] - 1).astype(np.uint32)[:, None], axis=1)
        open_ = open_[over <= allowed]
        width[open_] -= 1
        open_ = open_[width[open_] > 0]
    out: list[bytes] = [b""] * n
    for w in map(int, np.unique(width)):
        rows = np.flatnonzero(width == w)
        v = rest[rows]
        packed = _pack(v, w)
        high = v >> np.uint32(w) if w < 32 else np.zeros_like(v)
        some = high.any(1)
        for k, r in enumerate(rows):
            at = np.flatnonzero(high[k]) if some[k] else np.zeros(0, np.int64)
            count = min(size, len(values) - int(r) * size)
            out[r] = _HEAD.pack(int(low[r]), w, 0, len(at), count) + packed[k].tobytes() + at.astype("<u2").tobytes() + high[k][at].astype("<u4").tobytes()
    return out


def unpack_blocks(data: bytes, offsets: np.ndarray, size: int) -> np.ndarray:
    """Ids of the blocks that start at ``offsets`` of ``data``."""
    heads = [_HEAD.unpack_from(data, int(o)) for o in offsets]
    raw = np.frombuffer(data, np.uint8)
    width = np.array([h[1] for h in heads])
    grid = np.zeros((len(heads), size), np.uint32)
    for w in map(int, np.unique(width)):
        rows = np.flatnonzero(width == w)
        grid[rows] = _unpack(raw[offsets[rows][:, None] + _HEAD.size + np.arange(w * size // 8)], size, w)
    for r, (o, (_, w, _, exceptions, _)) in enumerate(zip(offsets, heads, strict=True)):
        if exceptions:
            p = int(o) + _HEAD.size + w * size // 8
            at = np.frombuffer(data, "<u2", exceptions, p)
            grid[r, at] |= np.frombuffer(data, "<u4", exceptions, p + 2 * exceptions) << np.uint32(w)
    grid += np.array([h[0] for h in heads], np.uint32)[:, None]
    counts = [h[4] for h in heads]
    return grid.reshape(-1) if min(counts, default=size) == size else np.concatenate([g[:c] for g, c in zip(grid, counts, strict=True)])


MANIFEST = "shard int, name string, n_docs long, n_tokens long, n_bytes long"


def _write_shard(batches: Iterator[pa.RecordBatch], folder: str, tokenizer: str, end_id: int, size: int, percentile: float) -> Iterator[pa.RecordBatch]:
    coder, end = encoder(tokenizer), np.array([end_id], "<u4").tobytes()
    files, root = file_system(folder)
    shard, out, name = TaskContext.get().partitionId(), None, ""
    docs: list[bytes] = []
    index: list[int] = []
    n_tokens, waiting, at = 0, b"", 0
    for rows, _, _ in slices(batches):
        if out is None:
            name = f"shard-{shard:06d}.pfor"
            files.create_dir(root, recursive=True)
            attempt = f"{root}/.{name}.{uuid.uuid4().hex}"
            out = files.open_output_stream(attempt)
            out.write(MAGIC)
            at = len(MAGIC)
        texts = [t or "" for t in rows.column("text").to_pylist()]
        got = coder.ids(texts)
        table = np.empty((len(got), 2), "<i8")
        table[:, 0] = [NO_ID if i is None else i for i in rows.column("doc_id").to_pylist()]
        table[:, 1] = [len(g) // 4 + 1 for g in got]
        docs.append(table.tobytes())
        n_tokens += int(table[:, 1].sum())
        waiting += end.join(got) + end
        whole = len(waiting) // (4 * size) * 4 * size
        for block in pack_blocks(np.frombuffer(waiting[:whole], "<u4"), size, percentile):
            index.append(at)
            at += len(block)
            out.write(block)
        waiting = waiting[whole:]
    if out is None:
        return
    for block in pack_blocks(np.frombuffer(waiting, "<u4"), size, percentile):
        index.append(at)
        at += len(block)
        out.write(block)
    table_bytes = b"".join(docs)
    tail = table_bytes + np.array(index, "<u8").tobytes()
    n_docs = len(table_bytes) // 16
    out.write(tail + _TAIL.pack(n_docs, n_tokens, len(index), at, size))
    out.close()
    files.move(attempt, f"{root}/{name}")
    yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([name]), pa.array([n_docs]), pa.array([n_tokens]), pa.array([at + len(tail) + _TAIL.size])], names=["shard", "name", "n_docs", "n_tokens", "n_bytes"])


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, block: int = 1024, percentile: float = 0.98) -> DataFrame:
    """Encode every whole text and write the id files under ``folder``; returns the manifest
    (one row for each file), itself kept as a table beside them."""
    if block % 8 or block > 1 << 16:
        raise ValueError("block must be a multiple of 8, at most 65536")
    folder = qualified(docs.sparkSession, folder)
    ordered = id_text(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    rows = ordered.mapInArrow(partial(_write_shard, folder=f"{folder}/ids", tokenizer=tokenizer, end_id=end_id, size=block, percentile=percentile), MANIFEST)
    return staged(rows, folder, "manifest")


def _read_shards(batches: Iterator[pa.RecordBatch], folder: str, blocks_at_once: int) -> Iterator[pa.RecordBatch]:
    files, root = file_system(folder)
    for batch in batches:
        for name, start in zip(batch.column("name").to_pylist(), batch.column("start").to_pylist(), strict=True):
            with files.open_input_file(f"{root}/{name}") as f:
                total = f.size()
                f.seek(total - _TAIL.size)
                n_docs, _, n_blocks, footer, size = _TAIL.unpack(f.read(_TAIL.size))
                f.seek(footer)
                table = np.frombuffer(f.read(16 * n_docs), "<i8").reshape(-1, 2)
                index = np.append(np.frombuffer(f.read(8 * n_blocks), "<u8").astype(np.int64), footer)
                begin = start + np.cumsum(table[:, 1]) - table[:, 1]
                doc, held = 0, np.zeros(0, np.uint32)
                for a in range(0, n_blocks, blocks_at_once):
                    b = min(n_blocks, a + blocks_at_once)
                    f.seek(int(index[a]))
                    held = np.concatenate([held, unpack_blocks(f.read(int(index[b] - index[a])), index[a:b] - index[a], size)])
                    ends = np.cumsum(table[doc : doc + len(held), 1])
                    whole = int(np.searchsorted(ends, len(held), "right"))
                    if whole:
                        off = np.concatenate([[0], ends[:whole]])
                        raw = held[: off[-1]].astype("<u4").tobytes()
                        ids = table[doc : doc + whole, 0]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(ids, mask=ids == NO_ID), pa.array(begin[doc : doc + whole]), pa.Array.from_buffers(pa.binary(), whole, [None, pa.py_buffer((off * 4).astype(np.int32).tobytes()), pa.py_buffer(raw)])],
                            names=["doc_id", "start", "ids"],
                        )
                        held, doc = held[off[-1] :], doc + whole


def read_tokens(spark: SparkSession, folder: str, blocks_at_once: int = 256) -> DataFrame:
    """Documents of the files under ``folder``: ``doc_id``, ``start`` (ids of all documents
    before it) and ``ids`` (binary, little-endian unsigned 32-bit, end id included)."""
    folder = qualified(spark, folder)
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    shards = max(1, manifest.count())
    before = F.coalesce(F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (
        manifest.select("name", before.alias("start"))  # one row for each file
        .repartition(shards)
        .mapInArrow(partial(_read_shards, folder=f"{folder}/ids", blocks_at_once=blocks_at_once), "doc_id long, start long, ids binary")
    )


def op3_token_files(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """Write ``documents`` as id files and read them back: one row for each document."""
    from linclass.llm.tokenize import default_tokenizer

    folder = scratch_folder(spark, "op3")
    write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), folder, tokenizer or default_tokenizer())
    return read_tokens(spark, folder).select("doc_id", "start", F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
