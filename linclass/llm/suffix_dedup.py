"""Removal of repeated byte strings by blockwise suffix sorting with a difference cover (operator 9).

Every byte that is covered by a string of ``LENGTH`` bytes that also starts in a document with a
smaller ``doc_id`` goes. Documents are kept as blocks of about 1 MB; what is sorted is
sorted one bucket at a time, so memory is bounded by the size of a block or a bucket.

1. *Cover sample.* Of each document the positions whose residue modulo 31 is in a difference
   cover (6 of 31) are sampled. For any two positions i and j some shift below 31 takes both
   to sampled positions, so two equal strings of 50 bytes share the 20 bytes from a sampled
   position of either. The 20-byte beginnings of the sampled suffixes are sorted bucket by
   bucket; their rank tells whether any other block or document has the same.
2. *Suffix buckets.* A suffix none of whose cover samples within the next 31 positions has a
   shared rank ties with no other over 50 bytes, and needs no comparison. The others are dealt
   to buckets by the least 16-byte hash in their 50 bytes (neighbours share it, so they travel
   as one piece of text), and each bucket is sorted by the suffixes' first 8 bytes, ties by a
   64-bit hash of all 50. Repeats inside a block are settled before that: a string leaves a
   block once, from its first place in the block's first document with it, however frequent.
3. *Removal.* Each block reads the positions settled for it, adds the other places of those
   strings in the first document, which share their fate, and cuts.

Between the steps every block's answers are a small file in the shared folder, named after the
block and written by rename: a task that runs again writes the same file again.

Defined cases: null text is empty (nothing removed); a null ``doc_id`` counts as larger than
every id, and is not smaller than another null; rows with the same id do not remove from one
another; texts shorter than ``LENGTH`` stay whole; an empty table gives an empty result; other
columns are ignored. Cut text may end inside a character, so kept text is bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from linclass.llm.shared_files import file_system, qualified, read_file, write_file
from linclass.llm.text import BYTE_VALUE, Sums, distinct, id_text, mix64, scratch_folder, slices, staged

LENGTH = 50
PERIOD = 31
#: Every difference modulo 31 is one of two members.
COVER = (1, 5, 11, 24, 25, 27)
SAMPLE = LENGTH - PERIOD + 1
SEED = 16
BLOCK_BYTES = 1 << 20
#: Sampled suffixes in a bucket, about. Blocks times buckets is the number of shuffled rows, so
#: raise both sizes with the memory of a worker when the corpus grows to many TB.
BUCKET_ROWS = 1 << 22
NO_ID = np.iinfo(np.int64).max

_SAMPLED = np.zeros(PERIOD, bool)
_SAMPLED[list(COVER)] = True
BLOCKS = "block long, ids binary, offsets binary, data binary"


class Block:
    """Documents of a block: ascending ids (``NO_ID`` for null), byte offsets, bytes."""

    def __init__(self, block: int, ids: np.ndarray, off: np.ndarray, raw: np.ndarray):
        self.block, self.ids, self.off, self.raw = block, ids, off, raw

    @staticmethod
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
        for batch in batches:
            for k in range(batch.num_rows):
                ids, off, raw = (np.frombuffer(batch.column(c)[k].as_buffer(), t) for c, t in (("ids", np.int64), ("offsets", np.int64), ("data", np.uint8)))
                yield Block(batch.column("block")[k].as_py(), ids, off, raw)

    def words(self, at: np.ndarray, size: int, shift: int = 0) -> np.ndarray:
        """Little-endian numbers of ``size`` bytes at positions (unaligned)."""
        kind = np.dtype(f"<u{size}")
        return np.ndarray((max(0, len(self.raw) - size + 1),), kind, self.raw, strides=(1,))[at + shift]

    def sampled(self) -> np.ndarray:
        """Positions of the cover sample whose 20 bytes lie inside the document."""
        size = np.diff(self.off)
        tile = np.tile(_SAMPLED, int(size.max(initial=0)) // PERIOD + 1)
        parts = []
        for n in size:
            m = max(0, n - SAMPLE + 1)
            parts += [tile[:m], np.zeros(n - m, bool)]
        return np.flatnonzero(np.concatenate(parts)) if parts else np.zeros(0, np.int64)

    def sample_keys(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Sampled positions and the key (bucket and 32 more bits) of the 20 bytes at each."""
        at = self.sampled()
        tail = self.words(at, 4, 16).astype(np.uint64)
        h = mix64(self.words(at, 8) ^ mix64(self.words(at, 8, 8) ^ mix64(tail + np.uint64(1))))
        return at, h >> np.uint64(32 - bits)

    def document(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.off, at, "right") - 1


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size, n, part = 0, 0, TaskContext.get().partitionId()

    def block() -> pa.RecordBatch:
        ids = np.concatenate([h[0] for h in held])
        lengths = np.concatenate([np.diff(h[2]) for h in held])
        raw = np.concatenate([h[1] for h in held])
        start = np.cumsum(lengths) - lengths
        order = np.argsort(ids, kind="stable")
        data = b"".join([raw[start[k] : start[k] + lengths[k]].tobytes() for k in order])
        off = np.concatenate([[0], np.cumsum(lengths[order])]).astype(np.int64)
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array([part << 32 | n], pa.int64()), pa.array([ids[order].tobytes()], pa.binary()), pa.array([off.tobytes()], pa.binary()), pa.array([data], pa.binary())], names=["block", "ids", "offsets", "data"])

    for rows, raw, off in slices(batches, limit=BLOCK_BYTES // 2):
        if held and size + len(raw) > BLOCK_BYTES:
            yield block()
            size, n = 0, n + 1
        held.append((rows.column("doc_id").fill_null(NO_ID).to_numpy().copy(), raw.copy(), off))
        size += len(raw)
    if held:
        yield block()


ANSWERS = "block long, bucket int, payload binary"


def _answer(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())], names=["block", "bucket", "payload"])


def _sample_rows(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Distinct sample keys of each block, ascending, one row a bucket."""
    for b in Block.of(batches):
        keys = distinct(b.sample_keys(bits)[1])
        cut = np.searchsorted(keys, np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(32))
        low = keys.astype(np.uint32)
        yield _answer([(b.block, k, low[cut[k] : cut[k + 1]].tobytes()) for k in range(1 << bits) if cut[k] < cut[k + 1]])


def _by_bucket(batches: Iterator[pa.RecordBatch], settle: Callable) -> Iterator[pa.RecordBatch]:
    """Rows come ordered by bucket: gather one bucket at a time and answer its blocks."""
    bucket, held = None, []
    for batch in batches:
        for block, b, payload in zip(*(batch.column(c).to_pylist() for c in ("block", "bucket", "payload")), strict=True):
            if b != bucket and held:
                yield _answer(settle(bucket, held))
                held = []
            bucket = b
            held.append((block, payload))
    if held:
        yield _answer(settle(bucket, held))


def _shared_ranks(bucket: int, held: list[tuple[int, bytes]]) -> list[tuple[int, int, bytes]]:
    """A bit for each key of each block: whether another block has it too."""
    parts = [np.frombuffer(p, np.uint32) for _, p in held]
    value = np.sort(np.concatenate(parts))
    shared, out = distinct(value[1:][value[1:] == value[:-1]]), []
    for (block, _), p in zip(held, parts, strict=True):
        at = np.minimum(np.searchsorted(shared, p), max(0, len(shared) - 1))
        found = shared[at] == p if len(shared) else np.zeros(len(p), bool)
        out.append((block, bucket, np.packbits(found).tobytes()))
    return out


def _to_files(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """One file for each block with its answers, ordered by bucket."""
    files, root = file_system(folder)
    block, held = None, []

    def done() -> None:
        head = np.array([len(held), *[x for b, p in held for x in (b, len(p))]], np.int64).tobytes()
        write_file(files, f"{root}/{block}", head + b"".join([p for _, p in held]))

    names = []
    for batch in batches:
        for x, b, payload in zip(*(batch.column(c).to_pylist() for c in ("block", "bucket", "payload")), strict=True):
            if x != block and held:
                done()
                names.append(block)
                held = []
            block = x
            held.append((b, payload))
    if held:
        done()
        names.append(block)
    yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64())], names=["block"])


def _answers(files, root: str, block: int) -> list[tuple[int, memoryview]]:
    """Answers of a block, by bucket. Every block has a file, also one without answers."""
    data = read_file(files, f"{root}/{block}")
    n = int(np.frombuffer(data, np.int64, 1)[0])
    head = np.frombuffer(data, np.int64, 2 * n, 8).reshape(-1, 2)
    out, at = [], 8 + 16 * n
    for b, size in head.tolist():
        if b >= 0:
            out.append((b, memoryview(data)[at : at + size]))
        at += size
    return out


def _sliding_least(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each window of ``w`` values."""
    n = len(x) - w + 1
    padded = np.full(-(-len(x) // w) * w, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    grid = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n], ahead[w - 1 : w - 1 + n])


def _runs(at: np.ndarray) -> np.ndarray:
    """Start and length of the runs of consecutive numbers in ascending positions."""
    if not len(at):
        return np.zeros((0, 2), np.int64)
    cut = np.flatnonzero(np.diff(at) != 1) + 1
    first = at[np.concatenate([[0], cut])]
    last = at[np.concatenate([cut - 1, [len(at) - 1]])]
    return np.stack([first, last - first + 1], axis=1)


def _tied(b: Block, bits: int, answers: list) -> np.ndarray:
    """Positions whose 50 bytes may occur in another document, by the ranks of their samples."""
    at, key = b.sample_keys(bits)
    if not len(at):
        return at
    order = np.argsort(key, kind="stable")
    doc = b.document(at[order])
    value, first, which = np.unique(key[order], return_index=True, return_inverse=True)
    last = np.append(first[1:], len(at)) - 1
    shared = b.ids[doc[first]] != b.ids[doc[last]]  # positions are in the order of ids
    cut = np.searchsorted(value, np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(32))
    for bucket, payload in answers:
        n = cut[bucket + 1] - cut[bucket]
        shared[cut[bucket] : cut[bucket + 1]] |= np.unpackbits(np.frombuffer(payload, np.uint8), count=int(n)).astype(bool)
    sums = np.zeros(len(b.raw) + 1, np.int32)
    sums[at[order][shared[which]] + 1] = 1
    np.cumsum(sums, out=sums)
    near = sums[PERIOD:] > sums[:-PERIOD] if len(sums) > PERIOD else np.zeros(0, bool)  # any in [i, i + 31)
    whole = np.zeros(len(b.raw) + 1, np.int32)  # positions with 50 bytes left in their document
    size = np.diff(b.off)
    np.add.at(whole, b.off[:-1][size >= LENGTH], 1)
    np.add.at(whole, b.off[1:][size >= LENGTH] - LENGTH + 1, -1)
    fits = np.cumsum(whole[:-1]) > 0
    return np.flatnonzero(fits[: len(near)] & near)


def _piece_rows(batches: Iterator[pa.RecordBatch], bits: int, folder: str) -> Iterator[pa.RecordBatch]:
    """Settle ties inside each block, and deal out the text of those left to suffix buckets."""
    files, root = file_system(folder)
    for b in Block.of(batches):
        at = _tied(b, bits, _answers(files, f"{root}/ranks", b.block))
        if not len(at):
            for name in ("local", "same"):
                write_file(files, f"{root}/{name}/{b.block}", b"")
            continue
        h = Sums(b.raw, BYTE_VALUE).span(at, at + LENGTH)
        order = np.argsort(h, kind="stable")
        new = np.ones(len(h), bool)
        new[1:] = h[order][1:] != h[order][:-1]
        own = b.ids[b.document(at[order])]
        head = np.flatnonzero(new)[np.cumsum(new) - 1]  # the first place in the document with the least id
        least = own[head]
        write_file(files, f"{root}/local/{b.block}", _runs(np.sort(at[order[own > least]])).tobytes())
        other = np.flatnonzero(~new & (own == least))
        write_file(files, f"{root}/same/{b.block}", np.stack([at[order[head[other]]], at[order[other]]]).astype(np.uint32).tobytes())
        at = np.sort(at[order[new]])
        del order, new, own, head, least, other
        seeds = np.arange(len(b.raw) - SEED + 1)
        h = mix64(b.words(seeds, 8) ^ mix64(b.words(seeds, 8, 8) + np.uint64(3)))
        least = _sliding_least(h, LENGTH - SEED + 1)[at]
        cut = np.flatnonzero((np.diff(at) != 1) | (least[1:] != least[:-1])) + 1
        first = np.concatenate([[0], cut])
        count = np.diff(np.append(first, len(at)))
        first = np.flatnonzero((np.arange(len(at)) - np.repeat(first, count)) % 128 == 0)  # periodic text has long runs of one seed
        count = np.diff(np.append(first, len(at)))
        start, seed = at[first], least[first]
        ids = b.ids[b.document(start)]
        bucket = (mix64(seed) >> np.uint64(64 - bits)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        edge = np.searchsorted(bucket[order], np.arange((1 << bits) + 1))
        rows = []
        for k in range(1 << bits):
            sel = order[edge[k] : edge[k + 1]]
            if len(sel):
                s, n = start[sel], count[sel]
                texts = b"".join([b.raw[x : x + y + LENGTH - 1].tobytes() for x, y in zip(s.tolist(), n.tolist(), strict=True)])
                rows.append((b.block, k, np.array([len(sel)], np.int64).tobytes() + ids[sel].tobytes() + s.astype(np.uint32).tobytes() + n.astype(np.uint8).tobytes() + texts))
        yield _answer(rows)


def _suffixes(payloads: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First 8 bytes, hash of all 50, document id and position of every suffix of some pieces."""
    texts, ids, starts, counts = [], [], [], []
    for p in payloads:
        n = int(np.frombuffer(p, np.int64, 1)[0])
        ids.append(np.frombuffer(p, np.int64, n, 8))
        starts.append(np.frombuffer(p, np.uint32, n, 8 + 8 * n))
        counts.append(np.frombuffer(p, np.uint8, n, 8 + 12 * n))
        texts.append(np.frombuffer(p, np.uint8, offset=8 + 13 * n))
    raw, count = np.concatenate(texts), np.concatenate(counts).astype(np.int64)
    total = np.cumsum(count) - count
    place = np.cumsum(count + LENGTH - 1) - count - LENGTH + 1
    step = np.arange(int(count.sum())) - np.repeat(total, count)
    at = np.repeat(place, count) + step
    begin = np.ndarray((len(raw) - 7,), ">u8", raw, strides=(1,))[at].astype(np.uint64)
    pos = (np.repeat(np.concatenate(starts), count) + step).astype(np.uint32)
    return begin, Sums(raw, BYTE_VALUE).span(at, at + LENGTH), np.repeat(np.concatenate(ids), count), pos


def _sorted_suffixes(bucket: int, held: list[tuple[int, bytes]]) -> list[tuple[int, int, bytes]]:
    """Sort the suffixes of one bucket; answer each block with runs of positions whose 50 bytes
    occur in a document with a smaller id."""
    parts, owners, some, size = [], [], [], 0
    for j, (_, p) in enumerate(held):
        some.append(p)
        size += len(p)
        n = int(np.frombuffer(p, np.int64, 1)[0])
        owners.append(int(np.frombuffer(p, np.uint8, n, 8 + 12 * n).sum()))
        if size > BLOCK_BYTES // 2 or j + 1 == len(held):
            parts.append(_suffixes(some))
            some, size = [], 0
    begin, rank, own, pos = (np.concatenate(x) for x in zip(*parts, strict=True))
    owner = np.repeat(np.arange(len(held)), owners)
    del parts
    order = np.lexsort((rank, begin))
    new = np.ones(len(order), bool)
    new[1:] = (begin[order][1:] != begin[order][:-1]) | (rank[order][1:] != rank[order][:-1])
    group = np.cumsum(new) - 1
    least = np.minimum.reduceat(own[order], np.flatnonzero(new))[group]
    gone = order[own[order] > least]
    block = owner[gone]
    out = []
    by = np.argsort(block, kind="stable")
    edge = np.searchsorted(block[by], np.arange(len(held) + 1))
    for j, (name, _) in enumerate(held):
        if edge[j] < edge[j + 1]:
            out.append((name, bucket, _runs(np.sort(pos[gone[by[edge[j] : edge[j + 1]]]]).astype(np.int64)).tobytes()))
    return out


def _cut(batches: Iterator[pa.RecordBatch], folder: str, keep_text: bool) -> Iterator[pa.RecordBatch]:
    files, root = file_system(folder)
    for b in Block.of(batches):
        runs = [np.frombuffer(p, np.int64).reshape(-1, 2) for _, p in _answers(files, f"{root}/runs", b.block)]
        same = read_file(files, f"{root}/same/{b.block}")
        if runs and same:
            first, other = np.frombuffer(same, np.uint32).reshape(2, -1)
            depth, r = np.zeros(len(b.raw) + 1, np.int32), np.concatenate(runs)
            np.add.at(depth, r[:, 0], 1)
            np.add.at(depth, r[:, 0] + r[:, 1], -1)
            runs.append(_runs(np.sort(other[np.cumsum(depth)[first] > 0]).astype(np.int64)))
        runs.append(np.frombuffer(read_file(files, f"{root}/local/{b.block}"), np.int64).reshape(-1, 2))
        depth = np.zeros(len(b.raw) + 1, np.int32)
        if runs:
            r = np.concatenate(runs)
            np.add.at(depth, r[:, 0], 1)
            np.add.at(depth, r[:, 0] + r[:, 1] + LENGTH - 1, -1)
        gone = np.cumsum(depth[:-1]) > 0
        head = gone.copy()
        head[1:] &= ~gone[:-1]
        some = b.off[:-1][np.diff(b.off) > 0]
        head[some] = gone[some]
        removed = np.concatenate([[0], np.cumsum(gone)])[b.off]
        spans = np.concatenate([[0], np.cumsum(head)])[b.off]
        left = b.raw[~gone]
        kept_at = b.off - removed
        kept = [left[kept_at[k] : kept_at[k + 1]].tobytes() for k in range(len(b.ids))]
        columns = {
            "doc_id": pa.array(b.ids, mask=b.ids == NO_ID),
            "n_bytes": pa.array(np.diff(b.off)),
            "n_removed": pa.array(np.diff(removed)),
            "n_spans": pa.array(np.diff(spans)),
            "kept": pa.array(kept, pa.binary()) if keep_text else pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
        }
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def remove_repeats(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` of every row: the bytes
    that are left, or with ``keep_text=False`` their lowercase hex SHA-256."""
    from pyspark.sql import functions as F

    spark = docs.sparkSession
    folder = qualified(spark, scratch_folder(spark, "op9"))
    blocks = staged(id_text(docs).mapInArrow(_build, BLOCKS), folder, "blocks")
    total = blocks.agg(F.coalesce(F.sum(F.length("data")), F.lit(0))).first()[0]
    bits = min(20, max(8, int(total * len(COVER) / PERIOD / BUCKET_ROWS).bit_length()))

    def settled(rows: DataFrame, how: Callable, name: str) -> None:
        answers = rows.repartition("bucket").sortWithinPartitions("bucket", "block").mapInArrow(partial(_by_bucket, settle=how), ANSWERS)
        every = blocks.select("block", F.lit(-1).alias("bucket"), F.lit(b"").alias("payload"))  # a file for each block
        answers.union(every).repartition("block").sortWithinPartitions("block", "bucket").mapInArrow(partial(_to_files, folder=f"{folder}/{name}"), "block long").count()

    settled(blocks.mapInArrow(partial(_sample_rows, bits=bits), ANSWERS), _shared_ranks, "ranks")
    settled(blocks.mapInArrow(partial(_piece_rows, bits=bits, folder=folder), ANSWERS), _sorted_suffixes, "runs")
    return blocks.mapInArrow(partial(_cut, folder=folder, keep_text=keep_text), f"doc_id long, n_bytes long, n_removed long, n_spans long, kept {'binary' if keep_text else 'string'}")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep_text=False).withColumnRenamed("kept", "kept_sha256")
