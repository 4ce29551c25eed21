"""Exact Jaccard join on word 5-shingles by size-banded tiles and bitmap signatures (operator 5).

A document's set is the distinct hashes of its 5-word shingles, sorted. Two sets link when
their Jaccard similarity is 0.8 or more. Three exact filters come before the intersection:

* *Prefix*: under one global order of shingles, linked sets share ``COMMON`` of the first
  ``n // 5 + COMMON`` shingles of either (all they share, if that is less). So pairs under a
  shingle that few sets have only count as long as they have met ``COMMON`` times; those that
  meet under a frequent one go on to the tiles, where one meeting is enough. The order puts frequent shingles last (license lines,
  common passages), so they are in nobody's prefix; which ones count as frequent is found by
  counting every set and changes only cost, never results.
* *Size*: linked sets differ in size by a quarter at most. The sets with one prefix shingle
  are sorted by size and cut into tiles; only tiles whose size bands can match are compared.
* *Bitmap*: a bit of A's signature that B's lacks stands for a shingle of A that B lacks, so
  bit counts bound the overlap from above.

What passes is decided by the exact intersection of the sorted arrays. Only components are
asked for, so the join runs in two rounds: first each set is tried with the most connected set
of its size band, and with the next more connected one, that it meets under several prefix
shingles, and what links is joined into components; then only pairs of different components
are compared. Large groups of near copies thus cost links in proportion to their members, and
no link between components is lost: every pair that meets often enough is either inside one
component or compared.

Sets are keyed by their content, so exact copies are one set however many there are. Keys and
shingles are 64-bit hashes; two of them that differ are taken as different contents.

Defined cases: null, empty or blank texts have no shingles and are components of their own;
fewer than five words make one shingle; repeated ids are rows of their own, a null id is in
the component of its text, whose id is the least id that is not null (null if none); an empty
table gives an empty result; other columns are ignored or carried unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linclass.llm.components import connected_components
from linclass.llm.text import SMALL_SLICE, Recent, Sums, distinct_by_doc, fresh_name, id_text, list_array, mix64, scratch_folder, slices, staged, tidy, values_met, word_spans

WORDS = 5
#: Shingles that the order may call frequent; more of them stay unmarked, at a cost in time.
FREQUENT = 1 << 16
#: Shingles counted at one time by a task, and the share of a batch's sets that makes one frequent.
COUNTED, SHARE = 1 << 21, 0.0005
TILE = 1024
#: Linked sets share so many of their first ``n // 5 + COMMON`` shingles (or all, if they have fewer).
COMMON = 10
#: Pairs under a shingle of at most so many sets are counted, beyond it they are compared in tiles.
FEW = 8
#: Signature bits for each shingle: the more, the closer the bound comes to the overlap itself.
LOAD = 4
#: Words (of 64 bits) of the folded signature that goes with every row of a tile; the whole
#: signature is asked afterwards.
FOLDED_WORDS = 32
#: Words of the signatures that a tile compares at one time, on either side.
COMPARED = 1 << 19
#: Keys of so many pairs at most are broadcast (16 bytes a pair).
BROADCAST_PAIRS = 1 << 19
#: Marks in the table that tells a scan which texts it may need.
SPOTS = 1 << 24
_STEP = mix64(np.arange(11, 11 + WORDS, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Document number and hash of each distinct shingle, ascending in both."""
    start, end, doc = word_spans(raw, off)
    if not len(start):
        return doc, np.zeros(0, np.uint64)
    word = Sums(raw).span(start, end)
    n = len(off) - 1
    count = np.bincount(doc, minlength=n)
    first = np.cumsum(count) - count
    full = max(0, len(word) - WORDS + 1)
    s = np.zeros(full, np.uint64)
    for j in range(WORDS):
        s += word[j : j + full] * _STEP[j]
    inside = doc[:full] == doc[WORDS - 1 :]
    docs, values = [doc[:full][inside]], [mix64(s[inside])]
    few = np.flatnonzero((count > 0) & (count < WORDS))
    if len(few):
        s = np.full(len(few), 1, np.uint64) * count[few].astype(np.uint64)
        for j in range(WORDS - 1):
            has = count[few] > j
            s[has] += word[first[few[has]] + j] * _STEP[j]
        docs.append(few)
        values.append(mix64(s))
    return distinct_by_doc(np.concatenate(docs), np.concatenate(values))


def set_keys(doc: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Set size and a 64-bit key of each document's set (0 for an empty one)."""
    size = np.bincount(doc, minlength=n)
    key = np.zeros(n, np.uint64)
    some = np.flatnonzero(size)
    if len(some):
        first = (np.cumsum(size) - size)[some]
        total = np.add.reduceat(mix64(value), first)
        key[some] = mix64(mix64(total + size[some].astype(np.uint64)) + np.bitwise_xor.reduceat(value, first) * np.uint64(0x9E3779B97F4A7C15))
    return size, key


@tidy
def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles that stand out among some thousands of different sets, with their counts."""
    held: list[np.ndarray] = []
    seen = Recent()
    size = sets = 0

    def counted() -> pa.RecordBatch:
        value, count = values_met(held, max(4, ceil(SHARE * sets)))
        return pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(count.astype(np.int64))], names=["shingle", "sets"])

    for _, raw, off in slices(batches, limit=SMALL_SLICE):
        doc, value = shingle_sets(raw, off)
        n, key = set_keys(doc, value, len(off) - 1)
        new = seen.new(key)
        held.append(value[new[doc]])
        size += len(held[-1])
        sets += int(new.sum())
        if size > COUNTED:
            yield counted()
            size, sets, seen = 0, 0, Recent()
    if held:
        yield counted()


def signature(value: np.ndarray) -> bytes:
    """Bitmap of a set: ``LOAD`` bits a shingle, rounded up to a power of two (64 at least)."""
    bits = 1 << max(6, int(LOAD * len(value) - 1).bit_length())
    flags = np.zeros(bits, bool)
    flags[(value & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(flags, bitorder="little").tobytes()


SETS = "doc_id long, uid long, n int, key long, prefix array<long>, bits binary, folded binary"


@tidy
def _sets(batches: Iterator[pa.RecordBatch], frequent: np.ndarray, place: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The set of each row; prefix and signature only with the first row of a set in the task."""
    seen = Recent(slots=1 << 20)  # only spares repeats
    table = np.zeros(1 << 20, bool)
    table[(frequent >> np.uint64(44)).astype(np.int64)] = True
    for rows, raw, off in slices(batches, limit=SMALL_SLICE):
        doc, value = shingle_sets(raw, off)
        n, key = set_keys(doc, value, rows.num_rows)
        late = np.zeros(len(value), np.int64)
        maybe = np.flatnonzero(table[(value >> np.uint64(44)).astype(np.int64)])
        if len(maybe):
            at = np.minimum(np.searchsorted(frequent, value[maybe]), len(frequent) - 1)
            late[maybe] = np.where(frequent[at] == value[maybe], place[at] + 1, 0)
        first = np.cumsum(n) - n
        prefixes, bits, folded = [], [], []
        for k, new in enumerate((seen.new(key) & (n > 0)).tolist()):
            if not new:
                prefixes.append(None)
                bits.append(None)
                folded.append(None)
                continue
            own, turn = value[first[k] : first[k] + n[k]], late[first[k] : first[k] + n[k]]
            early = own[np.argsort(turn, kind="stable")] if turn.any() else own
            prefixes.append(early[: n[k] // 5 + COMMON].view(np.int64))
            bits.append(signature(own))
            folded.append(_fold(np.frombuffer(bits[-1], np.uint64), FOLDED_WORDS).tobytes())
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), rows.column("uid"), pa.array(n, pa.int32()), pa.array(key.view(np.int64)), pa.array(prefixes, pa.list_(pa.int64())), pa.array(bits, pa.binary()), pa.array(folded, pa.binary())],
            names=["doc_id", "uid", "n", "key", "prefix", "bits", "folded"],
        )


@tidy
def _arrays(batches: Iterator[pa.RecordBatch], spots: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sorted shingle arrays of the rows whose spot is marked."""
    for batch in _marked(batches, spots):
        for rows, raw, off in slices([batch], limit=SMALL_SLICE):
            doc, value = shingle_sets(raw, off)
            key = set_keys(doc, value, rows.num_rows)[1]
            cut = np.searchsorted(doc, np.arange(rows.num_rows + 1))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("uid"), pa.array(key.view(np.int64)), list_array(value.view(np.int64), cut, pa.int64())], names=["doc_id", "uid", "key", "shingles"])


def _fold(bits: np.ndarray, size: int) -> np.ndarray:
    """Signatures (rows of 64-bit words) narrowed to ``size`` words."""
    while bits.shape[-1] > size:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] | bits[..., half:]
    return bits


def may_link(n_a: np.ndarray, n_b: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the bit counts of signature rows leave room for a Jaccard similarity of 0.8."""
    most = np.minimum(n_a - np.bitwise_count(a & ~b).sum(1), n_b - np.bitwise_count(b & ~a).sum(1))
    return 9 * most >= 4 * (n_a + n_b)


def _spot(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(SPOTS)).cast("int")


def _spot_table(spots: DataFrame) -> np.ndarray:
    """Marks of a column ``spot`` as ``SPOTS`` bits, whatever the number of rows."""
    marked = spots.select(F.expr("spot div 32").alias("word"), F.expr("shiftleft(1L, spot % 32)").alias("bit"))
    words = marked.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()  # at most SPOTS / 32 rows
    table = np.zeros(SPOTS // 32, np.uint32)
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return table.view(np.uint8)


def _marked(batches: Iterator[pa.RecordBatch], spots: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows whose spot is marked."""
    for batch in batches:
        spot = batch.column("spot").to_numpy()
        yield batch.filter(pa.array((spots[spot >> 3] >> (spot & 7)) & 1 > 0))


@tidy
def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures allow a link."""
    for batch in batches:
        raw = [[np.frombuffer(x, np.uint64) for x in batch.column(c).to_pylist()] for c in ("bits_a", "bits_b")]
        n_a, n_b = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
        width = np.array([min(len(x), len(y)) for x, y in zip(*raw, strict=True)], np.int64)
        keep = np.zeros(batch.num_rows, bool)
        for w in np.unique(width):
            rows = np.flatnonzero(width == w)
            for c in range(0, len(rows), 4096):
                r = rows[c : c + 4096]
                a, b = (np.stack([_fold(x[k], int(w)) for k in r]) for x in raw)
                keep[r] = may_link(n_a[r], n_b[r], a, b)
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(keep)), batch.column("b").filter(pa.array(keep))], names=["a", "b"])


@tidy
def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sorted arrays have enough in common: both are merged, and a value of both
    stands beside itself."""
    for batch in batches:
        keep = np.zeros(batch.num_rows, bool)
        for k, (x, y) in enumerate(zip(batch.column("of_a"), batch.column("of_b"), strict=True)):
            merged = np.concatenate([x.values.to_numpy(), y.values.to_numpy()])
            merged.sort(kind="stable")  # two sorted runs: one merge
            keep[k] = 9 * int((merged[1:] == merged[:-1]).sum()) >= 4 * len(merged)
        yield batch.select(["a", "b"]).filter(pa.array(keep))


@tidy
def _tiles(batches: Iterator[pa.RecordBatch], most: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Rows come ordered by tile pair and size. Within each, pairs of different components in
    reach of one another's size whose signatures allow a link. A pair that a task meets again
    under another shingle is given once."""
    held: pa.Table | None = None
    given = Recent(2)  # only spares repeats

    def compare(t: pa.Table) -> Iterator[pa.RecordBatch]:
        key, n, comp, left, right, tile, token = (t.column(c).to_numpy() for c in ("key", "n", "comp", "left", "right", "tile", "token"))
        change = np.ones(len(key), bool)
        change[1:] = (token[1:] != token[:-1]) | (left[1:] != left[:-1]) | (right[1:] != right[:-1])
        group = np.cumsum(change)
        span = int(n.max()) * 2 + 2
        size = group * span + n
        reach = np.searchsorted(size, group * span + n * 5 // 4, "right") - np.arange(len(n)) - 1
        bits = [np.frombuffer(x, np.uint64) for x in t.column("bits").to_pylist()]
        width = np.array([len(b) for b in bits])
        total = np.concatenate([[0], np.cumsum(reach)])
        a = 0
        while a < len(n):
            b = max(a + 1, int(np.searchsorted(total, total[a] + most, "right")) - 1)
            i = np.repeat(np.arange(a, b), reach[a:b])
            j = np.arange(total[a], total[b]) - np.repeat(total[a:b], reach[a:b]) + i + 1
            other = (comp[i] != comp[j]) & ((left[i] == right[i]) | (tile[i] != tile[j]))
            i, j = i[other], j[other]
            keep = np.zeros(len(i), bool)
            for w in np.unique(width[i]) if len(i) else ():  # the smaller set has the narrower signature
                p = np.flatnonzero(width[i] == w)
                used, where = np.unique(np.concatenate([i[p], j[p]]), return_inverse=True)
                folded = np.stack([_fold(bits[k], int(w)) for k in used])
                step = max(1, COMPARED // int(w))
                for c in range(0, len(p), step):
                    q = slice(c, c + step)
                    x, y = where[: len(p)][q], where[len(p) :][q]
                    keep[p[q]] = may_link(n[i[p[q]]], n[j[p[q]]], folded[x], folded[y])
            i, j = i[keep], j[keep]
            x, y = np.minimum(key[i], key[j]), np.maximum(key[i], key[j])
            new = given.new(x.view(np.uint64), y.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(x[new]), pa.array(y[new])], names=["a", "b"])
            a = b

    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = t if held is None else pa.concat_tables([held, t])
        last = [t.column(c)[-1].as_py() for c in ("token", "left", "right")] if len(t) else None
        if last is None:
            continue
        same = np.logical_and.reduce([t.column(c).to_numpy() == x for c, x in zip(("token", "left", "right"), last, strict=True)])
        whole = len(t) - int(same.sum())
        held = t.slice(whole)
        if whole:
            yield from compare(t.slice(0, whole).combine_chunks())
    if held is not None and len(held):
        yield from compare(held.combine_chunks())


def join_sets(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The set of every row (``SETS``), and ``node`` and ``root`` keys of linked sets."""
    spark = docs.sparkSession
    folder = scratch_folder(spark, "op5")
    rows = id_text(docs).withColumn("uid", F.xxhash64("text"))
    top = rows.mapInArrow(_frequent, "shingle long, sets long").groupBy("shingle").agg(F.sum("sets").alias("sets")).orderBy(F.desc("sets"), "shingle").limit(FREQUENT).collect()  # at most FREQUENT rows
    frequent = np.array([r[0] for r in top], np.int64).view(np.uint64)
    order = np.argsort(frequent)
    place = np.arange(len(top), 0, -1)[order]  # the most frequent last
    shared = spark.sparkContext.broadcast((frequent[order], place))
    sets = staged(rows.mapInArrow(lambda b: _sets(b, *shared.value), SETS), folder, "sets")
    firsts = sets.where("prefix is not null")
    held = [shared]

    # sets that share prefix shingles with others; each shingle's most connected set of a size band
    # is tried as the centre of the others, if it is that under several of their shingles
    token, band = Window.partitionBy("token"), F.floor(F.log("n") / F.log(F.lit(1.25))).cast("int")
    posted = firsts.select(F.explode("prefix").alias("token"), "key", "n")
    posted = posted.withColumns({"least": F.min("key").over(token), "most": F.max("key").over(token), "sets": F.count("key").over(token)}).where("least != most")
    posted = staged(posted.select("token", "key", "n", "sets").distinct(), folder, "posted")
    # a set with fewer shared shingles than a link needs has no link
    met = posted.groupBy("key").agg(F.sum("sets").alias("links"), F.count("*").alias("met"))
    posted = staged(posted.join(met, "key").where(F.expr(f"met >= least({COMMON}, (4 * n + 4) div 5)")).select("token", "key", "n", "links"), folder, "known")
    known = posted.withColumn("band", band)
    central = Window.partitionBy("token", "band").orderBy(F.desc("links"), "key")
    known = known.withColumns({"head": F.first("key").over(central), "head_n": F.first("n").over(central), "prev": F.lag("key").over(central), "prev_n": F.lag("n").over(central)})
    tried = known.select(F.inline(F.array(F.struct("key", "n", F.col("prev").alias("o"), F.col("prev_n").alias("o_n")), F.struct("key", "n", F.col("head").alias("o"), F.col("head_n").alias("o_n")))))
    tried = tried.where("o is not null and key != o and 5 * least(n, o_n) >= 4 * greatest(n, o_n)").groupBy(F.least("key", "o").alias("a"), F.greatest("key", "o").alias("b"))
    tried = tried.agg(F.count("*").alias("shared"), F.min(F.least("n", "o_n")).alias("low")).where("20 * shared >= low")

    def bounded(pairs: DataFrame, name: str, steps: tuple[str, ...]) -> DataFrame:
        """Pairs whose signatures allow a link. Only the signatures of sets in a pair are dealt out;
        their keys are broadcast if they are few, and joined otherwise."""
        pairs = staged(pairs.select("a", "b"), folder, f"tried-{name}")
        for bits in steps:
            keys = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
            keys = F.broadcast(keys) if pairs.count() <= BROADCAST_PAIRS else keys
            marks = firsts.select("key", "n", bits).join(keys, "key", "left_semi").dropDuplicates(["key"])
            with_a = pairs.select(F.col("a").alias("key"), "b").join(marks, "key").select(F.col("key").alias("a"), F.col("b").alias("key"), F.col("n").alias("n_a"), F.col(bits).alias("bits_a"))
            both = with_a.join(marks, "key").select("a", F.col("key").alias("b"), "n_a", F.col("n").alias("n_b"), "bits_a", F.col(bits).alias("bits_b"))
            pairs = staged(both.mapInArrow(_bounded, "a long, b long"), folder, f"near-{name}-{bits}")
        return pairs

    near = bounded(tried, "1", ("bits",))

    owner = firsts.select("key", "uid", "doc_id").dropDuplicates(["key"])

    def linked(pairs: DataFrame, name: str) -> DataFrame:
        """Pairs whose exact intersection reaches the bound. Only the sets in a pair are built
        again, in a scan of the texts that leaves out the rows whose spot in a table of fixed
        size isn't marked; an exact join takes care of the spots that others share."""
        wanted = staged(owner.join(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct(), "key"), folder, f"wanted-{name}")
        spots = spark.sparkContext.broadcast(_spot_table(wanted.select(_spot("uid", "doc_id").alias("spot"))))
        held.append(spots)
        built = rows.withColumn("spot", _spot("uid", "doc_id")).mapInArrow(lambda b: _arrays(b, spots.value), "doc_id long, uid long, key long, shingles array<long>")
        arrays = built.select("key", "shingles").join(wanted.select("key"), "key").dropDuplicates(["key"])  # rows of a key have one set
        arrays = staged(arrays, folder, f"arrays-{name}")
        with_a = pairs.select(F.col("a").alias("key"), "b").join(arrays, "key").select(F.col("key").alias("a"), F.col("b").alias("key"), F.col("shingles").alias("of_a"))
        both = with_a.join(arrays, "key").select("a", F.col("key").alias("b"), "of_a", F.col("shingles").alias("of_b"))
        return staged(both.mapInArrow(_linked, "a long, b long"), folder, f"links-{name}")

    first_links = linked(near, "1")
    stars = connected_components(first_links, folder, "first")

    # pairs of different components under the prefix shingles they share
    placed = posted.select("token", "key", "n").join(stars.withColumnRenamed("node", "key"), "key", "left").select("token", "key", "n", F.coalesce("root", "key").alias("comp"))
    mixed = placed.withColumns({"least": F.min("comp").over(token), "most": F.max("comp").over(token), "sets": F.count("key").over(token), "at": F.row_number().over(token.orderBy("n", "key"))}).where("least != most")
    mixed = staged(mixed.select("token", "key", "n", "comp", "sets", F.floor((F.col("at") - 1) / TILE).cast("int").alias("tile")), folder, "mixed")

    # shingles of few sets: their pairs are counted, a link needs COMMON of them
    few = mixed.where(F.col("sets") <= FEW)
    other = few.select("token", F.col("key").alias("b"), F.col("n").alias("n_b"), F.col("comp").alias("comp_b"))
    counted = few.select("token", F.col("key").alias("a"), "n", "comp").join(other, "token").where("a < b and comp != comp_b and 5 * least(n, n_b) >= 4 * greatest(n, n_b)")
    counted = counted.groupBy("a", "b").agg(F.count("*").alias("shared"), F.max(F.greatest("n", "n_b")).alias("high")).where(F.expr(f"shared >= least({COMMON}, (4 * high + 4) div 5)"))

    # shingles of many: tiles
    many = mixed.where(F.col("sets") > FEW)
    ranges = many.groupBy("token", "tile").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    pairs = ranges.select("token", F.col("tile").alias("left"), F.col("high").alias("left_high")).join(ranges.select("token", F.col("tile").alias("right"), F.col("low").alias("right_low")), "token").where("left <= right and 5 * left_high >= 4 * right_low").select("token", "left", "right")
    small = firsts.select("key", F.col("folded").alias("bits")).dropDuplicates(["key"])
    dealt = pairs.withColumn("tile", F.explode(F.array_distinct(F.array("left", "right")))).join(many, ["token", "tile"]).join(small, "key")
    dealt = dealt.select("token", "left", "right", "tile", "key", "n", "comp", "bits").repartition("token", "left", "right").sortWithinPartitions("token", "left", "right", "n", "key")
    more = bounded(dealt.mapInArrow(_tiles, "a long, b long").union(counted.select("a", "b")).distinct(), "2", ("folded", "bits"))
    links = first_links.union(linked(more, "2"))
    stars = connected_components(links, folder, "all")
    for broadcast in held:
        broadcast.unpersist()
    return sets, stars


def link_components(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` (least id of the component) of every row."""
    sets, stars = join_sets(docs)
    owned = sets.groupBy("key").agg(F.min("doc_id").alias("first_id")).join(stars.withColumnRenamed("node", "key"), "key", "left")
    owned = owned.select("key", F.coalesce("root", "key").alias("root"), "first_id")
    roots = owned.groupBy("root").agg(F.min("first_id").alias("component_id"))
    ids = owned.join(roots, "root").select("key", "component_id")
    linked_rows = sets.where("n > 0").select("doc_id", "n", "key").join(ids, "key").select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")
    return linked_rows.unionByName(sets.where("n = 0").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each component (the one with the least id, null last; of rows with that id the
    one whose text hashes lowest) and all rows without words; all columns as they are."""
    sets, stars = join_sets(docs)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid")).alias("first")
    owned = sets.where("n > 0").groupBy("key").agg(first).join(stars.withColumnRenamed("node", "key"), "key", "left")
    keep = owned.groupBy(F.coalesce("root", "key").alias("root")).agg(F.min("first").alias("first")).select(F.col("first.uid").alias("keep_uid"), F.col("first.doc_id").alias("keep_id"))
    uid, at, keep_uid, keep_id = (fresh_name(c, docs.columns) for c in ("uid", "at", "keep_uid", "keep_id"))
    marked = docs.withColumn(uid, F.xxhash64(F.col("text").cast("string")))
    wordless = F.coalesce(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(True))
    keep = keep.toDF(keep_uid, keep_id)
    kept = marked.where(~wordless).join(keep, (F.col(uid) == F.col(keep_uid)) & F.col("doc_id").cast("long").eqNullSafe(F.col(keep_id)), "left_semi")
    single = kept.withColumn(at, F.row_number().over(Window.partitionBy(uid, "doc_id").orderBy(uid))).where(F.col(at) == 1).drop(at)
    return single.unionByName(marked.where(wordless)).drop(uid)


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
