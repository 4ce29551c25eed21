"""Information-theoretic sanitisation of personal data (operator 10).

Base spans (e-mail, IPv4 address, payment card, telephone number) come from fixed patterns.
Each found value is a protected entity. Words near its mentions may reveal it: over the whole
corpus, with n texts, n(e) of them with entity e, n(t) with term t and n(t, e) with t near a
mention of e, the share of e's information that t discloses is

    PMI(t; e) / IC(e) = log2(n(t, e) * n / (n(t) * n(e))) / log2(n / n(e)).

Small counts are no sure sign, so the share is also taken with the lower confidence bound of
n(t, e) / n(t) (Wilson, one-sided, ``QUANTILE``) instead of that ratio. Terms whose bounded share
is at or above ``GENERALISE`` become spans as well, kind ``term``: they are generalised to a
placeholder, and removed if the share itself is at or above ``REMOVE``, wherever they stand in any
text, near the entity or not. Every entity is judged by
this, also one that is met once: what a term in a single text must outweigh is the bound of 1 of
1, which it does if n / n(e) is some 700 or more.

All four numbers count distinct texts, by a hash of the text, so repeated rows and null or
repeated ids cannot change a result. A table of fixed size marks the texts that several rows
may have; only those are brought together to be counted once, all others are counted where
they are read. The marks change cost, never results.

Defined cases: null text is empty (no spans); an empty table gives an empty result; other
columns are ignored by the finder and carried unchanged by :func:`sanitise`.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from linclass.llm.labels import trimmed
from linclass.llm.text import SMALL_SLICE, Sums, distinct_by_doc, fresh_name, id_text, scratch_folder, slices, staged, tidy, word_spans

# Fixed patterns of the result contract.
KINDS = ("email", "ip", "card", "phone", "term")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# The look-behind only skips starts inside a run of digits that has failed at its first digit.
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

#: Terms on either side of a mention that are its context.
WINDOW = 8
#: Disclosure shares of the two actions, and the normal quantile (95 %) of the confidence bound.
GENERALISE, REMOVE, QUANTILE = 0.8, 0.95, 1.645
#: A term in more than a share 1 / COMMON of all texts is judged without a shuffle.
COMMON = 256
#: Parts into which the places of one term are dealt.
PARTS = 16
#: Marks in a table that thins a scan; the more keys share one, the more rows pass in vain.
SPOTS = 1 << 24
#: Keys that a task remembers to spare repeats.
SEEN = 1 << 20


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches of the e-mail pattern, found from each @ outwards, so
    that long runs without one cost nothing."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(done, at + 1))


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) by kind, then start; code points, end exclusive."""
    out = [(0, a, b) for a, b in emails(text)]
    if DIGIT.search(text):
        if "." in text:
            out += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(len(q) <= 3 and int(q or "0") <= 255 for q in (p.lstrip("0") for p in m[0].split(".")))]
        for m in CARD.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
        if "+" in text:
            out += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def joined(spans: Iterable[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def _long_hash(data: str | bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data.encode() if isinstance(data, str) else data, digest_size=8).digest(), "little", signed=True)


def term_places(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, start and end (code points) and hash of every term: words of three bytes and
    more without the punctuation at their ends."""
    start, end, doc = word_spans(raw, off)
    if not len(start):
        return doc, start, end, np.zeros(0, np.int64)
    start, end = trimmed(raw, start, end)
    keep = end - start >= 3
    start, end, doc = start[keep], end[keep], doc[keep]
    term = Sums(raw).span(start, end).view(np.int64)
    at = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=at[1:])
    first = at[off[doc]]
    return doc, at[start] - first, at[end] - first, term


def covered(spans: list[tuple[int, int, int]], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether places of a text overlap any of its base spans."""
    if not spans:
        return np.zeros(len(start), bool)
    low, high = np.array(sorted((a, b) for _, a, b in spans)).T
    reach = np.maximum.accumulate(high)
    at = np.searchsorted(low, end) - 1  # the last span that starts before the end
    return (at >= 0) & (reach[np.maximum(at, 0)] > start)


def contexts(text: str, spans: list[tuple[int, int, int]], window: int) -> list[dict]:
    """Each entity of the text with each term of its contexts: ``window`` terms on either side of
    a mention, however long, without those inside another mention."""
    raw = np.frombuffer(text.encode(), np.uint8)
    _, start, end, term = term_places(raw, np.array([0, len(raw)]))
    free = ~covered(spans, start, end)
    out = set()
    for k, a, b in spans:
        entity, left, right = entity_hash(text, k, a, b), int(np.searchsorted(end, a, "right")), int(np.searchsorted(start, b))
        for part in (slice(max(0, left - window), left), slice(right, right + window)):
            out.update((entity, t) for t in term[part][free[part]].tolist())
    return [{"entity": e, "term": t} for e, t in out]


def entity_hash(text: str, kind: int, start: int, end: int) -> int:
    return _long_hash(f"{kind}:{text[start:end]}")


FOUND = "doc_id long, text_key long, base array<struct<kind:int,start:int,end:int>>, entities array<long>, contexts array<struct<entity:long,term:long>>"
_BASE = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
_CONTEXTS = pa.list_(pa.struct([("entity", pa.int64()), ("term", pa.int64())]))


def text_keys(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Hash of each text (a null one counts as empty)."""
    data = memoryview(raw)
    return np.array([_long_hash(data[a:b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)], np.int64)


def spot_table(keys: DataFrame) -> np.ndarray:
    """A bit for each spot that a key (the only column) falls on, as bytes."""
    spot = F.col(keys.columns[0]).bitwiseAND(F.lit(SPOTS - 1))
    marked = keys.select(spot.alias("spot")).select(F.expr("spot div 32").alias("word"), F.expr("shiftleft(1L, cast(spot % 32 as int))").alias("bit"))
    words = marked.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()  # at most SPOTS / 32 rows
    table = np.zeros(SPOTS // 32, np.uint32)
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return table.view(np.uint8)


def on_spot(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    spot = keys & (SPOTS - 1)
    return (table[spot >> 3] >> (spot & 7).astype(np.uint8)) & 1 == 1


@tidy
def _find(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for rows, raw, off in slices(batches, limit=SMALL_SLICE):
        base, entities, near = [], [], []
        for text in rows.column("text").to_pylist():
            spans = base_spans(text or "")
            base.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
            entities.append(list({entity_hash(text, *s) for s in spans}) if spans else None)
            near.append(contexts(text, spans, window) if spans else None)
        columns = [rows.column("doc_id"), pa.array(text_keys(raw, off)), pa.array(base, _BASE), pa.array(entities, pa.list_(pa.int64())), pa.array(near, _CONTEXTS)]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_key", "base", "entities", "contexts"])


@tidy
def _single(batches: Iterator[pa.RecordBatch], copied: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows whose text no other row has."""
    for rows, raw, off in slices(batches, limit=SMALL_SLICE):
        yield rows.select(["text"]).filter(pa.array(~on_spot(copied, text_keys(raw, off))))


@tidy
def _copied(batches: Iterator[pa.RecordBatch], copied: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Key and text of the others, once a task as far as it remembers them."""
    seen: set[int] = set()
    for rows, raw, off in slices(batches, limit=SMALL_SLICE):
        key = text_keys(raw, off)
        keep = on_spot(copied, key)
        for k in np.flatnonzero(keep).tolist():
            x = int(key[k])
            keep[k] = x not in seen
            if len(seen) < SEEN:
                seen.add(x)
        yield pa.RecordBatch.from_arrays([pa.array(key), rows.column("text")], names=["text_key", "text"]).filter(pa.array(keep))


@tidy
def _term_texts(batches: Iterator[pa.RecordBatch], most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Number of texts with each term, summed over slices while they fit a bounded buffer."""
    held: list[np.ndarray] = []
    size = 0

    def merged() -> pa.RecordBatch:
        value, count = np.unique(np.concatenate(held), return_counts=True)
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(count.astype(np.int64))], names=["term", "texts"])

    for _, raw, off in slices(batches, limit=SMALL_SLICE):
        start, end, doc = word_spans(raw, off)
        if len(start):
            start, end = trimmed(raw, start, end)
            keep = end - start >= 3
            held.append(distinct_by_doc(doc[keep], Sums(raw).span(start[keep], end[keep]))[1])
            size += len(held[-1])
        if size > most:
            yield merged()
            size = 0
    if held:
        yield merged()


@tidy
def _places(batches: Iterator[pa.RecordBatch], chosen: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Places outside base spans of the terms whose spot is marked, of every text; a text once a
    task as far as it remembers them."""
    seen: set[int] = set()
    for rows, raw, off in slices(batches, limit=SMALL_SLICE):
        doc, start, end, term = term_places(raw, off)
        hit = on_spot(chosen, term)
        doc, start, end, term = doc[hit], start[hit], end[hit], term[hit]
        keep, key = np.ones(len(doc), bool), np.zeros(len(doc), np.int64)
        which, first, size = np.unique(doc, return_index=True, return_counts=True)
        for k, a, b in zip(which.tolist(), first.tolist(), (first + size).tolist(), strict=True):
            x = int(text_keys(raw, off[k : k + 2])[0])
            key[a:b] = x
            keep[a:b] = False if x in seen else ~covered(base_spans(rows.column("text")[k].as_py()), start[a:b], end[a:b])
            if len(seen) < SEEN:
                seen.add(x)
        columns = [pa.array(key), pa.array(term), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))]
        yield pa.RecordBatch.from_arrays(columns, names=["text_key", "term", "start", "end"]).filter(pa.array(keep))


def least_ratio(part: F.Column, whole: F.Column) -> F.Column:
    """Lower confidence bound of the ratio of two counts (Wilson's interval)."""
    z = QUANTILE * QUANTILE
    return (part + z / 2 - QUANTILE * F.sqrt(part * (whole - part) / whole + z / 4)) / (whole + z)


def find(docs: DataFrame, window: int = WINDOW, share: float = GENERALISE) -> tuple[DataFrame, DataFrame]:
    """All findings: one row of base spans for each document, and the revealing terms of each
    text (``text_key``, ``terms``: array of start, end and disclosure share)."""
    spark = docs.sparkSession
    rows = id_text(docs)
    folder = scratch_folder(spark, "op10")
    found = staged(rows.mapInArrow(lambda b: _find(b, window), FOUND), folder, "found")
    keys = found.groupBy("text_key").agg(F.count("*").alias("rows"))
    n = max(2, keys.count())
    once = found.where("size(entities) > 0").dropDuplicates(["text_key"])
    entity_texts = once.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("n_e"))
    pairs = once.select(F.inline("contexts")).groupBy("entity", "term").agg(F.count("*").alias("n_te"))
    copied = spark.sparkContext.broadcast(spot_table(keys.where("rows > 1").select("text_key")))
    single = rows.mapInArrow(lambda b: _term_texts(_single(b, copied.value)), "term long, texts long")
    several = rows.mapInArrow(lambda b: _copied(b, copied.value), "text_key long, text string").dropDuplicates(["text_key"]).mapInArrow(_term_texts, "term long, texts long")
    texts = staged(single.unionByName(several).groupBy("term").agg(F.sum("texts").alias("n_t")), folder, "texts")
    information = F.log2(n / F.col("n_e"))
    told = lambda ratio: F.log2(ratio * n / F.col("n_e")) / information
    enough = lambda n_t: told(least_ratio(F.col("n_te"), F.col(n_t))) >= share
    # a value in every second text or more carries no information that could be disclosed
    judged = pairs.join(entity_texts, "entity").where(F.col("n_e") * 2 < n)
    # words like "the" stand near every entity; there are few such terms, so they are judged here
    common = texts.where(F.col("n_t") * COMMON > n).select("term", F.col("n_t").alias("often"))
    judged = judged.join(F.broadcast(common), "term", "left").where(F.col("often").isNull() | enough("often"))
    revealing = judged.join(texts, "term").where(enough("n_t")).select("term", F.least(F.lit(1.0), told(F.col("n_te") / F.col("n_t"))).alias("share"))
    chosen = staged(revealing.groupBy("term").agg(F.max("share").alias("share")), folder, "chosen")
    # the decision holds for the term wherever it stands; a term of many texts has them in several parts
    spots = spark.sparkContext.broadcast(spot_table(chosen.select("term")))
    places = rows.mapInArrow(lambda b: _places(b, spots.value), "text_key long, term long, start int, end int").withColumn("part", F.pmod("text_key", F.lit(PARTS)))
    parts = chosen.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PARTS - 1).cast("long"))))
    terms = places.join(parts, ["term", "part"]).groupBy("text_key", "start", "end").agg(F.max("share").alias("share"))
    terms = terms.groupBy("text_key").agg(F.sort_array(F.collect_list(F.struct("start", "end", "share"))).alias("terms"))
    return found, staged(terms, folder, "terms")


@tidy
def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, digests, strings = [], [], []
        for base, terms in zip(batch.column("base").to_pylist(), batch.column("terms").to_pylist(), strict=True):
            spans = [(s["kind"], s["start"], s["end"]) for s in base]
            counts.append([sum(k == j for k, _, _ in spans) for j in range(4)])
            digests.append(hashlib.sha256(joined(spans).encode()).hexdigest())
            strings.append(joined(spans + [(4, t["start"], t["end"]) for t in terms or []]))
        columns = [pa.array([c[j] for c in counts], pa.int64()) for j in range(4)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns, pa.array(digests, pa.string()), pa.array(strings, pa.string())], names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, terms = find(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "text_key", "base").join(terms, "text_key", "left").select("doc_id", "base", "terms").mapInArrow(_digest, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    """Replace spans, the earlier and longer first; parts of later overlapping ones that are
    still uncovered go with them."""
    out, at = [], 0
    for a, b, word in sorted(spans, key=lambda s: (s[0], -s[1])):
        if b <= at:
            continue
        out.append(text[at : max(at, a)])
        if a >= at:
            out.append(word)
        at = b
    return "".join(out) + text[at:]


def sanitise(docs: DataFrame) -> DataFrame:
    """The table with its texts sanitised: base spans become ``[EMAIL]`` and so on, revealing
    terms ``[TERM]`` or nothing. All columns stay; only ``text`` changes."""
    _, terms = find(docs)
    schema, spots = docs.schema, docs.sparkSession.sparkContext.broadcast(spot_table(terms.select("text_key")))
    key = fresh_name("pii_key", schema.names)
    keyed = fresh_name("pii_terms", schema.names)

    def rewritten(rows: pa.RecordBatch, told: list) -> pa.RecordBatch:
        out = []
        for text, terms in zip(rows.column("text").to_pylist(), told, strict=True):
            spans = [(a, b, f"[{KINDS[k].upper()}]") for k, a, b in base_spans(text or "")]
            spans += [(t["start"], t["end"], "" if t["share"] >= REMOVE else "[TERM]") for t in terms or []]
            out.append(redact(text, spans) if spans else text)
        columns = [pa.array(out, pa.string()) if f.name == "text" else rows.column(f.name) for f in schema]
        return pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])

    @tidy
    def without_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, off in slices(batches, limit=SMALL_SLICE):
            rows = rows.filter(pa.array(~on_spot(spots.value, text_keys(raw, off))))
            yield rewritten(rows, [None] * rows.num_rows)

    @tidy
    def with_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, off in slices(batches, limit=SMALL_SLICE):
            own = text_keys(raw, off)
            yield rows.append_column(key, pa.array(own)).filter(pa.array(on_spot(spots.value, own)))

    @tidy
    def with_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _, _ in slices(batches, limit=SMALL_SLICE):
            yield rewritten(rows, rows.column(keyed).to_pylist())

    # texts without terms need no join; the others are dealt for theirs, so that no task has two
    # Python workers, one behind the other, with the memory of both
    plain = docs.mapInArrow(without_terms, schema)
    marked = docs.mapInArrow(with_key, StructType([*schema.fields, StructField(key, LongType())]))
    told = marked.join(terms.select(F.col("text_key").alias(key), F.col("terms").alias(keyed)).hint("merge"), key, "left").drop(key)
    return plain.unionByName(told.mapInArrow(with_terms, schema))
