"""Offset-mapped token attribution (operator 7).

A document is encoded once, whole. Its tokens are intervals of its bytes, its sections (lines,
each with the line break that ends it) are intervals too; one interval join gives every token
its section. Rule for a token that crosses a boundary: it belongs to the section that holds
most of its bytes, the earliest of equals. So the counts of the sections add up to the count
of the document, which they would not if sections were encoded apart.

Sections may also come as a table of code-point intervals (fields, headings, turns), see
:func:`tokens_of_sections`. Token intervals are then those of code points: a token that holds
a part of a character's bytes holds the character, as the tokenizers library has it.

Defined cases: null or empty text has no tokens and no sections; null and repeated ids are
rows like others; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linclass.llm.text import id_text, list_array, slices
from linclass.llm.tokenize import default_tokenizer, encoder

SCHEMA = "doc_id long, n_tokens long, n_sections long, n_crossing long, section_tokens array<long>"


def attribute(token_bytes: np.ndarray, section_ends: np.ndarray) -> tuple[np.ndarray, int]:
    """Section number of each token and how many tokens cross a boundary. Tokens and sections
    both cover the document's bytes without gaps; ``section_ends`` is ascending."""
    end = np.cumsum(token_bytes)
    start = end - token_bytes
    first = np.searchsorted(section_ends, start, "right")
    last = np.searchsorted(section_ends, end - 1, "right")
    crossing = np.flatnonzero(first != last)
    for t in crossing:
        edges = np.concatenate([[start[t]], section_ends[first[t] : last[t]], [end[t]]])
        first[t] += int(np.argmax(np.diff(edges)))
    return first, len(crossing)


def _count(batches: Iterator[pa.RecordBatch], tokenizer: str) -> Iterator[pa.RecordBatch]:
    coder = encoder(tokenizer)
    for rows, raw, off in slices(batches):
        texts = [t or "" for t in rows.column("text").to_pylist()]
        n_tokens, n_sections, n_crossing, counts = [], [], [], []
        for k, got in enumerate(coder.ids(texts)):
            a, b = off[k], off[k + 1]
            ends = np.flatnonzero(raw[a:b] == 10) + 1
            if b > a and (not len(ends) or ends[-1] != b - a):
                ends = np.append(ends, b - a)
            ids = np.frombuffer(got, np.uint32)
            section, crossed = attribute(coder.n_bytes[ids], ends)
            n_tokens.append(len(ids))
            n_sections.append(len(ends))
            n_crossing.append(crossed)
            counts.append(np.bincount(section, minlength=len(ends)))
        sections = list_array(np.concatenate([np.zeros(0, np.int64), *counts]), np.concatenate([[0], np.cumsum(n_sections)]), pa.int64())
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(n_tokens, pa.int64()), pa.array(n_sections, pa.int64()), pa.array(n_crossing, pa.int64()), sections], names=["doc_id", "n_tokens", "n_sections", "n_crossing", "section_tokens"])


def section_token_counts(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Tokens of every whole text, and of each of its lines, without a shuffle."""
    return id_text(docs).mapInArrow(partial(_count, tokenizer=tokenizer or default_tokenizer()), SCHEMA)


def token_characters(text: bytes, n_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each token in code points, from the tokens' numbers of bytes."""
    number = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    end = np.cumsum(n_bytes)
    start = end - n_bytes
    if not len(n_bytes):
        return start, end
    return number[start] - 1, number[end - 1]


def assign(start: np.ndarray, end: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Section of each token (-1: none) and whether it crosses a boundary. Sections ascend and do
    not overlap; gaps and empty ones are allowed."""
    first = np.searchsorted(ends, start, "right")
    last = np.searchsorted(begins, end, "left") - 1
    found = np.where(first <= last, first, -1)
    inside = (found >= 0) & (first == last) & (begins[np.minimum(first, len(begins) - 1)] <= start) & (ends[np.minimum(first, len(ends) - 1)] >= end) if len(begins) else np.zeros(len(start), bool)
    crossing = (found >= 0) & ~inside
    for t in np.flatnonzero(first < last):
        k = np.arange(first[t], last[t] + 1)
        held = np.minimum(ends[k], end[t]) - np.maximum(begins[k], start[t])
        found[t] = k[int(np.argmax(held))] if held.max() > 0 else -1
    return found, crossing


def _by_section(batches: Iterator[pa.RecordBatch], tokenizer: str) -> Iterator[pa.RecordBatch]:
    coder = encoder(tokenizer)
    for rows, raw, off in slices(batches):
        out = []
        told = rows.column("sections").to_pylist()
        for k, (doc_id, got) in enumerate(zip(rows.column("doc_id").to_pylist(), coder.ids([t or "" for t in rows.column("text").to_pylist()]), strict=True)):
            start, end = token_characters(raw[off[k] : off[k + 1]].tobytes(), coder.n_bytes[np.frombuffer(got, np.uint32)])
            own = told[k] or []
            begins, ends = (np.array([x[c] for x in own], np.int64) for c in ("start", "end"))
            if (ends < begins).any() or (begins[1:] < ends[:-1]).any():
                raise ValueError(f"sections of document {doc_id} overlap or end before they start")
            found, crossing = assign(start, end, begins, ends)
            n, crossed = np.bincount(found + 1, minlength=len(own) + 1), np.bincount(found + 1, crossing, len(own) + 1)
            out += [(doc_id, None, int(n[0]), 0)] if n[0] or not own else []
            out += [(doc_id, x["section"], int(n[j]), int(crossed[j])) for j, x in enumerate(own, 1)]
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], t) for j, t in enumerate(kinds)], names=["doc_id", "section", "n_tokens", "n_crossing"])


def tokens_of_sections(docs: DataFrame, sections: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``doc_id, section, n_tokens, n_crossing`` for each row of ``sections`` (``doc_id``, ``section``,
    ``start``, ``end``: code points, end exclusive) of a document in ``docs``.

    Each document is encoded once, whole. A token that lies in several sections belongs to the one
    that holds most of its code points, the earliest of equals, and counts as crossing there; so
    does one that sticks out into a gap. Tokens in no section are counted in a row without one.
    Sections of a document that overlap are an error; rows with a null in them are ignored."""
    given = sections.select(F.col("doc_id").cast("long").alias("doc_id"), F.struct(F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), F.col("section").cast("string").alias("section")).alias("s"))
    lists = given.where("doc_id is not null and s.start is not null and s.end is not null").groupBy("doc_id").agg(F.sort_array(F.collect_list("s")).alias("sections"))  # those of one document
    return id_text(docs).join(lists, "doc_id", "left").mapInArrow(partial(_by_section, tokenizer=tokenizer or default_tokenizer()), "doc_id long, section string, n_tokens long, n_crossing long")


def op7_section_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return section_token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
