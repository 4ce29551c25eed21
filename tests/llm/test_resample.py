"""Importance resampling against features of whole texts, counted in plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import FOLD, awkward_rows, ordered, sentence, table

from linclass.llm import resample
from linclass.llm.crc import crc_byte, crc_spans

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text) -> list[str]:
    w = WORD.findall((text or "").translate(FOLD))
    return w + [f"{a} {b}" for a, b in zip(w[:-1], w[1:], strict=True)]


def bucket(s: str) -> int:
    return zlib.crc32(s.encode()) % 10_000


def plain(rows, target, percent=25, least=20) -> tuple[list[tuple], int]:
    """Rows without their rank, and how many are drawn; ``ranks_fit`` checks the ranks."""
    s, t = Counter(bucket(f) for _, x in rows for f in features(x)), Counter(bucket(f) for x in target for f in features(x))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log(((t[b] + 1) * (s_all + 10_000)) / ((s[b] + 1) * (t_all + 10_000)))) for b in s}
    out, able = [], 0
    for i, x in rows:
        f = features(x)
        weight = sum(gain[bucket(y)] for y in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
        able += (len(f) + 1) // 2 >= least
    return ordered(out), able * percent // 100


def ranks_fit(got, drawn: int, least=20) -> bool:
    """Ranks are 1 to ``drawn``, in order of score and id, and nobody undrawn comes before them."""
    key = lambda r: (-r["score"], r["doc_id"] is None, r["doc_id"] or 0)
    ranked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    rest = [key(r) for r in got if r["rank"] is None and (r["n_features"] + 1) // 2 >= least]
    keys = [key(r) for r in ranked]
    return [r["rank"] for r in ranked] == list(range(1, drawn + 1)) and keys == sorted(keys) and (not rest or not keys or keys[-1] <= min(rest))


LINES = "Licence granted, free of charge.\n"
ROWS = awkward_rows() + [(k, LINES * (k % 4) + sentence(k, 25) + ("\n\n" if k % 2 else "\r\n--\n") + sentence(k % 5, 9) + "\n" + LINES) for k in range(40, 90)]
TARGET = [sentence(41, 30), None, "", LINES + "É 123 granted\nfree"]


def test_awkward_texts_and_shared_lines(spark):
    got = resample.importance_resample(table(spark, ROWS), spark.createDataFrame([(t,) for t in TARGET], "text string")).collect()
    want, drawn = plain(ROWS, TARGET)
    assert ordered(r[:4] for r in got) == want
    assert drawn > 10 and ranks_fit(got, drawn)


def test_any_share_of_lines_may_be_heavy(spark, monkeypatch):
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    for heavy in (1, 10**9):  # no line, every line
        monkeypatch.setattr(resample, "HEAVY", heavy)
        got = resample.importance_resample(table(spark, ROWS), target, percent=100).collect()
        want, drawn = plain(ROWS, TARGET, 100)
        assert ordered(r[:4] for r in got) == want and ranks_fit(got, drawn)


@pytest.mark.parametrize("rows", [[], [(1, None), (None, ""), (2, "\n \n")]])
def test_no_features(spark, rows):
    got = resample.importance_resample(table(spark, rows), spark.createDataFrame([], "text string"))
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert [tuple(r)[1:3] + (r["rank"],) for r in got.collect()] == [(0, 0, None)] * len(rows)


def test_drawn_documents_keep_their_columns(spark):
    docs = table(spark, [(k, sentence(k, 30)) for k in range(8)])
    scored = resample.importance_resample(docs, docs, percent=50)
    drawn = resample.drawn_documents(docs, scored)
    assert drawn.columns == docs.columns and drawn.count() == 4


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=300), st.lists(st.tuples(st.integers(0, 300), st.integers(0, 300)), max_size=30))
def test_span_checksums_are_those_of_zlib(data, spans):
    raw = np.frombuffer(data, np.uint8)
    a = np.array([min(x, y, len(data)) for x, y in spans], np.int64)
    b = np.array([min(max(x, y), len(data)) for x, y in spans], np.int64)
    crc = crc_spans(raw, a, b)
    assert crc.tolist() == [zlib.crc32(data[x:y]) for x, y in zip(a, b, strict=True)]
    assert crc_spans(raw, a, b, crc_byte(crc, 32)).tolist() == [zlib.crc32(data[x:y] + b" " + data[x:y]) for x, y in zip(a, b, strict=True)]


def test_features_of_lines_and_bridges_are_those_of_the_text():
    r = random.Random(3)
    texts = ["".join(r.choices("ab É\n.9", k=r.randrange(60))) for _ in range(200)]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    got, cuts, words = resample.word_features(raw, off, 10_000)
    for k, t in enumerate(texts):
        assert sorted(got[cuts[k] : cuts[k + 1]].tolist()) == sorted(map(bucket, features(t))), t
        assert words[k] == len(WORD.findall(t.translate(FOLD)))
