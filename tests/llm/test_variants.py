"""Spelling variants against all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import FOLD, awkward_rows, ordered, table

from linclass.llm import variants


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    k = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def plain_counts(rows, damaged=199, least_length=6, least_count=5) -> Counter:
    n: Counter = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(FOLD)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % damaged == 0 else run] += 1
    return Counter({w: c for w, c in n.items() if len(w) >= least_length and c >= least_count})


def plain_variants(n: dict) -> list[tuple]:
    forms, near = {}, {}
    for w in n:
        others = [x for x in n if one_edit(w, x)]
        near[w] = len(others)
        best = min(others, key=lambda x: (-n[x], x), default=None)
        forms[w] = best if best is not None and n[best] >= 5 * n[w] else None

    def root(w):
        while forms[w] is not None:
            w = forms[w]
        return w

    return ordered((w, forms[w], root(w), n[w], near[w], n[forms[w]] if forms[w] else None) for w in n)


def test_awkward_texts_and_damaged_runs(spark):
    r = random.Random(5)
    stems = ["garden", "gardens", "gaarden", "gardén", "wardens", "letter", "leter", "lettter", "ÉCOLES", "écoles", "ÀÿÀÿÀÿ"]
    rows = awkward_rows() + [(k, " ".join(r.choices(stems, [60, 12, 2, 2, 3, 50, 9, 2, 3, 8, 1], k=40)) + "x1" * 3 + "½garden") for k in range(100, 130)] + [(7, "q" * 300)] * 5
    n = plain_counts(rows, damaged=7)
    got = variants.word_counts(table(spark, rows), damaged=7)
    assert dict(map(tuple, got.collect())) == dict(n) and any(len(w) == 300 for w in n)
    assert ordered(variants.spelling_variants(got).collect()) == plain_variants(n)
    assert dict(map(tuple, variants.word_counts(table(spark, rows)).collect())) == dict(plain_counts(rows))


def test_chains_end_at_the_last_form_and_ties_take_the_smaller_word(spark):
    n = {"aaaaaa": 1, "aaaaab": 5, "aaaabb": 25, "aaabbb": 125, "aabbbb": 625, "abbbbb": 3125, "zzzzzz": 7, "zzzzzy": 7, "zzzzzx": 1, "zzzzz": 7}
    got = variants.spelling_variants(spark.createDataFrame(list(n.items()), "word string, n long"))
    assert ordered(got.collect()) == plain_variants(n)
    assert {r["word"]: r["root"] for r in got.collect()}["aaaaaa"] == "abbbbb"


@pytest.mark.parametrize("rows", [[], [(1, None), (None, "")]])
def test_no_words(spark, rows):
    got = variants.spelling_variants(variants.word_counts(table(spark, rows)))
    assert got.collect() == [] and got.columns == ["word", "form", "root", "n", "n_near", "form_n"]


@settings(max_examples=12, deadline=None)
@given(st.dictionaries(st.text(alphabet="abé", min_size=1, max_size=5), st.integers(1, 60), min_size=1, max_size=60))
def test_any_vocabulary(spark, n):
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    assert ordered(variants.spelling_variants(words).collect()) == plain_variants(n)


def test_no_group_is_larger_than_the_alphabet_and_one(spark):
    words = [f"{a}{b}{c}" for a in "abcd" for b in "abcd" for c in "abcd"]
    keyed = variants.rotations(spark.createDataFrame(list(enumerate(words)), "id long, word string"))
    assert keyed.groupBy("key").count().agg({"count": "max"}).first()[0] <= 5
