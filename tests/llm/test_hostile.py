"""Inputs made to break an operator."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import components, none_first, ordered, sentence, table

from linclass.llm import jaccard_join, packing, pii
from linclass.llm.text import Recent


def thue_morse(n: int, swap: bool = False) -> str:
    return "".join("ab"[(bin(k).count("1") + swap) % 2] for k in range(n))


def test_regular_long_words_are_not_taken_for_one_another(spark):
    rows = [(k, thue_morse(1 << (9 + k // 2), k % 2 == 1)) for k in range(6)] + [(9, sentence(1, 30) + " " + thue_morse(2048)), (10, sentence(1, 30) + " " + thue_morse(2048, True))]
    assert ordered(jaccard_join.link_components(table(spark, rows)).collect()) == sorted(components(rows), key=none_first)


def test_numbers_of_thousands_of_digits_are_parts_of_no_address():
    text = "0" * 5000 + ".0.0.1 and " + "9" * 5000 + ".1.1.1 and 010.0.0.255"
    found = [(a, b) for k, a, b in pii.base_spans(text) if k == 1]
    assert found == [(0, 5006), (len(text) - 11, len(text))]


def test_rows_over_the_budget_have_batches_of_their_own(spark):
    lengths = spark.createDataFrame([(1, 70_000), (1, 70_000), (None, 80_000), (None, 80_000), (2, 65_536), (None, 10), (None, 10)], "doc_id long, n_tokens long")
    got = packing.pack(lengths).collect()
    assert max(Counter((r["batch"], r["slot"]) for r in got).values()) == 1
    tokens: Counter = Counter()
    for r in got:
        tokens[r["batch"]] += r["n_tokens"]
    assert sum(n > 65_536 for n in tokens.values()) == 4 and len(got) == 7


def test_equal_lengths_and_null_ids_share_the_parts(spark, monkeypatch):
    monkeypatch.setattr(packing, "PART_ROWS", 50)
    rows = spark.range(1000).selectExpr("cast(null as long) as doc_id", "7L as n_tokens")
    got = packing.pack(rows).collect()
    parts = Counter(r["batch"].split("-")[1] for r in got)
    assert len(parts) == 20 and max(parts.values()) < 150
    assert max(Counter((r["batch"], r["slot"]) for r in got).values()) == 1


def test_columns_of_any_name_stay_when_copies_go(spark):
    names = ["uid", "at", "keep_uid", "keep_id", "__uid", "__at", "pii_key", "pii_terms"]
    rows = [(k, sentence(k // 2, 40) + " me@x.org", *range(len(names))) for k in range(6)] + [(7, "", *range(len(names)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} long" for n in names))
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [0, 2, 4, 7]
    clean = pii.sanitise(docs)
    assert clean.columns == docs.columns and {tuple(r)[2:] for r in clean.collect()} == {tuple(range(len(names)))}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 3)), max_size=12), max_size=6), st.sampled_from([1, 8, 1 << 10]))
def test_keys_met_lately_are_never_mistaken(batches, slots):
    seen, met = Recent(2, slots), set()
    for batch in batches:
        new = seen.new(*(np.array([x[c] for x in batch], np.uint64) for c in (0, 1)))
        for k, x in enumerate(batch):
            if not new[k]:
                assert x in met or x in batch[:k]
        firsts = [x for k, x in enumerate(batch) if new[k]]
        assert len(firsts) == len(set(firsts))
        assert set(batch) <= met | set(firsts)
        met |= set(batch)


@pytest.mark.parametrize("n", [0, 1, 3])
def test_merged_arrays_count_what_both_have(n):
    import pyarrow as pa

    a, b = np.arange(9) - 4, np.concatenate([np.arange(9 - n) - 4, 100 + np.arange(n)])
    batch = pa.record_batch({"a": [1], "b": [2], "of_a": pa.array([a]), "of_b": pa.array([b])})
    (got,) = jaccard_join._linked(iter([batch]))
    assert got.num_rows == (100 * (9 - n) >= 80 * (9 + n))
