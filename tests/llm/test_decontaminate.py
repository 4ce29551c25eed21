"""q-gram filter and banded alignment against plain edit distance."""

from __future__ import annotations

import random
import time

import numpy as np
import pytest
from conftest import SF01
from llm_cases import awkward_rows, sentence, table

from linclass.llm import decontaminate as d


def least_edits(piece: np.ndarray, text: np.ndarray) -> int:
    """Edits of the best occurrence of a piece anywhere in a text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(piece, 1):
        new = [i]
        for j, x in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != x), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def edited(text: str, n: int, r: random.Random) -> str:
    p = list(text)
    for _ in range(n):
        k, o = r.randrange(len(p)), r.random()
        if o < 0.4:
            p[k] = r.choice("abcxyz")
        elif o < 0.7:
            del p[k]
        else:
            p.insert(k, r.choice("abc xyz"))
    return "".join(p)


def test_found_exactly_within_the_edit_budget():
    r = random.Random(2)
    items = [(k, sentence(100 + k, 15 + k % 9)) for k in range(12)] + [(50, "a short item of words")]
    index = d.Index.build(items)
    for n in range(60):
        item, text = r.choice(items)
        host = sentence(1000 + n, 40)
        at = r.randrange(len(host))
        full = host[:at] + edited(text, r.choice([0, 2, 5, 7, 9, 14]), r) + host[at:]
        got = {index.items[g[1]]: g for g in d.search(index, ["before", full, "after"])}
        want: dict = {}
        for p, code in enumerate(index.codes):
            e = least_edits(code, d.code_points(full))
            if e <= index.edits[p]:
                name = index.items[index.item[p]]
                want[name] = min(want.get(name, 99), e)
        assert {k: g[4] for k, g in got.items()} == want
        assert all(g[0] == 1 for g in got.values())


def test_case_white_space_and_positions():
    text = sentence(7, 20)
    index = d.Index.build([(1, text)])
    host = "Some words before:\n" + text.upper().replace(" ", "\n") + " and after"
    (got,) = d.search(index, [host])[:1]
    assert host[got[2] : got[3]].lower().replace("\n", " ") in text and got[4] == 0


def test_no_match_crosses_documents():
    text = sentence(8, 14)
    index = d.Index.build([(1, text)])
    assert d.search(index, [text[:40], text[40:]]) == [] and len(d.search(index, [text])) == 1


def test_exact_leaks_of_the_tables(spark):
    got = {(r.doc_id, r.item_id) for r in d.op2_decontaminate(spark, SF01).collect()}
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{SF01}/benchmark.parquet").collect()
    exact = {(r.doc_id, b.item_id) for r in docs for b in items if b.text in r.text}
    assert exact <= got and len({x[0] for x in got - exact}) <= 5


def test_awkward_rows_and_blocks(spark, monkeypatch):
    docs = table(spark, awkward_rows())
    leak = sentence(1, 60)[20:150]
    bench = spark.createDataFrame([(1, leak), (2, None), (3, ""), (4, "of"), (None, sentence(900, 30)), (6, sentence(901, 30)), (7, leak)], "item_id long, text string")
    whole = {(r.doc_id, r.item_id) for r in d.find_leaks(docs, bench).collect()}
    assert whole == {(i, k) for i in (1, 2, 8, 11) for k in (1, 7)}
    kept = d.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(awkward_rows()) - 5
    monkeypatch.setattr(d, "BLOCK_CHARS", 150)
    assert {(r.doc_id, r.item_id) for r in d.find_leaks(docs, bench).collect()} == whole
    empty = bench.limit(0)
    assert d.find_leaks(docs, empty).count() == 0 and d.drop_contaminated(docs, empty).count() == len(awkward_rows())
    assert d.find_leaks(table(spark, []), bench).count() == 0


@pytest.mark.parametrize("meetings", [50, 1 << 20])
def test_periodic_texts_in_bounded_parts(monkeypatch, meetings):
    r = random.Random(9)
    items = ["a" * 90, "ab" * 60, "=" * 30 + "a heading that a benchmark has" + "=" * 30, "".join(r.choices("ab", k=120))]
    whole = d.Index.build(list(enumerate(items)))
    for text in ("a" * 3000, "x" * 700 + "a" * 2000 + "y" * 900, "ab" * 900, "=" * 1000 + "a heading that a benchmark has" + "=" * 500, "b" * 600 + items[3] + "a" * 600):
        plain = d.search(whole, [text])
        monkeypatch.setattr(d, "MEETINGS", meetings)
        monkeypatch.setattr(d, "_shortened", lambda cp: (cp, np.zeros(0, np.int64), np.zeros(0, np.int64)))
        assert d.search(whole, [text]) == plain and plain
        monkeypatch.undo()


def test_a_megabyte_of_one_character_costs_little():
    import resource

    index = d.Index.build([(k, "a" * 200) for k in range(20)])
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    began = time.time()
    got = d.search(index, ["a" * (1 << 20) + "b"])
    assert [g[1:] for g in got] == [(k, 0, 80, 0) for k in range(20)]
    assert time.time() - began < 20 and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 1 << 20  # KB
