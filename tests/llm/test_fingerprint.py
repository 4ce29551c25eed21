"""Locally consistent parsing: consistency, edited texts, order of rows."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from llm_cases import awkward_rows, none_first, ordered, sentence, table

from linclass.llm import fingerprint as fp


def prints(texts):
    raw, off = fp._bytes(texts)
    return fp.fingerprints(raw, off), np.diff(off) == 0


def names(text: str, level: int) -> set:
    raw, off = fp._bytes([text])
    for k, (_, got) in enumerate(fp.parse(raw, off), 1):
        if k == level:
            return set(got.tolist())
    return set()


def test_equal_substrings_share_names_at_any_offset():
    common = sentence(9, 300)
    a, b = "x" * 3 + " start " + common, "quite another beginning, longer: " + common + " tail"
    for level in (1, 2, 3):
        whole = names(common, level)
        assert len(whole & names(a, level) & names(b, level)) > 0.8 * len(whole)


def test_phrases_are_short_and_levels_shrink():
    raw, off = fp._bytes([sentence(4, 3000), "ab" * 5000, "a" * 10_000])
    sizes = [np.bincount(owner, minlength=3) for owner, _ in fp.parse(raw, off)]
    for before, after in zip(sizes, sizes[1:], strict=False):
        assert all(b <= a // 2 + 1 for a, b in zip(before, after, strict=True))
    assert len(sizes) < 20


def test_likeness():
    t = sentence(1, 400)
    w = t.split()
    w[200] = "changed"
    values, empty = prints([t, t, " ".join(w), sentence(2, 400), "", ""])
    near = lambda i, j: fp.likeness(values[[i]], values[[j]], empty[[i]], empty[[j]])[0]
    assert near(0, 1) == 1 and near(0, 2) > 0.7 and near(0, 3) < 0.2 and near(4, 5) == 1 and near(0, 4) == 0


def test_results_do_not_depend_on_the_slice():
    texts = [t or "" for _, t in awkward_rows()]
    together, _ = prints(texts)
    for k, t in enumerate(texts):
        assert (prints([t])[0][0] == together[k]).all()


@pytest.mark.parametrize("shift", [0, 7])
def test_pairs_against_a_plain_pass(spark, shift):
    rows = awkward_rows() + [(20 + shift * k, sentence(k, 30 + k)) for k in range(60)]
    got = fp.with_next(table(spark, rows).repartition(5)).mapInArrow(fp._compare, fp.PAIRS).collect()
    line = [(i, t or "") for i, t in sorted(rows, key=lambda r: none_first((r[0], r[1])))]
    want = []
    for k, (i, t) in enumerate(line):
        nxt = line[(k + 1) % len(line)][1]
        edited = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        values, empty = prints([t, edited, nxt])
        text = fp.as_hex(values, empty)
        near = [float(fp.likeness(values[[0]], values[[j]], empty[[0]], empty[[j]])[0]) for j in (1, 2)]
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), text[0], text[1], *near))
    assert ordered(got) == ordered(want)


def test_small_tables(spark):
    run = lambda rows: fp.with_next(table(spark, rows)).mapInArrow(fp._compare, fp.PAIRS).collect()
    assert run([]) == []
    one = run([(5, sentence(1, 50))])
    assert len(one) == 1 and one[0].near_next == 1
    assert len(run([(None, "a"), (None, None)])) == 2
    assert fp.fingerprint(table(spark, awkward_rows())).count() == len(awkward_rows())


def test_short_edited_texts_are_recognised():
    near, far = [], []
    for k in range(60):
        t, other = sentence(k, 14)[:100], "".join(chr(97 + (7 * i * i + k * i) % 26) for i in range(100))
        values, empty = prints([t, t[:50] + other[:50], other])
        near.append(fp.likeness(values[[0]], values[[1]], empty[[0]], empty[[1]])[0])
        far.append(fp.likeness(values[[0]], values[[2]], empty[[0]], empty[[2]])[0])
    assert np.mean(near) > 0.3 and min(near) > 0.15 and np.mean(far) < 0.05
