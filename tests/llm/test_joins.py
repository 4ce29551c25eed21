"""Jaccard join and byte-string removal against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF001
from llm_cases import awkward_rows, components, ordered, sentence, shingles, table

from linclass.llm import jaccard_join as j
from linclass.llm import suffix_dedup as s
from linclass.llm.components import connected_components
from linclass.llm.shared_files import file_system, qualified, read_file, write_file
from linclass.llm.text import scratch_folder


def copies(seed: int, n: int, words: int, edits: int) -> list[str]:
    """Near copies of one text, each with its own edits."""
    r = random.Random(seed)
    base = sentence(seed, words).split()
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(r.randint(0, edits)):
            w[r.randrange(len(w))] = f"w{r.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def cases() -> list[tuple]:
    rows = awkward_rows()
    texts = copies(1, 40, 80, 3) + copies(2, 30, 30, 2) + copies(3, 25, 8, 1) + [t + " shared licence line of ten words for all of them" for t in copies(4, 30, 14, 6)]
    return rows + [(100 + k, t) for k, t in enumerate(texts)] + [(300, "ONE two Three four"), (301, "one TWO three four"), (302, "one two three")]


@pytest.mark.parametrize("tile", [256, 4])
def test_components_against_all_pairs(spark, monkeypatch, tile):
    monkeypatch.setattr(j, "TILE", tile)
    rows = cases()
    got = j.link_components(table(spark, rows).repartition(4)).collect()
    assert ordered(got) == ordered(components(rows))


def test_components_of_the_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    assert ordered(j.op5_jaccard_join(spark, SF001).collect()) == ordered(components(rows))


def test_one_of_each_component_stays(spark):
    rows = cases()
    docs = table(spark, rows)
    kept = j.one_of_each(docs)
    assert kept.columns == docs.columns
    want = {}
    for (i, t), (_, n, c) in zip(rows, components(rows), strict=True):
        if n and c is not None and i == c:
            want[i, frozenset(shingles(t))] = 1
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert sorted(i for i, t in got if shingles(t) and i is not None) == sorted(i for i, _ in want)
    assert sum(not shingles(t) for _, t in got) == sum(not shingles(t) for _, t in rows)  # rows without words stay
    assert sum(i is None and bool(t) for i, t in got) == 1


def test_an_empty_table(spark):
    assert j.link_components(table(spark, [])).count() == 0 and j.one_of_each(table(spark, [])).count() == 0


def test_the_bitmap_bound_never_refuses_a_link():
    r = np.random.default_rng(1)
    for _ in range(300):
        common = r.integers(0, 2**63, r.integers(1, 200)).astype(np.uint64)
        a, b = (np.unique(np.concatenate([common, r.integers(0, 2**63, r.integers(0, 30)).astype(np.uint64)])) for _ in range(2))
        both = len(np.intersect1d(a, b))
        x, y = (np.frombuffer(j.signature(v), np.uint64) for v in (a, b))
        w = min(len(x), len(y))
        ok = j.may_link(np.array([len(a)]), np.array([len(b)]), j._fold(x, w)[None], j._fold(y, w)[None])[0]
        assert ok or 9 * both < 4 * (len(a) + len(b))


def test_connected_components(spark):
    r = random.Random(4)
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 140)] + [(r.randrange(200, 260), r.randrange(200, 260)) for _ in range(40)]
    got = {x.node: x.root for x in connected_components(spark.createDataFrame(edges, "a long, b long"), scratch_folder(spark, "cc"), "t").collect()}
    parent: dict = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert all(got.get(x, x) == find(x) for x in list(parent))


def removed(rows: list[tuple], length: int = 50) -> list[tuple]:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of each row, string by string."""
    first: dict = {}
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - length + 1):
            w = b[k : k + length]
            if i is not None:
                first[w] = min(first.get(w, i), i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            f = first.get(b[k : k + length])
            if f is not None and (i is None or f < i):
                gone[k : k + length] = True
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(gone) else 0
        out.append((i, len(b), int(gone.sum()), spans, np.frombuffer(b, np.uint8)[~gone].tobytes()))
    return out


@pytest.mark.parametrize("block", [4 << 20, 3000])
def test_repeats_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(s, "BLOCK_BYTES", block)
    passage = sentence(77, 30)
    rows = [(i, t[:6000] if t else t) for i, t in cases()] + [(400 + k, sentence(500 + k, 20) + passage + sentence(700 + k, 5)) for k in range(30)] + [(450, "ab" * 200), (451, "ab" * 100 + "ba" * 90), (452, passage[:49]), (453, "é" * 40 + passage), (454, "x" + "é" * 60)]
    got = s.remove_repeats(table(spark, rows).repartition(3)).collect()
    assert ordered((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == ordered(removed(rows))


def test_op9_digest(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    got = s.op9_suffix_dedup(spark, SF001).collect()
    assert ordered(got) == ordered((*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in removed(rows))
    assert s.remove_repeats(table(spark, [])).count() == 0


def test_every_difference_is_covered():
    assert {(a - b) % s.PERIOD for a in s.COVER for b in s.COVER} == set(range(s.PERIOD))


def test_a_string_leaves_a_block_once(spark):
    line = sentence(7, 14) + ".\n"
    parts = [(line * 400 + sentence(8, 9)).encode(), line.encode()]
    block = s.Block(5, np.array([1, 2]), np.array([0, len(parts[0]), len(parts[0] + parts[1])]), np.frombuffer(b"".join(parts), np.uint8))
    columns = [pa.array([block.block]), *[pa.array([x.tobytes()], pa.binary()) for x in (block.ids, block.off.astype(np.int64), block.raw)]]
    batch = pa.RecordBatch.from_arrays(columns, names=["block", "ids", "offsets", "data"])
    sent = 0
    folder = qualified(spark, scratch_folder(spark, "test"))
    files, root = file_system(folder)
    write_file(files, f"{root}/ranks/{batch.column('block')[0].as_py()}", np.zeros(1, np.int64).tobytes())
    for answer in s._piece_rows(iter([batch]), 8, folder):
        sent += sum(len(s._suffixes([p])[0]) for p in answer.column("payload").to_pylist())
    assert 0 < sent <= len({parts[0][k : k + 50] for k in range(len(parts[0]) - 49)})


def test_all_places_of_a_string_share_its_fate(spark):
    line = sentence(7, 14) + ".\n"
    rows = [(1, line), (2, line * 50 + "x" + line * 3), (2, line * 4), (3, "ab" * 400), (4, "ab" * 900), (None, "ab" * 100), (0, "ba" * 26)]
    got = {}
    for parts in (1, len(rows)):
        got[parts] = sorted((99 if r.doc_id is None else r.doc_id, r.n_bytes, bytes(r.kept)) for r in s.remove_repeats(table(spark, rows).repartition(parts)).collect())
        assert got[parts] == sorted((i if i is not None else 99, len(t), k) for (i, t), k in zip(rows, kept_by_rule(rows), strict=True))


def kept_by_rule(rows) -> list[bytes]:
    least: dict = {}
    ids, texts = [i if i is not None else 99 for i, _ in rows], [t.encode() for _, t in rows]
    for i, t in zip(ids, texts, strict=True):
        for k in range(len(t) - 49):
            least[t[k : k + 50]] = min(least.get(t[k : k + 50], i), i)
    out = []
    for i, t in zip(ids, texts, strict=True):
        gone = {p for k in range(len(t) - 49) if least[t[k : k + 50]] < i for p in range(k, k + 50)}
        out.append(bytes(c for p, c in enumerate(t) if p not in gone))
    return out


def test_a_lost_file_is_an_error_and_folders_have_a_scheme(spark, workdir):
    folder = qualified(spark, f"{workdir}/shared")
    assert folder.startswith("file:/") and qualified(spark, folder) == folder and qualified(spark, "s3a://b/x") == "s3a://b/x"
    files, root = file_system(folder)
    write_file(files, f"{root}/runs/7", np.zeros(1, np.int64).tobytes())
    assert read_file(files, f"{root}/runs/7") and s._answers(files, f"{root}/runs", 7) == []
    with pytest.raises(FileNotFoundError):
        s._answers(files, f"{root}/runs", 8)
    with pytest.raises(ValueError, match="no scheme"):
        file_system(f"{workdir}/shared")
