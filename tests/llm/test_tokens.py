"""Token files, length buckets and section counts against the tokenizers library itself."""

from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import awkward_rows, none_first, ordered, sentence, table

from linclass.llm import packing, token_counts, token_store
from linclass.llm.text import scratch_folder
from linclass.llm.tokenize import Encoder, default_tokenizer, encoder


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_tokenizer())


def plain(tokenizer, text) -> list[int]:
    return tokenizer.encode(text or "", add_special_tokens=False).ids


ODD = ["", "  a  b", " a", "a ", "a\n b", "a \n\n b c", "a b c  d", "x  y\tz", " ", "\n", "don't stop 's  'll", "<|endoftext|> a b", "a <|endoftext|>b", "é ñ 1 2 33 ! ?? .. a", "a  b 　 c", "\x1c a \x1d b\x85 c", "a b.\nc d\n\ne f\ng", "a b,\nÉc.\nd e.", "Ⅷ ² x̀ ʼ n ª º. ab́c", "​ a ﻿ b", "a b\r\nc d"]


def test_pieces_give_the_ids_of_whole_texts(tokenizer):
    coder = Encoder(default_tokenizer())
    texts = ODD + [t or "" for _, t in awkward_rows()]
    for text, got in zip(texts, coder.ids(texts), strict=True):
        ids = np.frombuffer(got, np.uint32)
        assert ids.tolist() == plain(tokenizer, text), text[:40]
        assert coder.n_bytes[ids].sum() == len(text.encode())


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab É1.,!'\n\t 　\x85-")), max_size=30))
def test_any_text_is_encoded_as_a_whole(text):
    coder = encoder(default_tokenizer())
    assert np.frombuffer(coder.ids([text])[0], np.uint32).tolist() == plain(coder.tokenizer, text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), min_size=1, max_size=400), st.sampled_from([0.5, 0.9, 0.98, 1.0]))
def test_blocks_round_trip(values, percentile):
    v = np.array(values, np.uint32)
    blocks = token_store.pack_blocks(v, 64, percentile)
    off = np.cumsum([0] + [len(b) for b in blocks])
    assert (token_store.unpack_blocks(b"".join(blocks), off[:-1], 64) == v).all()


def test_exceptions_keep_blocks_narrow():
    v = np.full(1024, 5, np.uint32)
    v[[3, 700]] = 4_000_000_000
    assert len(token_store.pack_blocks(v, 1024, 0.98)[0]) < 40


@pytest.mark.parametrize("rows", ["awkward", "empty"])
def test_token_files_round_trip(spark, tokenizer, rows):
    data = awkward_rows() if rows == "awkward" else []
    folder = scratch_folder(spark, "test3")
    manifest = token_store.write_tokens(table(spark, data).repartition(3), folder, default_tokenizer(), block=64)
    got = [tuple(r) for r in token_store.read_tokens(spark, folder, blocks_at_once=3).orderBy("start").collect()]
    want, start = [], 0
    for i, t in sorted(data, key=lambda r: none_first(r)):
        ids = np.array([*plain(tokenizer, t), 0], "<u4")
        want.append((i, start, ids.tobytes()))
        start += len(ids)
    assert [(i, s, bytes(b)) for i, s, b in got] == want
    assert manifest.agg({"n_tokens": "sum"}).first()[0] == (start or None)


def test_op3_digest(spark, tokenizer):
    from conftest import SF001

    got = token_store.op3_token_files(spark, SF001).collect()
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()}
    start = 0
    for r in sorted(got):
        ids = np.array([*plain(tokenizer, texts[r.doc_id]), 0], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert len(got) == len(texts)


def padding(lengths, counts, bounds) -> int:
    return sum(c * (min(b for b in bounds if b >= x) - x) for x, c in zip(lengths, counts, strict=True))


def test_boundaries_are_optimal():
    r = random.Random(5)
    for _ in range(40):
        lengths = np.array(sorted(r.sample(range(1, 60), r.randint(1, 9))))
        counts = np.array([r.randint(1, 20) for _ in lengths])
        for k in (1, 2, 3, 4):
            best = min(padding(lengths, counts, (*c, lengths[-1])) for m in range(min(k, len(lengths))) for c in itertools.combinations(lengths[:-1], m))
            got = packing.optimal_boundaries(lengths, counts, k)
            assert len(got) <= k and padding(lengths, counts, got) == best


def test_batches_keep_the_budget_and_all_rows(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "PART_ROWS", 20)
    rows = awkward_rows() + [(100 + k, sentence(k, 1 + k % 50)) for k in range(120)]
    got = packing.length_buckets(table(spark, rows), buckets=4, budget=512).collect()
    assert ordered((r.doc_id, r.n_tokens) for r in got) == ordered((i, len(plain(tokenizer, t)) + 1) for i, t in rows)
    batches: dict = {}
    for r in got:
        assert r.n_tokens <= r.boundary
        batches.setdefault(r.batch, []).append(r)
    for rs in batches.values():
        assert len({r.boundary for r in rs}) == 1 and sorted(r.slot for r in rs) == list(range(len(rs)))
        assert len(rs) * rs[0].boundary <= 512 or len(rs) == 1
    assert len({r.boundary for r in got if r.bucket >= 0}) <= 4
    assert packing.length_buckets(table(spark, [])).count() == 0


def test_a_crossing_token_goes_to_the_section_with_most_of_it():
    section, crossed = token_counts.attribute(np.array([2, 4, 3, 2]), np.array([3, 8, 11]))
    assert section.tolist() == [0, 1, 1, 2] and crossed == 2  # bytes 2..5: one before 3, three after; 6..8: two and one
    section, crossed = token_counts.attribute(np.array([4]), np.array([2, 4]))
    assert section.tolist() == [0] and crossed == 1  # equal halves: the earlier
    assert token_counts.attribute(np.zeros(0, int), np.zeros(0, int))[1] == 0


def test_section_counts_add_up(spark, tokenizer):
    rows = awkward_rows() + [(50, "a\n\n\nb c\n"), (51, "\n")]
    got = token_counts.section_token_counts(table(spark, rows)).collect()
    want = ordered((i, len(plain(tokenizer, t)), len((t or "").split("\n")) - (not t or t.endswith("\n"))) for i, t in rows)
    assert ordered((r.doc_id, r.n_tokens, r.n_sections) for r in got) == want
    assert all(sum(r.section_tokens) == r.n_tokens and len(r.section_tokens) == r.n_sections for r in got)
    assert token_counts.section_token_counts(table(spark, [])).count() == 0


def test_token_intervals_are_those_of_the_tokenizer(tokenizer):
    coder = encoder(default_tokenizer())
    for text in ODD + [t or "" for _, t in awkward_rows()]:
        start, end = token_counts.token_characters(text.encode(), coder.n_bytes[np.frombuffer(coder.ids([text])[0], np.uint32)])
        assert list(zip(start.tolist(), end.tolist(), strict=True)) == tokenizer.encode(text, add_special_tokens=False).offsets, text[:40]


def test_tokens_of_given_sections(spark, tokenizer):
    """Against the tokenizer's offsets: the section with most of a token, the earliest of equals."""
    r = random.Random(8)
    rows = awkward_rows() + [(60, "é" * 30 + "日本語🎉 naïve " * 9)]
    sections = []
    for i in sorted({i for i, _ in rows if i is not None}):
        size = max(len(t or "") for j, t in rows if j == i)
        cuts = sorted(r.choices(range(size + 1), k=2 * r.randrange(5)))
        sections += [(i, f"s{k}", a, b) for k, (a, b) in enumerate(zip(cuts[::2], cuts[1::2], strict=True))]
    sections += [(1, None, None, 3), (None, "x", 0, 1), (999, "x", 0, 1)]
    given = spark.createDataFrame([(*x, "clash") for x in sections], "doc_id long, section string, start long, end long, text string")
    want = []
    for i, t in rows:
        own = [x[1:] for x in sections if x[0] == i and i is not None and x[2] is not None]
        n, crossing, none = [0] * len(own), [0] * len(own), 0
        for a, b in tokenizer.encode(t or "", add_special_tokens=False).offsets:
            held = [max(0, min(b, y) - max(a, x)) for _, x, y in own]
            if not held or max(held) == 0:
                none += 1
            else:
                k = held.index(max(held))
                n[k] += 1
                crossing[k] += held[k] < b - a
        want += [(i, None, none, 0)] * (none > 0 or not own) + [(i, s, n[k], crossing[k]) for k, (s, _, _) in enumerate(own)]
    assert ordered(token_counts.tokens_of_sections(table(spark, rows), given).collect()) == ordered(want)
    assert token_counts.tokens_of_sections(table(spark, []), given).count() == 0
    with pytest.raises(Exception, match="overlap"):
        token_counts.tokens_of_sections(table(spark, rows), spark.createDataFrame([(1, "a", 0, 9), (1, "b", 5, 12)], "doc_id long, section string, start long, end long")).collect()
