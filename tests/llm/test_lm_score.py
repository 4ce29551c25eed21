"""Language-model scores against the same model in plain Python dictionaries."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import pytest
from llm_cases import FOLD, WORD, awkward_rows, none_first, sentence, table

from linclass.llm import lm_score


def is_test(i) -> bool:
    return i is None or zlib.crc32(str(i).encode()) % 5 == 1


def brute(rows, order: int) -> tuple[list[tuple], dict]:
    """Expected rows, and the weights."""
    texts = [(i, [None, *WORD.findall((t or "").translate(FOLD)), None]) for i, t in rows]

    def counts(some) -> Counter:
        return Counter(tuple(x[k - m + 1 : k + 1]) for _, x in some for k in range(1, len(x)) for m in range(1, order + 1) if k >= m - 1)

    learned = [r for r in texts if not is_test(r[0])]
    held = [r for r in learned if zlib.crc32(f"weights:{r[0]}".encode()) % 10 == 0]
    full, kept = counts(learned), counts([r for r in learned if zlib.crc32(f"weights:{r[0]}".encode()) % 10])
    total, known = sum(n for g, n in full.items() if len(g) == 1), sum(len(g) == 1 for g in full)

    def levels(c: Counter, x: list, k: int, weight: dict) -> list[tuple]:
        """(probability, weight, bucket) from the uniform level up."""
        out = [(1 / (known + 1), None, None)]
        for m in range(1, min(order, k + 1) + 1):
            g = tuple(x[k - m + 1 : k + 1])
            n = total if m == 1 else c[g[:-1]]
            b = (m, 0 if m == 1 else n.bit_length())
            w = weight.get(b, 0.5) if n else 0.0
            out.append(((w * c[g] / n if n else 0) + (1 - w) * out[-1][0], w, b if n else None))
        return out

    weight: dict = {}
    before = -math.inf
    for _ in range(lm_score.ROUNDS):
        had, made, log, n = Counter(), Counter(), 0.0, 0
        for _, x in held:
            for k in range(1, len(x)):
                p = levels(kept, x, k, weight)
                log, n, left = log + math.log(p[-1][0]), n + 1, 1.0
                for (low, _, _), (high, w, b) in zip(p[-2::-1], p[:0:-1], strict=True):
                    if b is not None:
                        below = left * (1 - w) * low / high
                        had[b] += left
                        made[b] += left - below
                        left = below
        if not n or (log - before) / n < lm_score.ENOUGH:
            break
        before, weight = log, weight | {b: (made[b] + 1) / (had[b] + 2) for b in had}
    out = []
    for i, x in texts:
        base = sum(math.log10((full[(w,)] + 0.5) / (total + 0.5 * (known + 1))) for w in x[1:])
        score = sum(math.log10(levels(full, x, k, weight)[-1][0]) for k in range(1, len(x)))
        out.append((i, is_test(i), len(x) - 1, sum(full[(w,)] > 0 for w in x[1:]), total, base, score))
    return sorted(out, key=none_first), weight


def same(got, want) -> None:
    got = sorted((tuple(r) for r in got), key=none_first)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want, strict=True):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)


ROWS = awkward_rows() + [(k, sentence(k % 37, 30 + k % 11) + (" rare%d" % k) * (k % 3)) for k in range(100, 260)]


@pytest.mark.parametrize(("order", "block", "part"), [(2, 1 << 24, 1 << 23), (2, 3_000, 2_000), (3, 20_000, 50_000), (1, 5_000, 1 << 23)])
def test_scores_and_weights(spark, order, block, part):
    want, weight = brute(ROWS, order)
    same(lm_score.score_corpus(table(spark, ROWS), order=order, block_bytes=block, part_bytes=part).collect(), want)
    assert len(weight) > order - 1


def test_probabilities_of_all_next_words_sum_to_one():
    import numpy as np

    words = [w for k in range(40) for w in [*sentence(k, 12).split(), None]]
    single, pairs = Counter(words), Counter(zip([None, *words], words, strict=False))
    known = sorted(single, key=str)
    weights = np.random.default_rng(2).uniform(0.1, 0.9, (2, lm_score.CONTEXTS + 1))
    for before in known:
        counts = [np.array([*(single[w] for w in known), 0]), np.array([*(pairs[before, w] for w in known), 0])]
        p = lm_score.interpolate(counts, [np.full(len(known) + 1, single[before])], weights, len(words), len(known))
        assert all(x.sum() == pytest.approx(1, abs=1e-12) and (x > 0).all() for x in p)


def test_held_out_documents_are_scored_better_than_by_single_words(spark):
    got = [r for r in lm_score.score_corpus(table(spark, [(k, sentence(k % 7, 40)) for k in range(400)])).collect() if r["held_out"]]
    assert sum(r["score"] for r in got) > 0.85 * sum(r["base_score"] for r in got)


@pytest.mark.parametrize("rows", [[], [(None, "only held out"), (None, None)]])
def test_nothing_to_learn_from(spark, rows):
    got = lm_score.score_corpus(table(spark, rows)).collect()
    assert [(r["held_out"], r["n_known"], r["train_tokens"], r["score"]) for r in got] == [(True, 0, 0, 0.0)] * len(rows)


def test_a_test_column_of_ones_own(spark):
    from pyspark.sql import functions as F

    rows = [(k, sentence(k, 20)) for k in range(30)]
    got = lm_score.score_corpus(table(spark, rows), test=F.col("doc_id") < 10).collect()
    assert sorted(r["doc_id"] for r in got if r["held_out"]) == list(range(10))
    assert {r["train_tokens"] for r in got} == {21 * 20}


def test_changed_texts_are_an_error(spark):
    import numpy as np
    import pyarrow as pa

    texts = pa.table({"block": [0], "doc_id": [1], "text": ["a b c"]})
    answers = pa.table({"block": [0], "m": [1], "part": [0], "size": [3], "kept": [np.ones(3, np.uint8).tobytes()], "held": [np.zeros(3, np.uint8).tobytes()]})
    with pytest.raises(RuntimeError, match="4 n-grams of 1 words have 3 answers"):
        lm_score._counts(texts, answers, 1, 0, ["kept", "held"])


def test_weights_and_names_have_their_limits():
    import numpy as np

    assert lm_score.bucket(np.array([0, 1, 2, 3, 4, 2**40])).tolist() == [0, 1, 2, 2, 3, 41]
    name = np.sort(np.random.default_rng(1).integers(0, 2**64, 50, np.uint64))
    for bits in (0, 3, 16):
        cut = (name >> np.uint64(16 - bits)) << np.uint64(16 - bits)
        part = cut >> np.uint64(64 - bits) if bits else cut * np.uint64(0)
        for p in np.unique(part):
            own = cut[part == p]
            packed = lm_score._unpack(lm_score._pack(own, 2, bits), 2)
            assert len(packed) == len(own) and (np.diff(packed.astype(np.int64)) >= 0).all() and len(np.unique(packed)) == len(np.unique(own))
