"""Small tables with every awkward case, and plain reference versions of what operators compute."""

from __future__ import annotations

import random
import re
from collections import Counter

WORDS = "amber basin cedar delta ember frost grove haven inlet jetty knoll ledge marsh north ocean pearl quarry ridge stone thorn".split()

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, token string, key long, n int, label int, score double, start long, part int, root long, __x string"


def sentence(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


def awkward_rows() -> list[tuple]:
    """(doc_id, text): nulls, empty, blank, very long, repeated and tied rows, odd characters."""
    base, long_ = sentence(1, 60), sentence(2, 30_000)
    near = base.split()
    near[7] = "changed"
    return [
        (1, base),
        (2, base),
        (2, base),
        (3, None),
        (4, ""),
        (5, "  \n\t "),
        (None, sentence(3, 40)),
        (None, None),
        (6, long_),
        (7, "word"),
        (8, " ".join(near)),
        (9, "é ñ 日本語 🎉 naïve  café\n\nzwei  Räume\tund mehr ÉCOLE"),
        (10, long_[:100_000] + " end"),
        (11, sentence(4, 45) + ".\n" + base),
        (11, sentence(5, 12)),
        (12, "to " * 300 + "x" * 5000),
        (-3, "aaaa" * 60 + "b"),
    ]


def table(spark, rows):
    """A documents table whose further columns are null and carry names that operators use."""
    return spark.createDataFrame([(i, t, None, None, None, "clash", 7, None, 1, None, None, 3, None, None) for i, t in rows], SCHEMA)


WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def shingles(text: str | None) -> set:
    w = WORD.findall((text or "").translate(FOLD))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def components(rows: list[tuple]) -> list[tuple]:
    """(doc_id, n_shingles, component_id) of each row by comparing all pairs with common shingles."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    inverted: dict = {}
    for k, s in enumerate(sets):
        common = Counter(j for x in s for j in inverted.get(x, ()))
        for x in s:
            inverted.setdefault(x, []).append(k)
        for j, c in common.items():
            if 100 * c >= 80 * (len(s) + len(sets[j]) - c):
                parent[find(k)] = find(j)
    least: dict = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            r = find(k)
            least[r] = min(least.get(r, i), i)
    return [(i, len(s), least.get(find(k)) if s else i) for k, ((i, _), s) in enumerate(zip(rows, sets, strict=True))]


def auc(score, label) -> float:
    pos = [s for s, y in zip(score, label, strict=True) if y]
    neg = [s for s, y in zip(score, label, strict=True) if not y]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def none_first(x):
    return tuple((v is not None, v) if not isinstance(v, list) else (True, tuple(v)) for v in x)


def ordered(rows) -> list[tuple]:
    return sorted((tuple(r) for r in rows), key=none_first)
