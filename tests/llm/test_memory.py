"""Memory of the pipeline's Python tasks: what a task holds at one time, what a worker keeps."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from linclass.llm import jaccard_join, packing, pii, text, toxicity
from linclass.llm.tokenize import TOKENS, default_tokenizer, encoder


def batches(texts: list[str]) -> list[pa.RecordBatch]:
    n = len(texts)
    return [pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array(texts), pa.array(range(n), pa.int64())], names=["doc_id", "text", "uid"])]


@pytest.mark.parametrize("name", ["_frequent", "_sets", "_keep"])
def test_a_task_holds_little_beside_its_batch(name):
    rng = np.random.default_rng(5)
    rows = batches([" ".join(f"w{x}" for x in rng.integers(0, 10**6, 400)) for _ in range(1400)])  # 4 MB
    none = np.zeros(0, np.uint64)
    run = {
        "_frequent": lambda: jaccard_join._frequent(rows),
        "_sets": lambda: jaccard_join._sets(rows, none, np.zeros(0, np.int64)),
        "_keep": lambda: toxicity._keep(rows, toxicity.LinearModel(none, np.zeros(0), 0.0), "text"),
    }[name]
    text._POWERS.clear()
    tracemalloc.start()
    for _ in run():
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 32e6


@pytest.mark.parametrize("least", [1, 2, 4, 7, 5000])
def test_values_met_counts_like_unique(least):
    rng = np.random.default_rng(least)
    parts = [rng.integers(0, 300, n).astype(np.uint64) for n in (0, 1, 700, 1200)]
    value, count = np.unique(np.concatenate(parts), return_counts=True)
    got = text.values_met(parts, least)
    assert got[0].tolist() == value[count >= least].tolist() and got[1].tolist() == count[count >= least].tolist()
    assert not parts
    assert text.values_met([np.full(3, 9, np.uint64)], least)[1].tolist() == ([3] if least <= 3 else [])


def test_encoder_goes_with_tasks_of_another_kind():
    rows = batches(["one two three", "", "one two"])
    lengths = [b.column("n_tokens").to_pylist() for b in packing._lengths(rows, default_tokenizer())]
    kept = encoder(default_tokenizer())
    assert [b.column("n_tokens").to_pylist() for b in packing._lengths(rows, default_tokenizer())] == lengths
    assert encoder(default_tokenizer()) is kept
    assert list(jaccard_join._frequent(rows))
    assert TOKENS not in text.KEPT
    assert [b.column("n_tokens").to_pylist() for b in packing._lengths(rows, default_tokenizer())] == lengths


def test_powers_of_a_long_text_are_not_kept():
    rows = batches(["x " * (2 * text.MOST_POWERS // 2 + 100)])
    assert list(jaccard_join._frequent(rows)) is not None
    assert all(len(t) <= text.MOST_POWERS for t in text._POWERS.values())


def test_no_task_of_the_rewriting_has_two_workers(spark):
    texts = ["write to a.b@c.org today", None, "", "call +1 202 555 0147 now", "write to a.b@c.org today"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    clean = pii.sanitise(docs)
    got = {r.doc_id: r.text for r in clean.collect()}
    assert got[1] is None and got[2] == "" and got[0] == got[4] and "a.b@c.org" not in got[0] and "[PHONE]" in got[3]
    above: list[tuple[int, str]] = []  # the plan as a tree: depth and name of a node's ancestors
    for line in clean._jdf.queryExecution().sparkPlan().toString().splitlines():
        name = line.lstrip(" :+-*")
        depth = len(line) - len(name)
        above = [x for x in above if x[0] < depth]
        if name.startswith("MapInArrow"):
            # above another worker there is a join that deals its rows anew
            for k, x in enumerate(above):
                assert not x[1].startswith("MapInArrow") or any("SortMergeJoin" in y[1] for y in above[k:])
        above.append((depth, name))
