"""The pipeline's stages against plain versions of their decisions; registration."""

from __future__ import annotations

import numpy as np
from conftest import SF001
from llm_cases import components
from test_pii import plain

import __spark_entry__ as entry
import corpus_pipeline
from linclass.llm import decontaminate, pii, toxicity
from linclass.llm.text import scratch_folder
from linclass.llm.tokenize import default_tokenizer, encoder


def test_stages_take_effect(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "personal_data", "packing"]
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    tables, folder = [docs], scratch_folder(spark, "test")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, tables[-1], SF001).write.parquet(f"{folder}/{name}")
        tables.append(spark.read.parquet(f"{folder}/{name}"))
    assert all(t.dtypes == docs.dtypes for t in tables[1:5])
    rows = [{r.doc_id: r.text for r in t.select("doc_id", "text").collect()} for t in tables[:5]]
    # toxic documents as the classifier predicts them
    predicted = {r.doc_id: r.predicted for r in toxicity.op6_toxicity(spark, SF001).collect()}
    assert set(rows[1]) == {i for i in rows[0] if not predicted[i]}
    # one of each component
    assert set(rows[2]) == {c for _, _, c in components(list(rows[1].items()))}
    # no benchmark item is left, and nothing else went
    index = decontaminate.Index.build([tuple(r) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").select("item_id", "text").collect()])
    dirty = {i for i, t in rows[2].items() if decontaminate.search(index, [t])}
    assert {i for i, t in rows[2].items() if any(r.text in t for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect())} <= dirty
    assert set(rows[3]) == set(rows[2]) - dirty
    # personal data is replaced, texts without stay as they are
    assert set(rows[4]) == set(rows[3])
    for i, t in rows[3].items():
        spans = plain(t)
        assert (rows[4][i] == t) == (not spans)
        assert all(t[a:b] not in rows[4][i] for _, a, b in spans)
    assert all(r.n_chars == len(r.text) for r in tables[4].collect())
    # lengths of what is left
    coder = encoder(default_tokenizer())
    want = {i: len(coder.ids([t])[0]) // 4 + 1 for i, t in rows[4].items()}
    assert {r.doc_id: r.n_tokens for r in tables[5].collect()} == want
    run = corpus_pipeline.run(spark, SF001)
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, tables[5].collect()))


def test_every_operator_is_registered():
    names = entry.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14)) and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)


def test_helpers_hold_on_empty_input():
    assert len(pii.base_spans("")) == 0
    assert decontaminate.grams(np.zeros(3, np.uint32)).size == 0
