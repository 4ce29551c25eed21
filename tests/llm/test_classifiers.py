"""Toxicity and quality: label model, factorisation machine, held-out accuracy, awkward rows."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from conftest import SF01
from llm_cases import auc, awkward_rows, table

from linclass.llm import quality, toxicity
from linclass.llm.text import string_bytes

import pyarrow as pa


def held(i) -> bool:
    return i is None or zlib.crc32(str(i).encode()) % 5 == 0


def test_label_model_recovers_the_class_from_votes():
    rng = np.random.default_rng(3)
    y = rng.random(4000) < 0.15
    hit, false = np.array([0.5, 0.4, 0.3, 0.3, 0.1]), np.array([0.01, 0.005, 0.02, 0.001, 0.09])
    votes = (rng.random((4000, 5)) < np.where(y[:, None], hit, false)).astype(np.float32)
    votes = np.concatenate([votes, votes[:, :1], votes[:, :1]], axis=1)  # two voters repeat the first
    post, got_hit, got_false = toxicity.label_model(votes, 0.15)
    assert auc(post, y) > 0.85
    assert np.abs(got_hit[:4] - hit[:4]).max() < 0.15 and (got_hit[:4] > 5 * got_false[:4]).all()
    # the noisy voter alone convinces less than a good one
    assert got_hit[4] / got_false[4] < got_hit[1] / got_false[1]


def test_posteriors_are_those_of_enumeration():
    """Every pattern of votes that occurs: both classes' joint probability by the learned rates,
    one factor a voter that fires, and one for a row on which none does."""
    rng = np.random.default_rng(11)
    prior, y = 0.2, rng.random(20_000) < 0.2
    rates = np.where(y[:, None], [0.5, 0.35, 0.25, 0.4], [0.02, 0.01, 0.03, 0.005])
    votes = (rng.random((20_000, 4)) < rates).astype(np.float32)
    post, hit, false = toxicity.label_model(votes, prior, rounds=400)
    some = votes.any(1)
    fires = [(post[some].sum() + 1) / (post.sum() + 2), ((1 - post)[some].sum() + 1) / ((1 - post).sum() + 2)]
    for pattern in np.unique(votes, axis=0):
        joint = [prior, 1 - prior]
        for j, fired in enumerate(pattern):
            if fired:
                joint = [joint[0] * hit[j], joint[1] * false[j]]
        if not pattern.any():
            joint = [joint[0] * (1 - fires[0]), joint[1] * (1 - fires[1])]
        own = (votes == pattern).all(1)
        assert np.ptp(post[own]) < 1e-9 and post[own][0] == pytest.approx(joint[0] / sum(joint), abs=2e-3)
    # the rates are the classes' shares of votes, weighed by the posteriors
    assert hit == pytest.approx((votes.T @ post + 0.5 * prior) / (post.sum() + 1), abs=2e-3)


def test_sum_of_squares_equals_all_pairs():
    rng = np.random.default_rng(0)
    m = quality.Machine(0.3, rng.normal(size=quality.N_FEATURES).astype(np.float32), rng.normal(size=(quality.N_FEATURES, quality.FACTORS)).astype(np.float32))
    raw, off = string_bytes(pa.array(["one two two three", "", "A b. 12 ###"]))
    doc, at, x = quality.features(raw, off)
    got = m.margin(doc, at, x, 3)
    for d in range(3):
        i, xi = at[doc == d], x[doc == d]
        want = m.bias + (m.weights[i] * xi).sum() + sum(m.factors[i[a]] @ m.factors[i[b]] * xi[a] * xi[b] for a in range(len(i)) for b in range(a))
        assert got[d] == pytest.approx(want, rel=1e-3, abs=1e-3)


@pytest.mark.parametrize("op, label, threshold, least", [(toxicity.op6_toxicity, "toxic", 0.5, 0.8), (quality.op8_quality, "quality", 0.3, 0.95)])
def test_held_out_rows(spark, op, label, threshold, least):
    got = op(spark, SF01).collect()
    truth = {r[0]: r[1] for r in spark.read.parquet(f"{SF01}/labels.parquet").select("doc_id", label).collect()}
    assert len(got) == spark.read.parquet(f"{SF01}/documents.parquet").count()
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 and r.predicted == int(r.score >= threshold) for r in got)
    out = [r for r in got if r.held_out and r.doc_id in truth]
    assert auc([r.score for r in out], [truth[r.doc_id] for r in out]) >= least


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (quality, "quality")])
def test_labels_of_held_out_rows_are_not_learned(spark, module, label):
    rows = [(i, f"plain words here {'awful' if i % 3 == 0 else 'kind'} number{i % 7} and so on {i}") for i in range(120)]
    docs = table(spark, rows)
    true = [(i, int(i % 3 == 0)) for i in range(120)]
    false = [(i, 1 - y if held(i) else y) for i, y in true]
    a, b = (module.score(docs, module.fit(docs, spark.createDataFrame(t, f"doc_id long, {label} int"))).orderBy("doc_id").collect() for t in (true, false))
    assert a == b
    assert auc([r.score for r in a], [y for _, y in true]) > 0.95


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (quality, "quality")])
def test_awkward_rows(spark, module, label):
    docs = table(spark, awkward_rows())
    none = spark.createDataFrame([], f"doc_id long, {label} int")
    some = spark.createDataFrame([(1, 1), (2, 1), (3, 0), (6, 0), (7, None), (None, 1), (8, 5), (9, 0), (9, 1)], f"doc_id long, {label} int")
    for labels in (none, some):
        model = module.fit(docs, labels)
        got = module.score(docs, model).collect()
        assert len(got) == len(awkward_rows()) and all(0 <= r.score <= 1 for r in got)
        assert len({round(r.score, 12) for r in got if r.doc_id in (3, 4)}) == 1  # null reads as empty
        assert module.score(table(spark, []), model).count() == 0
    kept = toxicity.drop_toxic(docs, toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int")))
    assert kept.columns == docs.columns and kept.count() == len(awkward_rows())
