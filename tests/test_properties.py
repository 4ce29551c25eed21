"""Randomised properties (hypothesis): distributed metrics against brute force."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from linclass.operators.evaluate import binary_metrics

rows = st.lists(
    st.tuples(
        st.sampled_from(["a", "b"]),  # group
        st.sampled_from([0.0, 1.0]),  # label
        st.integers(min_value=-6, max_value=6).map(lambda v: v / 2.0),  # score with ties
        st.sampled_from([0.0, 1.0]),  # prediction
    ),
    min_size=1,
    max_size=60,
)


def brute(data):
    pos = [s for _, y, s, _ in data if y == 1.0]
    neg = [s for _, y, s, _ in data if y == 0.0]
    if not pos or not neg:
        return None, None
    auc = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg) / (len(pos) * len(neg))
    tpr = sum(1 for _, y, _, p in data if y == 1.0 and p == 1.0) / len(pos)
    tnr = sum(1 for _, y, _, p in data if y == 0.0 and p == 0.0) / len(neg)
    return auc, (tpr + tnr) / 2


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows, bins=st.sampled_from([1, 2, 5, 64]))
def test_metrics_by_group_equal_brute_force(spark, data, bins):
    df = spark.createDataFrame(data, "g string, label double, score double, prediction double")
    got = {r.g: r for r in binary_metrics(df, "label", "score", "prediction", by=["g"], bins=bins).collect()}
    for g in {d[0] for d in data}:
        part = [d for d in data if d[0] == g]
        auc, ba = brute(part)
        r = got[g]
        assert r.n_rows == len(part) and r.n_pos == sum(1 for d in part if d[1] == 1.0)
        if auc is None:
            assert r.auc is None and r.balanced_accuracy is None
        else:
            assert r.auc == pytest.approx(auc, abs=1e-12)
            assert r.balanced_accuracy == pytest.approx(ba, abs=1e-12)
