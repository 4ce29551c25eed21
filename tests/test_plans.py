"""Physical-plan properties: pruning, pushdown, shuffles, no pair-producing joins."""

from __future__ import annotations

import contextlib
import io
import re

import pytest
from conftest import SF01

from linclass.plans import catalogue as C

LAZY = [
    "scan_delimited", "label_recode", "drop_columns", "dimensions", "class_profile", "class_counts",
    "data_checks", "set_aside", "hash_split", "scaler_transform", "score_logistic_hard",
    "score_logistic_soft", "score_svm", "balanced_accuracy",
]


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def read_schemas(text: str) -> list[str]:
    return re.findall(r"ReadSchema: struct<(.*)>", text)


@pytest.mark.parametrize("name", LAZY)
def test_no_pair_joins(spark, name):
    text = plan_text(C.QUERIES[name](spark, SF01))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_scoring_is_one_pruned_projection(spark):
    text = plan_text(C.QUERIES["score_logistic_soft"](spark, SF01))
    assert read_schemas(text) == ["l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_discount:double,l_tax:double"]
    assert "Exchange" not in text


def test_split_reads_only_the_key(spark):
    text = plan_text(C.QUERIES["hash_split"](spark, SF01))
    assert read_schemas(text) == ["o_orderkey:bigint"] and "Exchange" not in text


def test_checks_are_two_small_aggregates(spark):
    text = plan_text(C.QUERIES["data_checks"](spark, SF01))
    # one row of counts, and d partial rows a task for the features, whatever their number
    assert len(re.findall(r"\(\d+\) Exchange", text)) == 2
    assert all("props" not in r and "ts:" not in r for r in read_schemas(text))


def test_fold_filter_runs_in_the_scan_stage(spark):
    from pyspark.sql import functions as F

    train = C.lineitem_folds(spark, SF01, C.SCALE_FEATURES).where(F.col("fold") == "train")
    text = plan_text(train)
    # the md5 fold predicate is evaluated in the codegen stage of the scan: no exchange
    assert "Exchange" not in text and re.search(r"\(\d+\) Filter \[codegen id : 1\]", text)
    assert "md5" in text


def test_document_text_never_shuffles(spark):
    text = plan_text(C.doc_table(spark, SF01))
    # every exchange carries doc_id and derived doubles only
    for block in re.split(r"\n\(\d+\) ", text):
        if block.startswith("Exchange") or block.startswith("BroadcastExchange"):
            inputs = re.search(r"Input \[\d+\]: \[(.*)\]", block)
            assert inputs and "text" not in inputs.group(1), block


def test_auc_is_one_scan_and_two_exchanges(spark):
    text = plan_text(C.q_auc_scores(spark, SF01))
    # counts go to ranges of (group, score) once; a row for each range and group meets by group
    assert len(re.findall(r"\(\d+\) Exchange", text)) == 2 and len(read_schemas(text)) == 1
    assert "rangepartitioning" in text and "Window" not in text and "SinglePartition" not in text and "Join" not in text


def test_folds_without_a_key_number_no_rows_by_a_window(spark):
    text = plan_text(C.q_random_split(spark, SF01))
    # rows are counted by digest, with a partial count in every task; none are numbered or paired
    assert "Window" not in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "partial_count" in text
