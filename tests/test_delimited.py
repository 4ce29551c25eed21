"""Delimited source and column rules on the edge files of FIXTURES.md section 3."""

from __future__ import annotations

import pytest
from conftest import write_file
from pyspark.sql import functions as F

from linclass.operators.checks import DataCheckError, data_checks
from linclass.operators.columns import ColumnError, prepare, resolve_columns
from linclass.sources.delimited import CORRUPT, load_delimited


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_header_and_types(spark, workdir):
    p = write_file(workdir, "a.csv", '"x","y","Target"\n1,2.5,1\n3,4,-1\n')
    df, h = load_delimited(spark, p)
    assert h.names == ["x", "y", "Target"]
    assert sorted(rows(df, "x", "y", "Target")) == [(1.0, 2.5, 1.0), (3.0, 4.0, -1.0)]
    assert df.where(F.col(CORRUPT).isNotNull()).count() == 0


def test_repeat_header_and_blank_lines_dropped(spark, workdir):
    p = write_file(workdir, "a.csv", "x,Target\n1,1\n\nx,Target\n2,0\n   \n")
    df, _ = load_delimited(spark, p)
    assert sorted(rows(df, "x")) == [(1.0,), (2.0,)]


def test_multi_file_folder(spark, workdir):
    write_file(workdir, "in/part1.csv", "x,Target\n1,1\n2,0\n")
    write_file(workdir, "in/part2.csv", "x,Target\n3,1\n")
    df, h = load_delimited(spark, f"{workdir}/in")
    assert h.names == ["x", "Target"]
    assert sorted(rows(df, "x")) == [(1.0,), (2.0,), (3.0,)]


def test_short_long_malformed_rows_marked(spark, workdir):
    text = "a,b,Target\n1,2,1\n1,2\n1,2,3,4\nabc,1,0\n1_000,1,1\nnan,1,1\n,1,0\n"
    df, _ = load_delimited(spark, write_file(workdir, "a.csv", text))
    marked = df.where(F.col(CORRUPT).isNotNull())
    # short, long, 'abc', '1_000' and 'nan' are marked; the empty field is a plain null
    assert marked.count() == 5
    # marks survive selecting a single column
    assert df.select("a", CORRUPT).where(F.col(CORRUPT).isNotNull()).count() == 5
    assert df.where(F.col("a").isNull() & F.col(CORRUPT).isNull()).count() == 1


def test_quoted_values_and_pipe_separator(spark, workdir):
    p = write_file(workdir, "a.txt", '"a"|"Target"\n"1"|"0"\n2|1\n')
    df, h = load_delimited(spark, p, sep="|")
    assert h.names == ["a", "Target"]
    assert sorted(rows(df, "a", "Target")) == [(1.0, 0.0), (2.0, 1.0)]


def test_multichar_separator(spark, workdir):
    p = write_file(workdir, "a.txt", "a||b||Target\n1||2||1\n")
    df, _ = load_delimited(spark, p, sep="||")
    assert rows(df, "a", "b", "Target") == [(1.0, 2.0, 1.0)]


def test_text_excluded_column_never_cast(spark, workdir):
    p = write_file(workdir, "a.csv", "id,name,x,Target\n1,alice,0.5,1\n2,bob,1.5,0\n")
    df, h = load_delimited(spark, p, string_columns=["name"])
    cols = resolve_columns(h.names, "Target", ["name"])
    assert cols.features == ["id", "x"]
    assert df.where(F.col(CORRUPT).isNotNull()).count() == 0
    assert sorted(rows(prepare(df, cols), "label", "x")) == [(0.0, 1.5), (1.0, 0.5)]


def test_neg_labels_recoded(spark, workdir):
    p = write_file(workdir, "a.csv", "x,Target\n1,-1\n2,1\n3,-1\n")
    df, h = load_delimited(spark, p)
    out = prepare(df, resolve_columns(h.names, "Target"))
    assert sorted(rows(out, "x", "label")) == [(1.0, 0.0), (2.0, 1.0), (3.0, 0.0)]


def test_bad_label_fails_check(spark, workdir):
    p = write_file(workdir, "a.csv", "x,Target\n1,2\n2,1\n3,0\n")
    df, h = load_delimited(spark, p)
    cols = resolve_columns(h.names, "Target")
    checks = {(r.check, r.column): r.n_bad for r in data_checks(prepare(df, cols), "label", cols.features).collect()}
    assert checks[("label_domain", "label")] == 1


def test_column_name_errors():
    with pytest.raises(ColumnError, match="duplicate"):
        resolve_columns(["a", "a", "Target"], "Target")
    with pytest.raises(ColumnError, match="available"):
        resolve_columns(["a", "Target"], "Target", ["zzz"])
    with pytest.raises(ColumnError, match="unknown"):
        resolve_columns(["a", "b"], "Target")
    with pytest.raises(ColumnError, match="also in the excluded"):
        resolve_columns(["a", "b", "Target"], "Target", ["Target"])
    # duplicates in the exclusion list are dropped, not popped twice
    assert resolve_columns(["a", "b", "c", "Target"], "Target", ["b", "b"]).features == ["a", "c"]


def test_strict_job_reports_counts(spark, workdir):
    from linclass.plans.jobs import logistic_job

    p = write_file(workdir, "a.csv", "x,Target\n1,1\nabc,0\n2,0\n3,1\n")
    with pytest.raises(DataCheckError, match=r"corrupt\(\*\)=1"):
        logistic_job(spark, p, save=False)


def test_names_with_spaces_and_backticks(spark, workdir):
    p = write_file(workdir, "a.csv", '"Age years","odd`name",Target\n30,1,1\n40,2,0\n')
    df, h = load_delimited(spark, p)
    assert h.names == ["Age years", "odd`name", "Target"]
    cols = resolve_columns(h.names, "Target")
    assert sorted(rows(prepare(df, cols), "label", "Age years")) == [(0.0, 40.0), (1.0, 30.0)]


def test_infinite_and_nan_values_fail_checks(spark, workdir):
    p = write_file(workdir, "a.csv", "x,Target\nInf,1\nNaN,0\n2,1\n3,0\n")
    df, h = load_delimited(spark, p)
    cols = resolve_columns(h.names, "Target")
    checks = {(r.check, r.column): r.n_bad for r in data_checks(prepare(df, cols), "label", cols.features).collect()}
    assert checks[("non_finite", "x")] == 2 and checks[("null", "x")] == 0
