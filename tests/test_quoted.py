"""CSV records with line breaks inside quotes, over splits and files."""

from __future__ import annotations

import csv
import io
import random

import pytest
from conftest import write_file

from linclass.sources.delimited import CORRUPT, load_csv_inferred, read_records


@pytest.fixture()
def tiny_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "8")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_a_line_break_in_quotes_is_no_end_of_a_record(spark, workdir):
    path = write_file(workdir, "a.csv", 'k,v\n1,"x\ny"\n2,"z"\n')
    rows = load_csv_inferred(spark, path)
    assert [tuple(r) for r in rows.orderBy("k").collect()] == [(1, "x\ny", None), (2, "z", None)]
    assert rows.columns == ["k", "v", CORRUPT]


def test_an_open_quote_is_marked(spark, workdir):
    path = write_file(workdir, "a.csv", 'k,v\n1,"x"\n2,"open\n3,rest\n')
    got = {r.k: r[CORRUPT] for r in load_csv_inferred(spark, path).collect()}
    assert got[1] is None and [c for c in got.values() if c] == ['2,"open\n3,rest']


def test_records_over_many_splits_and_files(spark, workdir, tiny_splits):
    r = random.Random(2)
    want = []
    for k in range(4):
        out = io.StringIO()
        w = csv.writer(out, lineterminator="\n")
        w.writerow(["k", "text", "n"])
        for j in range(60):
            text = "".join(r.choices(["word ", "\n", '"', ",", "é", "long passage of text "], k=r.choice([0, 1, 6, 30])))
            text = "t" + text + "t"
            row = (k * 1000 + j, text, r.randrange(100))
            want.append(row)
            w.writerow(row)
        write_file(workdir, f"in/{k}.csv", out.getvalue())
    assert read_records(spark, f"{workdir}/in").rdd.getNumPartitions() > 8
    rows = load_csv_inferred(spark, f"{workdir}/in")
    assert sorted(tuple(x) for x in rows.drop(CORRUPT).collect()) == sorted(want)
    assert rows.where(f"{CORRUPT} is not null").count() == 0


def test_a_record_longer_than_several_splits_and_short_rows(spark, workdir, tiny_splits):
    text = "\n".join("line %d of one field" % k for k in range(60))
    path = write_file(workdir, "a.csv", f'k,v\n1,"{text}"\n2\n3,"a\nb",4\n5,"c\nd"\n')
    got = load_csv_inferred(spark, path).collect()
    assert {r.k: r.v for r in got if r[CORRUPT] is None} == {1: text, 5: "c\nd"}
    assert sorted(r[CORRUPT] for r in got if r[CORRUPT]) == ["2", '3,"a\nb",4']
