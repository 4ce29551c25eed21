"""Every catalogue query against its DuckDB SQL on the sf0.001 tables (names, types, rows,
values), the check the driver runs at sf0.01 (run `python tests/oracle_compare.py` for that)."""

from __future__ import annotations

import pytest
from conftest import SF001

import __spark_entry__ as E
from oracle_compare import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    res = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF001)
    assert res["ok"], res.get("why")
