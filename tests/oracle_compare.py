"""Run catalogue queries in Spark and their SQL in DuckDB; compare rows, columns, values.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Values are compared as sorted tuples of row values (columns sorted by name), the way the
driver's check orders them.
"""

from __future__ import annotations

import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


DUCK_TO_SPARK = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
    "FLOAT": "float", "SMALLINT": "smallint", "TINYINT": "tinyint", "DATE": "date",
}


def type_mismatches(df, res) -> list[str]:
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    out = []
    for col, typ in zip([c[0] for c in res.description], [str(c[1]) for c in res.description]):
        want = DUCK_TO_SPARK.get(typ.upper(), typ)
        if spark_types.get(col) != want:
            out.append(f"{col}: spark {spark_types.get(col)} vs duckdb {typ}")
    return out


def compare(spark, con, name, fn, sql, sf_dir):
    t = time.time()
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    spark_s = time.time() - t
    if sql is None:
        return {"name": name, "ok": None, "rows": len(s_rows), "spark_s": round(spark_s, 2)}
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    out = {"name": name, "rows": len(s_rows), "spark_s": round(spark_s, 2)}
    types = type_mismatches(df, res)
    if sorted(s_cols) != sorted(d_cols):
        out.update(ok=False, why=f"columns {s_cols} vs {d_cols}")
    elif types:
        out.update(ok=False, why=f"types {types}")
    elif len(s_rows) != len(d_rows):
        out.update(ok=False, why=f"rows {len(s_rows)} vs {len(d_rows)}")
    else:
        a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        out.update(ok=not bad, why=f"{len(bad)} differing rows, e.g. {bad[:2]}" if bad else "")
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from linclass.session import local_session

    spark = local_session(8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    failed = 0
    for name in names or list(qs):
        try:
            r = compare(spark, con, name, qs[name], sqls.get(name), sf_dir)
        except Exception as e:  # report and go on
            r = {"name": name, "ok": False, "why": repr(e)[:400]}
        failed += r.get("ok") is False
        print(r, flush=True)
    print("FAILED", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
