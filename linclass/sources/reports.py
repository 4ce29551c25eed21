"""Report sink: run record, coefficient table and checks written as tables.

Formats are Spark's (parquet, json, csv); paths may be on any Hadoop file system.
Existing output at the same path is overwritten by the writer.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def write_tables(tables: Mapping[str, DataFrame], out_dir: str, fmt: str = "json") -> dict[str, str]:
    """Write each small report table as ``out_dir/<name>`` in one file; returns the paths."""
    paths = {}
    for name, df in tables.items():
        path = f"{out_dir.rstrip('/')}/{name}"
        writer = df.coalesce(1).write.mode("overwrite")
        if fmt == "csv":
            writer = writer.option("header", True)
        writer.format(fmt).save(path)
        paths[name] = path
    return paths
