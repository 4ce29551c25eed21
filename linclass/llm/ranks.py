"""Row numbers of a globally sorted table without a window over all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linclass.llm.text import staged


def numbered(rows: DataFrame, order: list[Column], folder: str, name: str, rank: str = "rank") -> DataFrame:
    """``rows`` with their place 1, 2, 3 ... in ``order`` (a total one, or equal rows are ranked
    in any order).

    The rows are sorted over range partitions and written, which fixes partition and place of each.
    A partition's first rank is the number of rows before it: the driver sees one count for each
    partition of the sort, whatever the number of rows."""
    place = f"{rank}_place"
    placed = staged(rows.orderBy(*order).withColumn(place, F.monotonically_increasing_id()), folder, name)
    part = F.shiftright(place, 33).cast("int")
    sizes = sorted((r["part"], r["n"]) for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    before, total = [], 0
    for k, n in sizes:
        before.append((k, total))
        total += n
    starts = placed.sparkSession.createDataFrame(before, f"{rank}_part int, {rank}_before long")
    ranked = placed.withColumn(f"{rank}_part", part).join(F.broadcast(starts), f"{rank}_part")  # a row for each partition
    return ranked.withColumn(rank, F.col(f"{rank}_before") + F.col(place).bitwiseAND((1 << 33) - 1) + 1).select(*rows.columns, rank)
