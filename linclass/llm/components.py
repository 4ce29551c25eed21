"""Connected components by alternating large-star and small-star steps, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linclass.llm.text import staged


def connected_components(edges: DataFrame, folder: str, name: str) -> DataFrame:
    """``node`` and ``root`` (least node of its component) of every node that isn't its own root.

    ``edges`` has long columns ``a`` and ``b``. Each step groups by node with map-side
    combination; links of a hub are joined to the hub's one minimum, so no group is gathered.
    Every step is written out, and the driver sees two numbers a step."""
    links = staged(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), folder, f"{name}-0")
    seen, step = None, 0
    while True:
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen, step = tuple(state), step + 1
        both = links.union(links.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        near = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(near, "a").where("b != m").select(F.col("b").alias("u"), F.col("m").alias("v"))
        links = staged(small.union(near).distinct(), folder, f"{name}-{step}")
