"""Train / test split.

The default form is a fold column from a hash of a key: a pure expression, no shuffle,
and the same fold for a row under any partitioning or re-run (a lost task recomputes the
same rows into the same fold).

Rows without their key, and all rows where no key is named, get the fold of their content:
a hash of all their columns and of the number of the occurrence among equal rows. Equal rows
are thus spread over the folds, and nothing depends on how rows are dealt to files,
partitions or tasks. Only digests are counted to find the rows that occur more than once;
rows that occur once stay where they are. Equal rows are first counted (one row for each
content and task) and then written out again from their number, at most ``CHUNK`` by a task at
one time, so a content that a third of all rows have is no hot key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linclass.functions.expressions import TWO_32, col, escaped, hash_unit

FOLD = "fold"
DEFAULT_WEIGHTS = {"train": 0.8, "test": 0.2}
#: Equal rows that are written out from one counted row.
CHUNK = 10_000


def _normalise(weights: Mapping[str, float]) -> list[tuple[str, float]]:
    if not weights:
        raise ValueError("no fold weights")
    if any(w < 0 for w in weights.values()):
        raise ValueError(f"negative fold weight in {dict(weights)}")
    total = float(sum(weights.values()))
    if total <= 0:
        raise ValueError("fold weights sum to zero")
    out, acc = [], 0.0
    for name, w in weights.items():
        acc += w / total
        out.append((name, acc))
    return out


def fold_expr(u: Column, weights: Mapping[str, float] = DEFAULT_WEIGHTS) -> Column:
    """Name of the fold whose cumulative bound first exceeds ``u`` in [0, 1)."""
    bounds = _normalise(weights)
    expr = F.lit(bounds[-1][0])
    for name, upper in reversed(bounds[:-1]):
        expr = F.when(u < F.lit(upper), F.lit(name)).otherwise(expr)
    return expr


def hash_split(
    df: DataFrame,
    key: str | Sequence[str] | None = None,
    weights: Mapping[str, float] = DEFAULT_WEIGHTS,
    seed: int = 11,
    fold_col: str = FOLD,
    nulls: bool | None = None,
) -> DataFrame:
    """Add ``fold_col`` from md5('seed:key'); rows with a null key (and all rows when there
    is no key) by their content.

    ``nulls`` says whether keys may be null. By default one small job looks for the first null
    key (the filter reaches the scan); without one the split is a projection and nothing else."""
    if key is None:
        return random_folds(df, weights, seed, fold_col)
    keys = [key] if isinstance(key, str) else list(key)
    by_key = lambda rows: rows.withColumn(fold_col, fold_expr(hash_unit(keys, seed), weights))
    missing = reduce(lambda a, b: a | b, [col(k).isNull() for k in keys])
    if nulls is None:
        nulls = not df.where(missing).select(F.lit(1)).isEmpty()
    if not nulls:
        return by_key(df)
    return by_key(df.where(~missing)).unionByName(random_folds(df.where(missing), weights, seed, fold_col))


def content_digest(df: DataFrame) -> Column:
    """md5 of the texts of all columns of a row. Nulls are told from every text."""
    parts = []
    for f in df.schema.fields:
        c = col(f.name)
        if isinstance(f.dataType, T.BinaryType):
            c = F.base64(c)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            c = F.to_json(F.struct(c.alias("v")), {"ignoreNullFields": "false"})
        parts.append(F.coalesce(escaped(c.cast("string")), F.lit("\\N")))
    return F.md5(F.concat_ws(":", F.lit(str(len(parts))), *parts).cast("binary"))


def occurrence_unit(digest: Column, occurrence: Column, seed: int) -> Column:
    """Uniform value in [0, 1) of one of the rows with a content."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), digest, F.lit(":"), occurrence.cast("string")).cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(TWO_32)


def _fresh(df: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def random_folds(
    df: DataFrame, weights: Mapping[str, float] = DEFAULT_WEIGHTS, seed: int = 11, fold_col: str = FOLD
) -> DataFrame:
    """Add ``fold_col`` from the content of each row and its number among equal rows."""
    columns = [c for c in df.columns if c.lower() != fold_col.lower()]
    df = df.select(*map(col, columns))
    digest, copies, first, row = (_fresh(df, n) for n in ("_digest", "_copies", "_first", "_row"))
    marked = df.withColumn(digest, content_digest(df))
    repeated = marked.groupBy(digest).agg(F.count(F.lit(1)).alias(copies)).where(F.col(copies) > 1).select(digest)
    fold = lambda number: fold_expr(occurrence_unit(F.col(digest), number, seed), weights)
    once = marked.join(repeated, digest, "left_anti").select(*map(col, columns), fold(F.lit(0)).alias(fold_col))
    counted = marked.join(repeated, digest, "left_semi").groupBy(digest).agg(F.first(F.struct(*map(col, columns))).alias(row), F.count(F.lit(1)).alias(copies))
    chunks = counted.withColumn(first, F.explode(F.sequence(F.lit(0).cast("long"), F.col(copies) - 1, F.lit(CHUNK).cast("long")))).repartition(F.col(digest), F.col(first))
    number = F.explode(F.sequence(F.col(first), F.least(F.col(first) + CHUNK, F.col(copies)) - 1))
    out = chunks.select(digest, row, number.alias(first)).select(f"{row}.*", fold(F.col(first)).alias(fold_col))
    return once.unionByName(out)


def folds(df: DataFrame, fold_col: str = FOLD, names: Sequence[str] = ("train", "test")) -> dict[str, DataFrame]:
    """One filtered DataFrame per fold name (filters on the fold expression)."""
    return {n: df.where(col(fold_col) == n) for n in names}


def random_split(
    df: DataFrame, weights: Mapping[str, float] = DEFAULT_WEIGHTS, seed: int = 11
) -> dict[str, DataFrame]:
    """One DataFrame per fold name. They share the fold of a row, not a scan: to read the
    input once, keep ``random_folds`` (cached or written) and filter it."""
    fold = _fresh(df, "_fold")
    tagged = random_folds(df, weights, seed, fold)
    return {n: tagged.where(col(fold) == n).drop(fold) for n in weights}
