"""Data checks: DataFrame[check, column, n_bad, ok].

Row checks (a bad row can be set aside): ``corrupt`` (short, long or unparsable line),
``null``, ``non_finite`` (NaN or +/-Infinity), ``label_domain`` (label not 0/1 after the
-1 -> 0 recode). Table checks: ``empty``, ``single_class``, ``constant`` (min = max, or no
value). Fold checks (with a fold column): ``empty_fold``, ``single_class_fold``; they are
fatal for the training fold. ``null_key`` counts rows without their split key.

The table, label and fold counts are one aggregate of a few expressions. The features are
packed into one array and counted block by block with NumPy over Arrow batches, d partial
rows a task, so a table of thousands of features plans like one of three.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linclass.functions.expressions import col

# Checks that stop a strict run; the others are reported only.
FATAL = frozenset({"corrupt", "null", "non_finite", "label_domain", "empty", "single_class"})
ROW_CHECKS = frozenset({"corrupt", "null", "non_finite", "label_domain"})


class DataCheckError(ValueError):
    pass


@dataclass(frozen=True)
class CheckSpec:
    check: str
    column: str
    value: Column


def _flag(cond: Column) -> Column:
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def check_specs(
    label: str | None,
    fold_col: str | None = None,
    fold_names: Sequence[str] = ("train", "test"),
    corrupt_col: str | None = None,
    key_columns: Sequence[str] = (),
) -> list[CheckSpec]:
    specs = [CheckSpec("empty", "*", _flag(F.count(F.lit(1)) == 0))]
    if corrupt_col is not None:
        specs.append(CheckSpec("corrupt", "*", F.count_if(col(corrupt_col).isNotNull())))
    if label is not None:
        y = col(label)
        specs += [
            CheckSpec("null", label, F.count_if(y.isNull())),
            CheckSpec("label_domain", label, F.count_if(~y.isin(0.0, 1.0))),
            CheckSpec("single_class", label, _flag((F.count_if(y == 1.0) == 0) | (F.count_if(y == 0.0) == 0))),
        ]
    if key_columns:
        lost = col(key_columns[0]).isNull()
        for c in key_columns[1:]:
            lost = lost | col(c).isNull()
        specs.append(CheckSpec("null_key", ",".join(key_columns), F.count_if(lost)))
    if fold_col is not None:
        f = col(fold_col)
        for name in fold_names:
            in_fold = f == F.lit(name)
            specs.append(CheckSpec("empty_fold", name, _flag(F.count_if(in_fold) == 0)))
            if label is not None:
                y = col(label)
                specs.append(
                    CheckSpec(
                        "single_class_fold",
                        name,
                        _flag((F.count_if(in_fold & (y == 1.0)) == 0) | (F.count_if(in_fold & (y == 0.0)) == 0)),
                    )
                )
    return specs


def _feature_parts(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[pa.RecordBatch]:
    """Of each feature over a task's rows: nulls, non-finite values, least and greatest value
    (NaN greatest, as Spark orders it; null without values)."""
    nulls, odd = np.zeros(d, np.int64), np.zeros(d, np.int64)
    low, high, some, nan = np.full(d, np.inf), np.full(d, -np.inf), np.zeros(d, bool), np.zeros(d, bool)
    for batch in batches:
        if not batch.num_rows:
            continue
        flat = batch.column(0).flatten()
        none = flat.is_null().to_numpy(zero_copy_only=False).reshape(-1, d)
        x = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)
        nulls += none.sum(0)
        odd += (~np.isfinite(x) & ~none).sum(0)
        number = ~np.isnan(x)
        low = np.minimum(low, np.where(number, x, np.inf).min(0))
        high = np.maximum(high, np.where(number, x, -np.inf).max(0))
        some |= number.any(0)
        nan |= (~number & ~none).any(0)
    first = [float(a) if v else (float("nan") if q else None) for a, v, q in zip(low, some, nan)]
    last = [float("nan") if q else (float(a) if v else None) for a, v, q in zip(high, some, nan)]
    columns = [pa.array(range(d), pa.int32()), pa.array(nulls), pa.array(odd), pa.array(first, pa.float64()), pa.array(last, pa.float64())]
    yield pa.RecordBatch.from_arrays(columns, names=["i", "n_null", "n_odd", "low", "high"])


def _feature_counts(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """DataFrame[i, null, non_finite, constant]: one row a feature."""
    d = len(features)
    packed = df.select(F.array(*[col(c).cast("double") for c in features]).alias("x"))
    parts = packed.mapInArrow(lambda batches: _feature_parts(batches, d), "i int, n_null long, n_odd long, low double, high double")
    flat = (F.min("low") == F.max("high")) | F.max("high").isNull()
    return parts.groupBy("i").agg(F.sum("n_null").alias("null"), F.sum("n_odd").alias("non_finite"), _flag(flat).cast("long").alias("constant"))


FEATURE_CHECKS = ("null", "non_finite", "constant")


def data_checks(
    df: DataFrame,
    label: str | None,
    features: Sequence[str],
    fold_col: str | None = None,
    fold_names: Sequence[str] = ("train", "test"),
    corrupt_col: str | None = None,
    key_columns: Sequence[str] = (),
) -> DataFrame:
    """DataFrame[check: string, column: string, n_bad: bigint, ok: boolean]."""
    specs = check_specs(label, fold_col, fold_names, corrupt_col, key_columns)
    wide = df.agg(*[s.value.cast("long").alias(f"_c{i}") for i, s in enumerate(specs)])
    rows = F.array(
        *[
            F.struct(F.lit(s.check).alias("check"), F.lit(s.column).alias("column"), F.col(f"_c{i}").alias("n_bad"))
            for i, s in enumerate(specs)
        ]
    )
    out = wide.select(F.explode(rows).alias("_r")).select("_r.check", "_r.column", "_r.n_bad")
    if features:
        names = F.array(*[F.lit(c) for c in features])
        each = F.array(*[F.struct(F.lit(c).alias("check"), F.col(c).alias("n_bad")) for c in FEATURE_CHECKS])
        counts = _feature_counts(df, features).select(F.element_at(names, F.col("i") + 1).alias("column"), F.explode(each).alias("_r"))
        out = out.unionByName(counts.select("_r.check", "column", "_r.n_bad"))
    return out.withColumn("ok", F.col("n_bad") == 0)


def failures(check_rows: Sequence, fatal_only: bool = True, train: str | None = None) -> list:
    """Failed check rows from a collected check table; the fold checks of the fold ``train``
    are fatal too, because nothing can be learned from it."""
    fold = ("empty_fold", "single_class_fold")
    fatal = lambda r: r["check"] in FATAL or (train is not None and r["check"] in fold and r["column"] == train)
    return [r for r in check_rows if not r["ok"] and (not fatal_only or fatal(r))]


def enforce(check_rows: Sequence, strict: bool = True, train: str | None = None) -> None:
    """Strict mode: raise with the failed checks, their columns and counts."""
    bad = failures(check_rows, train=train)
    if strict and bad:
        text = "; ".join(f"{r['check']}({r['column']})={r['n_bad']}" for r in bad)
        raise DataCheckError(f"data checks failed: {text}")


def require_classes(kept: DataFrame, label: str, fold_col: str, train: str) -> None:
    """Raise unless the training fold of these rows holds both classes (one small row)."""
    here, y = col(fold_col) == train, col(label)
    pos, neg = kept.agg(F.count_if(here & (y == 1.0)), F.count_if(here & (y == 0.0))).first()
    if not pos or not neg:
        raise DataCheckError(f"no fit is possible: the fold {train!r} has {pos} positive and {neg} negative rows after bad rows were set aside")


def row_ok(label: str | None, features: Sequence[str], corrupt_col: str | None = None) -> Column:
    """True for a row that passes every row check."""
    cond = F.lit(True)
    if corrupt_col is not None:
        cond = cond & col(corrupt_col).isNull()
    if label is not None:
        cond = cond & col(label).isNotNull() & col(label).isin(0.0, 1.0)
    if features:
        values = F.array(*[col(c).cast("double") for c in features])
        cond = cond & F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(cond, F.lit(False))


def set_aside(
    df: DataFrame, label: str | None, features: Sequence[str], corrupt_col: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Permissive mode: (rows passing every row check, rows failing one)."""
    ok = row_ok(label, features, corrupt_col)
    return df.where(ok), df.where(~ok)


def run_checks(
    df: DataFrame,
    label: str | None,
    features: Sequence[str],
    fold_col: str | None = None,
    fold_names: Sequence[str] = ("train", "test"),
    corrupt_col: str | None = None,
    extra: dict[str, Column] | None = None,
    key_columns: Sequence[str] = (),
) -> tuple[list[dict], dict]:
    """Run the checks and any ``extra`` aggregates now; (check rows, extra values).

    To the driver come one row of counts and one row a feature.
    """
    specs = check_specs(label, fold_col, fold_names, corrupt_col, key_columns)
    extra = dict(extra or {})
    row = df.agg(
        *[s.value.cast("long").alias(f"_c{i}") for i, s in enumerate(specs)],
        *[v.alias(f"_e{j}") for j, v in enumerate(extra.values())],
    ).first()
    found = [(s.check, s.column, int(row[f"_c{i}"])) for i, s in enumerate(specs)]
    if features:
        for r in sorted(_feature_counts(df, features).collect(), key=lambda r: r["i"]):
            found += [(c, features[r["i"]], int(r[c])) for c in FEATURE_CHECKS]
    checks = [{"check": c, "column": name, "n_bad": n, "ok": n == 0} for c, name, n in found]
    return checks, {k: row[f"_e{j}"] for j, k in enumerate(extra)}


def checks_frame(spark, checks: Sequence[dict]) -> DataFrame:
    """The collected check rows (a few dozen at most) as a DataFrame."""
    return spark.createDataFrame(
        [(c["check"], c["column"], int(c["n_bad"]), bool(c["ok"])) for c in checks],
        "check string, column string, n_bad bigint, ok boolean",
    )
