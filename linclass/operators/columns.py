"""Column rules: target and excluded lookup by name, feature list, label recode, vector.

Features are the header minus the target minus the excluded columns, in header order.
Every bad name is an error that lists the available columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame

from linclass.functions.expressions import col, recode_label

LABEL = "label"
FEATURES = "features"


class ColumnError(ValueError):
    pass


@dataclass(frozen=True)
class Columns:
    target: str
    excluded: list[str]
    features: list[str]
    all_columns: list[str]


def resolve_columns(names: Sequence[str], target: str, excluded: Sequence[str] = ()) -> Columns:
    """Check the names and return the feature list (header - target - excluded)."""
    names = list(names)
    folded = [n.lower() for n in names]  # Spark resolves names without case
    dups = sorted({n for n in names if folded.count(n.lower()) > 1})
    seen = set(names)
    if dups:
        raise ColumnError(f"duplicate column names in the input: {dups}")
    excl: list[str] = []
    for c in excluded:
        if c not in excl:
            excl.append(c)
    unknown = [c for c in [target, *excl] if c not in seen]
    if unknown:
        raise ColumnError(f"unknown column(s) {unknown}; available: {names}")
    if target in excl:
        raise ColumnError(f"target {target!r} is also in the excluded columns")
    drop = {target, *excl}
    features = [n for n in names if n not in drop]
    if not features:
        raise ColumnError("no feature column left after removing target and excluded columns")
    return Columns(target=target, excluded=excl, features=features, all_columns=names)


def prepare(
    df: DataFrame,
    cols: Columns,
    keep: Sequence[str] = (),
    recode: bool = True,
    label: str = LABEL,
    rename: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rows as (keep..., label, feature doubles...): label recoded -1 -> 0 when ``recode``;
    features renamed by ``rename`` (original -> new name) where given."""
    y = recode_label(cols.target) if recode else col(cols.target).cast("double")
    names = rename or {}
    return df.select(
        *[col(k) for k in keep],
        y.alias(label),
        *[col(c).cast("double").alias(names.get(c, c)) for c in cols.features],
    )


def safe_names(features: Sequence[str], reserved: Sequence[str] = ()) -> dict[str, str]:
    """Original -> name usable by every Spark ML stage (no '.', no '`', not a reserved
    column such as the label or the fold), unique."""
    res = set(reserved)

    def ok(c: str) -> bool:
        return "." not in c and "`" not in c and c not in res

    taken = res | {c for c in features if ok(c)}
    out = {}
    for c in features:
        if ok(c):
            out[c] = c
            continue
        base = c.replace(".", "_").replace("`", "_")
        name, i = base, 1
        while name in taken:
            name, i = f"{base}_{i}", i + 1
        taken.add(name)
        out[c] = name
    return out


def assembler(features: Sequence[str], output: str = FEATURES, handle_invalid: str = "error") -> VectorAssembler:
    """Feature vector stage. Rows with nulls or NaN fail by default: the checks run first."""
    return VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid=handle_invalid)
