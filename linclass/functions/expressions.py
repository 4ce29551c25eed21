"""Column expressions shared by the operators.

All of them are built-in Spark SQL functions, so they run in the JVM inside whole-stage
codegen; nothing here calls Python per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")
TWO_32 = 4294967296.0


def col(c: str | Column) -> Column:
    """A column by its exact name (quoted: dots, spaces and backticks are literal)."""
    return F.col("`" + c.replace("`", "``") + "`") if isinstance(c, str) else c


def recode_label(c: str | Column) -> Column:
    """Label -1 becomes 0; every other value is kept (the label check rejects the rest)."""
    y = col(c).cast("double")
    return F.when(y == -1.0, F.lit(0.0)).otherwise(y)


def is_finite(c: str | Column) -> Column:
    """True for a number that is neither NaN nor +/-Infinity; null stays null."""
    x = col(c).cast("double")
    return ~F.isnan(x) & (F.abs(x) != F.lit(INF))


def dot(features: Sequence[str | Column], weights: Sequence[float], intercept: float = 0.0) -> Column:
    """w . x + b as one arithmetic expression, added in pairs: its depth is the logarithm of
    the number of features, so a wide model plans like a narrow one."""
    if len(features) != len(weights):
        raise ValueError(f"{len(features)} features against {len(weights)} weights")
    terms = [F.lit(float(intercept)), *[F.lit(float(w)) * col(c).cast("double") for c, w in zip(features, weights)]]
    while len(terms) > 1:
        terms = [terms[i] + terms[i + 1] if i + 1 < len(terms) else terms[i] for i in range(0, len(terms), 2)]
    return terms[0]


def sigmoid(c: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-c))


def escaped(text: Column) -> Column:
    """A text whose backslashes and colons are marked, so that texts can be joined by colons."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit(":"), F.lit("\\:"))


def hash_unit(keys: Sequence[str | Column], seed: int) -> Column:
    """Uniform value in [0, 1) from the md5 of 'seed:key1:key2...'; null if a key is null.

    The first 32 bits of the digest, read as an unsigned number, over 2^32. Depends only on
    the key, so a row keeps its fold under any partitioning, file layout or re-run. Of
    several keys each has its backslashes and colons escaped, so no two lists of keys share
    a text.
    """
    parts = [col(k).cast("string") for k in keys]
    if len(parts) > 1:
        parts = [escaped(p) for p in parts]
    text = F.concat(F.lit(f"{seed}:"), *[x for p in parts for x in (F.lit(":"), p)][1:])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(TWO_32)


# The letters and the space that ``non_letter_share`` does not count, and the
# white-space characters of Java's \s (space, tab, newline, vertical tab, form feed, return).
ASCII_LETTERS_AND_SPACE = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ "
WHITESPACE = " \t\n\x0b\f\r"


def non_letter_share(text: str | Column) -> Column:
    """Share of the characters of a text that are not in [a-zA-Z ] (0 for an empty text).

    ``translate`` deletes the counted set character by character (no regex)."""
    t = col(text)
    n = F.length(t)
    rest = F.length(F.translate(t, ASCII_LETTERS_AND_SPACE, ""))
    return F.when(n > 0, rest / n).otherwise(F.lit(0.0))


def distinct_word_share(text: str | Column) -> Column:
    """Distinct words over words, words split on runs of white space (0 for no words)."""
    # After trim the split yields no empty token, except the single one of a blank text.
    # The ratio is kept out of a CASE branch so that the split is computed once per row
    # (common subexpressions are shared only among always-evaluated expressions).
    trimmed = F.trim(col(text), F.lit(WHITESPACE))
    words = F.split(trimmed, r"\s+")
    ratio = F.size(F.array_distinct(words)) / F.size(words)
    return ratio * (trimmed != F.lit("")).cast("double")
