"""Column expressions (JVM-side built-ins only)."""

from linclass.functions.expressions import (
    distinct_word_share,
    dot,
    hash_unit,
    is_finite,
    non_letter_share,
    recode_label,
    sigmoid,
)

__all__ = [
    "distinct_word_share",
    "dot",
    "hash_unit",
    "is_finite",
    "non_letter_share",
    "recode_label",
    "sigmoid",
]
