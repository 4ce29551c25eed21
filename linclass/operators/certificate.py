"""How far returned weights are from the optimum of the problem they were fitted to.

For a smooth loss with an elastic-net penalty the optimality conditions are equations (for a
weight of zero an interval), so one aggregate over the training rows at the returned weights
measures by how much the worst of them is missed. The residual is in units of the loss's slope
against a standardised feature; 0 is exact. It says nothing about how the weights were found.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame

from linclass.operators.blocks import block_sums, collect_vector, packed_blocks


def logistic_residual(
    train: DataFrame,
    features: Sequence[str],
    weights: Sequence[float],
    intercept: float,
    label: str = "label",
    l1: float = 0.0,
    l2: float = 0.0,
    scaled_penalty: bool = True,
    intercept_penalty: bool = False,
) -> float | None:
    """Largest violation of the optimality conditions of mean logistic loss plus
    ``l1 |v| + l2 / 2 v^2`` for each ``v``; None without rows.

    ``scaled_penalty``: ``v`` is the weight of the standardised feature, as Spark's trainer has
    it, else the weight itself. ``intercept_penalty``: the intercept is penalised like a weight, as
    the gradient-descent rules do."""
    d = len(features)
    w, b = np.asarray(weights, np.float64), float(intercept)

    def add(total: np.ndarray, y: np.ndarray, x: np.ndarray) -> None:
        with np.errstate(over="ignore"):
            off = 1.0 / (1.0 + np.exp(-(x @ w + b))) - y
        total[:d] += off @ x
        total[d : 2 * d] += x.sum(0)
        total[2 * d : 3 * d] += (x * x).sum(0)
        total[3 * d :] += [off.sum(), len(y)]

    sums = collect_vector(block_sums(packed_blocks(train, list(features), label), d, 3 * d + 2, add), 3 * d + 2)
    n = sums[-1]
    if not n:
        return None
    spread = np.sqrt(np.maximum(sums[2 * d : 3 * d] - sums[d : 2 * d] ** 2 / n, 0.0) / max(n - 1, 1))
    used = spread > 0
    slope = np.divide(sums[:d] / n, spread, out=np.zeros(d), where=used) if scaled_penalty else sums[:d] / n
    v = w * spread if scaled_penalty else w
    if not scaled_penalty:
        used = np.ones(d, bool)
    slope, v = np.append(slope[used], sums[-2] / n), np.append(v[used], b if intercept_penalty else 0.0)
    free = np.zeros(len(v), bool)
    free[-1] = not intercept_penalty
    pull = np.where(free, 0.0, l2 * v)
    edge = np.where(free, 0.0, l1)
    missed = np.where(v != 0, np.abs(slope + pull + edge * np.sign(v)), np.maximum(np.abs(slope) - edge, 0.0))
    return float(missed.max())
