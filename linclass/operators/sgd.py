"""Gradient-descent trainer for logistic and hinge loss, as DataFrame aggregations.

Each iteration is one pass over the cached train rows, packed once into blocks of samples
(``blocks.packed_blocks``): every task sums its gradient block by block with NumPy on the packed
bytes, so no step converts a row, and one small reduce adds the partial vectors of d + 2
numbers. The weights are data of that pass, not literals of its plan, so every step (and every
number of features) runs the same plan. The update is d + 1 floating-point operations on the
driver. Rows with nulls are an error, counted before the first step.

Rules (those of the classic gradient-descent trainers the reference calls):

* full batch every step; step_t = step / sqrt(t); at most ``iterations`` steps;
* logistic multiplier sigma(w.x) - y; hinge: -(2y - 1) where (2y - 1) w.x < 1, else 0;
  the gradient is the mean of multiplier * x;
* l2: w <- w (1 - step_t lambda) - step_t g; l1: w <- w - step_t g, then soft-threshold by
  lambda step_t; none: w <- w - step_t g;
* the intercept is a constant-1 feature: it starts at 1.0 and is penalised like the rest;
* stop once ||w_t - w_(t-1)|| < tol * max(||w_t||, 1) (checked from the second step on).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linclass.functions.expressions import col
from linclass.operators.blocks import block_sums, collect_vector, loop_frame, packed_blocks
from linclass.operators.linear import LinearModel

PENALTIES = ("l2", "l1", "none")
LOSSES = ("logistic", "hinge")


class NullRowsError(ValueError):
    """Training rows with a null label or feature; ``n_rows`` of them."""

    def __init__(self, n_rows: int):
        super().__init__(f"{n_rows} training rows hold a null label or feature")
        self.n_rows = n_rows


@dataclass
class SgdTrace:
    iterations: int = 0
    converged: bool = False
    rows: int = 0
    history: list[list[float]] = field(default_factory=list)


def update(
    w: list[float], g: list[float], step_t: float, penalty: str, reg: float
) -> list[float]:
    """One step of the update rule on the full weight vector (intercept included)."""
    if penalty == "l2":
        return [wi * (1.0 - step_t * reg) - step_t * gi for wi, gi in zip(w, g)]
    moved = [wi - step_t * gi for wi, gi in zip(w, g)]
    if penalty == "l1":
        shrink = reg * step_t
        return [math.copysign(abs(v) - shrink, v) if abs(v) > shrink else 0.0 for v in moved]
    return moved


def _norm(v: Sequence[float]) -> float:
    return math.sqrt(sum(x * x for x in v))


def _gradient_parts(blocks: DataFrame, d: int, w: list[float], b: float, loss: str) -> DataFrame:
    """DataFrame[i, s]: the sums m*x_1, ..., m*x_d, m and the rows of one pass over the blocks."""
    wv = np.asarray(w, dtype=np.float64)

    def add(total: np.ndarray, y: np.ndarray, x: np.ndarray) -> None:
        margin = x @ wv + b
        with np.errstate(over="ignore"):
            if loss == "logistic":
                m = 1.0 / (1.0 + np.exp(-margin)) - y
            else:
                s = 2.0 * y - 1.0
                m = np.where(s * margin < 1.0, -s, 0.0)
        total[:d] += m @ x
        total[d] += m.sum()
        total[d + 1] += len(y)

    return block_sums(blocks, d, d + 2, add)


def sgd_fit(
    train: DataFrame,
    features: Sequence[str],
    label: str = "label",
    loss: str = "logistic",
    penalty: str = "l2",
    reg: float = 0.01,
    iterations: int = 100,
    step: float = 1.0,
    intercept: bool = True,
    tol: float = 0.001,
    inputs: Sequence[Column] | None = None,
    persist: bool = True,
) -> tuple[LinearModel, SgdTrace]:
    """Fit by full-batch gradient descent; returns (model, trace).

    ``inputs`` may give one column expression per feature (e.g. standardised values);
    the model then scores with the same expressions through its ``means`` / ``stds``.
    """
    if loss not in LOSSES:
        raise ValueError(f"loss must be one of {LOSSES}")
    if penalty not in PENALTIES:
        raise ValueError(f"penalty must be one of {PENALTIES}, got {penalty!r}")
    features = list(features)
    d = len(features)
    exprs = list(inputs) if inputs is not None else [col(c).cast("double") for c in features]
    if len(exprs) != d:
        raise ValueError(f"{len(exprs)} input expressions for {d} features")

    # Blocks are what is cached: the inputs are evaluated and converted once.
    data = packed_blocks(train, exprs, label)
    if persist:
        data = data.persist(StorageLevel.MEMORY_AND_DISK)

    w = [0.0] * d + ([1.0] if intercept else [])
    trace = SgdTrace()
    prev: list[float] | None = None
    cached = data
    data, release = loop_frame(cached)
    try:
        nulls = data.agg(F.sum("n_null")).first()[0]
        if nulls:
            raise NullRowsError(nulls)
        for t in range(1, iterations + 1):
            b = w[d] if intercept else 0.0
            sums = collect_vector(_gradient_parts(data, d, w[:d], b, loss), d + 2).tolist()
            n = sums[-1]
            if n <= 0:
                break
            trace.rows = int(n)
            g = [s / n for s in sums[:d]] + ([sums[d] / n] if intercept else [])
            w = update(w, g, step / math.sqrt(t), penalty, reg)
            trace.iterations = t
            trace.history.append(list(w))
            if prev is not None:
                diff = _norm([a - c for a, c in zip(w, prev)])
                if diff < tol * max(_norm(w), 1.0):
                    trace.converged = True
                    break
            prev = list(w)
    finally:
        release()
        if persist:
            cached.unpersist()

    model = LinearModel(
        features=features,
        weights=w[:d],
        intercept=w[d] if intercept else 0.0,
        loss=loss,
        params={"penalty": penalty, "reg": reg, "iterations": iterations, "step": step, "tol": tol},
    )
    return model, trace
