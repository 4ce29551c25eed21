"""Linear SVM with an l2, l1 or no penalty, solved to a duality gap by a bundle of planes.

The mean hinge loss is convex and piecewise linear: a pass over the packed blocks at weights w
gives its value and a plane that touches it there and lies below it everywhere. The planes so
far are a model of the loss; its minimum with the penalty, kept near the best weights by a
proximal term, is where the next pass looks. That small problem lives on the driver in its
dual, one number between 0 and 1 a plane (``passes`` planes of d numbers at most).

The same numbers weigh the training rows' dual variables, so each of them gives a lower bound
of the true optimum: the fit ends when best value and bound differ by ``tol`` of the value.
Without a penalty the bound holds for weights within ``REACH`` times the best ones' norm.
Features come standardised or as they are; there is no intercept.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linclass.operators.blocks import block_sums, collect_vector, loop_frame, packed_blocks
from linclass.operators.linear import LinearModel
from linclass.operators.sgd import PENALTIES, NullRowsError

REACH = 10.0


@dataclass
class BundleTrace:
    passes: int = 0
    objective: float = float("inf")
    bound: float = float("-inf")
    converged: bool = False
    rows: int = 0

    @property
    def gap(self) -> float:
        return self.objective - self.bound


def hinge_plane(blocks: DataFrame, d: int, w: np.ndarray) -> tuple[np.ndarray, float, float, int]:
    """Slope and offset of the plane that touches the mean hinge loss at ``w``, the loss, rows."""

    def add(total: np.ndarray, y: np.ndarray, x: np.ndarray) -> None:
        sign = 2.0 * y - 1.0
        short = 1.0 - sign * (x @ w)
        inside = short > 0
        total[:d] -= sign[inside] @ x[inside]
        total[d:] += [inside.sum(), short[inside].sum(), len(y)]

    sums = collect_vector(block_sums(blocks, d, d + 3, add), d + 3)
    n = max(sums[-1], 1.0)
    return sums[:d] / n, sums[d] / n, sums[d + 1] / n, int(sums[-1])


def solve_model(slopes: np.ndarray, offsets: np.ndarray, centre: np.ndarray, near: float, l1: float, l2: float, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Plane shares and weights that minimise the model, the penalty and ``near / 2`` times the
    squared distance from ``centre``, by a primal-dual interior-point method in the dual.

    With shares a of the planes and, for l1, slopes s of the penalty (each between -l1 and l1),
    the weights are -(a slopes + s - near centre) / (near + l2). A step solves one system with a
    row for each plane; the part of s is diagonal."""
    m, d = slopes.shape
    k = near + l2
    a, z, t = np.full(m, 1.0 / m), np.ones(m), 0.0
    s, up, down = np.zeros(d), np.full(d, float(l1 > 0)), np.full(d, float(l1 > 0))
    scale = max(1.0, np.abs(offsets).max(), np.abs(slopes).max())
    z *= scale
    for _ in range(rounds):
        v = (a @ slopes + s - near * centre) / k
        pairs = m + 2 * d * (l1 > 0)
        slack = float(a @ z + (l1 - s) @ up + (l1 + s) @ down) / pairs if l1 else float(a @ z) / m
        r1 = offsets - slopes @ v + z - t
        r2 = -(v + up - down) if l1 else np.zeros(d)
        if slack < 1e-15 * scale and max(np.abs(r1).max(), np.abs(r2).max(initial=0.0)) < 1e-11 * scale:
            break
        aim = 0.1 * slack
        # complementarity: what the multipliers move by is put into the right-hand sides
        r1 += aim / a - z
        if l1:
            high, low = l1 - s, l1 + s
            r2 += -(aim / high - up) + (aim / low - down)
            bend = up / high + down / low
            inner = 1.0 / (1.0 / k + bend)
            weight = bend / (1.0 + k * bend)
        else:
            inner, weight = np.zeros(d), np.full(d, 1.0 / k)
        system = np.zeros((m + 1, m + 1))
        system[:m, :m] = (slopes * weight) @ slopes.T
        system[:m, :m][np.diag_indices(m)] += z / a
        system[:m, m] = system[m, :m] = 1.0
        right = np.append(r1 - slopes @ (inner * r2) / k, 1.0 - a.sum())
        move = np.linalg.solve(system, right)
        da, dt = move[:m], move[m]
        ds = inner * (r2 - slopes.T @ da / k)
        dz = (aim - z * da) / a - z
        steps = [(a, da), (z, dz)]
        if l1:
            dup, ddown = (aim + up * ds) / high - up, (aim - down * ds) / low - down
            steps += [(high, -ds), (low, ds), (up, dup), (down, ddown)]
        size = min(1.0, *(0.99 * float((-x[dx < 0] / dx[dx < 0]).min(initial=np.inf)) for x, dx in steps))
        a, z, t = a + size * da, z + size * dz, t + size * dt
        if l1:
            s, up, down = s + size * ds, up + size * dup, down + size * ddown
    a = np.maximum(a, 0.0) / np.maximum(a, 0.0).sum()
    v = near * centre - a @ slopes
    return a, np.sign(v) * np.maximum(np.abs(v) - l1, 0.0) / k


def bundle_fit(
    train: DataFrame,
    features: Sequence[str],
    label: str = "label",
    penalty: str = "l2",
    reg: float = 0.01,
    passes: int = 200,
    tol: float = 1e-6,
    inputs: Sequence[Column] | None = None,
) -> tuple[LinearModel, BundleTrace]:
    """Fit by planes; returns (model, trace). ``inputs`` as in ``sgd_fit``."""
    if penalty not in PENALTIES:
        raise ValueError(f"penalty must be one of {PENALTIES}, got {penalty!r}")
    features = list(features)
    d = len(features)
    l1, l2 = (reg if penalty == "l1" else 0.0), (reg if penalty == "l2" else 0.0)
    cost = lambda w: l1 * np.abs(w).sum() + l2 / 2 * (w @ w)
    cached = packed_blocks(train, features if inputs is None else inputs, label).persist(StorageLevel.MEMORY_AND_DISK)
    blocks, release = loop_frame(cached)
    trace = BundleTrace()
    try:
        nulls = blocks.agg(F.sum("n_null")).first()[0]
        if nulls:
            raise NullRowsError(nulls)
        best = tried = np.zeros(d)
        slopes, offsets = np.zeros((0, d)), np.zeros(0)
        near, expected = 1.0, 0.0
        while trace.passes < passes:
            slope, offset, loss, trace.rows = hinge_plane(blocks, d, tried)
            trace.passes += 1
            if not trace.rows:
                break
            value = loss + cost(tried)
            gain = trace.objective - value
            if not trace.passes > 1 or gain > 0:
                best, trace.objective = tried, value
            if trace.passes > 1:
                near = max(near / 4, 1e-8) if gain >= 0.5 * expected else near * 1.5 if gain <= 0 else near
            slopes, offsets = np.vstack([slopes, slope]), np.append(offsets, offset)
            share, tried = solve_model(slopes, offsets, best, near, l1, l2)
            g, b = share @ slopes, float(share @ offsets)
            if l2:
                bound = b - (g @ g) / (2 * l2)
            elif l1:
                bound = b * min(1.0, l1 / max(np.abs(g).max(initial=0.0), 1e-300))
            else:
                bound = b - REACH * max(1.0, np.linalg.norm(best)) * np.linalg.norm(g)
            trace.bound = max(trace.bound, bound, 0.0)
            expected = trace.objective - ((offsets + slopes @ tried).max() + cost(tried))
            if trace.gap <= tol * max(trace.objective, 1e-12):
                trace.converged = True
                break
    finally:
        release()
        cached.unpersist()
    params = {"penalty": penalty, "reg": reg, "passes": passes, "tol": tol}
    return LinearModel(features=features, weights=best.tolist(), intercept=0.0, loss="hinge", params=params), trace
