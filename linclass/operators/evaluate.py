"""Exact AUC and balanced accuracy, distributed.

AUC is the Mann-Whitney statistic with half credit for ties (the trapezoid area under the
ROC curve over every distinct score, which is what ``BinaryClassificationEvaluator`` with
``numBins=0`` returns). For each distinct score s with p(s) positives and n(s) negatives:

    AUC = 1 - sum_s n(s) * (pos_below(s) + p(s)/2) / (P * N)

pos_below(s) needs a running sum in score order, which is a distributed prefix sum:

1. each task counts positives and negatives of equal (group, score) among a batch of its rows,
   so a score that a third of all rows have is a row a batch;
2. these counts are dealt to range partitions of (group, score) - the one exchange that grows
   with the data - and sorted; a task runs through its range once, with a constant state, and
   gives one row for each group in it: its counts, and its part of the sum as if nothing lay
   before;
3. those rows (at most groups and range partitions together) meet by group; the positives of
   the earlier ranges are each range's offset.

Equal scores are in one range, so ties stay exact. The number of ranges is that of Spark's
shuffle partitions (``bins`` for another), and a range may be of any size. Nothing is cached
and no group's rows reach one task or the driver.

A row counts only if its label is 0 or 1 and its score (and prediction, where one is judged)
is not null; the others are reported as ``n_dropped``, the same rows for every metric.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linclass.functions.expressions import col

_S, _P, _N, _D, _TP, _FP = "_s", "_p", "_n", "_d", "_tp", "_fp"
COUNTS = (_P, _N, _D, _TP, _FP)


def _valid(label: Column, *others: Column) -> Column:
    ok = label.isin(0.0, 1.0)
    for c in others:
        ok = ok & c.isNotNull()
    return F.coalesce(ok, F.lit(False))


def _combined(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Counts of the equal keys of each batch."""
    for batch in batches:
        sums = pa.Table.from_batches([batch]).group_by(keys).aggregate([(c, "sum") for c in COUNTS])
        yield from sums.select([*keys, *(f"{c}_sum" for c in COUNTS)]).rename_columns(batch.schema.names).to_batches()


def _changes(column: pa.Array) -> np.ndarray:
    """Where a value differs from the one before it; nulls are equal to each other."""
    a, b = column.slice(1), column.slice(0, len(column) - 1)
    differ = pc.fill_null(pc.not_equal(a, b), False)
    return pc.or_(differ, pc.xor(a.is_null(), b.is_null())).to_numpy(zero_copy_only=False)


class _Range:
    """State of one group in a pass over a range: counts so far, and the tie not ended yet."""

    def __init__(self) -> None:
        self.counts = np.zeros(len(COUNTS), np.int64)
        self.sum, self.below = 0.0, 0
        self.tie: tuple[float, int, int] | None = None

    def add(self, score: np.ndarray, counts: np.ndarray) -> None:
        self.counts += counts.sum(1)
        p, n = counts[0], counts[1]
        used = (p + n) > 0
        score, p, n = score[used], p[used], n[used]
        if not len(score):
            return
        if self.tie is not None:
            score, p, n = np.append(self.tie[0], score), np.append(self.tie[1], p), np.append(self.tie[2], n)
        new = np.flatnonzero(np.append(True, (score[1:] != score[:-1]) & ~(np.isnan(score[1:]) & np.isnan(score[:-1]))))
        p, n = np.add.reduceat(p, new), np.add.reduceat(n, new)
        self.tie = (float(score[new[-1]]), int(p[-1]), int(n[-1]))
        self._close(p[:-1], n[:-1])

    def _close(self, p: np.ndarray, n: np.ndarray) -> None:
        before = self.below + np.cumsum(p) - p
        self.sum += float((n * (before + p / 2.0)).sum())
        self.below += int(p.sum())

    def end(self) -> list:
        if self.tie is not None:
            self._close(np.array([self.tie[1]]), np.array([self.tie[2]]))
        return [*self.counts.tolist(), self.sum]


def _prefix_sums(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.RecordBatch]:
    """One row for each group of a sorted range."""
    part, key, state = TaskContext.get().partitionId(), None, None
    names = [*by, "_part", *COUNTS, "_sum"]

    def row(schema: pa.Schema) -> pa.RecordBatch:
        own = [part, *state.end()]
        kinds = [pa.int32(), *[pa.int64()] * len(COUNTS), pa.float64()]
        return pa.RecordBatch.from_arrays([*(pa.array([v], schema.field(c).type) for c, v in zip(by, key, strict=True)), *(pa.array([v], t) for v, t in zip(own, kinds, strict=True))], names=names)

    schema = None
    for batch in batches:
        if not batch.num_rows:
            continue
        schema = batch.schema
        score = batch.column(_S).to_numpy(zero_copy_only=False).astype(np.float64)
        counts = np.stack([batch.column(c).to_numpy() for c in COUNTS])
        edge = np.zeros(batch.num_rows - 1, bool)
        for c in by:
            edge |= _changes(batch.column(c))
        cuts = [0, *(np.flatnonzero(edge) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            own = tuple(batch.column(c)[a].as_py() for c in by)
            if state is not None and own != key:
                yield row(schema)
                state = None
            key, state = own, state or _Range()
            state.add(score[a:b], counts[:, a:b])
    if state is not None:
        yield row(schema)


def binary_metrics(
    scored: DataFrame,
    label: str = "label",
    score: str | Column = "score",
    prediction: str | None = "prediction",
    by: Sequence[str] = (),
    bins: int | None = None,
) -> DataFrame:
    """DataFrame[*by, n_rows, n_pos, n_neg, n_dropped, auc, balanced_accuracy] (one row per group).

    ``auc`` ranks ``score``; ``balanced_accuracy`` = (TPR + TNR) / 2 of ``prediction``,
    equal to the AUC of the hard 0/1 prediction. Both are null for a group with one class.
    Lazy: the ranges' bounds are sampled when the result is asked for.
    """
    by = list(by)
    y, s = col(label).cast("double"), col(score).cast("double")
    p = col(prediction).cast("double") if prediction is not None else F.lit(None).cast("double")
    ok = _valid(y, s, *([p] if prediction is not None else []))
    rows = scored.select(*by, F.when(ok, s).alias(_S), ok.alias("_ok"), (y == 1.0).alias("_pos"), (p == 1.0).alias("_hit"))
    yes = lambda c: F.coalesce(c, F.lit(False)).cast("long")
    own, hit = F.col("_ok") & F.col("_pos"), F.col("_ok") & F.col("_hit")
    rows = rows.select(*by, _S, yes(own).alias(_P), yes(F.col("_ok") & ~F.col("_pos")).alias(_N), yes(~F.col("_ok")).alias(_D), yes(own & hit).alias(_TP), yes(hit & ~F.col("_pos")).alias(_FP))
    keys = [*by, _S]
    counts = rows.mapInArrow(lambda b: _combined(b, keys), rows.schema)
    ranged = counts.repartitionByRange(*([bins] if bins else []), *keys).sortWithinPartitions(*keys)
    fields = [rows.schema[c] for c in by]
    partial = T.StructType([*fields, T.StructField("_part", T.IntegerType()), *[T.StructField(c, T.LongType()) for c in COUNTS], T.StructField("_sum", T.DoubleType())])
    parts = ranged.mapInArrow(lambda b: _prefix_sums(b, by), partial)

    each = parts.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("_part", _P, _N, "_sum"))).alias("_each"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS])
    # the sum over the ranges in order; below counts the positives of the ranges before
    start = F.struct(F.lit(0).cast("long").alias("below"), F.lit(0.0).alias("total"))
    step = lambda a, x: F.struct((a["below"] + x[_P]).alias("below"), (a["total"] + x["_sum"] + x[_N] * a["below"].cast("double")).alias("total"))
    g = each.select(*by, F.col(_P).alias("n_pos"), F.col(_N).alias("n_neg"), F.col(_D).alias("n_dropped"), _TP, _FP, F.aggregate("_each", start, step)["total"].alias("_sum"))

    pos, neg = F.col("n_pos"), F.col("n_neg")
    both = (pos > 0) & (neg > 0)
    auc = F.when(both, F.lit(1.0) - F.col("_sum") / (pos.cast("double") * neg.cast("double")))
    cols = [*by, (pos + neg).alias("n_rows"), "n_pos", "n_neg", "n_dropped", auc.alias("auc")]
    if prediction is not None:
        tpr = F.col("_tp") / pos
        tnr = (neg - F.col("_fp")) / neg
        cols.append(F.when(both, (tpr + tnr) / 2.0).alias("balanced_accuracy"))
    return g.select(*cols)


def auc(
    scored: DataFrame, label: str = "label", score: str | Column = "score", by: Sequence[str] = (), bins: int | None = None
) -> DataFrame:
    """DataFrame[*by, n_rows, n_pos, n_neg, n_dropped, auc]: exact AUC of ``score`` per group."""
    return binary_metrics(scored, label, score, None, by, bins)


def balanced_accuracy(
    scored: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """DataFrame[*by, n_rows, n_pos, n_neg, n_dropped, tp, tn, balanced_accuracy], one count pass.

    This is what an AUC on hard 0/1 predictions measures (the reference's train / test AUC).
    """
    y, p = col(label).cast("double"), col(prediction).cast("double")
    ok = _valid(y, p)
    g = scored.groupBy(*by).agg(
        F.count_if(ok & (y == 1.0)).alias("n_pos"),
        F.count_if(ok & (y == 0.0)).alias("n_neg"),
        F.count_if(~ok).alias("n_dropped"),
        F.count_if(ok & (y == 1.0) & (p == 1.0)).alias("tp"),
        F.count_if(ok & (y == 0.0) & (p == 0.0)).alias("tn"),
    )
    pos, neg = F.col("n_pos"), F.col("n_neg")
    ba = F.when((pos > 0) & (neg > 0), (F.col("tp") / pos + F.col("tn") / neg) / 2.0)
    return g.select(*by, (pos + neg).alias("n_rows"), "n_pos", "n_neg", "n_dropped", "tp", "tn", ba.alias("balanced_accuracy"))


def evaluator_auc(scored: DataFrame, label: str = "label", raw: str = "rawPrediction") -> float:
    """Spark ML's evaluator without binning (exact); one number to the driver."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    ev = BinaryClassificationEvaluator(rawPredictionCol=raw, labelCol=label, metricName="areaUnderROC", numBins=0)
    return ev.evaluate(scored)
