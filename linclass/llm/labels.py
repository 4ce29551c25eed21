"""Training rows shared by the two classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linclass.llm.text import id_text

#: A classifier is fitted on at most so many labelled rows (those whose id hashes lowest).
SAMPLE_ROWS = 12_000
FOLDS = 5

#: Punctuation that is cut from both ends of a word.
IS_MARK = np.zeros(256, bool)
IS_MARK[[i for i in range(33, 127) if not chr(i).isalnum()]] = True


def held_out(doc_id) -> F.Column:
    """True for the fifth of the ids that no label is learned from; null ids are held out too."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, limit: int = SAMPLE_ROWS) -> DataFrame:
    """``text`` and ``label`` (0 or 1) of the bounded sample. Rows without a label, with another
    value or with labels that contradict each other are no training rows. The sample is at
    most ``limit`` ids, so it is broadcast and the texts stay where they are read."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).where("label in (0, 1) and doc_id is not null")
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most").drop("most")
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    return id_text(docs).join(F.broadcast(sample), "doc_id").select("text", "label")


def trimmed(raw: np.ndarray, start: np.ndarray, end: np.ndarray, rounds: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Word spans without the punctuation at their ends (at most ``rounds`` marks a side)."""
    start, end = start.copy(), end.copy()
    for _ in range(rounds):
        start += (end > start) & IS_MARK[raw[np.minimum(start, len(raw) - 1)]]
        end -= (end > start) & IS_MARK[raw[np.maximum(end - 1, 0)]]
    return start, end


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))
