"""A fitted linear model held as weights, scored by column expressions.

The gradient-descent trainer (``sgd``) returns this model. Its scoring is one projection
(w . x + b, the sigmoid for logistic loss, the threshold), so it runs in the JVM with no
Python on the row path. Optional train statistics standardise the inputs inside the same
expression. It saves to and loads from any Hadoop file system as one small JSON record.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linclass.functions.expressions import col, dot, sigmoid
from linclass.operators.scale import ScalerStats, scaled_expr

MODEL_CLASS = "linclass.LinearModel"


@dataclass
class LinearModel:
    features: list[str]
    weights: list[float]
    intercept: float = 0.0
    loss: str = "logistic"  # "logistic" or "hinge"
    threshold: float | None = None  # logistic: on probability (0.5); hinge: on margin (0.0)
    means: list[float] | None = None  # standardise inputs with these train statistics
    stds: list[float] | None = None
    params: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.loss not in ("logistic", "hinge"):
            raise ValueError(f"loss must be 'logistic' or 'hinge', got {self.loss!r}")
        if self.threshold is None:
            self.threshold = 0.5 if self.loss == "logistic" else 0.0

    # ---- scoring -------------------------------------------------------------------
    def inputs(self) -> list[Column]:
        if self.means is None:
            return [col(c).cast("double") for c in self.features]
        stats = ScalerStats(self.features, self.means, self.stds or [])
        return [scaled_expr(stats, i) for i in range(len(self.features))]

    def margin(self) -> Column:
        return dot(self.inputs(), self.weights, self.intercept)

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``margin``, ``probability`` (logistic only) and ``prediction`` (0.0 / 1.0)."""
        m = df.withColumn("margin", self.margin())
        if self.loss == "logistic":
            m = m.withColumn("probability", sigmoid(F.col("margin")))
            pred = F.col("probability") > F.lit(self.threshold)
        else:
            pred = F.col("margin") > F.lit(self.threshold)
        return m.withColumn("prediction", pred.cast("double"))

    # ---- persistence ---------------------------------------------------------------
    def to_json(self) -> str:
        return json.dumps({"class": MODEL_CLASS, **asdict(self)})

    @classmethod
    def from_json(cls, text: str) -> LinearModel:
        d = json.loads(text)
        d.pop("class", None)
        return cls(**d)

    def save(self, spark: SparkSession, path: str) -> None:
        """One JSON line under ``path/metadata`` (overwrites), on any Hadoop file system."""
        rec = spark.createDataFrame([(self.to_json(),)], "value string")
        rec.coalesce(1).write.mode("overwrite").text(f"{path}/metadata")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LinearModel:
        return cls.from_json(spark.read.text(f"{path}/metadata").first()["value"])
