"""Model sink and source on any Hadoop file system (local, HDFS, S3, ...).

A saved model is a folder of versions. A save writes a new version and then, as the last thing, a
one-line commit record that names it; readers take the newest version that a record names. A
save that fails on the way leaves no record, so the model before it stays the one that is
loaded, and readers never see half a model. Nothing is deleted: a version that no reader needs
any more may be removed by hand.

The one-line metadata record of a version tells a Spark ML pipeline from a weight model.
Folders in the plain layout (the model itself, without versions) are read as well.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linclass.operators.linear import MODEL_CLASS, LinearModel

COMMITS = "number long, version string, saved_at string"


def timestamped_path(base: str, prefix: str = "model.lr", now: datetime | None = None) -> str:
    """``base/prefix.<MonDDYYYYHHMMSS>``, the time-stamped name of the logistic job."""
    # fixed value: the form of the stamp in saved model names
    stamp = (now or datetime.now()).strftime("%b%d%Y%H%M%S")
    return f"{base.rstrip('/')}/{prefix}.{stamp}"


def model_versions(spark: SparkSession, path: str) -> DataFrame:
    """Commit records of a model folder, empty if there are none."""
    try:
        return spark.read.schema(COMMITS).json(f"{path}/commits")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], COMMITS)


def _newest(spark: SparkSession, path: str):
    return model_versions(spark, path).where("version is not null").orderBy(F.desc("number"), F.desc("saved_at"), "version").first()


def save_model(model, path: str, spark: SparkSession | None = None) -> str:
    """Write ``model`` as the newest version under ``path``."""
    if not isinstance(model, (LinearModel, PipelineModel)):
        raise TypeError(f"cannot save {type(model).__name__}")
    spark = spark or SparkSession.getActiveSession()
    path = path.rstrip("/")
    before = _newest(spark, path)
    version = uuid.uuid4().hex
    if isinstance(model, LinearModel):
        model.save(spark, f"{path}/versions/{version}")
    else:
        model.write().save(f"{path}/versions/{version}")
    record = (1 if before is None else before["number"] + 1, version, datetime.now().isoformat())
    spark.createDataFrame([record], COMMITS).coalesce(1).write.mode("append").json(f"{path}/commits")
    return path


def load_model(spark: SparkSession, path: str, version: str | None = None):
    """The newest version of the model under ``path``, or the one named."""
    path = path.rstrip("/")
    if version is None:
        newest = _newest(spark, path)
        version = None if newest is None else newest["version"]
    at = path if version is None else f"{path}/versions/{version}"
    meta = json.loads(spark.read.text(f"{at}/metadata").first()["value"])
    if meta.get("class") == MODEL_CLASS:
        return LinearModel.from_json(json.dumps(meta))
    return PipelineModel.load(at)
