"""Session helpers: a local session for tests and bench, and the shared scratch root.

On a cluster the caller owns the session and names a shared folder in
``spark.checkpoint.dir``; everything this package writes between stages (models of the
round-trip check, checkpoints) goes under that folder. Only a local session with no such
setting gets a fresh folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "linclass") -> SparkSession:
    """Session for tests and bench: UI off, AQE on, small shuffle fan-out."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for intermediate writes: ``spark.checkpoint.dir`` of the session.

    When the setting is unset and the master is local (tests, bench), a fresh temporary
    folder is made and registered as the checkpoint dir. On a cluster an unset value is an
    error: a machine-local folder would not be seen by the executors.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if root:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(root)  # DataFrame.checkpoint() reads the context's setting
        return root.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, S3, ...) for this job")
    root = tempfile.mkdtemp(prefix="linclass-ckpt-")
    sc.setCheckpointDir(root)
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A new, unique path under the checkpoint root (nothing is deleted or reused)."""
    return f"{checkpoint_root(spark)}/linclass/{kind}/{uuid.uuid4().hex}"
