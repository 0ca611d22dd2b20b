"""Session construction and shared-storage locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # latest-N keeps its per-task limit up to this many rows per series
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000000",
}


def get_spark(master: str = "local[8]", shuffle_partitions: int = 8,
              app: str = "tidemark", extra: dict | None = None) -> SparkSession:
    """A session for local runs and tests (cluster jobs bring their own)."""
    b = SparkSession.builder.master(master).appName(app)
    conf = {**DEFAULT_CONF, "spark.sql.shuffle.partitions": str(shuffle_partitions),
            "spark.driver.memory": os.environ.get("TIDEMARK_DRIVER_MEMORY", "16g")}
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must point at shared storage and is used as is.
    Only a local master may leave it unset: a folder is then created and
    registered.  Elsewhere executors could not see a local folder, so it raises.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to storage that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint folder for one job's files."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/tidemark/{name}-{uuid.uuid4().hex[:12]}"
