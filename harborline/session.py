"""Session settings, shared scratch space and durable lineage cuts."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def session(app: str = "harborline", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the fixed settings; ``extra`` uses ``__`` for dots in setting names."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in extra.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def _shared_root(spark: SparkSession) -> str:
    """The shared folder of the cluster; a local temporary folder only under a local master."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return tempfile.gettempdir()


def scratch(spark: SparkSession, label: str) -> str:
    """A path nobody else uses, below the shared root."""
    return f"{_shared_root(spark)}/harborline-{label}-{uuid.uuid4().hex[:12]}"


def durable(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the reliable checkpoint folder, so that a lost executor cannot change it."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch(spark, "checkpoint"))
    return df.checkpoint(eager=True)
