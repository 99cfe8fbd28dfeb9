"""Session defaults and small helpers every operator relies on.

Nothing here touches Spark internals: the helpers are plain DataFrame
calls a Spark user would write.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Session settings the library assumes (UTC timestamps, ANSI arithmetic,
# adaptive execution with skew-join splitting and partition coalescing).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "rttlab", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        b = b.config("spark.driver.memory", os.environ.get("RTTLAB_DRIVER_MEMORY", "12g"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Set the runtime SQL options the library needs on an existing session."""
    for k, v in DEFAULT_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the deployment (a shared file
    system). Only when it is unset (local runs, tests) do we create one.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="rttlab-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def persist_table(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage by writing ``df`` as Parquet to the shared folder and
    reading it back (survives executor loss, unlike cached blocks)."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
