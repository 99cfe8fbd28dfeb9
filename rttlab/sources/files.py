"""Hourly dump manifests and listings (A-5 … A-7), as DataFrames.

The time filter and skip logic of the bulk download run as Spark
expressions over a file listing; no network client is part of this.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Hourly dump naming, ``YYYY-MM-DD/ping-YYYY-MM-DDTHHMM.bz2``.
DAY_FMT = "yyyy-MM-dd"
STAMP_FMT = "yyyy-MM-dd'T'HHmm"
NAME_RE = r"ping-(\d{4}-\d{2}-\d{2}T\d{4})\.bz2$"


def hourly_manifest(spark: SparkSession, start: str, end: str) -> DataFrame:
    """A-5: every hour in [start, end] (inclusive) with its relative path."""
    t = F.explode(F.sequence(F.to_timestamp(F.lit(start)), F.to_timestamp(F.lit(end)),
                             F.expr("interval 1 hour"))).alias("t")
    return spark.range(1).select(t).select(
        "t", F.concat(F.date_format("t", DAY_FMT), F.lit("/ping-"),
                      F.date_format("t", STAMP_FMT), F.lit(".bz2")).alias("path"))


def listing(spark: SparkSession, root: str, glob: str = "*.bz2") -> DataFrame:
    """Paths of files under ``root`` (contents are never read)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
                 .option("recursiveFileLookup", "true").load(root).select("path"))


def file_time(path_col="path"):
    stamp = F.regexp_extract(F.col(path_col), NAME_RE, 1)
    return F.try_to_timestamp(F.when(stamp != "", stamp), F.lit(STAMP_FMT))


def filter_listing(files: DataFrame, start: str | None = None, end: str | None = None,
                   hour_from: int | None = None, hour_to: int | None = None) -> DataFrame:
    """A-6: keep files whose name time is within [start, end] and/or whose
    hour is within [hour_from, hour_to]; names that do not parse are
    skipped; sorted by time."""
    t = file_time("path")
    df = files.withColumn("t", t).where(F.col("t").isNotNull())
    if start:
        df = df.where(F.col("t") >= F.to_timestamp(F.lit(start)))
    if end:
        df = df.where(F.col("t") <= F.to_timestamp(F.lit(end)))
    if hour_from is not None:
        df = df.where(F.hour("t") >= hour_from)
    if hour_to is not None:
        df = df.where(F.hour("t") <= hour_to)
    return df.orderBy("t")


def base_name(path_col="path"):
    """File name without folders and without the extension chain."""
    return F.regexp_extract(F.col(path_col), r"([^/]+?)(\.[A-Za-z0-9]+)*$", 1)


def missing_files(manifest: DataFrame, *existing: DataFrame) -> DataFrame:
    """A-7: manifest entries with no file of the same base name in any of
    the ``existing`` listings (raw, parsed or optimized stage)."""
    m = manifest.withColumn("_b", base_name("path"))
    for e in existing:
        m = m.join(e.select(base_name("path").alias("_b")).distinct(), "_b", "left_anti")
    return m.drop("_b")
