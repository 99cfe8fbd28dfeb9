"""Readers (A-1 … A-4, A-8).

Raw dumps are bz2 JSON lines; Spark splits bz2 input and parses it in the
scan. Malformed lines are kept in ``_corrupt_record`` (PERMISSIVE mode)
instead of failing the whole file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import PROBE_IP_MAP, RAW_DUMP_WITH_CORRUPT
from ..session import shared_path


def read_raw_dump(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A-1: JSON-lines dumps (any Hadoop codec, e.g. ``*.bz2``) with the raw
    schema; ``result`` stays JSON text. Bad lines land in
    ``_corrupt_record`` with all other fields NULL."""
    return (spark.read.schema(RAW_DUMP_WITH_CORRUPT)
                 .option("mode", "PERMISSIVE")
                 .option("columnNameOfCorruptRecord", "_corrupt_record")
                 .json(path))


def quarantine(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split a raw read into (good rows, corrupt rows)."""
    bad = F.col("_corrupt_record").isNotNull()
    # the corrupt side keeps every column: Spark refuses queries that read
    # only the corrupt-record column of a raw file
    return raw.where(~bad).drop("_corrupt_record"), raw.where(bad)


def read_ping(spark: SparkSession, path: str, cols: list[str] | None = None) -> DataFrame:
    """A-2: Parquet directory or glob, nested folders included, column-pruned."""
    df = spark.read.option("recursiveFileLookup", "true").parquet(path)
    return df.select(*cols) if cols else df


def read_probe_map(spark: SparkSession, path: str) -> DataFrame:
    """A-3: header CSV -> (ip, dst_prb_id); an old header ``prb_id`` is renamed."""
    df = spark.read.option("header", True).csv(path)
    if "prb_id" in df.columns and "dst_prb_id" not in df.columns:
        df = df.withColumnRenamed("prb_id", "dst_prb_id")
    return df.select(F.col("ip").cast("string"),
                     F.col("dst_prb_id").cast(PROBE_IP_MAP["dst_prb_id"].dataType))


def probe_map_from_records(records: DataFrame, id_col: str = "id",
                           addr_cols: tuple[str, ...] = ("address_v4", "address_v6")) -> DataFrame:
    """A-4: unpivot probe records into one (ip, dst_prb_id) row per non-null address."""
    arr = F.array(*[F.col(c).cast("string") for c in addr_cols])
    return (records.select(F.col(id_col).cast("bigint").alias("dst_prb_id"), F.explode(arr).alias("ip"))
                   .where(F.col("ip").isNotNull())
                   .select("ip", "dst_prb_id"))


def sample_head(df: DataFrame, n: int, cols: list[str] | None = None) -> DataFrame:
    """A-8 (head): first ``n`` rows of the selected columns."""
    return (df.select(*cols) if cols else df).limit(n)


def sample_sorted(df: DataFrame, fraction: float, seed: int = 42, order: str = "ts") -> DataFrame:
    """A-8 (sample): Bernoulli sample then time sort — sampling is the feature."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed).orderBy(order)


def write_raw_dump(ping: DataFrame, path: str) -> None:
    """Write ping rows in the raw dump layout (bz2 JSON lines, ``result`` as
    a nested JSON array, ``ts`` as ``timestamp``)."""
    nested = F.from_json("result", "array<struct<rtt:double,x:string>>")
    (ping.select("prb_id", "dst_addr", F.col("ts").alias("timestamp"), "sent", "rcvd", "avg",
                 nested.alias("result"))
         .write.mode("overwrite").option("compression", "bzip2").json(path))


def write_raw_lines(lines: DataFrame, path: str) -> None:
    """Write (dump, line) rows as bz2 text files, a folder and a file per dump."""
    (lines.select("dump", F.col("line").alias("value")).repartition("dump")
          .write.mode("overwrite").partitionBy("dump").option("compression", "bzip2").text(path))


def raw_dump_roundtrip(ping: DataFrame) -> DataFrame:
    """Write ``ping`` as a raw dump into the shared checkpoint folder and
    read it back with ``read_raw_dump``: good rows and, with their text in
    ``_corrupt_record``, bad ones (:func:`quarantine` tells them apart)."""
    spark = ping.sparkSession
    path = shared_path(spark, "raw-dump")
    write_raw_dump(ping, path)
    return read_raw_dump(spark, path)
