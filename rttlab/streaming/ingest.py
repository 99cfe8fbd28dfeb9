"""Incremental ingestion and windowed stream aggregates (K-1, K-2).

K-1 turns "process each new hourly dump once, resumable" into a file
stream: the checkpoint records which files were consumed, so a rerun adds
nothing and a new file adds only its rows. Every micro-batch writes its good
rows, its rejected lines and its counts per file into folders named by the
batch, which a batch that is run again after a failure overwrites.

K-2 keeps tumbling panes of the same stream. A pane's counts and sums can be
merged, so a micro-batch writes the panes of its own rows and reading adds
them up: no state is held and no late row is lost; rows behind the watermark
are counted as late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.json import extract_rtts
from ..operators.filters import parse_measurements
from ..operators.series import merge_panes, panes, windows_of_panes
from ..schemas import RAW_DUMP

CORRUPT = "_corrupt_record"
WATERMARK_SECONDS = 3_600   # dumps arrive hourly
LOG_SCHEMA = "lines bigint, rejects bigint, rows bigint, late_rows bigint, max_ts bigint"


def raw_stream(spark: SparkSession, src_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Every line of the dumps under ``src_dir`` with its ``file``; one that does not parse has its text in
    ``_corrupt_record``."""
    schema = T.StructType([f for f in RAW_DUMP.fields if f.name != CORRUPT] + [T.StructField(CORRUPT, T.StringType())])
    r = (spark.readStream.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
         .option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(src_dir).withColumn("file", F.col("_metadata.file_path"))


def parsed(lines: DataFrame) -> DataFrame:
    """C-1 + E-1 of the lines that parse."""
    p = parse_measurements(lines.where(F.col(CORRUPT).isNull()))
    return p.select("prb_id", "dst_addr", "ts", "sent", "rcvd", "avg", *extract_rtts("result"))


def _run(lines: DataFrame, checkpoint: str, each):
    """Run the stream to the end of what is there. A batch's lines are parsed once and held while ``each`` writes."""
    def land(batch: DataFrame, number: int) -> None:
        held = batch.persist()
        try:
            each(held, number)
        finally:
            held.unpersist()

    q = (lines.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def _write(df: DataFrame, folder: str, number: int) -> None:
    df.write.mode("overwrite").parquet(f"{folder}/batch={number}")


def stream_ingest(spark: SparkSession, src_dir: str, out_dir: str, checkpoint: str,
                  max_files_per_trigger: int | None = None):
    """K-1: consume every file not seen before (``availableNow``); blocks until the backlog is written.

    One stream and one checkpoint: the parsed rows go to ``out_dir``, lines
    that do not parse, whole, with their file to ``<out_dir>-rejects``, and
    the counts per file to ``<out_dir>-ledger``, each in a folder per batch.
    """
    def each(lines: DataFrame, number: int) -> None:
        bad = F.col(CORRUPT).isNotNull()
        _write(parsed(lines), out_dir, number)
        _write(lines.where(bad).select("file", F.col(CORRUPT).alias("line")), out_dir + "-rejects", number)
        _write(lines.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), F.count_if(~bad).alias("ok_rows"),
                                         F.count_if(bad).alias("corrupt_rows")), out_dir + "-ledger", number)

    return _run(raw_stream(spark, src_dir, max_files_per_trigger), checkpoint, each)


def ingested(spark: SparkSession, out_dir: str) -> DataFrame:
    """The rows that :func:`stream_ingest` parsed."""
    return spark.read.parquet(out_dir).drop("batch")


def rejects(spark: SparkSession, out_dir: str) -> DataFrame:
    """file, line: what did not parse."""
    return spark.read.parquet(out_dir + "-rejects").drop("batch")


def ingest_ledger(spark: SparkSession, out_dir: str) -> DataFrame:
    """B-7: per consumed file its lines, parsed and failed ones, and whether it is ok. A file is consumed in one
    batch, so its row is not merged."""
    return spark.read.parquet(out_dir + "-ledger").drop("batch").withColumn("ok", F.col("corrupt_rows") == 0)


def stream_panes(spark: SparkSession, src_dir: str, out_dir: str, checkpoint: str, width: int, key: str = "prb_id",
                 delay: int = WATERMARK_SECONDS, max_files_per_trigger: int | None = None):
    """K-2: panes of ``width`` seconds of the raw dump stream in ``out_dir``, a folder per batch.

    ``<out_dir>-batches`` says of every batch how many lines it read, how many
    did not parse, the largest time among its rows, and how many rows came
    late: ``delay`` seconds or more behind the largest time of the batches
    before. Late rows are in the panes as all others.
    """
    log = out_dir + "-batches"

    def each(lines: DataFrame, number: int) -> None:
        rows = parsed(lines)
        before = None
        if number:
            seen = spark.read.parquet(*[f"{log}/batch={n}" for n in range(number)])
            before = seen.agg(F.max("max_ts")).head()[0]
        late = F.lit(False) if before is None else F.col("ts") <= before - delay
        _write(panes(rows, [key], width), out_dir, number)
        read = lines.agg(F.count(F.lit(1)), F.count_if(F.col(CORRUPT).isNotNull())).head()
        mine = rows.agg(F.count(F.lit(1)), F.count_if(late), F.max("ts")).head()
        _write(spark.createDataFrame([(*read, *mine)], LOG_SCHEMA), log, number)

    return _run(raw_stream(spark, src_dir, max_files_per_trigger), checkpoint, each)


def stream_windows(spark: SparkSession, out_dir: str, size: int, slide: int, key: str = "prb_id") -> DataFrame:
    """K-2: sliding windows of ``size`` seconds every ``slide`` seconds from the panes of :func:`stream_panes`, whose
    width must divide ``slide``."""
    parts = spark.read.parquet(out_dir).drop("batch")
    return windows_of_panes(merge_panes(parts, [key], slide), [key], size, slide)


def stream_log(spark: SparkSession, out_dir: str) -> DataFrame:
    """batch, lines, rejects, rows, late_rows, max_ts of every batch of :func:`stream_panes`."""
    return spark.read.parquet(out_dir + "-batches")
