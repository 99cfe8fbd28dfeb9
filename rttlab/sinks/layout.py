"""Sinks and file layout jobs (B-1 … B-7).

Each job is one Spark job over the whole input (compact: one for each 500 files
that it writes). Only names, sizes and row counts of files come to the driver,
as names and sizes do when Spark lists a table.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.observation import Observation

from ..session import shared_path

SOURCE_FILE = "source_file"  # partition column that remembers the input file
SORT_ROWS, SORT_BYTES = 250_000, 16 << 20  # what one task of compact sorts: rows, and bytes of their files
JOB_RUNS = JOB_SCANS = 500  # of one job of compact


def write_ping(df: DataFrame, path: str, partition_by: list[str] | None = None,
               mode: str = "overwrite", max_records_per_file: int | None = None) -> None:
    """B-1: Parquet, snappy, explicit schema of ``df``; optional partition
    columns (e.g. a day column so day filters prune files)."""
    w = df.write.mode(mode).option("compression", "snappy")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


# ---------------------------------------------------------------- file ledger
def file_ledger(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """path, file (its name) and bytes of every file under ``path``. The
    binary-file source lists them; contents are never read. A folder without
    such files gives an empty table."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true").load(path)
            .select("path", F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes")))


def compact(spark: SparkSession, src: str, dst: str, target_files: int | None = None,
            target_bytes: int = 512 << 20, order: str | None = None) -> int:
    """B-2: rewrite many small Parquet parts as few files, without a shuffle unless a file takes a large sort.

    Files in name order (hourly names: time order) are put together until they
    hold ``target_bytes`` (or the ``target_files``-th part of all bytes); each
    such run of files is read by one task, which writes one file. With
    ``order`` the rows of each file are sorted by that column (:func:`_sorted`).
    Raises if the source holds no files. Returns the number of files written.
    """
    files = sorted((r.path, r.bytes) for r in file_ledger(spark, src).collect())
    if not files:
        raise FileNotFoundError(f"no parquet files under {src}")
    if target_files:
        target_bytes = -(-sum(size for _, size in files) // target_files)
    groups: list[tuple[list[str], int]] = []  # paths, bytes
    so_far = 0  # bytes of the files before
    for path, size in files:
        # a file belongs to the output in which its middle byte lies
        group = (so_far + size // 2) // max(1, target_bytes)
        if not groups or group != last:
            groups.append(([], 0))
        paths, held = groups[-1]
        paths.append(path)
        groups[-1] = (paths, held + size)
        last, so_far = group, so_far + size
    schema = spark.read.option("recursiveFileLookup", "true").parquet(src).schema
    mode = "overwrite"
    with _unions_keep_partitions(spark):
        for at in range(0, len(groups), JOB_RUNS):
            runs = [(spark.read.schema(schema).parquet(*paths), size) for paths, size in groups[at:at + JOB_RUNS]]
            parts = _sorted(runs, order) if order else [(run.coalesce(1), 1) for run, _ in runs]
            while parts:
                n, scans = 1, parts[0][1]
                while n < len(parts) and scans + parts[n][1] <= JOB_SCANS:
                    n, scans = n + 1, scans + parts[n][1]
                out = reduce(DataFrame.union, [part for part, _ in parts[:n]])
                out.write.mode(mode).option("compression", "snappy").parquet(dst)
                mode, parts = "append", parts[n:]
    return len(groups)


def _sorted(runs: list[tuple[DataFrame, int]], order: str) -> list[tuple[DataFrame, int]]:
    """Each run (a Parquet read and its bytes) as one partition sorted by ``order``, and the number of its reads.

    A run of at most SORT_ROWS rows and SORT_BYTES bytes is sorted by the task that reads it. The rows of the others are
    sorted in pieces of about that size, ranges of (run, ``order``, place of the row), and written to the shared
    folder; the run's task reads its pieces one after the other, so that its memory does not grow with the run.
    """
    spark = runs[0][0].sparkSession
    ids = reduce(DataFrame.union, [run.select(F.lit(i).alias("run")) for i, (run, _) in enumerate(runs)])
    rows = {r.run: r["count"] for r in ids.groupBy("run").count().collect()}  # from the files' footers
    pieces = {i: max(-(-rows.get(i, 0) // SORT_ROWS), -(-size // SORT_BYTES)) for i, (_, size) in enumerate(runs)}
    large = {i: n for i, n in pieces.items() if n > 1 and rows.get(i)}
    found: dict[int, list[str]] = {i: [] for i in large}
    if large:
        def keyed(i: int) -> DataFrame:
            run = runs[i][0]
            meta = run.metadataColumn("_metadata")
            place = F.xxhash64(meta.getField("file_path"), meta.getField("row_index"))  # rows of one value are dealt out, too
            return run.select(F.struct(*[F.col(f"`{c}`") for c in run.columns]).alias("row"), F.lit(i).alias("run"),
                              F.col(order).alias("key"), place.alias("place"))

        keys, folder = ["run", "key", "place"], shared_path(spark, "compact-pieces")
        # a piece is one row group, so no other task's split holds a part of it
        (reduce(DataFrame.union, [keyed(i) for i in large]).repartitionByRange(sum(large.values()), *keys)
         .sortWithinPartitions(*keys).select("row", "run").write.partitionBy("run")
         .option("parquet.block.size", str(512 << 20)).parquet(folder))
        for r in sorted(file_ledger(spark, folder).collect(), key=lambda r: (len(r.file), r.file)):  # names ascend as the ranges
            found[int(r.path.split("/run=")[-1].split("/")[0])].append(r.path)
    out = []
    for i, (run, _) in enumerate(runs):
        if i in large:
            reads = [spark.read.schema(T.StructType([T.StructField("row", run.schema)])).parquet(p).select("row.*") for p in found[i]]
            out.append((reduce(DataFrame.union, reads).coalesce(1), len(reads)))
        else:
            out.append((run.coalesce(1).sortWithinPartitions(order), 1))
    return out


@contextmanager
def _unions_keep_partitions(spark: SparkSession):
    """Since Spark 4.1 a union of inputs of one partition each has one partition, too, unless this is set."""
    key = "spark.sql.unionOutputPartitioning"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def batch_transform_write(spark: SparkSession, src: str, dst: str, fn, rows_per_file: int | None = None,
                          keep_source: bool = False) -> None:
    """B-3: read all inputs, apply ``fn`` (DataFrame -> DataFrame) and write
    in one job; ``rows_per_file`` bounds output files. Any task error
    fails the job and the committer leaves no partial output.

    With ``keep_source`` every row carries the name of its input file through
    ``fn`` (which must keep the column ``source_file``), and the output has one
    folder per input file: the lineage that :func:`size_report` reads.
    """
    df = spark.read.option("recursiveFileLookup", "true").parquet(src)
    if keep_source:
        df = df.select("*", F.col("_metadata.file_name").alias(SOURCE_FILE))
    w = fn(df).write.mode("overwrite")
    if rows_per_file:
        w = w.option("maxRecordsPerFile", rows_per_file)
    if keep_source:
        w = w.partitionBy(SOURCE_FILE)
    w.parquet(dst)


def verify_readback(spark: SparkSession, path: str) -> int:
    """B-4: re-read the output and count rows (answered from footers)."""
    return spark.read.parquet(path).count()


# ---------------------------------------------------------------- checked publishing
def write_checked(df: DataFrame, table: str, expected_rows: int | None = None) -> int:
    """B-5: publish ``df`` as the next version of ``table``, or leave the table as it is.

    The rows go to a folder of their own (``<table>/data/<id>``) and are
    counted on the way and again from the written files. Only when both counts
    equal ``expected_rows`` is the folder named in ``<table>/versions`` — an
    append of one row, which either happens or does not. A rejected write
    raises ValueError, a job that dies leaves an unnamed folder; readers
    (:func:`read_published`) see the version before in both cases. One writer
    at a time. Returns the number of rows.
    """
    spark = df.sparkSession
    folder = f"data/{uuid.uuid4().hex}"
    obs = Observation("rows_written")
    df.observe(obs, F.count(F.lit(1)).alias("n")).write.parquet(f"{table}/{folder}")
    counted, written = obs.get["n"], verify_readback(spark, f"{table}/{folder}")
    wanted = counted if expected_rows is None else expected_rows
    if not counted == written == wanted:
        raise ValueError(f"row count changed: {wanted} wanted, {counted} computed, {written} written")
    last = _versions(spark, table)
    number = (last.agg(F.max("version")).head()[0] or 0) + 1 if last is not None else 1
    (spark.createDataFrame([(number, folder, written)], "version bigint, folder string, rows bigint")
     .coalesce(1).write.mode("append").json(f"{table}/versions"))
    return written


def _versions(spark: SparkSession, table: str) -> DataFrame | None:
    """The table's published versions; None before the first."""
    if spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json") \
            .load(table).select("path").isEmpty():
        return None
    return spark.read.schema("version bigint, folder string, rows bigint").json(f"{table}/versions")


def read_published(spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
    """The rows of the latest (or the given) version of a table written by :func:`write_checked`."""
    versions = _versions(spark, table)
    if versions is not None:
        wanted = versions if version is None else versions.where(F.col("version") == version)
        found = wanted.orderBy(F.desc("version")).limit(1).collect()
        if found:
            return spark.read.parquet(f"{table}/{found[0].folder}")
    raise FileNotFoundError(f"no published version{'' if version is None else f' {version}'} of {table}")


def assert_row_count_preserved(before: DataFrame, after: DataFrame) -> int:
    """B-5: the optimized table must keep every input row."""
    a, b = before.count(), after.count()
    if a != b:
        raise ValueError(f"row count changed: {a} in, {b} out")
    return b


# ---------------------------------------------------------------- reports
def size_report(spark: SparkSession, in_path: str, out_path: str) -> DataFrame:
    """B-6: one row per input file — its bytes, the output files its rows went
    to and their bytes, and the reduction in % — and a totals row (file = '*').

    Output files belong to the input file named in their folder
    (``source_file=…``, written by :func:`batch_transform_write` with
    ``keep_source``); other output files count in the totals only, on a row
    without a file name. An input file without output has 0 output files."""
    a = file_ledger(spark, in_path).groupBy("file").agg(F.sum("bytes").alias("in_bytes"))
    source = F.url_decode(F.nullif(F.regexp_extract("path", f"{SOURCE_FILE}=([^/]+)/", 1), F.lit("")))
    b = (file_ledger(spark, out_path).select(source.alias("of"), "bytes")
         .groupBy("of").agg(F.count(F.lit(1)).alias("out_files"), F.sum("bytes").alias("out_bytes")))
    per = a.join(b, a.file == b.of, "full").select(
        F.coalesce("file", "of").alias("file"), "in_bytes", F.coalesce("out_files", F.lit(0)).alias("out_files"), "out_bytes")
    total = per.agg(F.lit("*").alias("file"), F.sum("in_bytes").alias("in_bytes"),
                    F.sum("out_files").alias("out_files"), F.sum("out_bytes").alias("out_bytes"))
    share = F.try_divide(F.col("out_bytes"), F.col("in_bytes"))
    return per.unionByName(total).withColumn("reduction_pct", F.round((1 - share) * 100.0, 2))


def ingest_report(raw: DataFrame) -> DataFrame:
    """B-7: per source file of a raw read (with ``_corrupt_record``): lines, lines that parsed, lines that failed, rows
    with a probe, and whether the file is ok (it has lines and none failed)."""
    bad = F.col("_corrupt_record").isNotNull()
    return raw.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(~bad).alias("ok_rows"), F.count_if(bad).alias("corrupt_rows"),
        F.count("prb_id").alias("rows_with_probe"), (F.count_if(bad) == 0).alias("ok"))


def ingest_summary(report: DataFrame) -> DataFrame:
    """B-7: one row over a report with ``rows``, ``ok_rows``, ``corrupt_rows`` and ``ok`` per file: files, ok and failed
    ones, lines, good and bad ones."""
    return report.agg(F.count(F.lit(1)).alias("files"), F.count_if("ok").alias("ok_files"), F.count_if(~F.col("ok")).alias("failed_files"),
                      F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.coalesce(F.sum("ok_rows"), F.lit(0)).alias("ok_rows"),
                      F.coalesce(F.sum("corrupt_rows"), F.lit(0)).alias("corrupt_rows"))
