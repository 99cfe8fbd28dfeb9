"""Exact deduplication as a stateful stream.

Normalised texts are digested; the digests flow through a streaming
aggregation whose state lives in an on-disk key-value store (RocksDB) and
never expires: per digest the smallest identifier, the number of rows and a
locator of the content of the row that stays. Rows that hit a digest of another
row are then compared with that row's full bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rttlab.session import persist_table, shared_path

from . import spans as S

WHITE_SPACE = r"[\x20\x09-\x0D]+"
# The state lives in RocksDB on disk; a task closes its store when it has committed, so that the
# stores open at once (several MB each) are as many as running tasks, not as partitions.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


def normalised(text):
    """Each run of ASCII white space as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE, " ")


def sha256_digest(norm):
    return F.sha2(norm, 256)


def _registry(spark: SparkSession, landing: str, schema) -> DataFrame:
    """Run the stream over the rows in ``landing`` to its end; the state's rows.

    Each micro-batch writes the keys it changed into a folder of its own
    (``batch=<id>``, overwritten if the batch is run again after a failure);
    a key's row of the latest batch is its state.
    """
    out, progress = shared_path(spark, "dedup-registry"), shared_path(spark, "dedup-progress")
    before = {name: spark.conf.get(name) for name in STATE_SETTINGS}
    for name, value in STATE_SETTINGS.items():
        spark.conf.set(name, value)
    try:
        state = (spark.readStream.schema(schema).parquet(landing).groupBy("digest")
                 .agg(F.min(F.struct("id", "locator")).alias("first"), F.count(F.lit(1)).alias("rows")))

        def keep(changed: DataFrame, batch: int) -> None:
            changed.write.mode("overwrite").parquet(f"{out}/batch={batch}")

        query = (state.writeStream.outputMode("update").foreachBatch(keep)
                 .option("checkpointLocation", progress).trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    changes = spark.read.schema(f"digest string, first struct<id:{schema['id'].dataType.simpleString()},locator:bigint>"
                                ", rows bigint, batch int").parquet(out)
    return (changes.groupBy("digest").agg(F.max_by(F.struct("first", "rows"), "batch").alias("s"))
            .select("digest", F.col("s.first.id").alias("keep_id"), F.col("s.first.locator").alias("keep_locator"),
                    F.col("s.rows").alias("group_size")))


def dedup_classes(docs: DataFrame, id_col: str = "doc_id", text: str = "text", digest=sha256_digest) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``row_hash``, ``locator``, ``digest``, ``keep_id``, ``keep_locator``,
    ``group_size`` and ``kept``.

    Texts are equal when identical after white-space normalisation; null
    counts as empty. Of equal texts the row with the smallest id stays (a null
    id comes first); of several rows with that id exactly one. ``group_size``
    counts rows, ``locator`` numbers them in the landing table, ``row_hash``
    hashes all columns of the input. Texts that share a digest but not their
    bytes are told apart. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    norm = normalised(F.col(text))
    landing = shared_path(spark, "dedup-landing")
    (docs.select(F.col(id_col).alias("id"), F.xxhash64(*[F.col(c) for c in docs.columns]).alias("row_hash"),
                 F.monotonically_increasing_id().alias("locator"), digest(norm).alias("digest"))
     .write.parquet(landing))
    rows = spark.read.parquet(landing)
    # written, so that both sides of the join are plain exchanges and Spark can split a digest with many rows
    registry = persist_table(_registry(spark, landing, rows.schema), "dedup-state")
    out = rows.join(registry, "digest")

    # Full bytes of the hits against the content that the state points at.
    repeated = registry.filter("group_size > 1").select(F.col("digest").alias("_digest"))
    copies = shared_path(spark, "dedup-copies")
    (docs.select(F.col(id_col).alias("id"), F.xxhash64(*[F.col(c) for c in docs.columns]).alias("row_hash"),
                 norm.alias("norm"), digest(norm).alias("digest"))
     .join(repeated, F.col("digest") == F.col("_digest"), "left_semi").write.parquet(copies))
    copies = spark.read.parquet(copies)
    firsts = (out.filter("locator = keep_locator and group_size > 1")
              .select(F.col("digest").alias("_digest"), F.col("row_hash").alias("_first")))
    # by digest and row, so that the rows of a digest with many copies are spread
    content = (copies.join(firsts, (F.col("digest") == F.col("_digest")) & (F.col("row_hash") == F.col("_first")))
               .groupBy("digest", "row_hash").agg(F.min("norm").alias("kept_norm")).select("digest", "kept_norm"))
    content = persist_table(content, "dedup-content")
    # written before it is made distinct: nothing behind the join then hinders Spark from splitting a hot digest
    differ = persist_table(copies.join(content, "digest").filter("norm <> kept_norm").select(F.col("digest").alias("_digest")),
                           "dedup-differences").distinct()
    differ = persist_table(differ, "dedup-collisions")
    if not differ.isEmpty():
        # A digest of several texts: its rows are grouped by the bytes themselves.
        apart = copies.join(differ, F.col("digest") == F.col("_digest"), "left_semi").dropDuplicates(["id", "row_hash"])
        apart = rows.join(apart.select(F.col("id").alias("_id"), F.col("row_hash").alias("_row"), "norm"),
                          F.col("id").eqNullSafe(F.col("_id")) & (F.col("row_hash") == F.col("_row"))).drop("_id", "_row")
        groups = (apart.groupBy("norm").agg(F.min(F.struct("id", "locator")).alias("f"), F.count(F.lit(1)).alias("group_size"))
                  .select("norm", F.col("f.id").alias("keep_id"), F.col("f.locator").alias("keep_locator"), "group_size"))
        out = (out.join(differ, F.col("digest") == F.col("_digest"), "left_anti")
               .unionByName(apart.join(groups, "norm").drop("norm")))
    return out.withColumn("kept", F.col("locator") == F.col("keep_locator"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text", digest=sha256_digest) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns (of any name); see :func:`dedup_classes`. Of whole rows
    that repeat, one stays; an empty table stays empty."""
    used = {"id": id_col, "text": text}
    packed = S.hide(docs, **used)
    stay = dedup_classes(packed, "id", "text", digest).filter("kept").select(F.col("id").alias("kept_id"), F.col("row_hash").alias("kept_row"))
    rows = packed.withColumn("row_hash", F.xxhash64(*[F.col(c) for c in packed.columns]))
    rows = rows.join(stay, (F.col("row_hash") == F.col("kept_row")) & F.col("id").eqNullSafe(F.col("kept_id")), "left_semi")
    return rows.dropDuplicates(["row_hash", "id"]).select(*S.unhide(rows, docs.columns, **used))


def op9_exact_dedup(spark, sf: str) -> DataFrame:
    """Groups of equal texts over all rows and whole texts of ``documents``."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    return dedup_classes(docs).select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
                                      F.col("digest").alias("text_sha256"))


ORACLE = {"op9_exact_dedup": r"""
with n as (select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as h from documents),
     g as (select h, min(doc_id) as keep_id, count(*) as group_size from n group by h)
select n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id as kept, n.h as text_sha256 from n join g using (h)
"""}
