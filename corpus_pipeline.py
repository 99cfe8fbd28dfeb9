"""Corpus pipeline over ``documents``: quality rules, exact and near deduplication, substring removal, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet to the shared folder and reads it again for the next.
All but the last return the columns of ``documents`` as they came in: columns
besides doc_id and text go through in a struct, so their names cannot clash
with any that a stage makes up. A null text is an empty one. A null doc_id is
a value of its own, the smallest; rows that repeat each other as a whole are
copies of each other. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rttlab.llm import exact, fmindex, packing, quality, simhash
from rttlab.llm import spans as S
from rttlab.session import persist_table

USED = {"doc_id": "doc_id", "text": "text"}


def _restored(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*S.unhide(rows, docs.columns, **USED))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; null and empty texts are not kept. Copies are judged alike."""
    return _restored(quality.quality_rules(S.hide(docs, **USED)).filter("kept"), docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the smallest id (a null id before all others); null and
    empty texts are equal."""
    return exact.exact_dedup(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id (a null id before all others); texts
    without words are near duplicates."""
    return simhash.near_dedup(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of 35 words or more that occur at several places. A text that loses nothing
    stays as it is, a null one null. A column n_chars of numbers is brought up to date."""
    out = fmindex.remove_substrings(docs)
    if "n_chars" in docs.columns and docs.schema["n_chars"].dataType.simpleString() in ("int", "bigint"):
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                             .otherwise(F.char_length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all documents' pieces in sequences of at most 2048 tokens. A null or empty text is one piece of the
    end token; repeated rows are packed each for itself."""
    return packing.pack_documents(docs)


STAGES = [("quality rules", quality_stage), ("exact dedup", exact_stage), ("simhash near-dedup", simhash_stage),
          ("substring dedup", substring_stage), ("best-fit packing", packing_stage)]

#: SQL has no fingerprints by XXH64 and no packing; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = persist_table(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
