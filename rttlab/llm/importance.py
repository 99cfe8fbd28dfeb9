"""Importance resampling towards a target distribution of hashed n-grams.

Batch concatenation: a block's texts are joined with separator sentinels, one
regex pass finds all words, ``searchsorted`` over the documents' offsets says
whose they are, and runs of words that cross a document are masked before
``bincount``. One pass counts the buckets of the corpus and of the target; a
second adds up each document's gains.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import islice
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import spans as S
from .crc_sql import crc_ctes
from .order import positions

BUCKETS = 10_000
RUN_LENGTHS = 2
MIN_WORDS = 20
PERCENT = 25
SEED = 7
SCALE = 1000
SENTINEL = b"\x00"  # not a character of words
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")  # lower-cased UTF-8 bytes of [^\x00-\x2F\x3A-\x60\x7B-\x7F]
CHUNK_WORDS = 1 << 16  # words taken from the regex pass at a time


def features(texts: list[bytes], run_lengths: int = RUN_LENGTHS, buckets: int = BUCKETS):
    """(run length, buckets, documents) arrays of all runs of 1 to ``run_lengths`` words of ``texts``, chunk by chunk."""
    ends = np.cumsum([len(t) + 1 for t in texts])
    found = WORD.finditer(SENTINEL.join(texts).lower())
    words: list[bytes] = []
    docs = np.zeros(0, np.int64)
    while chunk := list(islice(found, CHUNK_WORDS)):
        carried = min(len(words), run_lengths - 1)  # runs may begin in the chunk before
        words = words[len(words) - carried:] + [m[0] for m in chunk]
        starts = np.fromiter((m.start() for m in chunk), np.int64, len(chunk))
        docs = np.concatenate([docs[len(docs) - carried:], np.searchsorted(ends, starts, "right")])
        spaced = [b" " + w for w in words]
        sums = list(map(crc32, words))
        for run in range(1, run_lengths + 1):
            if run > 1:
                sums = list(map(crc32, spaced[run - 1:], sums))  # each run goes on by one word
            new = max(0, carried - run + 1)
            values, first, last = np.array(sums[new:], np.int64), docs[new:len(docs) - run + 1], docs[new + run - 1:]
            inside = first == last
            yield run, values[inside] % buckets, first[inside]


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, list[bytes]]]:
    data, offs = S.text_buffer(batch.column(column))
    for i, j in S.blocks(offs):
        yield i, j, [data[a:b].tobytes() for a, b in zip(offs[i:j], offs[i + 1:j + 1], strict=True)]


def bucket_counts(texts: DataFrame, text: str = "text", run_lengths: int = RUN_LENGTHS,
                  buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all texts in each bucket that has any. A null or empty text has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for _, _, block in _texts(b, 0):
                for _, values, _ in features(block, run_lengths, buckets):
                    total += np.bincount(values, minlength=buckets)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64)), pa.array(total[found])], names=["bucket", "n"])

    return (S.map_batches(texts.select(text), run, "bucket bigint, n bigint")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Each bucket's gain from two tables of :func:`bucket_counts`: the floored, scaled logarithm of how much more
    frequent its features are in the target, with one added to every count. At most ``buckets`` rows come to the driver."""
    both = [dict(counts.collect()) for counts in (corpus, target)]
    s_all, t_all = (sum(c.values()) for c in both)
    out = np.zeros(buckets, np.int64)
    for b in range(buckets):
        s, t = both[0].get(b, 0), both[1].get(b, 0)
        out[b] = math.floor(SCALE * math.log(float(t + 1) * float(s_all + buckets) / (float(s + 1) * float(t_all + buckets))))
    return out


def gumbel(id_col: str, seed: int) -> Column:
    """The seeded noise of a document, from the first 32 bits of a digest of its id (null: empty)."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-float(SCALE)) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def importance_scores(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text: str = "text",
                      seed: int = SEED, run_lengths: int = RUN_LENGTHS, buckets: int = BUCKETS,
                      carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: id, ``n_words``, ``n_features``, ``weight``, ``score``.

    ``weight`` is the floored mean gain of the document's features (0 without
    any), ``score`` adds seeded noise, so that the highest scores are a sample
    without replacement in proportion to exp(weight). Null texts are empty;
    texts are whole, long ones are read in chunks of words. A null id is a
    value like any other. An empty target, or an empty table, has zero counts.
    Other columns are not read; ``carry`` adds columns of ``docs`` by name.
    """
    add = gains(bucket_counts(docs, text, run_lengths, buckets), bucket_counts(target, text, run_lengths, buckets), buckets)
    carry = carry or {}
    rows = docs.select(F.col(text).alias("t"), F.col(id_col).alias("id"), *[c.alias(n) for n, c in carry.items()])
    schema = T.StructType(rows.schema.fields[1:] + [T.StructField(n, T.LongType()) for n in ("n_words", "n_features", "weight")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, found, total = (np.zeros(b.num_rows, np.int64) for _ in range(3))
            for i, j, block in _texts(b, 0):
                for length, values, doc in features(block, run_lengths, buckets):
                    n = np.bincount(doc, minlength=j - i)
                    found[i:j] += n
                    total[i:j] += np.bincount(doc, add[values], j - i).astype(np.int64)
                    if length == 1:
                        words[i:j] += n
            weight = np.where(found > 0, total // np.maximum(found, 1), 0)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(words), pa.array(found), pa.array(weight)],
                                             names=schema.names)

    scored = S.map_batches(rows, run, schema)
    return scored.withColumnRenamed("id", id_col).withColumn("score", F.col("weight") + gumbel(id_col, seed))


def draw(scores: DataFrame, id_col: str = "doc_id", percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """``scores`` with ``rank``: 1, 2, 3… by descending score (ties to the smaller id, a null id last) among the
    floor(percent * N / 100) highest of the N documents with at least ``min_words`` words; null for all others.
    Repeated rows are drawn each for itself."""
    marked = scores.withColumn("eligible", F.col("n_words") >= min_words)
    placed = positions(marked, ["eligible"], [F.col("score").desc(), F.col(id_col).asc_nulls_last()], "place", "n")
    drawn = F.col("eligible") & (F.col("place") < F.floor(F.col("n") * percent / 100))
    return placed.withColumn("rank", F.when(drawn, F.col("place") + 1)).drop("eligible", "place", "n")


def importance_resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text: str = "text",
                        percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns. Of equal rows all are returned if one is drawn."""
    row_hash = F.xxhash64(*[F.col(c) for c in docs.columns])
    ranked = draw(importance_scores(docs, target, id_col, text, seed, carry={"row_hash": row_hash}), id_col, percent, min_words)
    drawn = ranked.filter("rank is not null").select(F.col(id_col).alias("i"), F.col("row_hash").alias("h")).distinct()
    whole = docs.select(F.struct(*docs.columns).alias("row"), row_hash.alias("row_hash"))
    same = F.col("row")[id_col].eqNullSafe(F.col("i")) & (F.col("row_hash") == F.col("h"))
    return whole.join(drawn, same, "left_semi").select("row.*")


def op11_importance_resampling(spark, sf: str) -> DataFrame:
    """Every document of ``documents`` scored against the texts of ``benchmark``, the drawn ones ranked."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    target = spark.read.parquet(f"{sf}/benchmark.parquet")
    return draw(importance_scores(docs, target)).select("doc_id", "n_features", "weight", "score", "rank")


ORACLE = {"op11_importance_resampling": rf"""
with recursive texts as (
  select 'd' as side, doc_id as id, text from documents union all select 'b', null, text from benchmark),
words as (
  select side, id, row_number() over () as r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from texts),
feats as (
  select side, id, r, unnest(w) as s from words
  union all
  select side, id, r, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) from words where len(w) > 1),
{crc_ctes("feats")},
hashed as (select f.side, f.id, f.r, c.crc % {BUCKETS} as b from feats f join crc c using (s)),
counts as (select b, count(*) filter (side = 'd') as s, count(*) filter (side = 'b') as t from hashed group by b),
sums as (select coalesce(sum(s), 0) as ss, coalesce(sum(t), 0) as tt from counts),
gain as (select b, floor({SCALE} * ln(((t + 1)::double * (ss + {BUCKETS})::double) / ((s + 1)::double * (tt + {BUCKETS})::double)))::bigint as g
         from counts, sums),
weights as (select h.r, count(*) as n, floor(sum(g)::double / count(*))::bigint as weight from hashed h join gain using (b) group by h.r),
scored as (
  select w.id as doc_id, len(w.w) as n_words, coalesce(x.n, 0) as n_features, coalesce(x.weight, 0) as weight,
         coalesce(x.weight, 0) + floor(-{SCALE} * ln(-ln((('0x' || substr(sha256('{SEED}:' || w.id::varchar), 1, 8))::bigint + 0.5::double)
                                                          / 4294967296::double)))::bigint as score
  from words w left join weights x using (r) where w.side = 'd'),
ranked as (select doc_id, row_number() over (order by score desc, doc_id) as place, count(*) over () as n from scored where n_words >= {MIN_WORDS})
select s.doc_id, s.n_features::bigint as n_features, s.weight, s.score,
       case when k.place <= {PERCENT} * k.n // 100 then k.place end as rank
from scored s left join ranked k using (doc_id)
"""}
