"""SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint is cut into fewer segments than a plain pigeonhole split
would need: of two fingerprints that differ in at most d bits, one of
``d // 2 + 1`` segments differs in at most one bit. Each segment is indexed once for
every bit left out, so equal variants find all candidates; a full bit
comparison verifies them. Links become connected components.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rttlab.session import persist_table

from . import spans as S

BITS = 64
SHINGLE_WORDS, MAX_BITS, SEED = 3, 2, 42
LARGE_BUCKET = 16  # fingerprints; larger buckets are linked by points between them instead of pair by pair


def text_fingerprint(text: bytes, n: int = SHINGLE_WORDS) -> int:
    """SimHash of the n-word shingles of a text (ASCII lower case, ASCII white space); 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= n:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        size = np.fromiter(map(len, words), np.int64, len(words))
        start = np.cumsum(size + 1) - size - 1
        end = (start + size)[n - 1:].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(start.tolist(), end, strict=False)]
    bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
    ones = 2 * bits.sum(0, dtype=np.int64) > len(hashes)
    return int.from_bytes(np.packbits(ones).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint", n: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` without ``text``, with the fingerprint as a long (its 64 bits); null texts have no words."""
    rest = [c for c in docs.columns if c not in (text, out)]
    docs = docs.select(*rest, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = S.text_buffer(b.column(len(rest)))
            flat = data.tobytes()
            values = np.array([text_fingerprint(flat[i:j], n) for i, j in zip(offs.tolist(), offs[1:].tolist(), strict=False)], np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns[:len(rest)], pa.array(values.view(np.int64))], names=[*rest, out])

    return S.map_batches(docs, run, docs.select(rest).schema.add(out, "long"))


def distance(a, b):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def segments(d: int) -> list[tuple[int, int]]:
    """(first bit, bits) of the d // 2 + 1 segments, of which one differs in at most one bit."""
    n = d // 2 + 1
    cuts = [i * BITS // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def variants(prints: DataFrame, d: int) -> DataFrame:
    """``fp`` and the keys of its one-wildcard segment variants: ``slot`` (segment and left-out bit) and ``rest``."""
    masks = []
    for a, n in segments(d):
        whole = ((1 << n) - 1) << a
        masks += [_signed(whole & ~(1 << i)) for i in range(a, a + n)]
    table = F.array(*[F.lit(m).cast("long") for m in masks])
    return (prints.select("fp", F.posexplode(table).alias("slot", "mask"))
            .select("fp", "slot", F.col("fp").bitwiseAND(F.col("mask")).alias("rest")))


def links(prints: DataFrame, d: int = MAX_BITS, large: int = LARGE_BUCKET) -> DataFrame:
    """(a, b) with a < b: links between the distinct fingerprints ``fp`` that connect all that differ in at most ``d`` bits.

    A bucket of two gives its pair, one of up to ``large`` its pairs; members of
    larger ones are linked by the points between them. Every link is verified;
    no two within the distance stay unconnected.
    """
    keys = variants(prints, d)
    buckets = (keys.groupBy("slot", "rest").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
               .filter("n > 1"))
    buckets = persist_table(buckets, "simhash-buckets")
    near = distance("a", "b") <= d
    two = buckets.filter("n = 2").select("a", "b").filter(near)
    wide = buckets.filter("n > 2").select(F.col("slot").alias("_s"), F.col("rest").alias("_r"), "n")
    if wide.isEmpty():
        return two.distinct()
    wide = wide.hint("merge")  # their number grows with the corpus: no broadcast
    members = keys.join(wide, (F.col("slot") == F.col("_s")) & (F.col("rest") == F.col("_r"))).select("slot", "rest", "n", "fp")
    members = persist_table(members, "simhash-members")
    small = members.filter(F.col("n") <= large)
    pairs = (small.select("slot", "rest", F.col("fp").alias("a")).join(small.select("slot", "rest", F.col("fp").alias("b")), ["slot", "rest"])
             .filter("a < b").filter(near).select("a", "b"))
    big = members.filter(F.col("n") > large)
    stars = _stars(big, d)
    return two.union(pairs).union(stars).distinct()


def _stars(big: DataFrame, d: int) -> DataFrame:
    """Links of large buckets: two fingerprints within ``d`` bits share a point on the way between them.

    Every fingerprint is keyed by the points within half of ``d`` bits (rounded
    up) around it; a point that one of them is at most ``d // 2`` away from
    links all its fingerprints to that one. At most as many fingerprints meet
    at a point as it has neighbours.
    """
    masks = [(sum(1 << j for j in c), r) for r in range((d + 1) // 2 + 1) for c in combinations(range(BITS), r)]
    table = F.array(*[F.struct(F.lit(_signed(m)).cast("long").alias("m"), F.lit(r).alias("r")) for m, r in masks])
    keyed = (big.select("fp").distinct().select("fp", F.explode(table).alias("x"))
             .select("fp", F.col("fp").bitwiseXOR(F.col("x.m")).alias("point"), F.col("x.r").alias("r")))
    heads = keyed.groupBy("point").agg(F.min(F.when(F.col("r") <= d // 2, F.col("fp"))).alias("a"), F.count(F.lit(1)).alias("n"))
    heads = heads.filter("n > 1 and a is not null").drop("n")
    star = keyed.join(heads, "point").filter("fp <> a").select("a", F.col("fp").alias("b"))
    return star.filter(distance("a", "b") <= d).distinct()


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, root) for every ``fp`` of ``nodes``: the smallest node reachable over ``edges`` (a, b).

    Alternates large-star and small-star steps until the edges no longer
    change; they are written to the shared folder after every round. Nodes
    without an edge are their own root.
    """
    e = persist_table(edges.select("a", "b"), "simhash-edges")
    while True:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # large star: larger neighbours of a node move to the smallest of its neighbourhood
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b").filter("a <> b").distinct()
        # small star: a node and its smaller neighbours move to the smallest of them
        down = large.select(F.col("b").alias("n"), F.col("a").alias("s"))
        tops = down.groupBy("n").agg(F.min("s").alias("m"))
        moved = (down.join(tops, "n").filter("s <> m").select(F.col("m").alias("a"), F.col("s").alias("b"))
                 .union(tops.select(F.col("m").alias("a"), F.col("n").alias("b"))).distinct())
        now = persist_table(moved, "simhash-edges")
        old = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        new = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        e = now
        if old == new:
            break
    roots = e.select(F.col("b").alias("_b"), F.col("a").alias("root"))
    return nodes.join(roots, F.col("fp") == F.col("_b"), "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", n: int = SHINGLE_WORDS, d: int = MAX_BITS) -> DataFrame:
    """``docs`` without ``text``, with ``fingerprint`` (long), ``root`` (the smallest fingerprint reachable over links)
    and ``component_id`` (the smallest id of the documents reachable).

    Documents with equal fingerprints are linked; null, empty and wordless
    texts have fingerprint zero. Repeated rows keep their row. Null ids are in
    a component but name one only if all its ids are null. An empty table
    gives an empty table; columns named like an output are replaced.
    """
    columns = [c for c in docs.columns if c not in ("fingerprint", "root", "component_id", text)]
    packed = S.hide(docs.select(*[F.col(f"`{c}`") for c in [*columns, text]]), id=id_col, text=text)
    prints = persist_table(fingerprints(packed, n=n), "simhash-prints")
    groups = prints.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("id").alias("first_id"))
    groups = persist_table(groups, "simhash-groups")
    roots = components(groups.select("fp"), links(groups.select("fp"), d))
    named = roots.join(groups, "fp")
    names = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = named.join(names, "root").select("fp", "root", "component_id")
    return (prints.join(named, F.col("fingerprint") == F.col("fp"))
            .select(*S.unhide(prints, columns, id=id_col), "fingerprint", "root", "component_id"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text", n: int = SHINGLE_WORDS, d: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each component the one with the smallest id.

    A null id comes first; of several rows with that id, the one with the
    smallest row hash, and of whole rows that repeat, one.
    """
    used = {"id": id_col, "text": text}
    packed = S.hide(docs, **used)
    rows = packed.withColumn("row_hash", F.xxhash64(*[F.col(c) for c in packed.columns]))
    classes = near_duplicates(rows.select("id", "row_hash", "text"), "id", "text", n, d)
    stay = classes.groupBy("root").agg(F.min(F.struct("id", "row_hash")).alias("s")).select(
        F.col("s.id").alias("kept_id"), F.col("s.row_hash").alias("kept_row"))
    rows = rows.join(stay, (F.col("row_hash") == F.col("kept_row")) & F.col("id").eqNullSafe(F.col("kept_id")), "left_semi")
    return rows.dropDuplicates(["row_hash", "id"]).select(*S.unhide(rows, docs.columns, **used))


def op8_simhash(spark, sf: str) -> DataFrame:
    """Fingerprint and component of every document of ``documents``."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    out = near_duplicates(docs)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
