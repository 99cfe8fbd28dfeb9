"""Mixing sources to target weights.

Documents are aggregated by membership pattern (the set of sources that a
document belongs to). A min-cost flow routes the patterns' words to the
sources' quotas; every further copy of a pattern costs more than the one
before, so nothing is repeated while unused words can fill a quota. Seeded
documents then make up the words that each pattern gives.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rttlab.session import persist_table

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SEED = 7
BIN_DIGITS = 4  # hex digits of the seeded order that a first sum goes by
MAX_PATTERNS = 20_000  # patterns that the flow graph on the driver may have
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def repetition_cost(copy: int) -> int:
    """Cost of a word's ``copy``-th repetition (0: first use); it must grow faster and faster."""
    return copy * copy


def source_targets(sizes: dict[str | None, int], weights=WEIGHTS, max_repeats: int = MAX_REPEATS,
                   budget: int | None = None) -> dict[str | None, tuple[int, int]]:
    """Each source's share of ``budget`` words (default: of all sizes) as a fraction (numerator, denominator).

    Sources by code point, null last, weigh ``weights`` in turn. A share stops
    at ``max_repeats`` times its source's size; the excess is shared again by
    weight until none is above.
    """
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    rest = sum(sizes.values()) if budget is None else budget
    open_, out = set(names), {}
    while True:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if rest * weight[s] > max_repeats * sizes[s] * total}
        if not full:
            return out | {s: (rest * weight[s], total) for s in open_}
        for s in full:
            out[s] = (max_repeats * sizes[s], 1)
            rest -= max_repeats * sizes[s]
        open_ -= full


def route(capacity: dict, members: dict, quota: dict, max_repeats: int = MAX_REPEATS,
          cost: Callable[[int], int] = repetition_cost) -> dict[tuple, int]:
    """Min-cost flow: words of (pattern, source).

    ``capacity``: a pattern's words, for each of ``max_repeats`` copies;
    ``members``: its sources; ``quota``: the words a source wants. As much as
    possible is routed, at the least total cost. Costs lie on the arcs into the
    patterns alone, so the cheapest augmenting path begins at a pattern with
    the cheapest open copy; paths are searched breadth first, in order.
    """
    flow: dict[tuple, int] = {}
    into: dict = {}  # patterns with flow into a source
    left = dict(quota)
    for copy in sorted(range(max_repeats), key=cost):
        spare = dict(capacity)
        for start in members:
            while spare[start] > 0:
                # patterns and sources reached, each with the node before it
                before, sources, queue, end = {start: None}, {}, deque([start]), []  # end: a source (which may be None)
                while queue and not end:
                    p = queue.popleft()
                    for s in members[p]:
                        if s in sources:
                            continue
                        sources[s] = p
                        if left[s] > 0:
                            end = [s]
                            break
                        for q in into.get(s, ()):
                            if q not in before:
                                before[q] = s
                                queue.append(q)
                if not end:
                    break
                path, s, amount = [], end[0], min(spare[start], left[end[0]])
                while True:
                    p = sources[s]
                    path.append((p, s, 1))
                    if p == start:
                        break
                    s = before[p]
                    path.append((p, s, -1))
                    amount = min(amount, flow[p, s])
                for p, s, sign in path:
                    flow[p, s] = flow.get((p, s), 0) + sign * amount
                    if flow[p, s]:
                        into.setdefault(s, {})[p] = None
                    else:
                        into[s].pop(p)
                spare[start] -= amount
                left[end[0]] -= amount
    return {k: v for k, v in flow.items() if v}


def _membership(sources: Column) -> tuple[Column, Column]:
    """A pattern's sources without repeats, and a string that stands for it."""
    members = F.sort_array(F.array_distinct(sources))
    text = F.transform(members, lambda m: F.coalesce(F.concat(F.octet_length(m).cast("string"), F.lit(":"), m), F.lit("-")))
    return members, F.array_join(text, "")


class Mix:
    """The result of :func:`mix_sources`: ``documents`` (id, members, size, taken), ``sources`` (source, source_size,
    target, routed), ``flows`` (members, source, words)."""

    def __init__(self, documents: DataFrame, sources: DataFrame, flows: DataFrame):
        self.documents, self.sources, self.flows = documents, sources, flows


def mix_sources(docs: DataFrame, sources: Column, id_col: str = "doc_id", text: str = "text", weights=WEIGHTS,
                max_repeats: int = MAX_REPEATS, seed: int = SEED, budget: int | None = None,
                max_patterns: int = MAX_PATTERNS) -> Mix:
    """Words to take of every row of ``docs`` so that each source comes to its target.

    ``sources`` is an array of the row's sources (null is a source; a row in
    none is never taken). A word taken from a document of several sources
    counts for one of them. A pattern gives whole copies of all its documents
    and, of the rest, documents in seeded order; the last of these is cut, so
    the words come out exactly. ``taken`` counts words, repeats included, and
    is at most ``max_repeats`` times the size.

    A null or empty text has size 0. The order is by the digest of seed and
    id (null: empty), then id and size: reruns agree, repeated rows are
    interchangeable. An empty table gives empty tables. Other columns are not
    read. One row a pattern comes to the driver; more than ``max_patterns``
    raise an error.
    """
    spark = docs.sparkSession
    members, pattern = _membership(sources)
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    rows = persist_table(docs.select(F.col(id_col).alias("id"), members.alias("members"), pattern.alias("pattern"),
                                     word_count(text).alias("size"), order.alias("h")), "mixing-rows")
    groups = rows.groupBy("pattern").agg(F.first("members").alias("members"), F.sum("size").alias("size"))
    groups = groups.orderBy("pattern").limit(max_patterns + 1).collect()
    if len(groups) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns")
    capacity = {g.pattern: g.size for g in groups}
    belongs = {g.pattern: list(g.members) for g in groups}
    sizes: dict[str | None, int] = {}
    for p, names in belongs.items():
        for s in names:
            sizes[s] = sizes.get(s, 0) + capacity[p]
    all_words = sum(c for p, c in capacity.items() if belongs[p])
    shares = source_targets(sizes, weights, max_repeats, all_words if budget is None else budget)
    flow = route(capacity, belongs, {s: num // den if den else 0 for s, (num, den) in shares.items()}, max_repeats)

    take = dict.fromkeys(capacity, 0)
    routed = dict.fromkeys(sizes, 0)
    for (p, s), words in flow.items():
        take[p] += words
        routed[s] += words
    plan = [(p, *(divmod(t, capacity[p]) if capacity[p] else (0, 0))) for p, t in take.items()]
    plan = F.broadcast(spark.createDataFrame(plan, "p string, copies bigint, rest bigint"))  # at most max_patterns rows
    planned = rows.join(plan, F.col("pattern") == F.col("p")).withColumn("bin", F.substring("h", 1, BIN_DIGITS))

    # The bin of the seeded order in which each pattern's rest runs out: at most 16 ** BIN_DIGITS sums a pattern.
    bins = planned.filter("rest > 0").groupBy("p", "bin", "rest").agg(F.sum("size").alias("words"))
    bins = bins.withColumn("before", F.sum("words").over(Window.partitionBy("p").orderBy("bin")) - F.col("words"))
    edge = bins.filter("before < rest and before + words >= rest").select(F.col("p").alias("e"), F.col("bin").alias("edge"), "before")
    edge = F.broadcast(persist_table(edge, "mixing-edges"))  # at most one row a pattern
    placed = planned.join(edge, F.col("p") == F.col("e"), "left")
    whole = F.when(F.col("bin") < F.col("edge"), F.col("size")).otherwise(F.lit(0))
    outside = placed.filter("edge is null or bin <> edge").withColumn("extra", whole)
    so_far = Window.partitionBy("p").orderBy("h", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    room = F.col("rest") - F.col("before") - F.coalesce(F.sum("size").over(so_far), F.lit(0))
    inside = placed.filter("bin = edge").withColumn("extra", F.greatest(F.lit(0), F.least(F.col("size"), room)))
    documents = outside.unionByName(inside).select(
        F.col("id").alias(id_col), "members", "size", (F.col("copies") * F.col("size") + F.col("extra")).cast("long").alias("taken"))
    table = [(s, sizes[s], num / den if den else 0.0, routed[s]) for s, (num, den) in shares.items()]
    return Mix(documents, spark.createDataFrame(table, "source string, source_size bigint, target double, routed bigint"),
               spark.createDataFrame([(belongs[p], s, w) for (p, s), w in flow.items()],
                                     "members array<string>, source string, words bigint"))


def op12_source_mixing(spark, sf: str) -> DataFrame:
    """The mix of all ``documents`` by their sources' weights."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    mix = mix_sources(docs, F.array("source"))
    mine = F.element_at("members", 1).eqNullSafe(F.col("source"))
    return (mix.documents.join(F.broadcast(mix.sources), mine)  # at most max_patterns sources, as checked there
            .select("doc_id", "size", "source_size", "target", "taken"))


ORACLE = {"op12_source_mixing": rf"""
with d as (select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size,
                  sha256('{SEED}:' || doc_id::varchar) as h from documents),
s as (select source, sum(size)::bigint as size, count(*) as n from d group by source),
w as (select *, case (row_number() over (order by source nulls last) - 1) % {len(WEIGHTS)}
                {" ".join(f"when {i} then {x}" for i, x in enumerate(WEIGHTS))} end as weight from s),
o as (select *, row_number() over (order by size::double / weight, source nulls last) as i from w),
c as (select *, (sum(size) over ())::bigint - {MAX_REPEATS} * (sum(size) over (order by i) - size)::bigint as rest,
                (sum(weight) over ())::bigint - (sum(weight) over (order by i) - weight)::bigint as open_weight from o),
f as (select *, bool_and(rest * weight > {MAX_REPEATS} * size * open_weight) over (order by i) as is_full from c),
l as (select {MAX_REPEATS} * coalesce(sum(size) filter (is_full), 0)::bigint as used, sum(weight) filter (not is_full)::bigint as open_weight,
             sum(size)::bigint as total from f),
t as (select f.source, f.size as source_size,
             case when is_full then ({MAX_REPEATS} * f.size)::double
                  else ((total - used) * weight)::double / l.open_weight::double end as target,
             case when is_full then {MAX_REPEATS} * f.size else ((total - used) * weight) // l.open_weight end as quota from f, l),
p as (select d.*, t.source_size, t.target, case when t.source_size = 0 then 0 else t.quota // t.source_size end as copies,
             case when t.source_size = 0 then 0 else t.quota % t.source_size end as rest,
             sum(d.size) over (partition by d.source order by d.h, d.doc_id rows unbounded preceding) - d.size as before
      from d join t on d.source is not distinct from t.source)
select doc_id, size::bigint as size, source_size, target,
       (copies * size + greatest(0, least(size, rest - before)))::bigint as taken from p
"""}
