"""Aggregations and profiling reports (G-1 … G-17).

Each report is one or two aggregates with map-side combine; the global
ones return a single row. Distinct counts are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ip import is_ipv6
from ..functions.time import hour_of, loss_rate, r6, weekday_of
from .quantiles import exact_quantiles

PAIR = ["src", "dst"]


def column_counts(df: DataFrame) -> DataFrame:
    """G-1: non-null count per column (one row, one column per input column)."""
    return df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])


def range_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """G-2: min, max and exact number of distinct values per numeric column
    (long form: column, min, max, n_unique)."""
    aggs = []
    for c in cols:
        aggs += [F.min(F.col(c)).cast("double").alias(f"{c}__min"),
                 F.max(F.col(c)).cast("double").alias(f"{c}__max"),
                 F.count_distinct(F.col(c)).alias(f"{c}__nu")]
    wide = df.agg(*aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}__min").alias("min"),
                                        F.col(f"{c}__max").alias("max"),
                                        F.col(f"{c}__nu").alias("n_unique")) for c in cols]))
    return wide.select(rows.alias("r")).select("r.*")


SKETCH_LOG_K = 12  # sketches of 2 ** 12 buckets: relative standard error about 1.04 / 2 ** 6


def range_sketches(df: DataFrame, cols: list[str], by: list[str]) -> DataFrame:
    """G-2, incremental form: per part (a file, a day) and column the min, max and a distinct-count sketch. Parts are
    small and can be kept: a new part needs no look at the rows of the others."""
    aggs = []
    for c in cols:
        # a double's distinct values are those of its 64-bit hash; -0.0 counts as 0.0
        v = F.xxhash64(F.when(F.col(c) == 0, F.lit(0).cast(df.schema[c].dataType)).otherwise(F.col(c)))
        aggs += [F.min(F.col(c)).cast("double").alias(f"{c}__min"), F.max(F.col(c)).cast("double").alias(f"{c}__max"),
                 F.hll_sketch_agg(F.when(F.col(c).isNotNull(), v), SKETCH_LOG_K).alias(f"{c}__s")]
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}__min").alias("min"), F.col(f"{c}__max").alias("max"),
                                        F.col(f"{c}__s").alias("sketch")) for c in cols])).alias("r")
    return df.groupBy(*by).agg(*aggs).select(*by, each).select(*by, "r.*")


def merge_sketches(parts: DataFrame) -> DataFrame:
    """column, min, max and estimated n_unique over all parts of :func:`range_sketches`."""
    return parts.groupBy("column").agg(
        F.min("min").alias("min"), F.max("max").alias("max"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_unique"))


def describe(df: DataFrame, col: str = "ts") -> DataFrame:
    """G-3: count, mean, sample std, min, exact quartiles, max of a column."""
    a = df.agg(F.count(F.col(col)).alias("count"), F.avg(col).alias("mean"),
               F.stddev_samp(col).alias("std"), F.min(col).cast("double").alias("min"),
               F.max(col).cast("double").alias("max"))
    q = exact_quantiles(df, [], col, {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    a = a.withColumn("_k", F.lit(0))
    q = F.broadcast(q.withColumn("_k", F.lit(0)))  # one row
    j = a.join(q, "_k", "left")
    return j.select("count", r6("mean").alias("mean"), r6("std").alias("std"), r6("min").alias("min"),
                    r6("p25").alias("p25"), r6("p50").alias("p50"), r6("p75").alias("p75"),
                    r6("max").alias("max"))


def out_degree(edges: DataFrame) -> DataFrame:
    """G-4: distinct destinations per source."""
    return edges.select(*PAIR).distinct().groupBy("src").agg(F.count(F.lit(1)).alias("out_degree"))


def time_steps(df: DataFrame, col: str = "ts", first: int = 10, bucket: int = 3600) -> DataFrame:
    """G-5: gaps between consecutive distinct timestamps: count, min, max,
    most common (smallest on ties) and the first ``first`` gaps.

    No global window: gaps are taken inside hour buckets, and the gap into
    each bucket comes from the previous bucket's max via a window over the
    (few) bucket summaries."""
    t = df.select(F.col(col).alias("t")).where(F.col("t").isNotNull()).distinct() \
          .withColumn("b", F.floor(F.col("t") / bucket))
    wb = Window.partitionBy("b").orderBy("t")
    inner = t.withColumn("prev", F.lag("t").over(wb))
    bs = t.groupBy("b").agg(F.min("t").alias("bmin"), F.max("t").alias("bmax"))
    w_all = Window.orderBy("b")
    bs = bs.select("b", "bmin", F.lag("bmax").over(w_all).alias("pmax"))
    cross = bs.where(F.col("pmax").isNotNull()).select(F.col("bmin").alias("t"),
                                                         (F.col("bmin") - F.col("pmax")).alias("d"))
    inside = inner.where(F.col("prev").isNotNull()).select("t", (F.col("t") - F.col("prev")).alias("d"))
    gaps = inside.unionByName(cross)
    stats = gaps.agg(F.count(F.lit(1)).alias("n_gaps"), F.min("d").alias("min_step"),
                     F.max("d").alias("max_step"))
    mode = gaps.groupBy("d").agg(F.count(F.lit(1)).alias("c")) \
               .orderBy(F.desc("c"), F.asc("d")).limit(1).select(F.col("d").alias("mode_step"))
    firsts = gaps.orderBy("t").limit(first).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("t", "d"))),
                                 lambda s: s["d"].cast("string")), ",").alias("first_steps"))
    one = [F.lit(0).alias("_k")]
    return (stats.select("*", *one).join(mode.select("*", *one), "_k", "left")
                 .join(firsts.select("*", *one), "_k", "left").drop("_k"))


def completeness(edges: DataFrame) -> DataFrame:
    """G-6: rows / (#src · #dst · #ts) · 100 (a product of counts, no cross join)."""
    a = edges.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("src").alias("n_src"),
                  F.count_distinct("dst").alias("n_dst"), F.count_distinct("ts").alias("n_ts"))
    theo = F.col("n_src").cast("double") * F.col("n_dst") * F.col("n_ts")
    return a.select("rows", "n_src", "n_dst", "n_ts", theo.alias("theoretical"),
                    r6(F.col("rows") / theo * 100.0).alias("completeness_pct"))


def dup_measurements(edges: DataFrame) -> DataFrame:
    """G-7: rows per (src, dst, ts): max and mean."""
    c = edges.groupBy("src", "dst", "ts").agg(F.count(F.lit(1)).alias("c"))
    return c.agg(F.count(F.lit(1)).alias("n_keys"), F.max("c").alias("max_per_key"),
                 r6(F.avg("c")).alias("mean_per_key"))


def hourly_counts(df: DataFrame) -> DataFrame:
    """G-8: rows per hour of day."""
    return df.groupBy(hour_of("ts").alias("hour")).agg(F.count(F.lit(1)).alias("count"))


def dow_counts(df: DataFrame) -> DataFrame:
    """G-8: rows per weekday (Monday = 0)."""
    return df.groupBy(weekday_of("ts").alias("day_of_week")).agg(F.count(F.lit(1)).alias("count"))


def temporal_summary(df: DataFrame) -> DataFrame:
    """G-8: hours/days with data and mean/sample std of the per-hour and
    per-day counts, plus first/last ts and distinct ts."""
    h = hourly_counts(df).agg(F.count(F.lit(1)).alias("hours_with_data"),
                              r6(F.avg("count")).alias("mean_per_hour"),
                              r6(F.stddev_samp("count")).alias("std_per_hour"))
    d = dow_counts(df).agg(F.count(F.lit(1)).alias("days_with_data"),
                           r6(F.avg("count")).alias("mean_per_day"),
                           r6(F.stddev_samp("count")).alias("std_per_day"))
    t = df.agg(F.min("ts").alias("min_ts"), F.max("ts").alias("max_ts"),
               F.count_distinct("ts").alias("n_unique_ts"))
    k = F.lit(0).alias("_k")
    return h.select("*", k).join(d.select("*", k), "_k").join(t.select("*", k), "_k").drop("_k")


def overview(edges: DataFrame) -> DataFrame:
    """G-9: count, distinct src/dst/ts, ts range, latency min/max/mean/std
    (sample). No ``avg > 0`` filter here."""
    return edges.agg(
        F.count(F.lit(1)).alias("total_measurements"),
        F.count_distinct("src").alias("unique_sources"),
        F.count_distinct("dst").alias("unique_destinations"),
        F.count_distinct("ts").alias("unique_timestamps"),
        F.min("ts").alias("min_ts"), F.max("ts").alias("max_ts"),
        r6(F.min("avg")).alias("min_latency"), r6(F.max("avg")).alias("max_latency"),
        r6(F.avg("avg")).alias("mean_latency"), r6(F.stddev_samp("avg")).alias("std_latency"))


def summary(edges: DataFrame, min_count: int = 20) -> DataFrame:
    """G-10: count, span in hours, mean/std latency, successful rows
    (rcvd == 3) and %, unique pairs, and the most active non-self pair."""
    a = edges.agg(
        F.count(F.lit(1)).alias("total_measurements"),
        r6((F.max("ts") - F.min("ts")) / 3600.0).alias("time_span_hours"),
        r6(F.avg("avg")).alias("mean_latency"), r6(F.stddev_samp("avg")).alias("std_latency"),
        F.count_if(F.col("rcvd") == 3).alias("successful_measurements"))
    a = a.withColumn("success_pct", r6(F.col("successful_measurements") * 100.0 / F.col("total_measurements")))
    pairs = edges.select(*PAIR).distinct().agg(F.count(F.lit(1)).alias("unique_pairs"))
    from .pairs import top_pairs
    top = top_pairs(edges, 1, min_count).select(
        F.col("src").alias("top_src"), F.col("dst").alias("top_dst"), F.col("count").alias("top_count"))
    k = F.lit(0).alias("_k")
    return (a.select("*", k).join(pairs.select("*", k), "_k")
             .join(top.select("*", k), "_k", "left").drop("_k"))


def packet_loss(df: DataFrame) -> DataFrame:
    """G-11: rows per (sent, rcvd) with loss %, share of all rows, and
    whether the bucket is loss-free."""
    c = df.groupBy("sent", "rcvd").agg(F.count(F.lit(1)).alias("count"))
    tot = F.sum("count").over(Window.partitionBy())  # tiny: one row per (sent, rcvd)
    lr = loss_rate()
    return c.select("sent", "rcvd", "count", r6(lr).alias("loss_rate"),
                    r6(F.col("count") * 100.0 / tot).alias("pct_of_total"),
                    (lr == 0).alias("successful"))


def latency_matrix(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """G-12: mean latency per pair among a list of nodes (long form
    src, dst, avg_latency; missing cells are absent)."""
    nb = nodes.select(F.col(nodes.columns[0]).alias("node"))
    e = edges.join(nb, edges.src == nb.node, "left_semi").join(nb, edges.dst == nb.node, "left_semi")
    return e.groupBy(*PAIR).agg(r6(F.avg("avg")).alias("avg_latency"))


def latency_matrix_dense(long: DataFrame, node_ids: list[int]) -> DataFrame:
    """G-12 dense form: pivot to N columns in a fixed order (N <= 200)."""
    return long.groupBy("src").pivot("dst", node_ids).agg(F.first("avg_latency"))


def ipv4_retention(opt: DataFrame) -> DataFrame:
    """G-13: rows in total, kept by the IPv4-only filter (C-6), removed, %."""
    keep = (F.col("src_ipv4_int").isNotNull() & (F.col("src_ipv4_int") > 0)
            & F.col("dst_ipv4_int").isNotNull() & (F.col("dst_ipv4_int") > 0))
    a = opt.agg(F.count(F.lit(1)).alias("total"), F.count_if(keep).alias("kept"))
    return a.select("total", "kept", (F.col("total") - F.col("kept")).alias("removed"),
                    r6(F.col("kept") * 100.0 / F.col("total")).alias("kept_pct"),
                    r6((F.col("total") - F.col("kept")) * 100.0 / F.col("total")).alias("removed_pct"))


def ip_pair_distribution(opt: DataFrame) -> DataFrame:
    """G-14: rows by (source version, destination version) and %; an
    unmapped source is its own class."""
    sv = (F.when(F.col("src_is_ipv6").isNull(), "unmapped")
           .when(F.col("src_is_ipv6"), "ipv6").otherwise("ipv4"))
    dv = F.when(F.col("dst_is_ipv6"), "ipv6").otherwise("ipv4")
    c = opt.groupBy(sv.alias("src_version"), dv.alias("dst_version")).agg(F.count(F.lit(1)).alias("count"))
    return c.select("src_version", "dst_version", "count",
                    r6(F.col("count") * 100.0 / F.sum("count").over(Window.partitionBy())).alias("pct"))


def probe_quality(ping_or_edges: DataFrame, key: str = "src", dst: str = "dst",
                  min_rows: int = 20, min_dsts: int = 5) -> DataFrame:
    """G-16: probes with at least ``min_rows`` rows and ``min_dsts``
    distinct destinations."""
    a = ping_or_edges.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"),
                                       F.count_distinct(dst).alias("n_dsts"))
    return a.withColumn("good", (F.col("n_rows") >= min_rows) & (F.col("n_dsts") >= min_dsts))


def multi_ip_probes(probe_map: DataFrame) -> DataFrame:
    """G-17: probes listed with more than one IP, with their IP count."""
    return (probe_map.groupBy("dst_prb_id").agg(F.count(F.lit(1)).alias("n_ips"))
                     .where(F.col("n_ips") > 1))


def ip_version_distribution(ips: DataFrame, col: str) -> DataFrame:
    """F-7: distinct addresses by version: count and %."""
    d = ips.select(F.col(col).alias("ip")).where(F.col("ip").isNotNull()).distinct()
    c = d.groupBy(F.when(is_ipv6("ip"), "ipv6").otherwise("ipv4").alias("version")) \
         .agg(F.count(F.lit(1)).alias("count"))
    return c.select("version", "count",
                    r6(F.col("count") * 100.0 / F.sum("count").over(Window.partitionBy())).alias("pct"))


def ip_storage_estimate(ips: DataFrame, col: str) -> DataFrame:
    """F-8: over distinct addresses, bytes as text vs packed (4 or 16 bytes)."""
    d = ips.select(F.col(col).alias("ip")).where(F.col("ip").isNotNull()).distinct()
    v6 = is_ipv6("ip")
    a = d.agg(F.count(F.lit(1)).alias("n_ips"), F.sum(F.length("ip")).cast("bigint").alias("text_bytes"),
              F.sum(F.when(v6, 16).otherwise(4)).cast("bigint").alias("packed_bytes"))
    return a.withColumn("saving_pct", r6((1 - F.col("packed_bytes") / F.col("text_bytes")) * 100.0))


def storage_breakdown(opt: DataFrame) -> DataFrame:
    """F-9: rows with v4/v6 destination, mapped/v4/v6 source, % mapped."""
    a = opt.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~F.col("dst_is_ipv6")).alias("dst_ipv4"),
        F.count_if(F.col("dst_is_ipv6")).alias("dst_ipv6"),
        F.count_if(F.col("src_is_ipv6").isNotNull()).alias("src_mapped"),
        F.count_if(F.col("src_is_ipv6") == F.lit(False)).alias("src_ipv4"),
        F.count_if(F.col("src_is_ipv6")).alias("src_ipv6"))
    return a.withColumn("mapped_pct", r6(F.col("src_mapped") * 100.0 / F.col("rows")))
