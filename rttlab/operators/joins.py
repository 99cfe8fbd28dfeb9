"""Joins and set operations (D-1 … D-9).

The probe map's joins carry no hint: Spark picks a broadcast by the measured
bytes of the map, and above its threshold a shuffle join that AQE can split
when a probe is skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ip import ipv4_to_int, is_ipv6, with_ipv6_bytes
from .filters import rename_edge
from .pairs import top_sources_by_degree


def resolve_dst_probe(ping: DataFrame, probe_map: DataFrame) -> DataFrame:
    """D-1: LEFT join ``dst_addr = ip``, unmatched -> -1, then drop -1.

    The net effect is an inner join (Catalyst rewrites it into one). An IP
    listed for two probes fans out, as in the reference.
    """
    m = probe_map.select("ip", "dst_prb_id")
    j = (ping.join(m, ping.dst_addr == m.ip, "left")
             .withColumn("dst_prb_id", F.coalesce(F.col("dst_prb_id"), F.lit(-1).cast("bigint")))
             .where(F.col("dst_prb_id") != -1))
    return rename_edge(j)


def resolve_dst_probe_inner(ping: DataFrame, probe_map: DataFrame) -> DataFrame:
    """D-2: INNER join ``dst_addr = ip`` -> (src, dst, ts, avg, sent, rcvd)."""
    m = probe_map.select("ip", "dst_prb_id")
    return (ping.join(m, ping.dst_addr == m.ip, "inner")
                .select(F.col("prb_id").alias("src"), F.col("dst_prb_id").alias("dst"),
                        "ts", "avg", "sent", "rcvd"))


def dedup_probe_map(probe_map: DataFrame) -> DataFrame:
    """D-5: one IP per probe, IPv4 preferred, ties broken by the smaller IP text.

    ``min_by`` with a struct key is a partial (map-side) aggregate, so a probe
    with many addresses never gathers its rows in one place.
    """
    return (probe_map.groupBy("dst_prb_id")
                     .agg(F.min_by("ip", F.struct(is_ipv6("ip").cast("int"), F.col("ip")))
                          .alias("ip")))


def source_ip_columns(dedup_map: DataFrame) -> DataFrame:
    """The deduplicated map in optimized form: (dst_prb_id, src_is_ipv6,
    src_ipv4_int, src_ipv6_bytes)."""
    m = dedup_map.select("dst_prb_id", "ip", is_ipv6("ip").alias("src_is_ipv6"), ipv4_to_int("ip").alias("src_ipv4_int"))
    return with_ipv6_bytes(m, "ip", "src_ipv6_bytes").drop("ip")


def add_source_ip(df: DataFrame, probe_map: DataFrame) -> DataFrame:
    """D-3: LEFT join ``prb_id = dst_prb_id`` on the deduplicated map; never
    multiplies rows. Unmapped probes get NULL source columns."""
    src = source_ip_columns(dedup_probe_map(probe_map))
    return df.join(src, df.prb_id == src.dst_prb_id, "left").drop("dst_prb_id")


def add_source_ip_fanout(df: DataFrame, probe_map: DataFrame) -> DataFrame:
    """D-4: the same join on the raw map — rows multiply for probes with
    several IPs (kept to demonstrate the bias the dedup removes)."""
    src = probe_map.select("dst_prb_id", is_ipv6("ip").alias("src_is_ipv6"),
                           ipv4_to_int("ip").alias("src_ipv4_int"))
    return df.join(src, df.prb_id == src.dst_prb_id, "left").drop("dst_prb_id")


def filter_top_endpoints(edges: DataFrame, k: int = 100) -> DataFrame:
    """D-6: keep rows whose src and dst are both among the top-``k`` sources.

    The top set is at most ``k`` rows, so both semi joins broadcast it.
    """
    top = F.broadcast(top_sources_by_degree(edges, k).select(F.col("src").alias("node")))
    return (edges.join(top, edges.src == top.node, "left_semi")
                 .join(top, edges.dst == top.node, "left_semi"))


def mapped_probe_coverage(ping: DataFrame, probe_map: DataFrame) -> DataFrame:
    """D-7: distinct measuring probes, how many of them the map knows, and %."""
    probes = ping.select(F.col("prb_id").alias("p")).distinct()
    mapped = probe_map.select(F.col("dst_prb_id").alias("p")).distinct()
    j = probes.join(mapped.withColumn("m", F.lit(1)), "p", "left")
    return j.agg(F.count(F.lit(1)).alias("n_probes"),
                 F.count("m").alias("n_mapped"),
                 F.round(F.count("m") * 100.0 / F.count(F.lit(1)), 6).alias("pct_mapped"))


def distinct_edges(edges: DataFrame) -> DataFrame:
    """D-8: unique (src, dst)."""
    return edges.select("src", "dst").distinct()


def concat_files(*dfs: DataFrame) -> DataFrame:
    """D-9: vertical union by column name."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out
