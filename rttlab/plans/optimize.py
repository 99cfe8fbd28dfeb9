"""F-6: parsed ping rows -> compact typed table.

One lazy chain: IP columns (F-1, F-2, F-4) -> source IPs from the
deduplicated probe map (D-3; Spark broadcasts it below its byte threshold)
-> narrowing (C-7) -> display columns (F-5) -> drop ``dst_addr``. On the fact
side this is scan -> project -> join -> project: no shuffle while the map is
small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ip import dst_addr_display, ipv4_to_int, is_ipv6, src_addr_display, with_ipv6_bytes
from ..operators.filters import downcast, parse_rtts
from ..operators.joins import add_source_ip

OPT_COLUMNS = ["prb_id", "ts", "sent", "rcvd", "avg", "rtt_1", "rtt_2", "rtt_3",
               "dst_is_ipv6", "dst_ipv4_int", "dst_ipv6_bytes", "src_is_ipv6", "src_ipv4_int",
               "src_ipv6_bytes", "dst_addr_display", "src_addr_display"]


def add_dst_ip_columns(df: DataFrame) -> DataFrame:
    df = df.withColumns({"dst_is_ipv6": is_ipv6("dst_addr"), "dst_ipv4_int": ipv4_to_int("dst_addr")})
    return with_ipv6_bytes(df, "dst_addr", "dst_ipv6_bytes")


def optimize_dataset(parsed: DataFrame, probe_map: DataFrame) -> DataFrame:
    """``ping_parsed`` (+ probe map) -> ``ping_optimized``."""
    df = add_dst_ip_columns(parsed)
    df = add_source_ip(df, probe_map)
    df = downcast(df)
    df = df.withColumns({"dst_addr_display": dst_addr_display(),
                         "src_addr_display": src_addr_display()})
    return df.select(*OPT_COLUMNS)


def optimize_from_ping(ping: DataFrame, probe_map: DataFrame) -> DataFrame:
    """``ping`` (with the JSON result) -> parsed rtts -> optimized table."""
    return optimize_dataset(parse_rtts(ping), probe_map)


def optimized_edges(opt: DataFrame) -> DataFrame:
    """Edge view of the optimized table keyed by IPv4 integers (the form
    the matrix job uses): src, dst, ts, avg, sent, rcvd."""
    return opt.select(F.col("src_ipv4_int").alias("src"), F.col("dst_ipv4_int").alias("dst"),
                      "ts", F.col("avg").cast("double").alias("avg"),
                      F.col("sent").cast("bigint").alias("sent"),
                      F.col("rcvd").cast("bigint").alias("rcvd"))
