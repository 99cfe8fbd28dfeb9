"""StructTypes of the measurement tables.

Unsigned reference types are widened: u32 -> LongType, u8 -> ShortType.
"""

from pyspark.sql import types as T

# Raw JSON-lines dump. ``result`` is declared STRING so the nested JSON
# array is kept verbatim and parsed with JSON path functions later.
RAW_DUMP = T.StructType([
    T.StructField("prb_id", T.LongType()),
    T.StructField("src_addr", T.StringType()),
    T.StructField("dst_addr", T.StringType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("sent", T.LongType()),
    T.StructField("rcvd", T.LongType()),
    T.StructField("avg", T.DoubleType()),
    T.StructField("ttl", T.LongType()),
    T.StructField("result", T.StringType()),
])

RAW_DUMP_WITH_CORRUPT = T.StructType(
    RAW_DUMP.fields + [T.StructField("_corrupt_record", T.StringType())])

PING = T.StructType([
    T.StructField("prb_id", T.LongType(), False),
    T.StructField("dst_addr", T.StringType(), False),
    T.StructField("ts", T.LongType(), False),
    T.StructField("sent", T.LongType(), False),
    T.StructField("rcvd", T.LongType(), False),
    T.StructField("avg", T.DoubleType()),
    T.StructField("result", T.StringType()),
])

PING_PARSED = T.StructType(
    [f for f in PING.fields if f.name != "result"]
    + [T.StructField(f"rtt_{i}", T.DoubleType()) for i in (1, 2, 3)])

PING_OPTIMIZED = T.StructType([
    T.StructField("prb_id", T.LongType()),
    T.StructField("ts", T.LongType()),
    T.StructField("sent", T.ShortType()),
    T.StructField("rcvd", T.ShortType()),
    T.StructField("avg", T.FloatType()),
    T.StructField("rtt_1", T.FloatType()),
    T.StructField("rtt_2", T.FloatType()),
    T.StructField("rtt_3", T.FloatType()),
    T.StructField("dst_is_ipv6", T.BooleanType()),
    T.StructField("dst_ipv4_int", T.LongType()),
    T.StructField("dst_ipv6_bytes", T.BinaryType()),
    T.StructField("src_is_ipv6", T.BooleanType()),
    T.StructField("src_ipv4_int", T.LongType()),
    T.StructField("src_ipv6_bytes", T.BinaryType()),
    T.StructField("dst_addr_display", T.StringType()),
    T.StructField("src_addr_display", T.StringType()),
])

PROBE_IP_MAP = T.StructType([
    T.StructField("ip", T.StringType()),
    T.StructField("dst_prb_id", T.LongType()),
])

EDGE_PING = T.StructType([
    T.StructField("src", T.LongType()),
    T.StructField("dst", T.LongType()),
    T.StructField("ts", T.LongType()),
    T.StructField("avg", T.DoubleType()),
    T.StructField("result", T.StringType()),
    T.StructField("sent", T.LongType()),
    T.StructField("rcvd", T.LongType()),
])
