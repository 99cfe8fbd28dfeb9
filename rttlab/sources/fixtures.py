"""Stand-in inputs in the reference schemas, built from the driver tables.

These views only give rows of the shape the jobs expect (FIXTURES.md §2);
they do none of the jobs' work. Every job downstream is generic and runs
the same on any data of these schemas.

The DuckDB text of each view is kept next to its Spark form so the
oracle SQL in ``__spark_entry__`` reads the very same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ping`` rows (prb_id, dst_addr, ts, sent, rcvd, avg, result) from ``events``."""
    e = table(spark, sf_dir, "events")
    k = (e.event_id * 7 + e.user_id) % 10
    err = e.event_type == "error"
    lost = err & (e.event_id % 4 == 0)
    return e.select(
        (e.user_id % 10).cast("bigint").alias("prb_id"),
        F.when(k == 9, F.lit("2001:db8::9"))
         .otherwise(F.concat(F.lit("10.0."), k.cast("string"), F.lit(".1"))).alias("dst_addr"),
        F.unix_seconds(F.date_trunc("SECOND", e.ts)).alias("ts"),
        F.lit(3).cast("bigint").alias("sent"),
        F.when(err, e.event_id % 4).otherwise(F.lit(3)).cast("bigint").alias("rcvd"),
        F.when(lost, F.lit(-1.0)).otherwise(e.value).cast("double").alias("avg"),
        F.when(lost, F.lit('[{"x": "*"}]'))
         .otherwise(F.concat(F.lit('[{"rtt": '), (e.event_id % 500).cast("string"),
                             F.lit('}, {"x": "*"}, {"rtt": 7}]'))).alias("result"),
    )


def ping_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ping`` rows with the cases that the plain view lacks: other packet counts, a result that is missing, empty or no
    list, addresses that no probe has, that do not parse or are missing, other spellings of IPv6, a probe that the map lacks."""
    e = table(spark, sf_dir, "events")
    k = (e.event_id * 7 + e.user_id) % 10
    a, r = e.event_id % 40, e.event_id % 70
    addr = (F.when(a == 3, "192.0.2.77").when(a == 9, "300.1.2.3").when(a == 15, "2001:DB8::A").when(a == 21, "fe80::")
             .when(a == 27, None).when(a == 33, "nonsense").when(k == 9, F.lit("2001:db8::9"))
             .otherwise(F.concat(F.lit("10.0."), k.cast("string"), F.lit(".1"))))
    result = (F.when(r == 13, None).when(r == 17, "[]").when(r == 19, '{"error": "timeout"}')
               .otherwise(F.concat(F.lit('[{"rtt": '), (e.event_id % 500).cast("string"), F.lit('}, {"x": "*"}, {"rtt": 7}]'))))
    return e.select(
        F.when(e.event_id % 45 == 8, 77).otherwise(e.user_id % 10).cast("bigint").alias("prb_id"), addr.alias("dst_addr"),
        F.unix_seconds(F.date_trunc("SECOND", e.ts)).alias("ts"),
        F.when(e.event_id % 60 == 11, 2).otherwise(3).cast("bigint").alias("sent"),
        F.when(e.event_type == "error", e.event_id % 4).otherwise(3).cast("bigint").alias("rcvd"),
        F.when(e.event_id % 50 == 4, None).otherwise(e.value).cast("double").alias("avg"), result.alias("result"))


def raw_lines(spark: SparkSession, sf_dir: str, n_dumps: int = 5) -> DataFrame:
    """Text lines of raw dumps (dump, line) from :func:`ping_edge`; where the time
    leaves 3 when divided by 7 the line breaks off and does not parse; the last dump has no such line."""
    rows = ping_edge(spark, sf_dir)
    nested = F.from_json("result", "array<struct<rtt:double,x:string>>")
    good = F.to_json(F.struct("prb_id", "dst_addr", F.col("ts").alias("timestamp"), "sent", "rcvd", "avg", nested.alias("result")))
    broken = F.concat(F.lit('{"prb_id": '), F.col("prb_id").cast("string"), F.lit(', "timestamp": '), F.col("ts").cast("string"),
                      F.lit(', "dst_addr": "10.'))
    dump = F.col("ts") % n_dumps
    bad = (F.col("ts") % 7 == 3) & (dump < n_dumps - 1)
    return rows.select(dump.alias("dump"), F.when(bad, broken).otherwise(good).alias("line"))


def probe_ip_map(spark: SparkSession) -> DataFrame:
    """13-row dimension (ip, dst_prb_id): probes 0, 3, 6 have v4 and v6, probe 9 only v6."""
    r = spark.range(10).withColumnRenamed("id", "i")
    v4 = r.where("i < 9").select(
        F.concat(F.lit("10.0."), F.col("i").cast("string"), F.lit(".1")).alias("ip"),
        F.col("i").cast("bigint").alias("dst_prb_id"))
    v6 = r.where("i % 3 = 0").select(
        F.concat(F.lit("2001:db8::"), F.col("i").cast("string")).alias("ip"),
        F.col("i").cast("bigint").alias("dst_prb_id"))
    return v4.unionByName(v6)


def edge_big(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edge-form measurements (src, dst, ts, sent, rcvd, avg) from ``lineitem``; 6x ``events``."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        (li.l_suppkey % 20).cast("bigint").alias("src"),
        (li.l_partkey % 20).cast("bigint").alias("dst"),
        (F.unix_seconds(F.date_trunc("SECOND", li.l_shipdate))
         + (li.l_orderkey * 7 + li.l_linenumber) % 86400).cast("bigint").alias("ts"),
        F.lit(3).cast("bigint").alias("sent"),
        F.when(li.l_returnflag == "R", li.l_linenumber % 4).otherwise(F.lit(3))
         .cast("bigint").alias("rcvd"),
        (li.l_extendedprice / F.lit(1000.0)).cast("double").alias("avg"),
    )


# ---- DuckDB text of the same views (used by the oracle SQL) ----

DUCK_PING = """
select cast(user_id % 10 as bigint) as prb_id,
       case when (event_id * 7 + user_id) % 10 = 9 then '2001:db8::9'
            else concat('10.0.', cast((event_id * 7 + user_id) % 10 as varchar), '.1') end as dst_addr,
       cast(floor(epoch(ts)) as bigint) as ts,
       cast(3 as bigint) as sent,
       cast(case when event_type = 'error' then event_id % 4 else 3 end as bigint) as rcvd,
       cast(case when event_type = 'error' and event_id % 4 = 0 then -1.0 else value end as double) as avg,
       case when event_type = 'error' and event_id % 4 = 0 then '[{"x": "*"}]'
            else concat('[{"rtt": ', cast(event_id % 500 as varchar), '}, {"x": "*"}, {"rtt": 7}]') end as result
from events
"""

DUCK_PROBE_IP_MAP = """
select concat('10.0.', cast(i as varchar), '.1') as ip, cast(i as bigint) as dst_prb_id
from range(10) t(i) where i < 9
union all
select concat('2001:db8::', cast(i as varchar)) as ip, cast(i as bigint) as dst_prb_id
from range(10) t(i) where i % 3 = 0
"""

DUCK_EDGE_BIG = """
select cast(l_suppkey % 20 as bigint) as src, cast(l_partkey % 20 as bigint) as dst,
       cast(cast(floor(epoch(l_shipdate)) as bigint) + (l_orderkey * 7 + l_linenumber) % 86400 as bigint) as ts,
       cast(3 as bigint) as sent,
       cast(case when l_returnflag = 'R' then l_linenumber % 4 else 3 end as bigint) as rcvd,
       cast(l_extendedprice / 1000.0::double as double) as avg
from lineitem
"""

DUCK_PING_EDGE = """
select cast(case when event_id % 45 = 8 then 77 else user_id % 10 end as bigint) as prb_id,
       case event_id % 40 when 3 then '192.0.2.77' when 9 then '300.1.2.3' when 15 then '2001:DB8::A' when 21 then 'fe80::'
            when 27 then null when 33 then 'nonsense'
            else case when (event_id * 7 + user_id) % 10 = 9 then '2001:db8::9'
                      else concat('10.0.', cast((event_id * 7 + user_id) % 10 as varchar), '.1') end end as dst_addr,
       cast(floor(epoch(ts)) as bigint) as ts,
       cast(case when event_id % 60 = 11 then 2 else 3 end as bigint) as sent,
       cast(case when event_type = 'error' then event_id % 4 else 3 end as bigint) as rcvd,
       case when event_id % 50 = 4 then null else cast(value as double) end as avg,
       case event_id % 70 when 13 then null when 17 then '[]' when 19 then '{"error": "timeout"}'
            else concat('[{"rtt": ', cast(event_id % 500 as varchar), '}, {"x": "*"}, {"rtt": 7}]') end as result
from events
"""
