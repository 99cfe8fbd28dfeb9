"""URL filters: host and path rules, and a list of canonical URLs.

Listed URLs sit in a blocked Bloom filter (one 256-bit block per key, eight
32-bit lanes with one bit each); URLs that may be listed go on to an exact
hash join that removes the filter's false positives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The rules of the query (host and path prefix, verdict).
RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block",
         "com/fr/": "allow", "com/de/": "block"}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Odd multipliers that pick a bit in each lane.
LANES = [0x47B6137B, 0x44974D91, 0x1824AD5B, 0x22B7289D, 0x705495C7, 0x2DF1424B, 0x1EFC4947, 0x5C6BFB31]
KEYS_PER_BLOCK = 16  # 16 bits a key: about one false positive in 2,000
BROADCAST_BLOCKS = 100_000  # 7 MB at most; a larger filter is joined by block


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def canonical_url(host: Column, path: Column, url: Column) -> Column:
    """Host (lower case, without leading ``www.``), path without a final slash, and query; no scheme or fragment."""
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^?#]*(\?[^#]*)", 1)
    return F.concat(F.regexp_replace(host, r"^www\.", ""), F.regexp_replace(path, "/$", ""), query)


def rule_of(host: Column, path: Column, rules) -> Column:
    """The longest rule that fits: its host or a subdomain of it, and a prefix of the path; else null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=len):
        name, slash, prefix = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + prefix)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def _bloom_key(url: str, n_blocks: int) -> list[Column]:
    h = F.xxhash64(F.col(url))
    low = F.hash(F.col(url), h).cast("long").bitwiseAND(F.lit(0x7FFFFFFF))
    lanes = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(low * F.lit(m), 20).bitwiseAND(F.lit(31)).cast("int"))
             .alias(f"b{i}") for i, m in enumerate(LANES)]
    return [F.pmod(h, F.lit(n_blocks)).alias("_block"), *lanes]


def blocked_bloom(listed: DataFrame, url: str, n_blocks: int) -> DataFrame:
    """One row per used block: ``_block`` and the lanes ``w0``..``w7``."""
    bits = listed.select(*_bloom_key(url, n_blocks))
    return bits.groupBy("_block").agg(*[F.bit_or(f"b{i}").alias(f"w{i}") for i in range(len(LANES))])


def listed_urls(urls: DataFrame, url: str, listed: DataFrame) -> DataFrame:
    """Distinct values of ``urls[url]`` that occur in ``listed.url``, found through the Bloom filter.

    The filter has a block for every 16 listed URLs. Its size follows from the
    counted list: up to BROADCAST_BLOCKS blocks it is broadcast, a larger one
    is joined by block number. Nulls are never listed.
    """
    listed = listed.select(F.col("url").alias("_listed")).filter("_listed is not null").distinct()
    n_blocks = max(1, -(-listed.count() // KEYS_PER_BLOCK))
    bloom = blocked_bloom(listed, "_listed", n_blocks)
    if n_blocks <= BROADCAST_BLOCKS:
        bloom = F.broadcast(bloom)
    asked = urls.select(F.col(url).alias("_url")).filter("_url is not null").distinct()
    asked = asked.select("_url", *_bloom_key("_url", n_blocks))
    hit = F.lit(True)
    for i in range(len(LANES)):
        hit = hit & (F.col(f"b{i}").bitwiseAND(F.col(f"w{i}")) != 0)
    maybe = asked.join(bloom, "_block").filter(hit).select("_url")
    return maybe.join(listed, F.col("_url") == F.col("_listed"), "left_semi")


def url_filter(pages: DataFrame, listed: DataFrame, rules: dict[str, str], url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``canonical``, ``rule``, ``listed`` and ``verdict``.

    The verdict is the longest fitting rule's; without one, ``block`` if the
    canonical URL is in ``listed`` (column ``url``, canonical), else
    ``allow``. Null URLs, and those without ``://``, have empty host and path
    and fit no rule. Repeated rows are judged each for itself; input columns
    named like an output are replaced; an empty list blocks nothing.
    """
    added = ["host", "path", "canonical", "rule", "listed", "verdict"]
    rest = [c for c in pages.columns if c not in added]
    out = pages.select(*rest, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    out = out.withColumn("canonical", canonical_url(F.col("host"), F.col("path"), F.col(url)))
    out = out.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    blocked = listed_urls(out.filter("rule is null"), "canonical", listed).withColumnRenamed("_url", "_hit")
    ruled = out.filter("rule is not null").withColumn("listed", F.lit(None).cast("boolean"))
    free = out.filter("rule is null").join(blocked, F.col("canonical") == F.col("_hit"), "left")
    free = free.withColumn("listed", F.col("_hit").isNotNull()).drop("_hit")
    verdict = F.lit(None).cast("string")
    for r, v in rules.items():
        verdict = F.when(F.col("rule") == r, F.lit(v)).otherwise(verdict)
    verdict = F.when(F.col("rule").isNull(), F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))).otherwise(verdict)
    return ruled.unionByName(free).withColumn("verdict", verdict)


def stand_in_list(pages: DataFrame, url: str = "url") -> DataFrame:
    """A block list in the operator's schema: canonical URLs of the pages whose id is divisible by 20."""
    u = F.col(url)
    return (pages.filter("page_id % 20 = 0")
            .select(canonical_url(host_of(u), path_of(u), u).alias("url")).filter("url <> ''"))


def op3_url_filter(spark, sf: str) -> DataFrame:
    """Verdict for every url of ``pages``: fixed rules, else the list of canonical URLs."""
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url")
    return url_filter(pages, stand_in_list(pages), RULES).select("page_id", "host", "path", "rule", "verdict")


_HOST = f"translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}')"
ORACLE = {"op3_url_filter": rf"""
with p as (select page_id, {_HOST} as host,
                  regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path,
                  regexp_extract(coalesce(url, ''), '(?s)^.*?://[^?#]*(\?[^#]*)', 1) as query from pages),
     c as (select *, regexp_replace(host, '^www\.', '') || regexp_replace(path, '/$', '') || query as canonical from p),
     rules(rule, verdict) as (values {", ".join(f"('{r}', '{v}')" for r, v in RULES.items())}),
     fits as (select page_id, arg_max(rule, length(rule)) as rule from
                (select distinct c.page_id, r.rule from c, rules r
                 where (host = split_part(rule, '/', 1) or ends_with(host, '.' || split_part(rule, '/', 1)))
                   and starts_with(path, substr(rule, strpos(rule, '/')))) group by page_id),
     listed as (select distinct canonical from c where page_id % 20 = 0 and canonical <> '')
select c.page_id, c.host, c.path, f.rule,
       case when f.rule is not null then r.verdict
            when c.canonical in (select canonical from listed) then 'block' else 'allow' end as verdict
from c left join fits f using (page_id) left join rules r on r.rule = f.rule
"""}
