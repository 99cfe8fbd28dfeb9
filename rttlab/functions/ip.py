"""IP address scalars (F-1 … F-5) as native column expressions.

IPv4 integers use 0 for "not IPv4 / invalid" (the reference convention).
Unlike the reference we range-check octets: a part outside 0..255 makes
the address invalid (0).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_ipv6(ip) -> Column:
    """F-1: an address is IPv6 when it contains ':'."""
    return F.contains(_c(ip), F.lit(":"))


# Textual address patterns.
V6_FULL_RE = r"^([0-9a-f]{1,4}:){7}[0-9a-f]{1,4}$"


def _octets(ip: Column) -> list[Column]:
    """The four dot-separated parts as bigint (NULL when not an integer);
    plain string slicing, no regex engine per row."""
    return [F.substring_index(ip, ".", 1).try_cast("bigint"),
            F.substring_index(F.substring_index(ip, ".", 2), ".", -1).try_cast("bigint"),
            F.substring_index(F.substring_index(ip, ".", 3), ".", -1).try_cast("bigint"),
            F.substring_index(ip, ".", -1).try_cast("bigint")]


def ipv4_valid(ip) -> Column:
    """True when ``ip`` is a dotted quad of four integers in 0..255."""
    ip = _c(ip)
    ok = (F.length(ip) - F.length(F.replace(ip, F.lit("."), F.lit(""))) == 3) & ~F.contains(ip, F.lit(":"))
    for o in _octets(ip):
        ok = ok & o.isNotNull() & o.between(0, 255)
    return F.coalesce(ok, F.lit(False))


def ipv4_to_int(ip) -> Column:
    """F-2: dotted quad -> a*2^24 + b*2^16 + c*2^8 + d as LongType; else 0.
    String slicing only, so the expression stays cheap and inside codegen."""
    ip = _c(ip)
    a, b, c, d = _octets(ip)
    return F.when(ipv4_valid(ip), a * 16777216 + b * 65536 + c * 256 + d) \
            .otherwise(F.lit(0).cast("bigint"))


def int_to_ipv4(x) -> Column:
    """F-3: LongType -> dotted quad; NULL when the value is NULL or 0."""
    x = _c(x)
    t = F.concat_ws(".", F.floor(x / 16777216).cast("string"), (F.floor(x / 65536) % 256).cast("string"),
                    (F.floor(x / 256) % 256).cast("string"), (x % 256).cast("string"))
    return F.when(x.isNotNull() & (x > 0), t)


def _ipv6_steps(ip: Column):
    """The steps of F-4: yields (name, expression), and is sent what stands for it in later steps, which use it several times."""
    s = yield "_v6_text", F.lower(ip)
    tail = yield "_v6_tail", F.substring_index(s, ":", -1)
    v4_tail = F.contains(tail, F.lit("."))
    v4 = ipv4_to_int(tail)
    hex_tail = F.concat(F.lpad(F.hex(F.floor(v4 / 65536)), 4, "0"), F.lit(":"), F.lpad(F.hex(v4 % 65536), 4, "0"))
    # an embedded dotted IPv4 tail (``::ffff:1.2.3.4``) becomes two hex groups; one that does not parse spoils the text
    s2 = yield "_v6_hex", F.when(v4_tail & ipv4_valid(tail), F.concat(F.substring(s, F.lit(1), F.length(s) - F.length(tail)), hex_tail)) \
                           .when(~v4_tail, s)
    fill = yield "_v6_fill", F.lit(8) - F.regexp_count(s2, F.lit("[0-9a-f]+"))
    # '::' stands for the missing zero groups
    zeros = F.concat(F.lit(":"), F.repeat(F.lit("0:"), F.greatest(fill, F.lit(0))))
    one = (F.regexp_count(s2, F.lit("::")) == 1) & (fill >= 1)
    expanded = yield "_v6_groups", F.when(one, F.regexp_replace(F.regexp_replace(s2, "::", zeros), "^:|:$", "")).otherwise(s2)
    # every group is left-padded to four digits with two regex replacements
    padded = F.regexp_replace(F.regexp_replace(F.concat(F.lit(":"), expanded), ":", ":000"), ":0*([0-9a-f]{4})", "$1")
    valid = expanded.rlike(V6_FULL_RE) & ~F.contains(s2, F.lit(":::"))
    yield "", F.when(F.coalesce(valid, F.lit(False)), F.unhex(padded))


def ipv6_to_bytes(ip) -> Column:
    """F-4: textual IPv6 -> 16 packed bytes; IPv4, invalid or NULL -> NULL. One expression, in which the steps are
    repeated; for a column of a table :func:`with_ipv6_bytes` plans less."""
    steps = _ipv6_steps(_c(ip))
    name, expression = next(steps)
    while name:
        name, expression = steps.send(expression)
    return expression


def with_ipv6_bytes(df: DataFrame, ip: str, out: str) -> DataFrame:
    """F-4 as a column ``out`` of ``df``.

    The steps are columns of their own, so that Catalyst computes each once
    and the plan does not repeat them; they are dropped at the end.
    """
    columns = [c for c in df.columns if c != out]
    steps = _ipv6_steps(F.col(ip))
    name, expression = next(steps)
    while name:
        df = df.withColumn(name, expression)
        name, expression = steps.send(F.col(name))
    return df.select(*columns, expression.alias(out))


def dst_addr_display(dst_is_v6="dst_is_ipv6", dst_addr="dst_addr",
                     dst_int="dst_ipv4_int") -> Column:
    """F-5 (destination): original text for IPv6, dotted quad for IPv4."""
    return F.when(_c(dst_is_v6), _c(dst_addr)).otherwise(int_to_ipv4(dst_int))


def src_addr_display(src_is_v6="src_is_ipv6", src_int="src_ipv4_int") -> Column:
    """F-5 (source): NULL for IPv6 sources, dotted quad for IPv4."""
    return F.when(F.coalesce(_c(src_is_v6), F.lit(False)), F.lit(None).cast("string")) \
            .otherwise(int_to_ipv4(src_int))
