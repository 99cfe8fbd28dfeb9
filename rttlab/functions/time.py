"""Time and small math scalars (E-3 … E-7). Column -> Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_to_timestamp(ts="ts") -> Column:
    """E-3: unix seconds -> TIMESTAMP (session TZ must be UTC)."""
    return F.timestamp_seconds(_c(ts))


def hour_of(ts="ts") -> Column:
    """Hour of day 0..23 as bigint."""
    return F.hour(ts_to_timestamp(ts)).cast("bigint")


def weekday_of(ts="ts") -> Column:
    """Day of week Monday=0 … Sunday=6 as bigint (pandas convention)."""
    return F.weekday(ts_to_timestamp(ts)).cast("bigint")


def day_index(ts="ts", t0=None) -> Column:
    """Day number since ``t0`` (1-based): floor((ts - t0) / 86400) + 1."""
    return (F.floor((_c(ts) - _c(t0)) / 86400) + 1).cast("bigint")


def loss_rate(sent="sent", rcvd="rcvd") -> Column:
    """E-5: (sent - rcvd) / sent * 100, 0 when nothing was sent."""
    s, r = _c(sent), _c(rcvd)
    return F.when(s > 0, (s - r).cast("double") / s * 100.0).otherwise(F.lit(0.0))


def pair_label(src="src", dst="dst") -> Column:
    """E-6: "src→dst" text label."""
    return F.concat_ws("→", _c(src).cast("string"), _c(dst).cast("string"))


def r6(c) -> Column:
    """E-7 style rounding used on every floating output (6 decimals)."""
    return F.round(_c(c), 6)
