"""JSON scalars over the ping ``result`` text (E-1, E-2). Column -> Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RTT_ARRAY = "array<struct<rtt:double>>"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rtt_at(result, i: int, dtype: str = "double") -> Column:
    """``$[i].rtt`` of the result array (0-based); lost packet, short list
    or malformed text give NULL."""
    return F.get_json_object(_c(result), f"$[{i}].rtt").try_cast(dtype)


def extract_rtts(result="result", n: int = 3, dtype: str = "double",
                 prefix: str = "rtt_") -> list[Column]:
    """First ``n`` rtts as columns ``rtt_1..rtt_n`` (E-1)."""
    return [rtt_at(result, i, dtype).alias(f"{prefix}{i + 1}") for i in range(n)]


def rtts_array(result="result") -> Column:
    """The result text parsed once into ``array<struct<rtt:double>>`` (E-2)."""
    return F.from_json(_c(result), RTT_ARRAY)


def rtts_from_array(arr, n: int = 3, dtype: str = "double",
                    prefix: str = "rtt_") -> list[Column]:
    """``rtt_1..rtt_n`` from a parsed array; ``get`` returns NULL out of range."""
    a = _c(arr)
    return [F.get(a, i).getField("rtt").cast(dtype).alias(f"{prefix}{i + 1}")
            for i in range(n)]
