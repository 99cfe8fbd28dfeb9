"""Substring deduplication of bytes with two-stage suffix arrays.

A shard's texts are joined with separators. Only the suffixes that are smaller
than their successors are sorted directly; all others are induced by a scan
over the buckets of first characters. Adjacent common prefixes of the finished
array tell which windows of the texts occur elsewhere.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import windows as W

WINDOW, GRAM = 400, 64
_CHUNK, _CHAR_BITS = 7, 9  # characters of 0..511 in one 63-bit key


def chunk_keys(x: np.ndarray) -> np.ndarray:
    """For every place, the next seven characters as one number; past the end come zeros."""
    padded = np.concatenate([x, np.zeros(_CHUNK, x.dtype)]).astype(np.int64)
    out = np.zeros(len(x), np.int64)
    for j in range(_CHUNK):
        out = out << _CHAR_BITS | padded[j:j + len(x)]
    return out


def smaller_than_next(x: np.ndarray) -> np.ndarray:
    """Whether the suffix at each place is smaller than the one after it (the empty suffix is the smallest)."""
    n = len(x)
    rises = np.zeros(n, bool)
    rises[:-1] = x[:-1] < x[1:]
    decides = np.ones(n, bool)
    decides[:-1] = x[:-1] != x[1:]
    at = np.where(decides, np.arange(n), n)
    return rises[np.minimum.accumulate(at[::-1])[::-1]]


def dense(values: np.ndarray) -> np.ndarray:
    """Rank of each value among the different values, from 1."""
    order = np.argsort(values)
    v = values[order]
    rank = np.empty(len(values), np.int64)
    rank[order] = np.cumsum(np.concatenate([[True], v[1:] != v[:-1]]))
    return rank


class Names:
    """Numbers that stand for the next 7 (``keys``) and 28 (``names``) characters at each place, in their order; zeros
    follow for ``depth`` places past the end."""

    STEP = 4 * _CHUNK

    def __init__(self, x: np.ndarray, depth: int):
        self.n = n = len(x)
        self.keys = chunk_keys(x)
        names, step = dense(self.keys), _CHUNK
        for _ in range(2):
            after = np.zeros(n, np.int64)
            after[:-step] = names[step:]
            names, step = dense(names * (n + 1) + after), 2 * step
        self.names = np.concatenate([names, np.zeros(depth + self.STEP, np.int64)])
        self.keys = np.concatenate([self.keys, np.zeros(depth + self.STEP, np.int64)])


def sort_directly(names: Names, places: np.ndarray, depth: int) -> np.ndarray:
    """``places`` ordered by their suffixes' first ``depth`` characters (at least)."""
    value = names.names[places]
    o = np.argsort(value)
    order, value = places[o], value[o]
    where, group, at = np.arange(len(order)), value, 0
    while True:
        new = np.ones(len(where), bool)
        new[1:] = group[1:] != group[:-1]
        alone = new & np.append(new[1:], True)
        where, group = where[~alone], np.cumsum(new)[~alone]
        at += Names.STEP
        if at >= depth or not len(where):
            return order
        k = group * (names.n + 1) + names.names[order[where] + at]
        o = np.argsort(k)
        order[where], group = order[where][o], k[o]


def suffix_array(x: np.ndarray, depth: int, names: Names | None = None) -> np.ndarray:
    """Places of ``x`` (characters 0..511) ordered by their suffixes, at least by the first ``depth`` characters."""
    n = len(x)
    if not n:
        return np.zeros(0, np.int64)
    x = x.astype(np.int16, copy=False)
    small = smaller_than_next(x)
    direct = sort_directly(names or Names(x, depth), np.flatnonzero(small), depth)
    top = int(x.max()) + 1
    cuts = np.searchsorted(x[direct], np.arange(top + 1))
    induced: list[list[np.ndarray]] = [[] for _ in range(top)]

    def induce(found: np.ndarray) -> None:
        """Put the larger predecessors of ``found`` at the ends of their buckets, in order."""
        before = found[found > 0] - 1
        before = before[~small[before]]
        if len(before):
            first = x[before]
            o = np.argsort(first, kind="stable")
            before, first = before[o], first[o]
            edge = np.flatnonzero(np.diff(first)) + 1
            for part in np.split(before, edge):
                induced[x[part[0]]].append(part)

    induce(np.array([n]))
    out = []
    for c in range(top):
        done = 0
        while done < len(induced[c]):  # a bucket can induce into itself
            part = induced[c][done]
            done += 1
            out.append(part)
            induce(part)
        part = direct[cuts[c]:cuts[c + 1]]
        if len(part):
            out.append(part)
            induce(part)
    return np.concatenate(out)


def adjacent_common(names: Names, order: np.ndarray, most: int) -> np.ndarray:
    """Length of the common prefix of each suffix with the one before it in ``order``: up to ``most``, and to the
    character where the last 28 before ``most`` decide; shorter ones in whole steps of 28.

    Every suffix ends in a character of its own text's end (0), so keys past the end compare as zeros.
    """
    out = np.zeros(len(order), np.int64)
    a, b, where, at = order[:-1], order[1:], np.arange(1, len(order)), 0
    while len(where) and at + Names.STEP <= most:  # whole names while they agree
        same = names.names[a + at] == names.names[b + at]
        out[where] = at
        a, b, where = a[same], b[same], where[same]
        at += Names.STEP
    # then keys, then the characters of the differing key
    while len(where) and at < most:
        out[where] = at
        d = names.keys[a + at] ^ names.keys[b + at]
        bits = np.frexp(np.where(d > 0, d, 1).astype(np.float64))[1]  # place of the highest differing bit
        same = d == 0
        out[where] += np.where(same, _CHUNK, (_CHUNK * _CHAR_BITS - bits) // _CHAR_BITS)
        a, b, where = a[same], b[same], where[same]
        at += _CHUNK
    out[where] = most
    return np.minimum(out, most)


def find_repeats(items: np.ndarray, offs: np.ndarray, copies: np.ndarray, length: int) -> np.ndarray:
    """Whether the window of ``length`` bytes at each place of the joined texts also starts anywhere else in them, a text
    standing for as many places as it has copies."""
    n = len(offs) - 1
    x = np.zeros(len(items) + n, np.int16)  # a separator, 0, ends each text
    text = np.repeat(np.arange(n), np.diff(offs))
    x[np.arange(len(items)) + text] = items.astype(np.int16) + 1
    names = Names(x, length)
    order = suffix_array(x, length, names)
    common = adjacent_common(names, order, length)
    weight = np.repeat(copies, np.diff(offs) + 1)  # of each place, separators included
    first = np.flatnonzero(common < length)  # suffixes that begin alike, for a window's length, are neighbours
    sums = np.add.reduceat(weight[order], first) if len(order) else np.zeros(0, np.int64)
    hit = np.zeros(len(x), bool)
    hit[order] = np.repeat(sums > 1, np.diff(np.append(first, len(order))))
    inside = np.arange(len(items)) + length <= np.repeat(offs[1:], np.diff(offs))
    return hit[np.arange(len(items)) + text] & inside


def byte_unit(length: int = WINDOW, gram: int = GRAM) -> W.Unit:
    return W.Unit("byte", length, gram, "u1", find_repeats)


def suffix_dedup(docs: DataFrame, text: str = "text", length: int = WINDOW, gram: int = GRAM, hot_texts: int = W.HOT_TEXTS) -> DataFrame:
    """``docs`` without ``text``, with ``kept`` (remaining bytes), ``kept_text`` (the characters all of whose bytes remain),
    ``n_bytes``, ``n_removed`` and ``n_spans``.

    Every byte covered by a string of ``length`` bytes that starts at another
    place too is removed, judged on the input; matches never cross rows. Null
    and empty texts keep nothing and lose nothing. Rows that repeat each other
    remove each other's bytes; an empty table gives an empty table; columns
    named like an output are replaced.
    """
    unit = byte_unit(length, gram)

    def make(data: bytes, spans):
        kept, whole, at, end = [], [], 0, 0
        for a, e in spans:
            kept.append(data[at:a])
            whole.append(data[end:_character(data, a)])
            at, end = e, _character(data, e, 1)
        kept, whole = (b"".join([*x, data[y:]]) for x, y in ((kept, at), (whole, end)))
        return kept, whole.decode("utf-8", "replace"), len(data), len(data) - len(kept), len(spans)

    return W.remove(docs, text, unit, make, [("kept", "binary"), ("kept_text", "string"), ("n_bytes", "long"), ("n_removed", "long"),
                                             ("n_spans", "long")], hot_texts)


def _character(data: bytes, at: int, step: int = -1) -> int:
    """The edge of a UTF-8 character next to ``at``, backwards or forwards."""
    while 0 < at < len(data) and data[at] & 0xC0 == 0x80:
        at += step
    return at


def op6_suffix_array_dedup(spark, sf: str) -> DataFrame:
    """Bytes of ``documents`` inside 400-byte strings that occur elsewhere, removed; ``text``: the characters that remain whole."""
    out = suffix_dedup(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), F.col("kept_text").alias("text"))


ORACLE = {"op6_suffix_array_dedup": rf"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as text, encode(coalesce(text, '')) as b,
                  strlen(coalesce(text, ''))::bigint as n from documents),
win as (select r, i, md5(b[i + 1:i + {WINDOW}]) as m from (select r, b, unnest(range(0, n - {WINDOW - 1})) as i from d where n >= {WINDOW})),
hits as (select r, i, lag(i) over (partition by r order by i) as prev from win where m in (select m from win group by m having count(*) > 1)),
runs as (select r, min(i) as a, max(i) + {WINDOW} as e from
         (select r, i, sum((prev is null or i > prev + {WINDOW})::int) over (partition by r order by i) as run from hits) group by r, run),
edges as (select r, a, e, coalesce(lag(e) over (partition by r order by a), 0) as before, lead(a) over (partition by r order by a) as after from runs),
kept as (select d.r, string_agg(substr(hex(d.b), (2 * before + 1)::bigint, (2 * (a - before))::bigint)
                                || case when after is null then substr(hex(d.b), (2 * e + 1)::bigint) else '' end, '' order by a) as h,
                sum(e - a)::bigint as n_removed, count(*) as n_spans from edges join d using (r) group by d.r),
chars as (select r, c, k, sum(strlen(c)) over (partition by r order by k) as e from
          (select r, unnest(cs) as c, unnest(range(1, len(cs) + 1)) as k
           from (select r, regexp_extract_all(text, '(?s).') as cs from d where r in (select r from runs)))),
cut as (select distinct c.r, c.k from chars c join runs using (r) where runs.a < c.e and runs.e > c.e - strlen(c.c)),
whole as (select c.r, string_agg(c.c, '' order by c.k) filter (cut.k is null) as t from chars c left join cut on cut.r = c.r and cut.k = c.k group by c.r)
select doc_id, n as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
       sha256(case when kept.r is null then b else unhex(h) end) as kept_sha256,
       case when kept.r is null then text else coalesce(whole.t, '') end as text
from d left join kept using (r) left join whole using (r)
"""}
