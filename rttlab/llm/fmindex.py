"""Substring deduplication of words with FM-indexes.

Each shard's texts become a compressed FM-index: the Burrows-Wheeler transform
in a wavelet tree of packed bit vectors. Texts are streamed against it by
backward search, all texts of a shard at once; the matching statistics at the
searched places tell which windows occur elsewhere.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import spans as S
from . import windows as W

WINDOW, GRAM = 35, 10


class Bits:
    """Bit vector in 64-bit words with the number of ones before each word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        ones = np.bitwise_count(self.words).astype(np.uint32)
        self.before = np.concatenate([[0], np.cumsum(ones)[:-1]]).astype(np.uint32)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word].astype(np.int64) + np.bitwise_count(self.words[word] & low)


class WaveletTree:
    """Ranks of symbols in a sequence; one bit vector a level, the nodes of a level lie side by side."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.levels = max(1, int(n_symbols - 1).bit_length())
        self.bits: list[Bits] = []
        self.zeros: list[int] = []
        for level in reversed(range(self.levels)):
            bit = (symbols >> level & 1).astype(np.uint8)
            self.bits.append(Bits(bit))
            self.zeros.append(int(len(bit) - bit.sum()))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where place ``at`` leads to on the way down to ``symbol``; differences of it are ranks."""
        for i, (bits, zeros) in enumerate(zip(self.bits, self.zeros, strict=True)):
            ones = bits.rank(at)
            at = np.where(symbol >> (self.levels - 1 - i) & 1 == 1, zeros + ones, at - ones)
        return at


def suffix_order(x: np.ndarray, depth: int) -> np.ndarray:
    """Places ordered by at least ``depth`` symbols: by three at first, then by doubling, of those not yet told apart."""
    n = len(x)
    m = int(x.max(initial=0)) + 2
    known = 3 if m < 1 << 20 else 1
    key = np.zeros(n, np.int64)
    padded = np.concatenate([x.astype(np.int64) + 1, np.zeros(known, np.int64)])
    for j in range(known):
        key = key * m + padded[j:j + n]
    order = np.argsort(key)
    sorted_key = key[order]
    new = np.ones(n, bool)
    new[1:] = sorted_key[1:] != sorted_key[:-1]
    rank = np.zeros(n + 2 * depth + 2, np.int64)  # place of the group in the order, from 1; zeros past the end
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0)) + 1
    slots = np.flatnonzero(~(new & np.append(new[1:], True))) if n else np.zeros(0, np.int64)  # in groups of several
    while known < depth and len(slots):
        at = order[slots]
        group, next_ = rank[at], rank[at + known]
        o = np.argsort(group * (n + 1) + next_)
        at, group, next_ = at[o], group[o], next_[o]
        order[slots] = at
        new = np.ones(len(slots), bool)
        new[1:] = (group[1:] != group[:-1]) | (next_[1:] != next_[:-1])
        rank[at] = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))] + 1
        slots = slots[~(new & np.append(new[1:], True))]
        known *= 2
    return order


class FMIndex:
    """Backward search over a sequence of symbols 0..n_symbols-1, correct for patterns of up to ``depth`` symbols."""

    def __init__(self, x: np.ndarray, n_symbols: int, depth: int, weight: np.ndarray):
        order = suffix_order(x, depth + 1)
        self.weight = np.concatenate([[0], np.cumsum(weight[order])])  # of the places before each row
        self.tree = WaveletTree(x[order - 1], n_symbols)  # the symbol before each suffix; the first wraps around
        self.before = np.concatenate([[0], np.cumsum(np.bincount(x, minlength=n_symbols))]).astype(np.int64)
        start = np.zeros(n_symbols, np.int64)
        self.origin = self.tree.descend(np.arange(n_symbols), start)
        self.n = len(x)

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with ``symbol`` put before them; both ends go down the tree together."""
        base = self.before[symbol] - self.origin[symbol]
        down = self.tree.descend(np.concatenate([symbol, symbol]), np.concatenate([lo, hi]))
        return base + down[:len(lo)], base + down[len(lo):]


def find_repeats(items: np.ndarray, offs: np.ndarray, copies: np.ndarray, length: int) -> np.ndarray:
    """Whether the window of ``length`` words at each place of the texts also starts anywhere else, a text standing for
    as many places as it has copies.

    From the end of a window the match is extended to the left while it occurs
    twice. If it ends after d words, the word before it is the first that no
    later window with a match may contain together with this end: the search
    goes on behind it. Where a window matched, and in texts with copies, the
    search starts some windows further on; if the match then reaches back to the
    first, all of them occur twice, else they are searched one by one.
    """
    n = len(offs) - 1
    _, ids = np.unique(items, return_inverse=True)
    text = np.repeat(np.arange(n), np.diff(offs))
    n_words = int(ids.max()) + 1 if len(ids) else 0
    x = np.zeros(len(items) + n, np.int64)  # a separator, 0, ends each text
    x[np.arange(len(items)) + text] = ids + 1
    most = (1 << int(length).bit_length()) - 1 - length  # windows ahead that cost the index no further round of sorting
    index = FMIndex(x, n_words + 1, length + most, np.repeat(copies, np.diff(offs) + 1))
    found = np.zeros(len(items) + 1, np.int64)  # +1 where a run of matching windows begins, -1 behind it
    rows = np.flatnonzero(np.diff(offs) >= length)
    window, stop = offs[rows], offs[rows + 1] - length  # next window start, last window start
    ahead = np.where(copies[rows] > 1, np.minimum(most, stop - window), 0)
    depth, lo, hi = (np.zeros(len(rows), np.int64) for _ in range(3))
    while len(window):
        at = window + ahead + length - 1 - depth
        symbol, more = ids[at] + 1, np.flatnonzero(depth)
        low, high = index.extend(symbol[more], lo[more], hi[more])
        lo, hi = index.before[symbol], index.before[symbol + 1]  # of patterns of one word
        lo[more], hi[more] = low, high
        ends = index.weight[hi] - index.weight[lo] < 2  # found nowhere but here
        depth = depth + ~ends
        whole = depth == length + ahead
        found[window[whole]] += 1
        np.subtract.at(found, window[whole] + ahead[whole] + 1, 1)
        single = ends & (ahead == 0)
        window = np.where(single, at + 1, np.where(whole, window + ahead + 1, window))
        again = ends | whole
        ahead = np.where(whole, np.minimum(most, stop - window), np.where(ends, 0, ahead))
        depth[again] = 0
        go = window <= stop
        window, stop, ahead, depth, lo, hi = window[go], stop[go], ahead[go], depth[go], lo[go], hi[go]
    return np.cumsum(found[:-1]) > 0


def word_unit(length: int = WINDOW, gram: int = GRAM) -> W.Unit:
    return W.Unit("word", length, gram, "<u8", find_repeats)


def _kept_words(data: bytes, spans) -> tuple[list[bytes], int]:
    words = data.split()  # ASCII white space
    kept, at = [], 0
    for a, e in spans:
        kept += words[at:a]
        at = e
    return kept + words[at:], len(words)


def substring_dedup(docs: DataFrame, text: str = "text", length: int = WINDOW, gram: int = GRAM, hot_texts: int = W.HOT_TEXTS) -> DataFrame:
    """``docs`` without ``text``, with ``kept`` (remaining words joined by one space), ``n_words`` and ``n_removed``.

    Every word covered by a window of ``length`` words that starts at another
    place too is removed, judged on the input; words are compared unchanged
    and windows never cross rows. Null and empty texts have no words. Rows that
    repeat each other remove each other's words; an empty table gives an empty
    table; columns named like an output are replaced.
    """
    unit = word_unit(length, gram)

    def make(data: bytes, spans):
        kept, n = _kept_words(data, spans)
        return b" ".join(kept).decode("utf-8", "replace"), n, n - len(kept)

    return W.remove(docs, text, unit, make, [("kept", "string"), ("n_words", "long"), ("n_removed", "long")], hot_texts)


def remove_substrings(docs: DataFrame, text: str = "text", length: int = WINDOW, gram: int = GRAM, hot_texts: int = W.HOT_TEXTS) -> DataFrame:
    """``docs`` with repeated windows taken out of ``text``; a text that loses nothing stays as it is (null as well)."""
    packed = S.hide(docs, text=text).withColumn("whole", F.col("text"))
    out = substring_dedup(packed, "text", length, gram, hot_texts)
    out = out.withColumn("text", F.when(F.col("n_removed") == 0, F.col("whole")).otherwise(F.col("kept")))
    return out.select(*S.unhide(out, docs.columns, text=text))


def op7_substring_dedup(spark, sf: str) -> DataFrame:
    """Words of ``documents`` inside windows of 35 words that occur elsewhere, removed."""
    out = substring_dedup(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = {"op7_substring_dedup": rf"""
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
d as (select row_number() over () as r, doc_id, w, len(w) as n from w),
win as (select r, i, md5(array_to_string(w[i:i + {WINDOW - 1}], ' ')) as m
        from (select r, w, unnest(range(1, n - {WINDOW - 2})) as i from d where n >= {WINDOW})),
twice as (select m from win group by m having count(*) > 1),
gone as (select distinct r, i + k as i from win join twice using (m), range(0, {WINDOW}) t(k)),
kept as (select d.r, string_agg(d.w[p.i], ' ' order by p.i) filter (g.i is null) as t, count(g.i) as n_removed
         from (select r, unnest(range(1, n + 1)) as i from d) p join d using (r) left join gone g on g.r = p.r and g.i = p.i group by d.r)
select doc_id, n::bigint as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(t, '')) as kept_sha256
from d left join kept using (r)
"""}
