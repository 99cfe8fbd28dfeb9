"""Vectorised text helpers for Arrow batches: byte spans of words and lines,
and rolling hashes of spans.

Texts stay UTF-8 bytes in one numpy buffer with row offsets, so that a batch
of documents is handled by a fixed number of numpy calls. Batches are cut into
blocks of at most ``BLOCK_BYTES``; a longer single text is a block of its own
(whole texts, never prefixes).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 512 << 10
BATCH_ROWS, BATCH_BYTES = 1_000, 8 << 20  # of an Arrow batch

U64 = np.uint64
_MIX1, _MIX2 = U64(0xFF51AFD7ED558CCD), U64(0xC4CEB9FE1A85EC53)

# white space of the word pattern [^\x20\x09-\x0D]+
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def map_batches(df: DataFrame, run, schema) -> DataFrame:
    """``df.mapInArrow`` in batches of at most BATCH_ROWS rows and (but for one longer row) BATCH_BYTES bytes.

    The limits are settings of the session and stay set: they count when the result is computed.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def hide(docs: DataFrame, **used: str) -> DataFrame:
    """``docs`` as the columns named by the keys of ``used`` (from its columns of the values) and one struct ``rest`` of all
    others, whose names then cannot clash with any that an operator makes up."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in used.values()]
    return docs.select(*[F.col(f"`{c}`").alias(n) for n, c in used.items()], (F.struct(*rest) if rest else F.lit(True)).alias("rest"))


def unhide(rows: DataFrame, columns: list[str], **used: str) -> list[Column]:
    """The columns of :func:`hide`'s input, by their names and in their order."""
    back = {c: n for n, c in used.items()}
    return [F.col(back[c]).alias(c) if c in back else F.col("rest").getField(c).alias(c) for c in columns]


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offs = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1] \
        if len(column) else np.zeros(1, np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    lo = offs[0]
    return data[lo:offs[-1]], offs - lo


def blocks(offs: np.ndarray, limit: int = BLOCK_BYTES):
    """Row ranges (i, j) whose texts hold at most ``limit`` bytes together."""
    n, i = len(offs) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def word_spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (bytes) of all words, and the word offsets of the rows."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offs), np.int64)
    word = ~IS_SPACE[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    last = word.copy()
    last[:-1] &= ~word[1:]
    cut = offs[:-1][offs[:-1] < n]  # rows never share a word
    first[cut] = word[cut]
    cut = offs[1:][offs[1:] > 0] - 1
    last[cut] = word[cut]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offs)


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U64(33))
    x *= _MIX1
    x ^= x >> U64(29)
    x *= _MIX2
    x ^= x >> U64(32)
    return x


class Rolling:
    """Polynomial rolling hash modulo 2**64 over bytes or 64-bit items.

    Every byte is first mapped to a random 64-bit number; a span's hash does
    not depend on where the span lies.
    """

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.table = rng.integers(0, 1 << 63, 256, dtype=U64) * U64(2) + U64(1)
        self.base = int(rng.integers(1 << 62, 1 << 63)) * 2 + 1 | 4  # odd, 5 mod 8
        self.base = (self.base & ~7) | 5
        self.back = pow(self.base, -1, 1 << 64)
        self.up = self.down = np.ones(1, U64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 1 << 16)
            for name, x in (("up", self.base), ("down", self.back)):
                p = np.full(n, U64(x))
                p[0] = 1
                setattr(self, name, np.cumprod(p, dtype=U64))

    def of_bytes(self, data: np.ndarray) -> np.ndarray:
        return self.of_items(self.table[data])

    def of_items(self, items: np.ndarray) -> np.ndarray:
        """Prefix hashes, one more than items."""
        n = len(items)
        self._powers(n + 1)
        out = np.zeros(n + 1, U64)
        np.cumsum(items * self.up[:n], out=out[1:])
        return out

    def raw(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of spans before mixing: for tables that spread keys themselves."""
        return (prefix[end] - prefix[start]) * self.down[start]

    def span(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        x = (prefix[end] - prefix[start]) * self.down[start]
        return mix(x ^ ((end - start).astype(U64) * U64(0x9E3779B97F4A7C15)))


def mixed_span(roll: Rolling, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the same spans that is independent of :meth:`Rolling.span` in all but the polynomial."""
    return mix(roll.raw(prefix, start, end) * U64(0xD6E8FEB86659FD93) + (end - start).astype(U64))


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(occurs twice or more, equals an earlier one) for each key."""
    n = len(keys)
    twice, later = np.zeros(n, bool), np.zeros(n, bool)
    if n > 1:
        order = np.argsort(keys, kind="stable")
        s = keys[order]
        same = s[1:] == s[:-1]
        later[order[1:][same]] = True
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
    return twice, later


def fill(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of many ranges, one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(total)


def same_spans(items: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the ``size`` items from ``a`` equal those from ``b``, for each pair of places."""
    out = np.ones(len(a), bool)
    some = np.flatnonzero(size > 0)
    if len(some):
        differ = items[fill(a[some], size[some])] != items[fill(b[some], size[some])]
        first = np.cumsum(size[some]) - size[some]
        out[some] = np.add.reduceat(differ, first, dtype=np.int64) == 0
    return out


def exact_groups(keys: np.ndarray, items: np.ndarray, start: np.ndarray, size, owner: np.ndarray | None = None) -> np.ndarray:
    """Numbers that are equal just where the spans of ``items`` (and their owners) are.

    ``keys`` are hashes of the spans: equal spans of one owner have equal keys.
    Every span is compared with the first of its key; those that differ from it
    in spite of the key are told apart by their items.
    """
    n = len(keys)
    size = np.broadcast_to(np.asarray(size, np.int64), n)
    out = np.zeros(n, np.int64)
    if not n:
        return out
    order = np.argsort(keys, kind="stable")
    new = np.ones(n, bool)
    new[1:] = keys[order[1:]] != keys[order[:-1]]
    group = np.cumsum(new) - 1
    out[order] = group
    later, first = order[~new], order[np.flatnonzero(new)][group[~new]]
    same = size[later] == size[first]
    if owner is not None:
        same &= owner[later] == owner[first]
    at = np.flatnonzero(same)
    same[at] = same_spans(items, start[later[at]], start[first[at]], size[later[at]])
    apart: dict[tuple, int] = {}
    for k in later[~same].tolist():
        span = items[start[k]:start[k] + size[k]].tobytes()
        out[k] = apart.setdefault((None if owner is None else int(owner[k]), span), n + len(apart))
    return out


LONG_WORD = 48  # bytes; the polynomial hash of longer words has constructible collisions


def word_hashes(roll: Rolling, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of words: polynomial for short ones, XXH3 for those over ``LONG_WORD`` bytes."""
    out = roll.span(roll.of_bytes(data), start, end)
    for k in np.flatnonzero(end - start > LONG_WORD).tolist():
        out[k] = xxhash.xxh3_64_intdigest(data[start[k]:end[k]])
    return out


def covered(n: int, starts: np.ndarray, width: int) -> np.ndarray:
    """Which of n items lie in a window of ``width`` items from one of ``starts`` (distinct)."""
    step = np.zeros(n + 1, np.int32)
    step[starts] = 1
    step[starts + width] -= 1
    return np.cumsum(step)[:n] > 0


def row_sums(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sum of ``values`` for each row of item offsets."""
    c = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=c[1:])
    return c[offs[1:]] - c[offs[:-1]]
