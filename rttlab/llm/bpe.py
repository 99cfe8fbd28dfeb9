"""Byte-level BPE by dynamic programming over prefixes.

For every byte prefix of a piece there is exactly one token that its encoding
ends with. ``last[p]`` is found from shorter prefixes: the token ``t`` that is a
suffix of the prefix and that merging would leave beside ``last[p - len(t)]``.
So appends continue where the table ends, and an edit re-encodes only from the
edited place until the table agrees with the old one again. Whole Arrow
batches are handled in numpy: all new distinct pieces of a block together,
one prefix length after the other.
"""

from __future__ import annotations

import base64
import hashlib
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import spans as S

NONE = 1 << 31  # no token
LONG_PIECE = 64  # bytes; longer pieces take the scalar table
MAX_CACHE = 400_000  # distinct pieces that a Python worker remembers
MAX_CACHE_BYTES = 32 << 20  # and the most that their bytes and ids come to, before a block
SHORT_CONTRACTIONS, LONG_CONTRACTIONS = b"stmd", (b"re", b"ve", b"ll")

_OTHER, _LETTER, _NUMBER, _SPACE = range(4)
# Code points with the Unicode property White_Space.
WHITE_SPACE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabulary files write for the 256 bytes."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a rank file (base64 and number a line) or a tokenizer JSON with byte-level BPE.

    Added tokens of a JSON (special tokens) are left out: their strings in a text are ordinary text.
    """
    if path.endswith(".json"):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"] for t in spec.get("added_tokens", ())}
        of = byte_alphabet()
        return {bytes(of[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class KeyTable:
    """Values of 64-bit keys: keys are sorted by slot, so that most lookups of unknown keys end at an empty slot."""

    BITS = 20

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        keys = keys.astype(np.uint64)
        slot = self._slot(keys)
        order = np.argsort(slot, kind="stable")
        self.keys, self.values = keys[order], values[order]
        self.first = np.searchsorted(slot[order], np.arange((1 << self.BITS) + 1)).astype(np.int32)
        self.depth = int(np.diff(self.first).max(initial=0))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Value of each key, NONE for unknown ones."""
        keys = keys.astype(np.uint64, copy=False)
        slot = self._slot(keys)
        at = self.first[slot]
        out = np.full(len(keys), NONE, np.int64)
        some = np.flatnonzero(self.first[slot + 1] > at)
        for k in range(self.depth):
            pos = np.minimum(at[some] + k, len(self.keys) - 1)
            hit = self.keys[pos] == keys[some]
            out[some[hit]] = self.values[pos[hit]]
            some = some[~hit]
        return out


class Vocabulary:
    """Ranks, and for each token the two it was merged from."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        n = max(ranks.values()) + 1
        self.tokens = [b""] * n
        for t, i in ranks.items():
            self.tokens[i] = t
        self.left = np.arange(n, dtype=np.int64)
        self.right = np.arange(n, dtype=np.int64)
        self.usable = np.zeros(n, bool)  # reached by merges
        for t, i in ranks.items():
            parts = self._parts(t, i)
            self.usable[i] = parts is not None
            if parts is not None and len(parts) == 2:
                self.left[i], self.right[i] = ranks[parts[0]], ranks[parts[1]]
        merged = np.flatnonzero(self.left != np.arange(n))
        self.pair_of = {(int(a), int(b)): int(i) for i, a, b in zip(merged, self.left[merged], self.right[merged], strict=True)}
        self.pairs = KeyTable(self.left[merged] << 32 | self.right[merged], merged)
        self.size = np.array([len(t) for t in self.tokens], np.int64)
        self.flat = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.start = np.concatenate([[0], np.cumsum(self.size)])
        self.roll = S.Rolling(41)
        ids = np.flatnonzero(self.usable & (self.size > 0))
        h = self.roll.raw(self.roll.of_bytes(self.flat), self.start[ids], self.start[ids] + self.size[ids])
        self.by_hash = KeyTable(h, ids)
        self.lengths = [int(x) for x in np.unique(self.size[ids])]

    def _parts(self, token: bytes, rank: int) -> list[bytes] | None:
        """What merging leaves of ``token`` when its own merge is not allowed; None if it would not come to it."""
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best = min(((self.ranks.get(parts[i] + parts[i + 1], NONE), i) for i in range(len(parts) - 1)))
            if best[0] >= rank:
                return None
            i = best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def stays(self, a: int, b: int) -> bool:
        """Whether merging leaves token ``b`` right after token ``a``.

        The last merges of both are undone, latest first; nothing that was
        mergeable across the border may come before the merge undone last.
        """
        limit = NONE
        while True:
            if self.pair_of.get((a, b), NONE) < limit:
                return False
            undo_a = a > b
            for _ in range(2):
                if undo_a:
                    limit, inner = a, int(self.right[a])
                    if inner != a:
                        a = inner
                        break
                else:
                    limit, inner = b + 1, int(self.left[b])
                    if inner != b:
                        b = inner
                        break
                undo_a = not undo_a
            else:
                return True

    def all_stay(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """:meth:`stays` for arrays."""
        out = np.ones(len(a), bool)
        todo = np.arange(len(a))
        a, b = a.copy(), b.copy()
        limit = np.full(len(a), NONE, np.int64)
        while len(todo):
            wrong = self.pairs.find(a << 32 | b) < limit
            out[todo[wrong]] = False
            ra, lb = self.right[a], self.left[b]
            base_a, base_b = ra == a, lb == b
            undo_a = np.where(a > b, ~base_a, base_b & ~base_a)
            ended = base_a & base_b
            limit = np.where(undo_a, a, b + 1)
            a, b = np.where(undo_a, ra, a), np.where(undo_a, b, lb)
            go = ~(wrong | ended)
            todo, a, b, limit = todo[go], a[go], b[go], limit[go]
        return out


class PrefixTable:
    """The unique last token of every prefix of one piece; grows by appends and follows edits."""

    def __init__(self, vocabulary: Vocabulary, piece: bytes = b""):
        self.v, self.piece, self.last = vocabulary, b"", [NONE]
        self.append(piece)

    def _last_token(self, p: int) -> int:
        v = self.v
        for n in reversed(v.lengths):
            if n > p:
                continue
            t = v.ranks.get(self.piece[p - n:p])
            if t is not None and v.usable[t] and (n == p or v.stays(self.last[p - n], t)):
                return t
        raise ValueError("the vocabulary lacks a byte")

    def append(self, more: bytes) -> None:
        self.piece += more
        for p in range(len(self.last), len(self.piece) + 1):
            self.last.append(self._last_token(p))

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Put ``new`` for bytes [start, end); how many prefixes were worked out anew.

        Prefixes before the edit stay. Behind it, once as many prefixes in a
        row as the longest token has bytes have the last tokens they had, all
        later ones keep theirs as well.
        """
        tail = self.last[end + 1:]
        self.piece = self.piece[:start] + new + self.piece[end:]
        del self.last[start + 1:]
        same, longest = 0, self.v.lengths[-1]
        for p in range(start + 1, len(self.piece) + 1):
            t = self._last_token(p)
            self.last.append(t)
            old = p - (start + len(new)) - 1
            same = same + 1 if old >= 0 and tail[old] == t else 0
            if same >= longest:
                self.last += tail[old + 1:]
                return p - start
        return len(self.piece) - start

    def ids(self) -> list[int]:
        out, p = [], len(self.piece)
        while p:
            out.append(self.last[p])
            p -= len(self.v.tokens[out[-1]])
        return out[::-1]


@lru_cache(1)
def _classes() -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        k = unicodedata.category(chr(c))[0]
        if k == "L":
            table[c] = _LETTER
        elif k == "N":
            table[c] = _NUMBER
    table[WHITE_SPACE] = _SPACE
    return table


def byte_classes(data: np.ndarray) -> np.ndarray:
    """Class of the character that each byte of a UTF-8 text belongs to."""
    table = _classes()
    out = table[:128][data & 0x7F]
    high = np.flatnonzero(data >= 0xC0)
    if len(high):
        d = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.int32)
        b = d[high]
        code = np.where(b < 0xE0, (b & 0x1F) << 6 | d[high + 1] & 0x3F,
                        np.where(b < 0xF0, (b & 0x0F) << 12 | (d[high + 1] & 0x3F) << 6 | d[high + 2] & 0x3F,
                                 (b & 0x07) << 18 | (d[high + 1] & 0x3F) << 12 | (d[high + 2] & 0x3F) << 6 | d[high + 3] & 0x3F))
        k = table[np.minimum(code, 0x10FFFF)]
        out[high] = k
        for extra, least in ((1, 0xC0), (2, 0xE0), (3, 0xF0)):
            wide = b >= least
            at = high[wide] + extra
            ok = at < len(out)
            out[at[ok]] = k[wide][ok]
    return out


def piece_starts(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Where the matches of public_tokenizers.PATTERN start, in all rows; rows never share a piece."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    kind = byte_classes(data)
    row_start = np.zeros(n + 1, bool)
    row_start[offs] = True
    new = row_start[:n].copy()
    new[1:] |= kind[1:] != kind[:-1]
    start = new.copy()
    runs = np.flatnonzero(new)
    ends = np.append(runs[1:], n)
    # a run of spaces before something else gives its last character away
    space = (kind[runs] == _SPACE) & ~row_start[ends]
    last = ends[space] - 1
    while (inner := (data[last] & 0xC0) == 0x80).any():
        last = last - inner
    start[last] = True
    # ... which begins the next piece if it is a plain one
    plain = ends[space][data[last] == 0x20]
    start[plain] = False
    # contractions: an apostrophe that begins a piece and is followed by its letters
    mark = runs[(data[runs] == 0x27) & start[runs] & (ends - runs == 1)]
    d = np.concatenate([data, np.zeros(2, np.uint8)])
    row_end = np.concatenate([row_start, [True, True]])
    one, two = d[mark + 1], d[mark + 2]
    free = ~row_end[mark + 1]
    size = np.where(free & np.isin(one, list(SHORT_CONTRACTIONS)), 2, 0)
    for a, b in LONG_CONTRACTIONS:
        size = np.where(free & ~row_end[mark + 2] & (one == a) & (two == b), 3, size)
    mark, size = mark[size > 0], size[size > 0]
    start[mark + 1] = False
    behind = mark + size
    start[behind[behind < n]] = True
    return np.flatnonzero(start)


class Encoder:
    """Ids of whole blocks of texts; remembers the pieces it has seen, up to MAX_CACHE."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self._forget()

    def _forget(self) -> None:
        self.known: dict[int, int] = {}  # hash of a piece: its number
        self.n = self.n_ids = self.n_bytes = 0
        self.ids, self.text = np.zeros(1 << 16, np.int32), np.zeros(1 << 18, np.uint8)
        self.id_start, self.id_size, self.text_start, self.text_size = (np.zeros(1 << 14, np.int64) for _ in range(4))

    def _room(self, name: str, n: int) -> np.ndarray:
        while n > len(x := getattr(self, name)):
            setattr(self, name, np.concatenate([x, np.zeros_like(x)]))
        return x

    def _remember(self, keys, text, sizes, ids, counts) -> np.ndarray:
        numbers = np.arange(self.n, self.n + len(keys))
        for name, starts, lengths, flat, used in (("id", self.n_ids, counts, "ids", ids), ("text", self.n_bytes, sizes, "text", text)):
            self._room(name + "_start", self.n + len(keys))[numbers] = starts + np.cumsum(lengths) - lengths
            self._room(name + "_size", self.n + len(keys))[numbers] = lengths
            self._room(flat, starts + len(used))[starts:starts + len(used)] = used
        self.known.update(zip(keys.tolist(), numbers.tolist(), strict=True))
        self.n, self.n_ids, self.n_bytes = self.n + len(keys), self.n_ids + len(ids), self.n_bytes + len(text)
        return numbers

    def _encode(self, data: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces one after the other, number of ids of each) for pieces given one after the other."""
        v = self.v
        ends = np.cumsum(size)
        order = np.argsort(-size, kind="stable")  # long pieces first: those that have a prefix of p bytes come first
        start = (ends - size)[order]
        falling = -size[order]
        prefix = v.roll.of_bytes(data)
        width = size[order] + 1
        base = np.cumsum(width) - width
        last = np.full(int(width.sum()), NONE, np.int64)
        whole = v.by_hash.find(v.roll.raw(prefix, start, start - falling))
        last[base + width - 1] = whole
        n_long = int(np.searchsorted(falling, -LONG_PIECE))
        for i in np.flatnonzero(whole[:n_long] == NONE):
            last[base[i]:base[i] + width[i]] = PrefixTable(v, data[start[i]:start[i] + size[order[i]]].tobytes()).last
        todo = n_long + np.flatnonzero(whole[n_long:] == NONE)
        todo_start, todo_base, falling = start[todo], base[todo], falling[todo]
        for p in range(1, -int(falling[0]) + 1 if len(todo) else 0):
            n_open = int(np.searchsorted(falling, -p, "right"))
            s, b = todo_start[:n_open], todo_base[:n_open]
            for n in reversed(v.lengths):
                if n > p:
                    continue
                t = v.by_hash.find(v.roll.raw(prefix, s + (p - n), s + p))
                hit = np.flatnonzero(t != NONE)
                if n < p and len(hit):
                    hit = hit[v.all_stay(last[b[hit] + (p - n)], t[hit])]
                if len(hit):
                    last[b[hit] + p] = t[hit]
                    rest = np.ones(len(s), bool)
                    rest[hit] = False
                    s, b = s[rest], b[rest]
                    if not len(s):
                        break
            else:
                raise ValueError("the vocabulary lacks a byte")
        # walk back from the ends
        back, counts = [], np.zeros(len(size), np.int64)
        rows, p = np.arange(len(size)), size[order]
        while len(rows):
            t = last[base[rows] + p[rows]]
            back.append((rows, t))
            counts[rows] += 1
            p[rows] -= v.size[t]
            rows = rows[p[rows] > 0]
        place = np.zeros(len(size), np.int64)
        place[order] = counts
        counts, ends = place, np.cumsum(place)
        out = np.zeros(int(ends[-1]) if len(ends) else 0, np.int32)
        for k, (rows, t) in enumerate(back):
            out[ends[order[rows]] - 1 - k] = t
        return out, counts

    def _encode_exactly(self, data: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`_encode`, with every piece compared to the bytes of its ids.

        Tokens are looked up by hash. A wrong hit cannot hide: if all ids of a
        piece spell its bytes they are its encoding; other pieces are encoded
        by their bytes alone.
        """
        v = self.v
        try:
            ids, counts = self._encode(data, size)
        except ValueError:  # a wrong hit may also leave a prefix without a token
            ids, counts = np.zeros(0, np.int32), np.zeros(len(size), np.int64)
        spelt = np.add.reduceat(np.append(v.size[ids], 0), np.cumsum(counts) - counts)
        right = (counts > 0) & (spelt == size)
        ends = np.cumsum(size)
        if right.all():
            wrong = v.flat[S.fill(v.start[ids], v.size[ids])] != data
            right = np.add.reduceat(np.append(wrong, False), ends - size, dtype=np.int64) == 0
            if right.all():
                return ids, counts
        parts = np.split(ids, np.cumsum(counts)[:-1]) if len(ids) else [ids] * len(size)
        for k in range(len(size)):
            piece = data[ends[k] - size[k]:ends[k]].tobytes()
            if b"".join(v.tokens[t] for t in parts[k].tolist()) != piece:
                parts[k] = np.array(PrefixTable(v, piece).ids(), np.int32)
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)

    def block(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, offsets of the rows' ids).

        Pieces are remembered by hash. Every occurrence is compared with the
        remembered bytes; pieces that share a hash with an unlike one are
        encoded by themselves and not remembered.
        """
        start = piece_starts(data, offs)
        size = np.diff(start, append=len(data))
        key = self.v.roll.span(self.v.roll.of_bytes(data), start, start + size)
        keys, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        if self.n + len(keys) > MAX_CACHE or self.n_bytes + self.n_ids > MAX_CACHE_BYTES:
            self._forget()
        get = self.known.get
        entry = np.array([get(k, -1) for k in keys.tolist()], np.int64)
        new = entry < 0
        if new.any():
            at = first[new]
            text = data[S.fill(start[at], size[at])]
            entry[new] = self._remember(keys[new], text, size[at], *self._encode_exactly(text, size[at]))
        entry = entry[inverse]
        same = self.text_size[entry] == size
        if same.all():  # the pieces are the whole of the data, one after the other
            differ = self.text[S.fill(self.text_start[entry], size)] != data
            if differ.any():
                same = np.add.reduceat(differ, start, dtype=np.int64) == 0
        else:
            at = np.flatnonzero(same)
            both = np.concatenate([self.text[:self.n_bytes], data])
            same[at] = S.same_spans(both, self.text_start[entry[at]], self.n_bytes + start[at], size[at])
        sizes = self.id_size[entry]
        if same.all():
            ids = self.ids[S.fill(self.id_start[entry], sizes)]
        else:
            odd = np.flatnonzero(~same)
            odd_ids, odd_counts = self._encode_exactly(data[S.fill(start[odd], size[odd])], size[odd])
            sizes[odd] = odd_counts
            ids = np.zeros(int(sizes.sum()), np.int32)
            place = np.cumsum(sizes) - sizes
            fine = np.flatnonzero(same)
            ids[S.fill(place[fine], sizes[fine])] = self.ids[S.fill(self.id_start[entry[fine]], sizes[fine])]
            ids[S.fill(place[odd], odd_counts)] = odd_ids
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return ids, ends[np.searchsorted(start, offs)]


@lru_cache(2)
def _encoder(path: str) -> Encoder:
    return Encoder(Vocabulary(read_ranks(path)))


def encode_column(column, encoder: Encoder) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, ids, id offsets) for each block of an Arrow text column."""
    data, offs = S.text_buffer(column)
    for i, j in S.blocks(offs, 2 * S.BLOCK_BYTES):
        yield i, j, *encoder.block(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])


def encode(docs: DataFrame, ranks_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` without ``text``, with array<int> ``ids``; one row per row.

    Each match of the pre-splitting pattern is encoded separately, no special
    tokens. Null and empty texts give an empty array; texts are whole. A
    column named like ``ids`` is replaced, repeated rows stay, an empty table
    stays empty. ``ranks_path`` must be readable on every executor.
    """
    rest = [c for c in docs.columns if c not in (text, ids)]
    docs = docs.select(*rest, text)
    schema = docs.select(rest).schema.add(ids, T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks_path)
        for b in batches:
            for i, j, flat, offs in encode_column(b.column(len(rest)), encoder):
                lists = pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([*[c.slice(i, j - i) for c in b.columns[:len(rest)]], lists], names=[*rest, ids])

    return S.map_batches(docs, run, schema)


def list_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """(flat ids, offsets) of an array<int> column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(pa.scalar([], column.type))
    offs = column.offsets.to_numpy().astype(np.int64)
    return column.values.to_numpy(zero_copy_only=False)[offs[0]:offs[-1]], offs - offs[0]


def decode(rows: DataFrame, ranks_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``rows`` with the bytes of their ids as binary ``out``; a null array gives empty bytes."""
    rest = [c for c in rows.columns if c != out]
    rows = rows.select(rest)
    at = rest.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = _encoder(ranks_path).v
        for b in batches:
            flat, offs = list_buffer(b.column(at))
            for i, j in S.blocks(offs, S.BLOCK_BYTES):
                part = flat[offs[i]:offs[j]]
                sizes = v.size[part]
                data = v.flat[S.fill(v.start[part], sizes)]
                ends = np.concatenate([[0], np.cumsum(sizes)])[offs[i:j + 1] - offs[i]]
                texts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), j - i, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays([*[c.slice(i, j - i) for c in b.columns], texts.cast(pa.binary())], names=[*rest, out])

    return S.map_batches(rows, run, rows.select("*").schema.add(out, "binary"))


def decimal_digest(rows: DataFrame, ids: str = "ids", out: str = "ids_sha256") -> DataFrame:
    """``rows`` with the SHA-256 of the decimal ids joined by one space instead of the ids."""
    rest = [c for c in rows.columns if c not in (ids, out)]
    rows = rows.select(*rest, ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat, offs = list_buffer(b.column(len(rest)))
            digests = []
            top = int(flat.max()) + 1 if len(flat) else 1
            words = np.char.add(np.arange(top).astype(f"S{len(str(top))}"), b" ")
            width = words.dtype.itemsize
            table = words.view(np.uint8).reshape(top, width)
            for i, j in S.blocks(offs, S.BLOCK_BYTES):
                rows_ = table[flat[offs[i]:offs[j]]]
                full = rows_ != 0
                ends = np.concatenate([[0], np.cumsum(full.sum(1))])[offs[i:j + 1] - offs[i]]
                text = rows_[full].tobytes()
                digests += [hashlib.sha256(text[x:max(x, y - 1)]).hexdigest() for x, y in zip(ends, ends[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([*b.columns[:len(rest)], pa.array(digests, pa.string())], names=[*rest, out])

    return S.map_batches(rows, run, rows.select(rest).schema.add(out, "string"))


def op4_bpe(spark, sf: str, ranks_path: str | None = None) -> DataFrame:
    """Ids of every whole text of ``documents``, and what they decode to."""
    path = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = decode(encode(docs, path).withColumn("n_tokens", F.size("ids").cast("long")), path)
    rows = rows.withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("decoded")
    return decimal_digest(rows).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
