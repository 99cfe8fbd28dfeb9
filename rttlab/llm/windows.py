"""Windows of a fixed number of items (bytes or words) that start at more than one place of a corpus.

Every window has an anchor: the k-gram of it with the smallest hash (leftmost
of equal ones). Equal windows have equal anchors, so consecutive windows with
one anchor are a *run*, and only runs that share an anchor can repeat each
other. Runs with identical text are brought down to one text and its number of
copies before anything is exchanged; all texts of an anchor go to a shard, whose
index (suffix array, FM-index) tells which windows repeat, a text weighing as
much as it has copies. An anchor with very many different texts is not brought
together: its windows are compared by hashes of ever shorter ranges of window
starts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rttlab.session import persist_table

from . import spans as S

SEGMENT_ITEMS = 1 << 20  # of one text at a time; segments of a longer text overlap by a window
POSITION_BITS = 24
SHARD_ITEMS = 1 << 19
HOT_TEXTS = 2_000  # distinct texts of one anchor that a shard takes
HOT_STEP = 16  # window starts that the texts of a hot anchor are first compared by

_ROLL, _BYTE = S.Rolling(61), S.Rolling(63)

Find = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Unit:
    """What a window is made of. ``find`` gets the concatenated items, the texts' offsets and copies, and the window
    length; it tells for each window start whether the window occurs elsewhere, in another copy of the text as well."""
    name: str
    length: int  # items in a window
    gram: int  # items in an anchor
    dtype: str
    find: Find

    def items(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Items and row offsets in items: the bytes themselves, or hashes of the words."""
        if self.name == "byte":
            return data, offs
        start, end, rows = S.word_spans(data, offs)
        return S.word_hashes(_BYTE, data, start, end), rows

    def prefix(self, items: np.ndarray) -> np.ndarray:
        return _ROLL.of_bytes(items) if self.name == "byte" else _ROLL.of_items(items)


def anchors(prefix: np.ndarray, offs: np.ndarray, unit: Unit):
    """Runs of the windows of all rows: (row, first window start, windows, anchor place, anchor hash), in items."""
    L, k = unit.length, unit.gram
    n = len(prefix) - 1
    if n < L:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    at = np.arange(n - k + 1)
    h = _ROLL.span(prefix, at, at + k)
    low = np.uint64((1 << POSITION_BITS) - 1)
    key = h & ~low | at.astype(np.uint64)
    w = L - k + 1
    pad = -len(key) % w
    grid = np.concatenate([key, np.full(pad, ~np.uint64(0))]).reshape(-1, w)
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = n - L + 1
    place = (np.minimum(right[:starts], left[w - 1:w - 1 + starts]) & low).astype(np.int64)
    ok = np.zeros(starts + 1, np.int32)  # windows inside one row
    size = np.diff(offs)
    whole = np.flatnonzero(size >= L)
    ok[offs[:-1][whole]] += 1
    ok[offs[1:][whole] - L + 1] -= 1
    s = np.flatnonzero(np.cumsum(ok)[:starts] > 0)
    p = place[s]
    new = np.ones(len(s), bool)
    new[1:] = (p[1:] != p[:-1]) | (s[1:] != s[:-1] + 1)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(s)))
    lo = s[first]
    return np.searchsorted(offs, lo, "right") - 1, lo, count, p[first], h[p[first]]


def body_hash(items: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """XXH3 of whole texts, whose equality settles what repeats (the polynomial hash only picks anchors)."""
    flat, width = np.ascontiguousarray(items).view(np.uint8).data, items.dtype.itemsize
    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(flat[a:b]) for a, b in zip((start * width).tolist(), (end * width).tolist(), strict=True)], np.uint64)


def segments(offs: np.ndarray, unit: Unit) -> Iterator[tuple[int, int, int, int]]:
    """(first row, end row, first item, end item): blocks of whole rows, or overlapping parts of one long row."""
    for i, j in S.blocks(offs, SEGMENT_ITEMS):
        a, b = int(offs[i]), int(offs[j])
        if b - a <= SEGMENT_ITEMS:
            yield i, j, a, b
        else:
            step = SEGMENT_ITEMS - unit.length + 1
            for x in range(a, max(a + 1, b - unit.length + 1), step):
                yield i, j, x, min(b, x + SEGMENT_ITEMS)


def pack_place(lo, n, off, tag):
    """32 bits of the first window start, 9 of the windows, 9 of the anchor's place, 14 that tell rows apart."""
    return (lo << 32) | (n << 23) | (off << 14) | tag


def keyed(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with ``_row`` and ``_tag``, hashes of the whole row: 78 bits that identify it (equal rows agree)."""
    cols = [F.col(c) for c in docs.columns]
    return (docs.withColumn("_row", F.xxhash64(*cols))
            .withColumn("_tag", F.pmod(F.xxhash64(F.lit(7), *reversed(cols)), F.lit(1 << 14)).cast("long")))


RUN_SCHEMA = "row long, place long, anchor long, body long"


def runs(docs: DataFrame, text: str, unit: Unit) -> DataFrame:
    """All runs: the row's hash, its place, the anchor's hash, and the hash of the run's whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = S.text_buffer(b.column(2))
            ids, tags = b.column(0).to_numpy(), b.column(1).to_numpy()
            for i, j in S.blocks(offs):
                items, rows = unit.items(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                for x, y, a, e in segments(rows, unit):
                    prefix = unit.prefix(items[a:e])
                    cut = np.clip(rows[x:y + 1], a, e) - a
                    r, lo, n, p, anchor = anchors(prefix, cut, unit)
                    body = body_hash(items[a:e], lo, lo + n - 1 + unit.length)
                    row = i + x + r
                    place = pack_place(lo + a - rows[x + r], n, p - lo, tags[row])
                    yield pa.RecordBatch.from_arrays([pa.array(ids[row]), pa.array(place), pa.array(anchor.view(np.int64)),
                                                      pa.array(body.view(np.int64))], names=["row", "place", "anchor", "body"])

    return S.map_batches(keyed(docs, text).select("_row", "_tag", text), run, RUN_SCHEMA)


TEXT_SCHEMA = ("anchor long, body long, copies long, items binary, part int, core long, whole long, "
               "hashes array<long>, first int, wins int")


def fetch(docs: DataFrame, text: str, unit: Unit, wanted: DataFrame) -> DataFrame:
    """The texts of ``wanted`` runs (row, tag, list of place, anchor, body, copies, hot).

    A hot anchor's text comes as ranges of window starts that lie alike to the
    anchor: the hash of what all windows of a range share (``core``), of the
    range's whole text, and of each window.
    """
    L, step = unit.length, HOT_STEP

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = S.text_buffer(b.column(0))
            out: list[list] = [[] for _ in range(10)]
            for i, todo in enumerate(b.column(1).to_pylist()):
                mine = data[offs[i]:offs[i + 1]]
                items, _ = unit.items(mine, np.array([0, len(mine)]))
                for t in todo:
                    lo, n, off = t["place"] >> 32, t["place"] >> 23 & 511, t["place"] >> 14 & 511
                    base = [t["anchor"], t["body"], t["copies"]]
                    if not t["hot"]:
                        for c, v in zip(out, [*base, items[lo:lo + n - 1 + L].tobytes(), None, None, None, None, 0, n], strict=True):
                            c.append(v)
                        continue
                    for q in range((off - n + 1) // step, off // step + 1):  # o = off - window: distance to the anchor
                        o1, o2 = max(q * step, off - n + 1), min(q * step + step - 1, off)
                        w1, w2 = off - o2, off - o1
                        anchor = lo + off
                        c0, c1 = anchor - q * step, anchor - (q * step + step - 1) + L
                        core = body_hash(items, np.array([c0]), np.array([max(c0, min(c1, len(items)))]))[0]
                        at = np.arange(lo + w1, lo + w2 + 1)
                        each = body_hash(items, at, at + L)
                        body = body_hash(items, at[:1], at[-1:] + L)[0] ^ np.uint64((w2 - w1) * 64 + o1 % step)
                        for c, v in zip(out, [*base, None, q, int(core.view(np.int64)), int(body.view(np.int64)),
                                              each.view(np.int64)[::-1].tolist(), o1, w2 - w1 + 1], strict=True):
                            c.append(v)
                if len(out[0]) > 2_000:
                    yield _text_batch(out)
                    out = [[] for _ in range(10)]
            if out[0]:
                yield _text_batch(out)

    rows = keyed(docs, text).select("_row", "_tag", text)
    want = wanted.select(F.col("row").alias("_r"), F.col("tag").alias("_t"), "todo")
    both = rows.join(want, (F.col("_row") == F.col("_r")) & (F.col("_tag") == F.col("_t")))
    return S.map_batches(both.select(text, "todo"), run, TEXT_SCHEMA)


_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.int32()]


def _text_batch(cols: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _TYPES, strict=True)],
                                      names=[f.split()[0] for f in TEXT_SCHEMA.split(", ")])


FOUND_SCHEMA = "anchor long, body long, starts array<int>, sizes array<int>"


def search(texts: DataFrame, unit: Unit) -> DataFrame:
    """Repeated windows of the texts, as ranges (starts, sizes) of window starts, found in shards.

    All texts of an anchor are in one shard; a shard takes anchors until it
    holds SHARD_ITEMS items.
    """
    def shard(rows: list[tuple]) -> pa.RecordBatch:
        parts = [np.frombuffer(r[3], unit.dtype) for r in rows]
        offs = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        hit = unit.find(np.concatenate(parts), offs, np.array([r[2] for r in rows], np.int64), unit.length)
        out: list[list] = [[], [], [], []]
        for i in range(len(rows)):
            mine = hit[offs[i]:offs[i + 1]]
            if mine.any():
                edge = np.flatnonzero(np.diff(np.concatenate([[0], mine.astype(np.int8), [0]])))
                for c, v in zip(out, [rows[i][0], rows[i][1], edge[::2].tolist(), (edge[1::2] - edge[::2]).tolist()], strict=True):
                    c.append(v)
        return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.list_(pa.int32())),
                                           pa.array(out[3], pa.list_(pa.int32()))], names=["anchor", "body", "starts", "sizes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size, width = 0, np.dtype(unit.dtype).itemsize
        for b in batches:
            for r in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if size >= SHARD_ITEMS and r[0] != rows[-1][0]:
                    yield shard(rows)
                    rows, size = [], 0
                rows.append(r)
                size += len(r[3]) // width
        if rows:
            yield shard(rows)

    plain = texts.filter("part is null").select("anchor", "body", "copies", "items").dropDuplicates(["anchor", "body"])
    # a number of its own: Spark then leaves the partitions as small as asked for, a task is CPU-bound
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return S.map_batches(plain.repartition(tasks, "anchor").sortWithinPartitions("anchor"), run, FOUND_SCHEMA)


def search_hot(texts: DataFrame) -> DataFrame:
    """Repeated windows of the texts of hot anchors, by counts of equal hashes; no group is brought together.

    A range of window starts whose whole text occurs twice repeats as a whole;
    one whose shared core occurs once has no repeated window; the windows of
    the rest are counted one by one.
    """
    hot = (texts.filter("part is not null").drop("items")
           .withColumn("of", F.struct("anchor", "body")).dropDuplicates(["anchor", "body", "part"]))
    cores = hot.groupBy("anchor", "part", "core").agg(F.sum("copies").alias("c")).filter("c > 1").drop("c")
    alive = hot.join(cores, ["anchor", "part", "core"], "left_semi")
    whole = alive.groupBy("anchor", "part", "whole").agg(F.sum("copies").alias("c")).filter("c > 1").drop("c")
    window = alive.select("anchor", "body", "copies", F.posexplode("hashes").alias("i", "hash"), "first")
    window = window.select("anchor", "body", "copies", "hash", (F.col("first") + F.col("i")).alias("o"))
    full = alive.join(whole, ["anchor", "part", "whole"], "left_semi")
    rest = alive.join(whole, ["anchor", "part", "whole"], "left_anti").select("anchor", "body", "part")
    twice = window.groupBy("anchor", "o", "hash").agg(F.sum("copies").alias("c")).filter("c > 1").drop("c")
    open_ = alive.join(rest, ["anchor", "body", "part"], "left_semi").select("anchor", "body", F.posexplode("hashes").alias("i", "hash"), "first")
    open_ = open_.select("anchor", "body", "hash", (F.col("first") + F.col("i")).alias("o"))
    single = open_.join(twice, ["anchor", "o", "hash"], "left_semi").select("anchor", "body", "o", F.lit(1).alias("wins"))
    both = full.select("anchor", "body", F.col("first").alias("o"), "wins").union(single)
    return both  # o: distance of the last window of the range to the anchor


def repeated_spans(docs: DataFrame, text: str, unit: Unit, hot_texts: int = HOT_TEXTS) -> DataFrame:
    """``row, tag, spans``: for every row with repeated windows the (start, items) spans that they cover.

    Spans of a row may touch or overlap. Equal rows count as several places;
    windows of rows with less than a window are none.
    """
    all_runs = persist_table(runs(docs, text, unit), "window-runs")
    # written, so that the join's sides are plain exchanges whose hot partitions Spark can split
    shared = persist_table(all_runs.groupBy("anchor").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("anchor"), "window-shared")
    cand = persist_table(all_runs.join(shared, "anchor", "left_semi"), "window-candidates")
    bodies = cand.groupBy("anchor", "body").agg(F.count(F.lit(1)).alias("copies"), F.min("row").alias("row"),
                                                F.min_by("place", "row").alias("place"))
    bodies = persist_table(bodies, "window-bodies")
    open_ = bodies.groupBy("anchor").agg((F.count(F.lit(1)) > hot_texts).alias("hot"))
    todo = bodies.join(persist_table(open_, "window-open"), "anchor")
    wanted = todo.groupBy("row", F.col("place").bitwiseAND(F.lit((1 << 14) - 1)).alias("tag")).agg(
        F.collect_list(F.struct("place", "anchor", "body", "copies", "hot")).alias("todo"))
    wanted = persist_table(wanted, "window-wanted")
    texts = persist_table(fetch(docs, text, unit, wanted), "window-texts")
    found = persist_table(search(texts, unit), "window-found")
    L = unit.length
    lo = F.shiftright("place", 32)
    off = F.shiftright("place", 14).bitwiseAND(F.lit(511))
    row = [F.col("row"), F.col("place").bitwiseAND(F.lit((1 << 14) - 1)).alias("tag")]
    span = lambda start, windows: F.struct(start.cast("long").alias("start"), (windows + L - 1).cast("long").alias("size"))
    spans = (cand.join(found, ["anchor", "body"]).select(*row, lo.alias("lo"), F.explode(F.arrays_zip("starts", "sizes")).alias("f"))
             .select("row", "tag", span(F.col("lo") + F.col("f.starts"), F.col("f.sizes")).alias("span")))
    if not texts.filter("part is not null").isEmpty():
        hot = cand.join(search_hot(texts), ["anchor", "body"])
        spans = spans.union(hot.select(*row, span(lo + off - F.col("o") - F.col("wins") + 1, F.col("wins")).alias("span")))
    return spans.groupBy("row", "tag").agg(F.collect_set("span").alias("spans"))


def remove(docs: DataFrame, text: str, unit: Unit, make: Callable, added: list[tuple[str, str]], hot_texts: int = HOT_TEXTS) -> DataFrame:
    """``docs`` without ``text``, with the columns ``added`` that ``make`` derives from a text and its repeated spans.

    Input columns named like an added one are replaced; all others come back as they are, whatever their names.
    """
    rest = [c for c in docs.columns if c != text and c not in dict(added)]
    packed = S.hide(docs.select(*[F.col(f"`{c}`") for c in [*rest, text]]), text=text)
    out = cover(packed, unit, make, added, repeated_spans(packed, "text", unit, hot_texts))
    return out.select(*S.unhide(out, rest), *dict(added))


def cover(packed: DataFrame, unit: Unit, make: Callable, added: list[tuple[str, str]], spans: DataFrame) -> DataFrame:
    """``rest`` of ``packed`` (rest, text), with the columns ``added`` that ``make`` derives.

    ``make(data, spans)`` gets a whole text and its covered [start, end) spans
    in items, merged and in order.
    """
    spans = spans.select(F.col("row").alias("_r"), F.col("tag").alias("_t"), "spans").hint("shuffle_hash")
    both = (keyed(packed, "text").join(spans, (F.col("_row") == F.col("_r")) & (F.col("_tag") == F.col("_t")), "left")
            .select("rest", "text", "spans"))
    schema = both.select("rest").schema
    for name, kind in added:
        schema = schema.add(name, kind)
    out_types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = S.text_buffer(b.column(1))
            spans = b.column(2).to_pylist()
            for i, j in S.blocks(offs, 16 * S.BLOCK_BYTES):
                out = []
                for k in range(i, j):
                    s = sorted((x["start"], x["start"] + x["size"]) for x in spans[k] or ())
                    merged: list[list[int]] = []
                    for a, e in s:
                        if merged and a <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], e)
                        else:
                            merged.append([a, e])
                    out.append(make(data[offs[k]:offs[k + 1]].tobytes(), merged))
                cols = [pa.array(c, out_types[t]) for c, (_, t) in zip(zip(*out, strict=True), added, strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), *cols], names=["rest", *dict(added)])

    return S.map_batches(both, run, schema)
