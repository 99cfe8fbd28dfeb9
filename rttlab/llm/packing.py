"""Best-fit packing of token pieces into sequences by bin completion.

Pieces of equal length are interchangeable, so the search works on the number
of pieces of each length (at most ``capacity`` numbers, whatever the size of
the corpus): sequences are completed around the largest length left, with
undominated fillings, for as many sequences at once as the counts allow. Spark
ranks the pieces within their length and gives every rank its place.
"""

from __future__ import annotations

import itertools
import random
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rttlab.session import persist_table

from . import spans as S
from .bpe import _encoder, encode_column

CAPACITY = 2048
END_ID = 0
SEARCH_NODES = 4000  # completions tried in all, after the first descent; the rows packed don't depend on it
LOOKS = 16  # fillings looked at for each of them
FEW = 64  # lengths left, for which the lower bound is taken
ROWS_PER_RANK_GROUP = 500_000


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences that any packing needs: by volume, and by documents of more than half a sequence."""
    sizes = sorted(counts)
    best = -(-sum(n * c for n, c in counts.items()) // capacity)
    for k in [0, *[n for n in sizes if 2 * n <= capacity]]:
        alone = sum(counts[n] for n in sizes if n > capacity - k)
        half = [(n, counts[n]) for n in sizes if n <= capacity - k and 2 * n > capacity]
        room = sum((capacity - n) * c for n, c in half)
        small = sum(n * counts[n] for n in sizes if k <= n and 2 * n <= capacity)
        best = max(best, alone + sum(c for _, c in half) + max(0, -(-(small - room) // capacity)))
    return best


def dominated(filling: dict[int, int], counts: dict[int, int], sizes: list[int], space: int) -> bool:
    """Whether a document left over could take the place of documents of ``filling`` that are no larger together.

    Those would fit into its place, so the other filling is never worse. Repeated, such steps give every
    filling whose places hold this one.
    """
    slack = space - sum(n * c for n, c in filling.items())
    inside = sorted(filling)
    sums, at = 1, 0  # of documents of the filling that are smaller than y
    for y in reversed(sizes):
        while at < len(inside) and inside[at] < y:
            for _ in range(filling[inside[at]]):
                sums |= sums << inside[at]
            at += 1
        low = max(0, y - slack)
        if counts[y] > filling.get(y, 0) and sums >> low & (1 << y - low + 1) - 1:
            return True
    return False


def fillings(counts: dict[int, int], sizes: list[int], space: int) -> Iterator[dict[int, int] | None]:
    """All undominated fillings of ``space``: falling sums, for one sum the largest documents first; None for a dominated one.

    The reachable sums are bit sets, so that every step of the enumeration ends in a filling.
    """
    fit = [n for n in sizes if n <= space]  # falling
    mask = (1 << space + 1) - 1
    reach = [1]
    for n in reversed(fit):
        bits, left, step = reach[-1], min(counts[n], space // n), 1
        while left > 0:
            step = min(step, left)
            bits |= bits << n * step & mask
            left -= step
            step *= 2
        reach.append(bits)
    reach.reverse()  # reach[i]: sums of fit[i:]

    def build(total: int) -> Iterator[dict[int, int]]:
        chosen: list[tuple[int, int]] = []  # (index in fit, documents)
        i, c, todo = 0, None, total
        while True:
            while todo:  # go on with the largest documents
                c = min(counts[fit[i]], todo // fit[i]) if c is None else c
                while c >= 0 and not reach[i + 1] >> todo - c * fit[i] & 1:
                    c -= 1
                if c < 0:
                    break
                if c:
                    chosen.append((i, c))
                todo -= c * fit[i]
                i, c = i + 1, None
            if not todo:
                yield {fit[j]: k for j, k in chosen}
            if not chosen:
                return
            i, c = chosen.pop()  # one less of the last that was chosen
            todo += c * fit[i]
            c -= 1

    first = True
    for total in range(reach[0].bit_length() - 1, -1, -1):
        if reach[0] >> total & 1:
            for filling in build(total):
                yield filling if first or not dominated(filling, counts, fit, space) else None
                first = False  # the fullest, with the largest documents, never is


@dataclass
class Packing:
    patterns: list[tuple[dict[int, int], int]] = field(default_factory=list)  # (documents by length, sequences)

    @property
    def sequences(self) -> int:
        return sum(m for _, m in self.patterns)


def largest_first(counts: dict[int, int], capacity: int) -> Packing:
    """Each sequence takes the largest document that still fits, again and again: a first incumbent."""
    left, out = dict(counts), Packing()
    while left:
        pattern, space = {}, capacity
        for n in sorted(left, reverse=True):
            c = min(left[n], space // n)
            if c:
                pattern[n] = c
                space -= c * n
        m = min(left[n] // c for n, c in pattern.items())
        for n, c in pattern.items():
            left[n] -= c * m
            if not left[n]:
                del left[n]
        out.patterns.append((pattern, m))
    return out


def bin_completion(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = SEARCH_NODES) -> Packing:
    """Branch and bound over completions around the largest document, by limited discrepancy.

    The first incumbent takes largest documents first; the first descent, the
    best-fit filling everywhere, may replace it. Pass k then tries all paths
    whose choices stand k places behind the first ones in all, so deviations
    near the root come as early as those near the leaves. A branch is pruned
    when its waste, or the lower bound of few lengths left, leaves no way to use
    fewer sequences than the incumbent, or when the same documents were left before. Ends at the lower bound, with all
    paths tried (the fewest sequences), or after ``nodes`` completions or LOOKS times
    as many fillings looked at: then more sequences than needed may come out, never more than
    largest-first.
    """
    counts = {n: c for n, c in counts.items() if c}
    if any(n > capacity or n < 1 for n in counts):
        raise ValueError("a document is longer than a sequence")
    volume = sum(n * c for n, c in counts.items())
    bound = lower_bound(counts, capacity) if counts else 0
    best = largest_first(counts, capacity)
    rng = random.Random(0)
    code = {n: rng.getrandbits(128) for n in sorted(counts)}
    looks = LOOKS * nodes
    left, waste, used, state = dict(counts), 0, 0, 0
    # path: (pattern, sequences, (places behind, pattern, sequences) of the choices not tried yet, places left)
    path: list[tuple[dict[int, int], int, list, int]] = []

    def shift(pattern: dict[int, int], m: int) -> None:
        """Take ``m`` sequences of ``pattern`` from what is left; give them back if negative."""
        nonlocal waste, used, state
        for n, c in pattern.items():
            left[n] = left.get(n, 0) - c * m
            state += code[n] * c * m
            if not left[n]:
                del left[n]
        waste += m * (capacity - sum(n * c for n, c in pattern.items()))
        used += m

    def choices():
        """Patterns around the largest document with as many sequences as the counts allow, then with half as many, and so on."""
        largest = max(left)
        rest = {**left, largest: left[largest] - 1}
        found = []
        for filling in fillings(rest, sorted((n for n, c in rest.items() if c), reverse=True), capacity - largest):
            if filling is None:
                yield None
                continue
            pattern = {**filling, largest: filling.get(largest, 0) + 1}
            m = min(left[n] // c for n, c in pattern.items())
            yield pattern, m
            found.append((pattern, m // 2))
        while found := [(p, m) for p, m in found if m]:
            yield from found
            found = [(p, m // 2) for p, m in found]

    for places in itertools.count():
        whole, seen, spare = True, {}, places
        while True:
            if not left and used < best.sequences:
                best = Packing([(p, m) for p, m, _, _ in path])
            if best.sequences <= bound or min(nodes, looks) <= 0:
                return best
            before = seen.get(state)
            known = before is not None and before[0] <= used and before[1] >= spare
            hopeless = places and (-(-(volume + waste) // capacity) >= best.sequences
                                   or len(left) <= FEW and used + lower_bound(left, capacity) >= best.sequences)
            if left and not known and not hopeless:
                if places:
                    seen[state] = used, spare
                options: list = []
                nodes -= places > 0
                for choice in choices():
                    looks -= places > 0
                    if choice is not None:
                        if len(options) > spare:
                            whole = False
                            break
                        options.append((len(options), *choice))
                    if not places and options or looks <= 0:
                        whole = False
                        break
                if not options:
                    return best
                _, pattern, m = options.pop(0)
                path.append((pattern, m, options, spare))
                shift(pattern, m)
                continue
            while path:
                pattern, m, options, spare = path.pop()
                shift(pattern, -m)
                if options:
                    cost, pattern, m = options.pop(0)
                    path.append((pattern, m, options, spare))
                    shift(pattern, m)
                    spare -= cost
                    break
            else:
                break
        if whole:
            return best


def slots(packing: Packing) -> dict[int, np.ndarray]:
    """Per length, rows (first rank, first sequence, places a sequence, first offset), by rising rank."""
    out: dict[int, list] = {}
    rank: dict[int, int] = {}
    base = 0
    for pattern, m in packing.patterns:
        at = 0
        for n in sorted(pattern, reverse=True):
            c = pattern[n]
            out.setdefault(n, []).append((rank.get(n, 0), base, c, at))
            rank[n] = rank.get(n, 0) + c * m
            at += n * c
        base += m
    return {n: np.array(rows, np.int64) for n, rows in out.items()}


def ranked(pieces: DataFrame, length: str, order: list[str]) -> DataFrame:
    """``pieces`` with ``_rank``: 0, 1, ... within a length, by no single task for a frequent length."""
    groups = max(16, -(-pieces.count() // ROWS_PER_RANK_GROUP))
    cell = pieces.withColumn("_cell", F.pmod(F.xxhash64(*order), F.lit(groups)))
    sums = cell.groupBy(length, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(length).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col(length).alias("_l"), F.col("_cell").alias("_c"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(length, "_cell").orderBy(*order))
    return (cell.withColumn("_row", inside).join(sums, (F.col(length) == F.col("_l")) & (F.col("_cell") == F.col("_c")))
            .withColumn("_rank", (F.col("_before") + F.col("_row") - 1).cast("long")).drop("_l", "_c", "_cell", "_before", "_row"))


def pack(pieces: DataFrame, order: list[str], length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; sequences are filled without gaps from offset 0.

    ``order``: columns that tell the pieces of one length apart; pieces equal in
    them are interchangeable. Every length is from 1 to ``capacity``. Repeated
    rows are packed each for itself; an empty table gives an empty table.
    Columns named like an output are replaced. The driver sees one number for
    each length; the places are a table of at most ``capacity`` patterns with
    at most 63 different lengths each (for 2048), sent to the tasks.
    """
    rest = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    pieces = persist_table(pieces.select(rest), "pack-pieces")
    counts = {r[0]: r[1] for r in pieces.groupBy(length).agg(F.count(F.lit(1))).collect()}  # one row for each length
    table = slots(bin_completion(counts, capacity))
    rows = ranked(pieces, length, order).select(*rest, "_rank")
    at = rest.index(length)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, rank = b.column(at).to_numpy(zero_copy_only=False), b.column(len(rest)).to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(sizes):
                mine = np.flatnonzero(sizes == n)
                t = table[int(n)]
                t = t[np.searchsorted(t[:, 0], rank[mine], "right") - 1]
                k = rank[mine] - t[:, 0]
                sequence[mine] = t[:, 1] + k // t[:, 2]
                offset[mine] = t[:, 3] + k % t[:, 2] * int(n)
            yield pa.RecordBatch.from_arrays([*b.columns[:len(rest)], pa.array(sequence), pa.array(offset)],
                                             names=[*rest, "sequence_id", "offset"])

    schema = pieces.select("*").schema.add("sequence_id", "long").add("offset", "long")
    return S.map_batches(rows, place, schema)


def token_pieces(docs: DataFrame, ranks_path: str, text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of at most ``capacity`` tokens: the columns of ``docs`` but ``text``, and piece, start, length, ids_bytes.

    A document's tokens are those of its whole text, then ``end_id``; null
    texts are empty. Only longer documents are cut: all pieces but the first
    have ``capacity`` tokens. ``ids_bytes``: little-endian unsigned 32-bit ids.
    """
    new = [("piece", "integer"), ("start", "long"), ("length", "long"), ("ids_bytes", "binary")]
    rest = [c for c in docs.columns if c != text and c not in dict(new)]
    docs = docs.select(*rest, text)
    schema = docs.select(rest).schema
    for n, t in new:
        schema = schema.add(n, t)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks_path)
        for b in batches:
            for i, j, flat, offs in encode_column(b.column(len(rest)), encoder):
                n = np.diff(offs) + 1
                # the ids with an end after each document
                ids = np.full(len(flat) + j - i, end_id, "<u4")
                keep = np.ones(len(ids), bool)
                doc_at = offs[:-1] + np.arange(j - i)
                keep[doc_at + n - 1] = False
                ids[keep] = flat
                pieces = -(-n // capacity)
                row = np.repeat(np.arange(j - i), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                first = n - (pieces - 1) * capacity
                start = np.where(piece == 0, 0, first[row] + (piece - 1) * capacity)
                length = np.where(piece == 0, first[row], capacity)
                ends = 4 * np.concatenate([[0], np.cumsum(length)])  # pieces follow one another as the ids do
                binary = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(ids)])
                take = pa.array(i + row)
                yield pa.RecordBatch.from_arrays(
                    [*[c.take(take) for c in b.columns[:len(rest)]], pa.array(piece.astype(np.int32)), pa.array(start),
                     pa.array(length), binary.cast(pa.binary())], names=schema.names)

    return S.map_batches(docs, run, schema)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", ranks_path: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of ``docs``."""
    path = ranks_path or public_tokenizers.path("byte_bpe_50k.json")
    pieces = token_pieces(docs.select(id_col, "text"), path)
    pieces = pieces.select(id_col, "piece", "start", "length", F.crc32("ids_bytes").alias("ids_crc32"))
    return pack(pieces, [id_col, "piece", "ids_crc32"])


def op2_best_fit_packing(spark, sf: str) -> DataFrame:
    """All ``documents`` packed into sequences of at most 2048 tokens."""
    return pack_documents(spark.read.parquet(f"{sf}/documents.parquet"))
