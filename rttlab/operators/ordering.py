"""Row positions inside a group without putting the group in one task.

A window ``partitionBy(pair).orderBy(ts)`` sends every row of a pair to a
single task; with one pair holding a third of the data that task never
finishes. Instead the time of each group is cut into *cells* (days):

1. rows per (key, cell) are counted — a partial aggregate, one row per pair
   and day — and written; a cell above a bound is cut into hours, such an
   hour into minutes, then seconds. The bound is never less than a
   ``SHARE``-th of all rows, so at most ``SHARE`` cells are cut at each
   level, and telling the rows where they belong is a broadcast of that size;
2. the counts are prefix-summed per key (one row per cell);
3. rows are exchanged once, by (key, cell), numbered inside their cell and
   moved up by the rows of the cells before.

The result is an exact dense 1-based ``rn`` in (ts, tie-break) order.
Lag/lead style operators then work on blocks of ``rn`` (``with_lags``),
again bounded in size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import persist_table

CELL_SECONDS = (86_400, 3_600, 60, 1)  # widths of cells, each a multiple of the next
CELL_ROWS = 1 << 16
SHARE = 1_000
BLOCK_ROWS = 4096


def _cell(time: Column, width: int) -> Column:
    return (F.floor(time / width) * width).cast("bigint")


def _cells(df: DataFrame, keys: list[str], time: Column, cell_rows: int) -> tuple[DataFrame, DataFrame]:
    """(``df`` with the start of each row's cell as ``_cell``, (keys, _cell, _c) rows per cell)."""
    rows = df.dropna(subset=keys).where(time.isNotNull()).withColumn("_cell", _cell(time, CELL_SECONDS[0]))
    per_cell = [*keys, "_cell"]
    counts = persist_table(rows.groupBy(*per_cell).agg(F.count(F.lit(1)).alias("_c")), "cell-rows")
    total, largest = counts.agg(F.sum("_c"), F.max("_c")).head()
    bound = max(cell_rows, (total or 0) // SHARE)
    for finer in CELL_SECONDS[1:]:
        if (largest or 0) <= bound:
            break
        large = counts.where(F.col("_c") > bound)  # at most SHARE rows
        over = F.broadcast(large.select(*[F.col(k).alias(f"_o{i}") for i, k in enumerate(per_cell)]))
        same = F.lit(True)
        for i, k in enumerate(per_cell):
            same = same & (F.col(k) == F.col(f"_o{i}"))
        cut = rows.join(over, same, "left")
        inside = F.col(f"_o{len(keys)}").isNotNull()
        finer_rows = cut.where(inside).withColumn("_cell", _cell(time, finer))
        parts = persist_table(finer_rows.groupBy(*per_cell).agg(F.count(F.lit(1)).alias("_c")), "cell-rows")
        counts = counts.where(F.col("_c") <= bound).unionByName(parts)
        largest = parts.agg(F.max("_c")).head()[0]
        rows = cut.withColumn("_cell", F.when(inside, _cell(time, finer)).otherwise(F.col("_cell"))).drop(
            *[f"_o{i}" for i in range(len(per_cell))])
    return rows, counts


def ordered_index(df: DataFrame, keys: list[str], time_col: str = "ts",
                  tiebreak: list[str] | None = None, rn: str = "rn", cell_rows: int = CELL_ROWS) -> DataFrame:
    """Add ``rn`` = position of the row in its ``keys`` group ordered by
    (``time_col``, *``tiebreak``). ``time_col`` must be numeric (seconds); rows
    with a null key or time have no position and are left out. Rows of one
    second of one group are numbered together."""
    order = [time_col, *(tiebreak or [])]
    rows, counts = _cells(df, keys, F.col(time_col), cell_rows)
    before = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_cell", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy(*keys, "_cell").orderBy(*order)
    numbered = rows.withColumn("_at", F.row_number().over(inside))
    return (numbered.join(offsets, [*keys, "_cell"])
            .withColumn(rn, (F.col("_off") + F.col("_at")).cast("bigint"))
            .select(*df.columns, rn))


def group_sizes(df: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    """Rows per group (partial aggregate)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def with_lags(idx: DataFrame, keys: list[str], value: str, lags: int, rn: str = "rn",
              block: int = BLOCK_ROWS, prefix: str = "lag_") -> DataFrame:
    """Add ``lag_1 .. lag_L`` (value at rn-1 … rn-L in the same group).

    Rows are split into blocks of ``block`` positions; the last ``lags``
    rows of each block are copied into the next block as context, so each
    window partition holds at most ``block + lags`` rows.
    """
    block = max(block, lags)
    pos0 = F.col(rn) - 1
    blk = F.floor(pos0 / block)
    home = F.struct(blk.alias("b"), F.lit(False).alias("c"))
    copy = F.struct((blk + 1).alias("b"), F.lit(True).alias("c"))
    # one pass: every row goes to its block, the tail rows also to the next one
    targets = F.when(pos0 % block >= block - lags, F.array(home, copy)).otherwise(F.array(home))
    u = idx.select("*", F.explode(targets).alias("_t")) \
           .select("*", F.col("_t.b").alias("_blk"), F.col("_t.c").alias("_ctx")).drop("_t")
    w = Window.partitionBy(*keys, "_blk").orderBy(rn)
    lag_cols = [F.lag(value, k).over(w).alias(f"{prefix}{k}") for k in range(1, lags + 1)]
    return u.select("*", *lag_cols).where(~F.col("_ctx")).drop("_blk", "_ctx")
