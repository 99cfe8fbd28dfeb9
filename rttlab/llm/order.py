"""Exact positions of rows in an order, without a group in one task.

Rows are dealt by sampled ranges of (group, order) and written to the shared
folder, so every row's range number stays what it is. A group's ranges are
counted, the counts prefix-summed (at most one row for each range), and rows
numbered inside their range. A group that holds a third of all rows is spread
over a third of the ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rttlab.session import persist_table


def positions(rows: DataFrame, group: list[str], order: list[Column], name: str = "position",
              size: str = "group_rows") -> DataFrame:
    """``rows`` with each row's place (from 0) among its group's and the group's number of rows.

    ``order`` should tell all different rows apart; equal rows take consecutive
    places in any order. A null group is a group. An empty table stays empty.
    """
    rows = persist_table(rows, "rows-to-order")  # read twice: for the ranges' sample, and to be dealt
    dealt = rows.repartitionByRange(*[F.col(g) for g in group], *order).withColumn("_range", F.spark_partition_id())
    dealt = persist_table(dealt, "ordered-rows")
    counts = dealt.groupBy(*group, "_range").agg(F.count(F.lit(1)).alias("_rows"))
    mine = Window.partitionBy(*group)
    counts = counts.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_range").alias("_r"),
        F.coalesce(F.sum("_rows").over(mine.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_before"),
        F.sum("_rows").over(mine).alias(size))
    same = F.col("_range") == F.col("_r")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    numbered = dealt.withColumn("_at", F.row_number().over(Window.partitionBy(*group, "_range").orderBy(*order)))
    return (numbered.join(counts, same).withColumn(name, F.col("_before") + F.col("_at") - 1)
            .select(*rows.columns, name, size))
