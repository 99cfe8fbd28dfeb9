"""Exact quantiles per group without buffering a group in one task.

``percentile``/``median`` keep every value of a group in one aggregation
buffer; a group with a third of the rows would not fit. Here the wanted order
statistics of a group (its *ranks*) lie in value ranges, at first one from
the group's min to its max:

* a range that holds at most ``small`` values is ranked once, by a window over
  that bounded set, and all its ranks are picked from it — a small group takes
  this step alone; a range with min == max is already the answer;
* a larger range is narrowed: its values are counted into ``nbins``
  equal-width buckets (partial aggregate), the counts prefix-summed (window over
  at most ``nbins`` rows), and the buckets that hold ranks become the next
  ranges, with their actual min/max.

Ranges of one group never overlap, so a row belongs to one of them at most:
rows are joined with their group's few ranges and are not copied per rank.

Linear interpolation between the two neighbouring order statistics gives
the same value as pandas/NumPy ``quantile``, Spark ``percentile`` and
DuckDB ``quantile_cont``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import persist_table

NBINS = 1024
SMALL = 50_000


def _in_ranges(d: DataFrame, keys: list[str], state: DataFrame) -> DataFrame:
    """Rows of ``d`` that lie in a range of their group, with it (``_r``: _a, _b, _below, _ranks)."""
    names = ["_a", "_b", "_below", "_ranks"]
    if keys:
        of_group = state.groupBy(*keys).agg(F.collect_list(F.struct(*names)).alias("_all"))
        j = d.join(of_group, keys)
    else:
        # one group: at most two ranges for each probability, tested without a join
        found = [F.struct(*[F.lit(x).alias(n) for n, x in zip(names, row, strict=True)])
                 for row in state.select(*names).collect()]
        every = F.array(*found).cast("array<struct<_a:double,_b:double,_below:bigint,_ranks:array<bigint>>>")
        j = d.withColumn("_all", every)
    mine = F.filter("_all", lambda r: F.col("_v").between(r["_a"], r["_b"]))
    return j.withColumn("_r", F.try_element_at(mine, F.lit(1))).where(F.col("_r").isNotNull()).drop("_all")


def exact_quantiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float],
                    nbins: int = NBINS, small: int = SMALL, max_passes: int = 80) -> DataFrame:
    """One row per group of ``keys`` with a column per entry of ``probs``
    (name -> probability). NULL values are ignored. The values are written
    once to the shared folder, so that no pass computes the input again."""
    kk = list(keys) if keys else ["_gk"]
    d = df.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    d = persist_table(d, "quantile-values")
    if not keys:
        d = d.withColumn("_gk", F.lit(0))
    stats = d.groupBy(*kk).agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_a"),
                               F.max("_v").alias("_b"))
    ranks = []
    for p in probs.values():
        pos = F.lit(float(p)) * (F.col("_n") - 1)
        ranks += [F.floor(pos).cast("bigint"), F.ceil(pos).cast("bigint")]
    state = stats.select(*kk, "_a", "_b", F.col("_n").alias("_cnt"), F.lit(0).cast("bigint").alias("_below"),
                         F.array_distinct(F.array(*ranks)).alias("_ranks"))
    state = persist_table(state, "quantile-ranges")
    large = (F.col("_cnt") > small) & (F.col("_a") < F.col("_b"))
    for _ in range(max_passes):
        act = state.where(large)
        if act.isEmpty():
            break
        j = _in_ranges(d, keys, act).select(*kk, "_v", "_r.*")
        bk = F.least(F.floor((F.col("_v") - F.col("_a")) / (F.col("_b") - F.col("_a")) * nbins),
                     F.lit(nbins - 1)).cast("int")
        h = j.groupBy(*kk, "_a", "_below", "_ranks", bk.alias("_bk")).agg(
            F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_mn"), F.max("_v").alias("_mx"))
        w = Window.partitionBy(*kk, "_a").orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
        h = h.withColumn("_lo", F.col("_below") + F.coalesce(F.sum("_c").over(w), F.lit(0)))
        mine = F.filter("_ranks", lambda r: (r >= F.col("_lo")) & (r < F.col("_lo") + F.col("_c")))
        nxt = (h.withColumn("_ranks", mine).where(F.size("_ranks") > 0)
               .select(*kk, F.col("_mn").alias("_a"), F.col("_mx").alias("_b"), F.col("_c").alias("_cnt"),
                       F.col("_lo").alias("_below"), "_ranks"))
        state = persist_table(state.where(~large).unionByName(nxt), "quantile-ranges")
    else:
        raise RuntimeError(f"value ranges still hold more than {small} values after {max_passes} passes")

    trivial = state.where(F.col("_a") == F.col("_b")).select(*kk, F.explode("_ranks").alias("_r"), F.col("_a").alias("_q"))
    j = _in_ranges(d, keys, state.where(F.col("_a") < F.col("_b"))).select(*kk, "_v", "_r.*")
    w = Window.partitionBy(*kk, "_a").orderBy("_v")
    picked = (j.withColumn("_i", F.col("_below") + F.row_number().over(w) - 1)
               .where(F.array_contains("_ranks", F.col("_i")))
               .select(*kk, F.col("_i").alias("_r"), F.col("_v").alias("_q")))
    vals = trivial.unionByName(picked)
    # gather the order statistics of a group into a map (<= 2 per prob)
    m = vals.groupBy(*kk).agg(F.map_from_entries(F.collect_list(F.struct("_r", "_q"))).alias("_m"))
    out = stats.select(*kk, "_n").join(m, kk)
    cols = []
    for name, p in probs.items():
        pos = F.lit(float(p)) * (F.col("_n") - 1)
        rlo, rhi = F.floor(pos).cast("bigint"), F.ceil(pos).cast("bigint")
        vlo, vhi = F.try_element_at("_m", rlo), F.try_element_at("_m", rhi)
        cols.append((vlo + (pos - rlo) * (vhi - vlo)).alias(name))
    res = out.select(*kk, *cols)
    return res.drop("_gk") if not keys else res
