"""Per-pair statistics, top-k and classification (H-1 … H-13).

Every statistic is a partial (map-side combined) aggregate keyed by the
pair, so a pair holding a third of all rows is pre-aggregated in every
task before the shuffle. Exact quantiles go through
``operators.quantiles`` (never one buffer per group); ordered
statistics (slope on row index) go through ``operators.ordering``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import hour_of, pair_label, r6, weekday_of
from ..session import persist_table
from .ordering import ordered_index
from .quantiles import exact_quantiles

PAIR = ["src", "dst"]


def pair_counts(edges: DataFrame) -> DataFrame:
    return edges.groupBy(*PAIR).agg(F.count(F.lit(1)).alias("count"))


def top_pairs(edges: DataFrame, k: int = 10, min_count: int = 20) -> DataFrame:
    """H-1: most measured pairs, self-loops excluded, ``count >= min_count``,
    descending; ties by (src, dst). A top-k report: the limit is the feature."""
    return (pair_counts(edges.where(F.col("src") != F.col("dst")))
            .where(F.col("count") >= min_count)
            .orderBy(F.desc("count"), F.asc("src"), F.asc("dst"))
            .limit(k))


def top_sources_by_degree(edges: DataFrame, k: int = 100) -> DataFrame:
    """H-2: ``nlargest(k)`` of the out-degree (G-4); ties by smaller src."""
    deg = edges.select(*PAIR).distinct().groupBy("src").agg(F.count(F.lit(1)).alias("out_degree"))
    return deg.orderBy(F.desc("out_degree"), F.asc("src")).limit(k)


def _restrict(edges: DataFrame, pairs: DataFrame | None) -> DataFrame:
    if pairs is None:
        return edges
    return edges.join(pairs.select(*PAIR), PAIR, "left_semi")  # Spark broadcasts a list below its threshold


def _rolled_up(cells: DataFrame, keys: list[str]) -> DataFrame:
    """n, mean and squared deviations (``m2``) per ``keys`` from cells with n, mean and m2; a group's cells are few."""
    w = Window.partitionBy(*keys)
    mu = F.sum(F.col("n") * F.col("mean")).over(w) / F.sum("n").over(w)
    d = cells.withColumn("_mu", mu)
    return d.groupBy(*keys, "_mu").agg(
        F.sum("rows").alias("rows"), F.sum("n").alias("n"),
        F.sum(F.col("m2") + F.col("n") * F.pow(F.col("mean") - F.col("_mu"), 2)).alias("m2")) \
        .withColumnRenamed("_mu", "mean")


def _std_samp():
    return F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1)))


def pair_variation(edges: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """H-3: per pair count, mean over hours of the per-hour sample std, the same
    over weekdays, CV = std/mean (0 when mean is 0), lag-1 autocorrelation,
    mean and sample std. No ``avg > 0`` filter, as in the reference.

    The rows are aggregated once, by (pair, hour, weekday): at most 168 cells a
    pair, from which all spreads are rolled up."""
    from .series import autocorr_lag1
    e = _restrict(edges, pairs).select(*PAIR, "ts", "avg")
    cells = persist_table(
        e.groupBy(*PAIR, hour_of("ts").alias("h"), weekday_of("ts").alias("d"))
         .agg(F.count(F.lit(1)).alias("rows"), F.count("avg").alias("n"), F.avg("avg").alias("mean"),
              (F.var_pop("avg") * F.count("avg")).alias("m2")), "pair-cells")
    filled = cells.where(F.col("n") > 0)

    def spread(part: str, name: str) -> DataFrame:
        return (_rolled_up(filled, [*PAIR, part]).groupBy(*PAIR).agg(F.avg(_std_samp()).alias(name)))

    counts = cells.groupBy(*PAIR).agg(F.sum("rows").alias("count"))
    base = _rolled_up(filled, PAIR).select(*PAIR, F.col("mean").alias("mean_latency"), _std_samp().alias("std_latency"))
    ac = autocorr_lag1(e, min_n=3).select(*PAIR, F.col("autocorr").alias("autocorrelation"))
    out = counts
    for part in (base, spread("h", "hourly_variation"), spread("d", "daily_variation"), ac):
        out = out.join(part, PAIR, "left")
    cv = F.when(F.col("mean_latency") != 0,
                F.try_divide(F.col("std_latency"), F.col("mean_latency"))).otherwise(F.lit(0.0))
    return out.select(*PAIR, "count", r6("hourly_variation").alias("hourly_variation"),
                      r6("daily_variation").alias("daily_variation"),
                      r6(cv).alias("coefficient_of_variation"),
                      r6("autocorrelation").alias("autocorrelation"),
                      r6("mean_latency").alias("mean_latency"),
                      r6("std_latency").alias("std_latency"))


def pair_stddev_matrix(edges: DataFrame) -> DataFrame:
    """H-4: population std of latency per pair with more than one row (long form)."""
    return (edges.groupBy(*PAIR)
                 .agg(F.count(F.lit(1)).alias("n"), F.stddev_pop("avg").alias("s"))
                 .where(F.col("n") > 1)
                 .select(*PAIR, "n", r6("s").alias("stddev")))


def pair_latency_stats(edges: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """H-5: ``avg > 0`` rows per pair: count, mean, exact median, sample and
    population std, min, max."""
    e = _restrict(edges, pairs).where(F.col("avg") > 0).select(*PAIR, "avg")
    agg = e.groupBy(*PAIR).agg(F.count(F.lit(1)).alias("count"), F.avg("avg").alias("mean"),
                               F.stddev_samp("avg").alias("std_samp"),
                               F.stddev_pop("avg").alias("std_pop"),
                               F.min("avg").alias("min"), F.max("avg").alias("max"))
    med = exact_quantiles(e, PAIR, "avg", {"median": 0.5})
    return (agg.join(med, PAIR, "left")
               .select(*PAIR, "count", r6("mean").alias("mean"), r6("median").alias("median"),
                       r6("std_samp").alias("std_samp"), r6("std_pop").alias("std_pop"),
                       r6("min").alias("min"), r6("max").alias("max")))


def histogram(df: DataFrame, value: str = "avg", bins: int = 30, keys: list[str] | None = None,
              where_positive: bool = True) -> DataFrame:
    """H-6: equal-width histogram over [min, max] per key, last bin closed.
    All-equal input puts every row in bin 1."""
    keys = list(keys or [])
    d = df.where(F.col(value) > 0) if where_positive else df.where(F.col(value).isNotNull())
    d = d.select(*keys, F.col(value).cast("double").alias("v"))
    kk = keys if keys else ["_k"]
    if not keys:
        d = d.withColumn("_k", F.lit(0))
    rng = d.groupBy(*kk).agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    # per-key range: an aggregate stage, AQE broadcasts it when small
    j = d.join(F.broadcast(rng) if not keys else rng, kk)
    b = F.when(F.col("hi") == F.col("lo"), F.lit(1)).otherwise(
        F.least(F.width_bucket(F.col("v"), F.col("lo"), F.col("hi"), F.lit(bins)), F.lit(bins)))
    h = j.groupBy(*keys, b.cast("bigint").alias("bin"), "lo", "hi").agg(
        F.count(F.lit(1)).alias("count"))
    w = (F.col("hi") - F.col("lo")) / bins
    return h.select(*keys, "bin", r6(F.col("lo") + (F.col("bin") - 1) * w).alias("bin_lo"),
                    r6(F.when(F.col("bin") == bins, F.col("hi"))
                        .otherwise(F.col("lo") + F.col("bin") * w)).alias("bin_hi"),
                    "count")


def boxplot_stats(edges: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """H-7: quartiles and 1.5·IQR whiskers per pair (``avg > 0``). Whiskers
    are the most extreme data points inside the fences (matplotlib rule)."""
    e = _restrict(edges, pairs).where(F.col("avg") > 0).select(*PAIR, "avg")
    q = exact_quantiles(e, PAIR, "avg", {"q1": 0.25, "q2": 0.5, "q3": 0.75})
    iqr = F.col("q3") - F.col("q1")
    fenced = e.join(q, PAIR).withColumn("lo_f", F.col("q1") - 1.5 * iqr) \
              .withColumn("hi_f", F.col("q3") + 1.5 * iqr)
    inside = F.col("avg").between(F.col("lo_f"), F.col("hi_f"))
    agg = fenced.groupBy(*PAIR, "q1", "q2", "q3").agg(
        F.min(F.when(inside, F.col("avg"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("avg"))).alias("whisker_hi"),
        F.count_if(~inside).alias("n_outliers"))
    return agg.select(*PAIR, r6("q1").alias("q1"), r6("q2").alias("median"), r6("q3").alias("q3"),
                      r6("whisker_lo").alias("whisker_lo"), r6("whisker_hi").alias("whisker_hi"),
                      "n_outliers")


def pair_cv(edges: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """H-8: ``avg > 0`` pairs with n > 1: mean, population std, CV (0 when
    mean <= 0), n, and the "src→dst" label."""
    e = _restrict(edges, pairs).where(F.col("avg") > 0)
    a = e.groupBy(*PAIR).agg(F.count(F.lit(1)).alias("count"), F.avg("avg").alias("mean"),
                             F.stddev_pop("avg").alias("std")).where(F.col("count") > 1)
    cv = F.when(F.col("mean") > 0, F.col("std") / F.col("mean")).otherwise(F.lit(0.0))
    return a.select(*PAIR, pair_label().alias("pair"), r6("mean").alias("mean"),
                    r6("std").alias("std"), r6(cv).alias("cv"), "count")


def trend_scores(edges: DataFrame, pairs: DataFrame | None = None, min_n: int = 20) -> DataFrame:
    """H-9 … H-12: per pair (``avg > 0``, ts order, ``n >= min_n``) mean,
    population std, CV, least-squares slope of latency on row index,
    stability class, trend class and modelability score, none of them rounded."""
    e = _restrict(edges, pairs).where(F.col("avg") > 0).select(*PAIR, "ts", "avg")
    idx = ordered_index(e, PAIR, "ts", ["avg"])
    a = idx.groupBy(*PAIR).agg(
        F.count(F.lit(1)).alias("count"), F.avg("avg").alias("mean"),
        F.stddev_pop("avg").alias("std"),
        F.regr_slope(F.col("avg"), F.col("rn").cast("double")).alias("slope"))
    a = a.where(F.col("count") >= min_n)
    cv = F.when(F.col("mean") > 0, F.col("std") / F.col("mean")).otherwise(F.lit(0.0))
    slope = F.coalesce(F.col("slope"), F.lit(0.0))
    a = a.withColumn("cv", cv).withColumn("slope", slope)
    stab = (F.when(F.col("cv") < 0.2, "Highly Stable")
             .when(F.col("cv") < 0.4, "Moderately Stable").otherwise("Variable"))
    tr = (F.when(F.abs(F.col("slope")) * F.col("count") < 1, "No Trend")
           .when(F.col("slope") > 0, "Increasing").otherwise("Decreasing"))
    a = a.withColumn("stability_class", stab).withColumn("trend_class", tr)
    model = ((1 - F.col("cv")) + F.when(F.col("trend_class") == "No Trend", 1.0).otherwise(0.5)) / 2
    return a.select(*PAIR, pair_label().alias("pair"), "count", "mean", "cv", "slope", "stability_class",
                    "trend_class", model.alias("modelability"))


def _rounded(scores: DataFrame, *more: str) -> DataFrame:
    return scores.select(*PAIR, "pair", "count", *[r6(c).alias(c) for c in ("mean", "cv", "slope")], "stability_class",
                         "trend_class", r6("modelability").alias("modelability"), *more)


def trend(edges: DataFrame, pairs: DataFrame | None = None, min_n: int = 20) -> DataFrame:
    """:func:`trend_scores` rounded for a report."""
    return _rounded(trend_scores(edges, pairs, min_n))


def modelability_ranking(scores: DataFrame, k: int = 15, threshold: float = 0.7) -> DataFrame:
    """H-12: pairs ranked by their unrounded modelability (desc, ties by pair)
    with a flag for score > threshold; the top-``k`` list is the report."""
    top = (scores.withColumn("high_modelability", F.col("modelability") > threshold)
                 .orderBy(F.desc("modelability"), F.asc("src"), F.asc("dst")).limit(k))
    return _rounded(top, "high_modelability")


def modelability_share(scores: DataFrame, threshold: float = 0.7) -> DataFrame:
    """H-12: one row: pairs, pairs whose unrounded modelability exceeds ``threshold``, and their share in %."""
    high = F.count_if(F.col("modelability") > threshold)
    return scores.agg(F.count(F.lit(1)).alias("n_pairs"), high.alias("n_high"),
                      r6(F.try_divide(high * 100.0, F.count(F.lit(1)))).alias("high_pct"))


def class_counts(scores: DataFrame) -> DataFrame:
    """H-13: pairs per (kind, class) for the stability and trend classes, with their share of all pairs in %."""
    kinds = F.array(F.struct(F.lit("stability").alias("kind"), F.col("stability_class").alias("class")),
                    F.struct(F.lit("trend").alias("kind"), F.col("trend_class").alias("class")))
    n = (scores.groupBy("stability_class", "trend_class").agg(F.count(F.lit(1)).alias("m"))
               .select("m", F.explode(kinds).alias("c")).groupBy("c.kind", "c.class").agg(F.sum("m").alias("n")))
    return n.select("kind", "class", "n", r6(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy("kind"))).alias("pct"))
