"""Window / time-series operators (I-1 … I-14).

Ordering inside a pair uses ``ordering.ordered_index`` (exact positions
without a pair-wide window) and ``ordering.with_lags`` (lag values inside
bounded blocks). Statistics are partial aggregates keyed by pair (and lag
or chunk), so no task ever holds a whole pair.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import r6
from ..session import persist_table
from .ordering import group_sizes, ordered_index, with_lags

PAIR = ["src", "dst"]


def _pearson(x, y):
    """Pearson r of aggregated columns x, y; NULL for constant input,
    clipped to [-1, 1] (rounding can leave |r| a hair above 1)."""
    r = F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
    const = (F.max(x) == F.min(x)) | (F.max(y) == F.min(y))
    return F.when(~const, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))


def attach(df: DataFrame, small: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join per-group results back to rows. The per-group side is an
    aggregate, i.e. a materialized shuffle stage: AQE measures its real size
    and turns the join into a broadcast join when it is under
    ``spark.sql.adaptive.autoBroadcastJoinThreshold``; otherwise it stays a
    shuffle join whose skewed partitions AQE splits. No extra counting pass."""
    return df.join(small, keys, how)


def hours_from_start(edges: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """E-4: hours of every row since the first row of its group. Output: keys, ts, hours."""
    keys = keys or PAIR
    e = edges.select(*keys, "ts")
    first = e.groupBy(*keys).agg(F.min("ts").alias("t0"))
    return attach(e, first, keys).select(*keys, "ts", r6((F.col("ts") - F.col("t0")) / 3600.0).alias("hours"))


def autocorr_lag1(edges: DataFrame, keys: list[str] | None = None, value: str = "avg",
                  min_n: int = 3, undefined: float | None = None) -> DataFrame:
    """I-1: Pearson correlation of x[t] and x[t+1] in (ts, value) order per
    group; groups with fewer than ``min_n`` rows or a constant series give
    ``undefined`` (NULL by default). Output: keys, n, autocorr."""
    a = lag1_correlation(edges, keys, value, min_n)
    r = F.col("r") if undefined is None else F.coalesce("r", F.lit(float(undefined)))
    return a.select(*(keys or PAIR), "n", r6(r).alias("autocorr"))


def lag1_correlation(edges: DataFrame, keys: list[str] | None = None, value: str = "avg", min_n: int = 3) -> DataFrame:
    """keys, n and the unrounded correlation ``r`` of :func:`autocorr_lag1`."""
    keys = keys or PAIR
    e = edges.select(*keys, "ts", value)
    idx = ordered_index(e, keys, "ts", [value])
    lagged = with_lags(idx, keys, value, 1)
    x, y = F.col("lag_1"), F.when(F.col("lag_1").isNotNull(), F.col(value))
    a = lagged.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), _pearson(x, y).alias("r"))
    return a.select(*keys, "n", F.when(F.col("n") >= min_n, F.col("r")).alias("r"))


def autocorr_multi(edges: DataFrame, max_lag: int = 60, min_n: int = 60,
                   keys: list[str] | None = None, value: str = "avg") -> DataFrame:
    """I-2: autocorrelation at lags 1..max_lag for groups with at least
    ``min_n`` rows (``avg > 0`` rows, ts order). Undefined values and lags
    with fewer than two points give 0. Output: keys, lag, autocorr.

    One aggregate per group holds the sums of the (centred) values, their
    squares and the product with each lagged value; it becomes one row per lag
    only afterwards. What a lag leaves out of the plain sums are the group's
    first and last ``lag`` rows, whose running sums come from at most
    ``max_lag + 1`` rows at either end."""
    keys = keys or PAIR
    e = edges.where(F.col(value) > 0).select(*keys, "ts", value)
    sizes = (e.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.avg(value).alias("_mean"))
              .where(F.col("_n") >= min_n))
    centred = attach(e, sizes, keys).select(*keys, "ts", (F.col(value) - F.col("_mean")).alias("_x"), "_n")
    idx = ordered_index(centred, keys, "ts", ["_x"])
    lagged = with_lags(idx, keys, "_x", max_lag)
    x = F.col("_x")
    lags = range(1, max_lag + 1)
    sums = lagged.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum(x).alias("s"), F.sum(x * x).alias("q"),
        F.count_if(x != F.col("lag_1")).alias("changes"),
        *[F.sum(x * F.col(f"lag_{k}")).alias(f"p_{k}") for k in lags])
    per_lag = sums.select(*keys, "n", "s", "q", "changes", F.posexplode(F.array(*[f"p_{k}" for k in lags])).alias("_k", "p")) \
                  .select("*", (F.col("_k") + 1).alias("lag")).drop("_k")

    def edge(rows: DataFrame, place, name: str) -> DataFrame:
        """Running sums over the rows at one end, ``lag`` = 1 at the outermost; changes of value between them."""
        w = Window.partitionBy(*keys).orderBy("lag")
        # _c: whether the value changes towards the next row inwards, a transition that the lag leaves out
        d = rows.select(*keys, place.alias("lag"), x).withColumn("_c", (x != F.lead(x).over(w)).cast("int"))
        run = w.rowsBetween(Window.unboundedPreceding, 0)
        return d.select(*keys, "lag", F.sum(x).over(run).alias(f"s_{name}"), F.sum(x * x).over(run).alias(f"q_{name}"),
                        F.coalesce(F.sum("_c").over(run), F.lit(0)).alias(f"c_{name}")).where(F.col("lag") <= max_lag)

    head = edge(idx.where(F.col("rn") <= max_lag + 1), F.col("rn"), "head")
    tail = edge(idx.where(F.col("rn") >= F.col("_n") - max_lag), F.col("_n") - F.col("rn") + 1, "tail")
    j = per_lag.join(head, [*keys, "lag"], "left").join(tail, [*keys, "lag"], "left")
    m = F.when(F.col("n") - F.col("lag") >= 2, (F.col("n") - F.col("lag")).cast("double"))
    sx, sy = F.col("s") - F.col("s_tail"), F.col("s") - F.col("s_head")  # x: without the last rows, y: without the first
    vx = F.col("q") - F.col("q_tail") - sx * sx / m
    vy = F.col("q") - F.col("q_head") - sy * sy / m
    constant = (F.col("changes") == F.col("c_tail")) | (F.col("changes") == F.col("c_head"))
    r = F.try_divide(F.col("p") - sx * sy / m, F.sqrt(vx) * F.sqrt(vy))
    r = F.when(~constant & (vx > 0) & (vy > 0), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))
    return j.select(*keys, F.col("lag").cast("bigint").alias("lag"), r6(F.coalesce(r, F.lit(0.0))).alias("autocorr"))


def node_activity(succ: DataFrame, n_nodes: int = 50, src: str = "src", dst: str = "dst") -> DataFrame:
    """G-15: rows as source plus rows as destination per node (0/NULL
    excluded); the ``n_nodes`` most active (ties by smaller id)."""
    pairs = succ.groupBy(F.col(src).alias("_s"), F.col(dst).alias("_d")).agg(F.count(F.lit(1)).alias("_c"))
    nodes = pairs.select("_c", F.explode(F.array("_s", "_d")).alias("node"))  # once per pair, not per row
    c = nodes.where(F.col("node").isNotNull() & (F.col("node") != 0)) \
             .groupBy("node").agg(F.sum("_c").alias("activity"))
    return c.orderBy(F.desc("activity"), F.asc("node")).limit(n_nodes)


def bounded_series(edges: DataFrame, bound: int = 50, order: list[str] | None = None,
                   keys: list[str] | None = None) -> DataFrame:
    """I-3: the first ``bound`` rows of each pair in ``order`` (default ts,
    avg). ``row_number() <= bound`` becomes a WindowGroupLimit that trims
    every task to ``bound`` rows per pair before the shuffle."""
    keys = keys or PAIR
    order = order or ["ts", "avg"]
    w = Window.partitionBy(*keys).orderBy(*order)
    return edges.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= bound).drop("_rn")


def bounded_series_of_files(files: DataFrame, bound: int = 50, keys: list[str] | None = None) -> DataFrame:
    """I-3 as the files stand: the first ``bound`` rows of each pair by file path, then by row in the file. ``files``
    is read straight from Parquet files, whose metadata column tells both."""
    place = files.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    return bounded_series(place, bound, ["_file", "_row"], keys).drop("_file", "_row")


def autocorr_matrix(succ: DataFrame, n_nodes: int = 50, bound: int | None = None, min_rows: int = 10,
                    order: list[str] | None = None, rounded: bool = True) -> DataFrame:
    """I-4: lag-1 autocorrelation matrix over the ``n_nodes`` most active
    nodes, long form (src, dst, autocorr). Each off-diagonal pair uses all of
    its successful rows in ts order (with ``bound`` only its first ones, I-3)
    and needs ``min_rows`` of them; undefined -> 0. Diagonal cells are 1.0."""
    columns = list(dict.fromkeys([*PAIR, "ts", "avg", *(order or [])]))
    rows = persist_table(succ.select(*columns), "matrix-rows")  # the chain before is computed once, five columns wide
    top = persist_table(node_activity(rows, n_nodes), "matrix-nodes")
    top_b = F.broadcast(top.select("node"))  # at most n_nodes rows
    e = (rows.join(top_b, rows.src == top_b.node, "left_semi")
             .join(top_b, rows.dst == top_b.node, "left_semi")
             .where(F.col("src") != F.col("dst")))
    if bound is not None:
        e = bounded_series(e, bound, order)
    cell = F.coalesce("r", F.lit(0.0))
    off = lag1_correlation(e, min_n=1).where(F.col("n") >= min_rows).select(
        *PAIR, (r6(cell) if rounded else cell).alias("autocorr"))
    diag = top.select(F.col("node").alias("src"), F.col("node").alias("dst"), F.lit(1.0).alias("autocorr"))
    return off.unionByName(diag)


def matrix_coverage(matrix: DataFrame) -> DataFrame:
    """I-5: valid cells / N², off-diagonal count and min/max/mean. N is the
    size of the matrix itself: its number of diagonal cells."""
    od = F.col("src") != F.col("dst")
    v = F.when(od, F.col("autocorr"))
    n = F.count_if(~od)
    return matrix.agg(
        F.count(F.lit(1)).alias("n_valid"),
        r6(F.try_divide(F.count(F.lit(1)) * 100.0, n * n)).alias("coverage_pct"),
        F.count_if(od).alias("n_offdiag"),
        r6(F.min(v)).alias("min_offdiag"), r6(F.max(v)).alias("max_offdiag"),
        r6(F.avg(v)).alias("mean_offdiag"))


def _indexed_positive(edges: DataFrame, keys: list[str], value: str) -> tuple[DataFrame, DataFrame]:
    e = edges.where(F.col(value) > 0).select(*keys, "ts", value)
    stats = e.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("t0"))
    idx = ordered_index(e, keys, "ts", [value])
    return idx, stats


def moving_average(edges: DataFrame, max_w: int = 20, keys: list[str] | None = None,
                   value: str = "avg") -> DataFrame:
    """I-6: trailing mean over w = min(max_w, n // 10) rows per pair
    (``avg > 0``, ts order), only where w > 1; the first w-1 rows have no
    output. Output: keys, rn, hours (from the pair's first ts), w, ma."""
    keys = keys or PAIR
    idx, stats = _indexed_positive(edges, keys, value)
    stats = stats.withColumn("w", F.least(F.lit(max_w), F.floor(F.col("n") / 10))).where(F.col("w") > 1)
    j = attach(idx, stats, keys)
    lagged = with_lags(j, keys, value, max_w - 1)
    total = F.col(value)
    for k in range(1, max_w):
        total = total + F.when(F.lit(k) < F.col("w"), F.col(f"lag_{k}")).otherwise(F.lit(0.0))
    return (lagged.where(F.col("rn") >= F.col("w"))
                  .select(*keys, "rn", r6((F.col("ts") - F.col("t0")) / 3600.0).alias("hours"),
                          F.col("w").cast("bigint").alias("w"), r6(total / F.col("w")).alias("ma")))


def rolling_cv(edges: DataFrame, min_chunk: int = 10, keys: list[str] | None = None,
               value: str = "avg", rounded: bool = True) -> DataFrame:
    """I-7: chunks of c = max(min_chunk, n // 20) rows with stride c // 2,
    starting at 0 while a full chunk fits; per chunk population CV
    (0 when mean <= 0) stamped at the chunk's row start + c // 2.

    Each row is assigned to the (at most three) chunks containing it and
    chunks are partial aggregates — no pair-wide window."""
    keys = keys or PAIR
    idx, stats = _indexed_positive(edges, keys, value)
    stats = stats.withColumn("c", F.greatest(F.lit(min_chunk), F.floor(F.col("n") / 20))) \
                 .withColumn("st", F.floor(F.col("c") / 2)).where(F.col("n") >= F.col("c"))
    j = attach(idx, stats, keys)
    p = F.col("rn") - 1
    lo = F.greatest(F.lit(0), F.floor((p - F.col("c")) / F.col("st")) + 1)
    hi = F.least(F.floor(p / F.col("st")), F.floor((F.col("n") - F.col("c")) / F.col("st")))
    ch = j.where(lo <= hi).withColumn("chunk", F.explode(F.sequence(lo, hi)))
    mid = F.col("chunk") * F.col("st") + F.floor(F.col("c") / 2)
    a = ch.groupBy(*keys, "chunk", "t0").agg(
        F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"),
        F.max(F.when(p == mid, F.col("ts"))).alias("t_mid"))
    cv = F.when(F.col("mean") > 0, F.col("std") / F.col("mean")).otherwise(F.lit(0.0))
    return a.select(*keys, F.col("chunk").cast("bigint").alias("chunk"),
                    r6((F.col("t_mid") - F.col("t0")) / 3600.0).alias("hours"), (r6(cv) if rounded else cv).alias("cv"))


def stability_status(rcv: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """I-8: mean of the unrounded rolling CVs (``rolling_cv(rounded=False)``) per pair: < 0.3 Stable, < 0.6 Variable, else
    Highly Variable."""
    keys = keys or PAIR
    a = rcv.groupBy(*keys).agg(F.avg("cv").alias("mean_cv"))
    st = (F.when(F.col("mean_cv") < 0.3, "Stable").when(F.col("mean_cv") < 0.6, "Variable")
           .otherwise("Highly Variable"))
    return a.select(*keys, r6("mean_cv").alias("mean_cv"), st.alias("status"))


def autocorr_over_time(edges: DataFrame, min_n: int = 3) -> DataFrame:
    """I-14: lag-1 autocorrelation per pair per UTC day with the
    t-statistic r·sqrt((n-2)/(1-r²)) of the unrounded r (NULL when undefined,
    and when 1-r² is below 1e-9, where it holds no digit)."""
    e = edges.withColumn("day", F.to_date(F.timestamp_seconds("ts")))
    a = lag1_correlation(e, [*PAIR, "day"], min_n=min_n)
    r = F.col("r")
    t = F.when(1.0 - r * r >= 1e-9, r * F.sqrt((F.col("n") - 2.0) / (1.0 - r * r)))
    return a.select(*PAIR, F.col("day").cast("string").alias("day"), "n",
                    r6(r).alias("autocorr"), r6(t).alias("t_stat"))


def baselines(edges: DataFrame, window: int = 7, keys: list[str] | None = None,
              value: str = "avg") -> DataFrame:
    """I-11 … I-13: per-row forecasts from earlier rows of the same pair
    (ts order): persistence (last value), moving average of the previous
    ``window`` values, linear trend fitted to the previous ``window``
    values and extrapolated one step. Output: keys, rn, ts, y, persistence,
    moving_avg, linear."""
    keys = keys or PAIR
    e = edges.select(*keys, "ts", value)
    idx = ordered_index(e, keys, "ts", [value])
    lagged = with_lags(idx, keys, value, window)
    ys = [F.col(f"lag_{k}") for k in range(1, window + 1)]
    m = sum((F.when(y.isNotNull(), F.lit(1)).otherwise(F.lit(0)) for y in ys), F.lit(0))
    sy = sum((F.coalesce(y, F.lit(0.0)) for y in ys), F.lit(0.0))
    # x = -k for the value k steps back; prediction at x = 0
    sx = sum((F.when(y.isNotNull(), F.lit(-float(k))).otherwise(F.lit(0.0)) for k, y in enumerate(ys, 1)), F.lit(0.0))
    sxx = sum((F.when(y.isNotNull(), F.lit(float(k * k))).otherwise(F.lit(0.0)) for k, y in enumerate(ys, 1)), F.lit(0.0))
    sxy = sum((F.coalesce(y, F.lit(0.0)) * F.lit(-float(k)) for k, y in enumerate(ys, 1)), F.lit(0.0))
    den = m * sxx - sx * sx
    slope = F.try_divide(m * sxy - sx * sy, den)
    intercept = (sy - slope * sx) / m
    return lagged.select(*keys, "rn", "ts", F.col(value).alias("y"),
                         F.col("lag_1").alias("persistence"),
                         F.when(m > 0, sy / m).alias("moving_avg"),
                         F.when(m >= 2, intercept).alias("linear"))


def baseline_mae(edges: DataFrame, window: int = 7) -> DataFrame:
    """J-9 for the baselines: per pair and method, rows with a forecast,
    MAE and the standard error of the absolute errors."""
    b = baselines(edges, window)
    methods = F.explode(F.array(*[F.struct(F.lit(m).alias("method"), F.col(m).alias("pred"))
                                  for m in ("persistence", "moving_avg", "linear")])).alias("p")
    long = b.select(*PAIR, "y", methods).select(*PAIR, "y", "p.method", "p.pred") \
            .where(F.col("pred").isNotNull())
    err = F.abs(F.col("y") - F.col("pred"))
    a = long.groupBy(*PAIR, "method").agg(F.count(F.lit(1)).alias("n"), F.avg(err).alias("mae"),
                                          F.stddev_samp(err).alias("sd"))
    return a.select(*PAIR, "method", "n", r6("mae").alias("mae"),
                    r6(F.col("sd") / F.sqrt(F.col("n"))).alias("mae_se"))


MILLION = 1_000_000.0


def panes(df: DataFrame, keys: list[str], width: int, time: str = "ts", value: str = "avg") -> DataFrame:
    """Tumbling panes of ``width`` seconds: keys, pane (its start), n, n_ok, total of positive values in millionths. Rows
    without a time belong to no pane. A total of whole numbers does not depend on the order in which parts are merged."""
    t = F.col(time)
    ok = F.col(value) > 0
    return (df.where(t.isNotNull()).groupBy(*keys, (F.floor(t / width) * width).cast("bigint").alias("pane"))
              .agg(F.count(F.lit(1)).alias("n"), F.count_if(ok).alias("n_ok"),
                   F.sum(F.when(ok, F.round(F.col(value) * MILLION).cast("bigint"))).alias("total")))


def merge_panes(parts: DataFrame, keys: list[str], width: int) -> DataFrame:
    """Panes of ``width`` seconds from narrower ones, or from several parts of the same panes."""
    return (parts.groupBy(*keys, (F.floor(F.col("pane") / width) * width).cast("bigint").alias("pane"))
                 .agg(F.sum("n").alias("n"), F.sum("n_ok").alias("n_ok"), F.sum("total").alias("total")))


def windows_of_panes(pane_rows: DataFrame, keys: list[str], size: int, slide: int) -> DataFrame:
    """Sliding windows of ``size`` seconds every ``slide`` seconds from panes of ``slide`` seconds: each pane, not each
    row, is copied to the windows that hold it. Output: keys, window_start, n, n_ok, mean (to the millionth, a half
    rounded up)."""
    back = F.transform(F.sequence(F.lit(0), F.lit(size // slide - 1)), lambda i: F.col("pane") - i * slide)
    w = pane_rows.select(*keys, "n", "n_ok", "total", F.explode(back).alias("window_start"))
    a = w.groupBy(*keys, "window_start").agg(F.sum("n").alias("n"), F.sum("n_ok").alias("n_ok"), F.sum("total").alias("total"))
    return a.select(*keys, F.col("window_start").cast("bigint").alias("window_start"), "n", "n_ok",
                    (F.expr("(2 * total + n_ok) div (2 * nullif(n_ok, 0))") / MILLION).alias("mean"))


def multi_resolution_windows(df: DataFrame, key: str = "prb_id", value: str = "avg",
                             resolutions: list[tuple[int, int]] | None = None) -> DataFrame:
    """I-10: sliding time windows per probe at several (size, slide)
    resolutions in seconds: rows, successful rows and mean latency of
    successful rows per window. Windows are aligned to the epoch.

    The rows are read and aggregated once, into panes of the finest slide;
    every coarser slide is merged from the panes before it."""
    resolutions = sorted(resolutions or RESOLUTIONS, key=lambda r: r[1])
    out, base, step = None, None, 1
    for size, slide in resolutions:
        if size % slide:
            raise ValueError(f"a window of {size} s is not a whole number of slides of {slide} s")
        if base is None or slide % step:
            base = panes(df, [key], slide, value=value)
        elif slide != step:
            base = merge_panes(base, [key], slide)
        step = slide
        part = windows_of_panes(base, [key], size, slide).select(
            F.lit(_resolution_name(size, slide)).alias("resolution"), key, "window_start", "n", "n_ok", "mean")
        out = part if out is None else out.unionByName(part)
    return out


def _resolution_name(size: int, slide: int) -> str:
    def text(seconds: int) -> str:
        for unit, width in (("day", 86_400), ("hour", 3_600), ("minute", 60), ("second", 1)):
            if seconds % width == 0:
                n = seconds // width
                return f"{n} {unit}{'s' if n > 1 else ''}"
    return f"{text(size)}/{text(slide)}"


# The (size, slide) resolutions named in the design notes, in seconds.
RESOLUTIONS = [(10, 1), (5 * 60, 30), (2 * 3600, 15 * 60), (86_400, 4 * 3600)]
