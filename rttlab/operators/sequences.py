"""Sequence preparation and evaluation tables (J-1 … J-11, I-9).

Token sequences are built with array expressions on each row (no UDF);
windows over a probe's history use ``ordering.ordered_index`` and a
partial aggregate per (probe, size, window), so a hot probe is never one
task. Window token lists are bounded by the window size (<= 128 rows).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import hour_of, r6
from .ordering import ordered_index, with_lags
from .quantiles import exact_quantiles

# Token vocabulary of the measurement language (ids are ours;
# the structure follows the design notes). Order of structural tokens:
# START, END, SRC, DST, V4, V6, LATENCY, TIMESTAMP, then PAD; the last id stands for an unknown address.
START, END, SRC, DST, V4, V6, LATENCY, TIMESTAMP, PAD = 0, 1, 2, 3, 4, 5, 6, 7, 8
SHORT_MIN = 9                      # SHORT(v) = 9 + v, v in 0..65535
SHORT_MAX = SHORT_MIN + 65535
LATENCY_MIN = SHORT_MAX + 1        # 1024 latency buckets
LATENCY_MAX = LATENCY_MIN + 1023
TIMESTAMP_MIN = LATENCY_MAX + 1    # 1024 time buckets
TIMESTAMP_MAX = TIMESTAMP_MIN + 1023
UNKNOWN_ADDRESS = TIMESTAMP_MAX + 1
VOCAB_SIZE = UNKNOWN_ADDRESS + 1
LAT_SCALE = 94.0                   # log-scale: ln(1 + 51,083 ms) * 94 < 1024
TIME_BUCKET_SECONDS = 600          # time-of-week in 10-minute buckets (1008)

# IPv4 byte-sequence variant (262 tokens).
BYTE_SUCCESS, BYTE_FAIL, BYTE_SEP, BYTE_TEMPORAL, BYTE_NO_TEMPORAL, BYTE_PAD = 256, 257, 258, 259, 260, 261
CONDITIONS = ["TEMPORAL", "NO_TEMPORAL"]
WINDOW_SIZES = [20, 40, 80, 128]

STRUCT_NAMES = ["START", "END", "SRC", "DST", "V4", "V6", "LATENCY", "TIMESTAMP", "PAD"]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- J-2
def latency_token(avg="avg") -> Column:
    """J-2: latency -> LATENCY_MIN + bucket; bucket = clip(floor(ln(1+x)*94), 1, 1023),
    failed measurement (avg <= 0 or NULL) -> bucket 0."""
    x = _c(avg).cast("double")
    b = F.least(F.lit(1023), F.greatest(F.lit(1), F.floor(F.log(F.lit(1.0) + x) * LAT_SCALE)))
    return (F.lit(LATENCY_MIN) + F.when(x > 0, b).otherwise(F.lit(0))).cast("int")


def time_token(ts="ts") -> Column:
    """J-2: unix seconds -> TIMESTAMP_MIN + 10-minute time-of-week bucket (Monday 00:00 = 0)."""
    tow = (_c(ts) + 3 * 86400) % 604800
    return (F.lit(TIMESTAMP_MIN) + F.floor(tow / TIME_BUCKET_SECONDS)).cast("int")


def _v4_shorts(x: Column) -> Column:
    return F.array((F.lit(SHORT_MIN) + F.floor(x / 65536)).cast("int"),
                   (F.lit(SHORT_MIN) + x % 65536).cast("int"))


def _v6_shorts(b: Column) -> Column:
    h = F.hex(b)
    return F.array(*[(F.lit(SHORT_MIN) + F.conv(F.substring(h, 4 * i + 1, 4), 16, 10).cast("int")).cast("int")
                     for i in range(8)])


def _ip_block(marker: int, is_v6: Column, v4: Column, v6: Column) -> Column:
    known = F.coalesce((is_v6 & v6.isNotNull()) | (~is_v6 & (v4 > 0)), F.lit(False))
    return F.when(~known, F.array(F.lit(marker), F.lit(UNKNOWN_ADDRESS))) \
            .when(is_v6, F.concat(F.array(F.lit(marker), F.lit(V6)), _v6_shorts(v6))) \
            .otherwise(F.concat(F.array(F.lit(marker), F.lit(V4)), _v4_shorts(v4)))


# ---------------------------------------------------------------- J-1
def tokenize(opt: DataFrame, seed: int = 42, with_timestamp: bool = True) -> DataFrame:
    """J-1: one token sequence per measurement of the optimized table:
    START, then the SRC, DST, LATENCY (and TIMESTAMP) blocks in a per-row
    permutation seeded by md5(seed|prb_id|ts|dst|field), then END. An address
    that is NULL or does not parse is one UNKNOWN_ADDRESS token; every row stays.
    Adds ``tokens array<int>`` and ``length int``."""
    src = _ip_block(SRC, F.col("src_is_ipv6"), F.col("src_ipv4_int"), F.col("src_ipv6_bytes"))
    dst = _ip_block(DST, F.col("dst_is_ipv6"), F.col("dst_ipv4_int"), F.col("dst_ipv6_bytes"))
    lat = F.array(F.lit(LATENCY), latency_token("avg"))
    blocks = [("src", src), ("dst", dst), ("lat", lat)]
    if with_timestamp:
        blocks.append(("ts", F.array(F.lit(TIMESTAMP), time_token("ts"))))

    def key(name):
        return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("prb_id").cast("string"),
                                 F.col("ts").cast("string"), F.col("dst_addr_display"), F.lit(name)))
    arr = F.array(*[F.struct(key(n).alias("h"), b.alias("b")) for n, b in blocks])
    body = F.flatten(F.transform(F.array_sort(arr), lambda s: s["b"]))
    tokens = F.concat(F.array(F.lit(START)), body, F.array(F.lit(END)))
    return opt.withColumn("tokens", tokens).withColumn("length", F.size("tokens"))


# ---------------------------------------------------------------- J-3
def byte_sequence(opt_v4: DataFrame) -> DataFrame:
    """J-3: IPv4 variant: 4 source bytes, 4 destination bytes, SUCCESS/FAIL
    (10 discrete tokens per measurement incl. the separator)."""
    def bytes_of(x):
        return [(F.floor(x / (1 << s)) % 256).cast("int") for s in (24, 16, 8, 0)]
    ok = F.when(succeeded(), F.lit(BYTE_SUCCESS)).otherwise(F.lit(BYTE_FAIL))
    toks = F.array(*bytes_of(F.col("src_ipv4_int")), *bytes_of(F.col("dst_ipv4_int")), ok, F.lit(BYTE_SEP))
    return opt_v4.withColumn("byte_tokens", toks)


def succeeded() -> Column:
    """All packets came back with a latency."""
    return F.coalesce((F.col("sent") == F.col("rcvd")) & (F.col("avg") > 0), F.lit(False))


def time_of_week(ts="ts") -> Column:
    """The 10-minute bucket of the week (0 = Monday midnight UTC), 0..1007."""
    return F.floor(((_c(ts) + 3 * 86400) % 604800) / TIME_BUCKET_SECONDS).cast("int")


# ---------------------------------------------------------------- J-4
def decode_tokens(tokens="tokens") -> Column:
    """J-4: token ids -> names by range."""
    def name(t):
        out = F.when(t == START, "START")
        for i, n in enumerate(STRUCT_NAMES[1:], 1):
            out = out.when(t == i, n)
        return (out.when(t == UNKNOWN_ADDRESS, "UNKNOWN_ADDRESS").when(t.between(SHORT_MIN, SHORT_MAX), F.concat(F.lit("SHORT("), (t - SHORT_MIN).cast("string"), F.lit(")")))
                   .when(t.between(LATENCY_MIN, LATENCY_MAX), F.concat(F.lit("LAT("), (t - LATENCY_MIN).cast("string"), F.lit(")")))
                   .when(t.between(TIMESTAMP_MIN, TIMESTAMP_MAX), F.concat(F.lit("TIME("), (t - TIMESTAMP_MIN).cast("string"), F.lit(")")))
                   .otherwise(F.concat(F.lit("UNKNOWN("), t.cast("string"), F.lit(")"))))
    return F.transform(_c(tokens), name)


# ---------------------------------------------------------------- J-5
def validate_tokens(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """J-5: list of violated rules per row (empty when valid): first START,
    last END, all ids in vocabulary, contains SRC, DST and LATENCY."""
    t = F.col(tokens)
    checks = [
        (F.try_element_at(t, F.lit(1)) != START, "first token is not START"),
        (F.try_element_at(t, F.lit(-1)) != END, "last token is not END"),
        (~F.forall(t, lambda x: (x >= 0) & (x < VOCAB_SIZE)), "token outside vocabulary"),
        (~F.array_contains(t, SRC), "missing SRC"),
        (~F.array_contains(t, DST), "missing DST"),
        (~F.array_contains(t, LATENCY), "missing LATENCY"),
    ]
    v = F.filter(F.array(*[F.when(F.coalesce(c, F.lit(True)), F.lit(msg)) for c, msg in checks]),
                 lambda x: x.isNotNull())
    return df.withColumn("violations", v).withColumn("valid", F.size(v) == 0)


# ---------------------------------------------------------------- J-6
def token_stats(tok: DataFrame) -> DataFrame:
    """J-6: sequence length min/max/mean/median, total and distinct tokens,
    and tokens per class (structural, short, latency, timestamp)."""
    lens = tok.agg(F.count(F.lit(1)).alias("n_sequences"), F.min("length").alias("min_length"),
                   F.max("length").alias("max_length"), r6(F.avg("length")).alias("mean_length"),
                   F.sum("length").cast("bigint").alias("total_tokens"))
    med = exact_quantiles(tok, [], "length", {"median_length": 0.5})
    t = tok.select(F.explode("tokens").alias("t"))
    cls = t.agg(F.count_distinct("t").alias("unique_tokens"),
                F.count_if((F.col("t") <= PAD) | (F.col("t") == UNKNOWN_ADDRESS)).alias("structural"),
                F.count_if(F.col("t").between(SHORT_MIN, SHORT_MAX)).alias("short"),
                F.count_if(F.col("t").between(LATENCY_MIN, LATENCY_MAX)).alias("latency"),
                F.count_if(F.col("t").between(TIMESTAMP_MIN, TIMESTAMP_MAX)).alias("timestamp"))
    k = F.lit(0).alias("_k")
    return (lens.select("*", k).join(med.select(r6("median_length").alias("median_length"), k), "_k")
                .join(cls.select("*", k), "_k").drop("_k"))


# ---------------------------------------------------------------- J-7
def pad_and_mask(df: DataFrame, max_length: int, tokens: str = "tokens") -> DataFrame:
    """J-7: pad sequences shorter than ``max_length`` with PAD, with a
    boolean attention mask (True on real tokens) and the real length.
    Longer sequences are kept whole (no truncation) with a full mask."""
    t = F.col(tokens)
    n = F.size(t)
    padded = F.concat(t, F.array_repeat(F.lit(PAD), F.greatest(F.lit(0), F.lit(max_length) - n)))
    mask = F.transform(padded, lambda x, i: i < n)
    return df.withColumn("padded", padded).withColumn("attention_mask", mask).withColumn("lengths", n)


# ---------------------------------------------------------------- J-8
def split(opt: DataFrame, train_share_hex: str = "b333") -> DataFrame:
    """J-8: probe split by md5(prb_id) (< 'b333' ≈ 70 % train probes) and a
    day index from the table's first timestamp: train probes give days 1-5
    to 'train' and day 6 to 'val'; held-out probes give day 7 to 'test';
    every other row is 'unused'."""
    t0 = opt.agg(F.min("ts")).scalar()
    day = (F.floor((F.col("ts") - t0) / 86400) + 1).cast("bigint")
    train_probe = F.md5(F.col("prb_id").cast("string")) < F.lit(train_share_hex)
    d = F.col("day")
    lab = (F.when(train_probe & d.between(1, 5), "train").when(train_probe & (d == 6), "val")
            .when(~train_probe & (d == 7), "test").otherwise("unused"))
    return opt.withColumn("day", day).withColumn("split", lab)


# ---------------------------------------------------------------- I-9
def _windows_of(sizes: list[int]) -> Column:
    """The windows (size, wid) of all sizes that hold the row at ``rn`` of ``_n``: at most two of each size."""
    p = F.col("rn") - 1
    every = [F.struct(F.lit(s).alias("size"), (F.floor(p / (s // 2)) - back).cast("int").alias("wid"))
             for s in sizes for back in (0, 1)]
    return F.explode(F.filter(F.array(*every), lambda w: (w["wid"] >= 0) & (w["wid"] * F.floor(w["size"] / 2) < F.col("_n") - w["size"]))
                     ).alias("w")


def training_windows(df: DataFrame, key: str = "prb_id", sizes: list[int] | None = None,
                     tiebreak: list[str] | None = None) -> DataFrame:
    """I-9: per probe in ts order, windows of each size with stride size/2,
    ``start in range(0, n - size, stride)``; each window in both conditions.
    Output: key, size, wid, condition, n, first_ts, last_ts, mean_latency,
    success_pct."""
    sizes = sizes or WINDOW_SIZES
    tiebreak = tiebreak or ["dst_addr_display", "avg"]
    idx = ordered_index(df, [key], "ts", tiebreak)
    n = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    idx = idx.join(n, key)
    u = idx.select(key, "ts", "avg", "sent", "rcvd", _windows_of(sizes)).select("*", "w.size", "w.wid")
    ok = (F.col("sent") == F.col("rcvd")) & (F.col("avg") > 0)
    a = u.groupBy(key, "size", "wid").agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
        r6(F.avg(F.col("avg").cast("double"))).alias("mean_latency"),
        r6(F.count_if(ok) * 100.0 / F.count(F.lit(1))).alias("success_pct"))
    return a.select(key, F.col("size").cast("bigint").alias("size"), F.col("wid").cast("bigint").alias("wid"),
                    F.explode(F.array(*[F.lit(c) for c in CONDITIONS])).alias("condition"),
                    "n", "first_ts", "last_ts", "mean_latency", "success_pct")


def window_sequences(opt_v4: DataFrame, key: str = "prb_id", sizes: list[int] | None = None) -> DataFrame:
    """I-9 + J-3: the training sequence of every window in both conditions, as long as the window's size asks.

    ``tokens``: the condition, then for each measurement in ts order its bytes,
    outcome and separator; of the last measurement, the one to predict, the
    bytes alone. ``latency``: one value per known measurement, NULL where it
    failed — in both conditions. ``week_time`` and ``gap`` (10-minute bucket of the
    week; seconds since the measurement before, 0 for the first): one value per
    measurement, the last included, under TEMPORAL only; NULL otherwise.
    ``target_success`` and ``target_latency`` (NULL when it failed) are the
    outcome of the last measurement. A window holds at most ``max(sizes)`` rows.
    """
    sizes = sizes or WINDOW_SIZES
    b = byte_sequence(opt_v4).withColumn("_ok", succeeded())
    idx = ordered_index(b, [key], "ts", ["dst_addr_display", "avg"])
    n = b.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    latency = F.when(F.col("_ok"), F.col("avg").cast("double"))
    u = idx.join(n, key).select(key, F.struct("rn", "byte_tokens", "ts", latency.alias("latency"), F.col("_ok").alias("ok")).alias("m"),
                                _windows_of(sizes)).select(key, "m", "w.size", "w.wid")
    seq = u.groupBy(key, "size", "wid").agg(F.array_sort(F.collect_list("m")).alias("ms"))
    known = F.slice("ms", 1, F.size("ms") - 1)
    last = F.element_at("ms", -1)
    body = F.concat(F.flatten(F.transform(known, lambda m: m["byte_tokens"])), F.slice(last["byte_tokens"], 1, 8))
    gap = F.transform("ms", lambda m, i: m["ts"] - F.get("ms", F.greatest(i - 1, F.lit(0)))["ts"])
    conds = F.explode(F.array(*[F.struct(F.lit(c).alias("condition"), F.lit(t).alias("token"))
                                for c, t in zip(CONDITIONS, (BYTE_TEMPORAL, BYTE_NO_TEMPORAL), strict=True)])).alias("c")
    timed = F.col("c.condition") == CONDITIONS[0]
    made = seq.select(key, "size", "wid", body.alias("body"), F.transform(known, lambda m: m["latency"]).alias("latency"),
                      F.transform("ms", lambda m: time_of_week(m["ts"])).alias("week_time"), gap.alias("gap"),
                      last["ok"].alias("target_success"), last["latency"].alias("target_latency"))
    return made.select("*", conds).select(
        key, "size", "wid", "c.condition", F.concat(F.array("c.token"), "body").alias("tokens"), "latency",
        F.when(timed, F.col("week_time")).alias("week_time"), F.when(timed, F.col("gap")).alias("gap"),
        "target_success", "target_latency")


# ---------------------------------------------------------------- J-9
def evaluate(pred: DataFrame, y: str = "y", p: str = "pred", by: list[str] | None = None,
             z: float = 1.96) -> DataFrame:
    """J-9: MAE with a normal confidence interval per group (e.g. method,
    condition, sequence length, hour of day)."""
    by = by or []
    err = F.abs(F.col(y) - F.col(p))
    a = pred.where(F.col(p).isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(err).alias("mae"), F.stddev_samp(err).alias("sd"))
    se = F.col("sd") / F.sqrt(F.col("n"))
    return a.select(*by, "n", r6("mae").alias("mae"), r6(F.col("mae") - z * se).alias("ci_lo"),
                    r6(F.col("mae") + z * se).alias("ci_hi"))


def window_errors(forecasts: DataFrame, methods: list[str], keys: list[str], lengths: list[int] | None = None) -> DataFrame:
    """Mean absolute error of every method in every full window of ``length`` consecutive rows (tumbling by ``rn``),
    over the rows for which all methods have a forecast. Output: keys, length, wid, hour (of the window's first row),
    n, one column per method. ``forecasts`` has keys, rn, ts, y and the methods' columns.

    Rows are summed once, in runs of the lengths' greatest common divisor; the
    lengths' windows are put together from those."""
    lengths = lengths or WINDOW_SIZES
    step = math.gcd(*lengths)
    whole = F.col("y").isNotNull()
    for m in methods:
        whole = whole & F.col(m).isNotNull()
    runs = forecasts.groupBy(*keys, F.floor((F.col("rn") - 1) / step).alias("_run")).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("ts").alias("_ts"), F.count_if(whole).alias("n"),
        *[F.sum(F.when(whole, F.abs(F.col("y") - F.col(m)))).alias(m) for m in methods])
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("length"), F.floor(F.col("_run") * step / k).alias("wid")) for k in lengths]))
    w = (runs.select("*", each.alias("_w")).groupBy(*keys, "_w.length", "_w.wid")
         .agg(F.sum("_rows").alias("_rows"), F.min("_ts").alias("_ts"), F.sum("n").alias("n"), *[F.sum(m).alias(m) for m in methods]))
    return (w.where((F.col("_rows") == F.col("length")) & (F.col("n") > 0))
             .select(*keys, F.col("length").cast("bigint").alias("length"), F.col("wid").cast("bigint").alias("wid"),
                     hour_of(F.col("_ts")).alias("hour"), "n", *[(F.col(m) / F.col("n")).alias(m) for m in methods]))


def delta_mae(windows: DataFrame, a: str, others: list[str], by: list[str] | None = None, z: float = 1.96) -> DataFrame:
    """J-9: how much smaller the error of each of ``others`` is than that of ``a``, paired by window.

    ``windows`` has one row per window with the methods' errors as columns
    (:func:`window_errors`). Output: by, method, n_windows, mae_a, mae, delta_mae
    (mean of the windows' differences, unrounded until the end; above 0: better than
    ``a``), its normal confidence interval, t_stat (NULL when all differences
    agree or there is one window) and whether the interval leaves out 0."""
    by = by or []
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("method"), F.col(m).alias("e")) for m in others])).alias("o")
    d = F.col(a) - F.col("o.e")
    g = windows.select(*by, a, each).groupBy(*by, "o.method").agg(
        F.count(d).alias("n_windows"), F.avg(F.when(d.isNotNull(), F.col(a))).alias("mae_a"), F.avg(F.when(d.isNotNull(), F.col("o.e"))).alias("mae"),
        F.avg(d).alias("delta"), F.when((F.count(d) > 1) & (F.max(d) > F.min(d)), F.stddev_samp(d)).alias("sd"))
    se = F.col("sd") / F.sqrt(F.col("n_windows"))
    t = F.col("delta") / se
    return g.select(*by, "method", "n_windows", r6("mae_a").alias("mae_a"), r6("mae").alias("mae"), r6("delta").alias("delta_mae"),
                    r6(F.col("delta") - z * se).alias("ci_lo"), r6(F.col("delta") + z * se).alias("ci_hi"), r6(t).alias("t_stat"),
                    F.coalesce(F.abs(t) > z, F.lit(False)).alias("significant"))


def success_accuracy(pred: DataFrame, label: str = "success", p: str = "pred_success",
                     by: list[str] | None = None, z: float = 1.96) -> DataFrame:
    """J-9: accuracy of a success/failure prediction with a normal confidence interval; rows without label or
    prediction don't count."""
    by = by or []
    hit = F.col(label) == F.col(p)
    a = pred.where(hit.isNotNull()).groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.avg(hit.cast("double")).alias("acc"))
    se = F.sqrt(F.col("acc") * (1 - F.col("acc")) / F.col("n"))
    return a.select(*by, "n", r6("acc").alias("accuracy"), r6(F.col("acc") - z * se).alias("ci_lo"), r6(F.col("acc") + z * se).alias("ci_hi"))


# ---------------------------------------------------------------- J-10
def dataset_traits(opt: DataFrame, key: str = "prb_id") -> DataFrame:
    """J-10: latency mean/std/min/max, success %, and rows-per-probe skew
    (min, exact quartiles, max)."""
    a = opt.agg(r6(F.avg(F.col("avg").cast("double"))).alias("mean_latency"),
                r6(F.stddev_samp(F.col("avg").cast("double"))).alias("std_latency"),
                r6(F.min(F.col("avg").cast("double"))).alias("min_latency"),
                r6(F.max(F.col("avg").cast("double"))).alias("max_latency"),
                r6(F.count_if(F.col("sent") == F.col("rcvd")) * 100.0 / F.count(F.lit(1))).alias("success_pct"))
    per = opt.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    s = per.agg(F.count(F.lit(1)).alias("n_probes"), F.min("rows").alias("min_rows_per_probe"),
                F.max("rows").alias("max_rows_per_probe"))
    q = exact_quantiles(per, [], "rows", {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    k = F.lit(0).alias("_k")
    return (a.select("*", k).join(s.select("*", k), "_k")
             .join(q.select(r6("p25").alias("p25_rows_per_probe"), r6("p50").alias("median_rows_per_probe"),
                            r6("p75").alias("p75_rows_per_probe"), k), "_k").drop("_k"))


# ---------------------------------------------------------------- J-11
def sample_sequences(windows: DataFrame, good_probes: DataFrame, n: int, seed: int = 42,
                     key: str = "prb_id") -> DataFrame:
    """J-11: ``n`` windows drawn from good probes (G-16) in a seeded md5
    order, each in both conditions (50/50 balance). Sampling is the feature."""
    g = good_probes.where("good").select(F.col(good_probes.columns[0]).alias(key))
    w = windows.where(F.col("condition") == CONDITIONS[0]).join(g, key, "left_semi")
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string"),
                          F.col("size").cast("string"), F.col("wid").cast("string")))
    picked = w.withColumn("_h", h).orderBy("_h").limit(n).drop("_h", "condition")
    return picked.select("*", F.explode(F.array(*[F.lit(c) for c in CONDITIONS])).alias("condition"))


# ------------------------------------------------------------- registry
METHODS = ["persistence", "moving_avg", "linear"]  # columns of series.baselines


def entry_queries(opt_fn, edges_fn) -> dict:
    from ..operators.filters import ipv4_only, success_label
    from ..operators.profile import probe_quality
    from ..operators.series import baselines

    def q_tokenize(spark, sf):
        t = tokenize(opt_fn(spark, sf))
        return t.select("prb_id", "ts", "dst_addr_display", F.array_join("tokens", " ").alias("tokens"),
                        F.col("length").cast("bigint").alias("length"))

    def q_validate_tokens(spark, sf):
        v = validate_tokens(tokenize(opt_fn(spark, sf)))
        return v.agg(F.count(F.lit(1)).alias("n_sequences"), F.count_if("valid").alias("n_valid"))

    def q_decode_tokens(spark, sf):
        t = tokenize(opt_fn(spark, sf))
        return t.select("prb_id", "ts", "dst_addr_display", F.array_join(decode_tokens("tokens"), " ").alias("names"))

    def q_token_stats(spark, sf):
        return token_stats(tokenize(opt_fn(spark, sf)))

    def q_pad_and_mask(spark, sf):
        t = pad_and_mask(tokenize(opt_fn(spark, sf)), 24)
        return t.select("prb_id", "ts", "dst_addr_display", F.array_join("padded", " ").alias("padded"),
                        F.size(F.filter("attention_mask", lambda x: x)).cast("bigint").alias("mask_true"),
                        F.size("attention_mask").cast("bigint").alias("mask_len"), F.col("lengths").cast("bigint").alias("lengths"))

    def q_byte_sequence(spark, sf):
        b = byte_sequence(ipv4_only(opt_fn(spark, sf)))
        return b.select("prb_id", "ts", "dst_ipv4_int", F.array_join("byte_tokens", " ").alias("byte_tokens"))

    def q_split(spark, sf):
        s = split(opt_fn(spark, sf))
        return s.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("prb_id").alias("n_probes"))

    def q_training_windows(spark, sf):
        return training_windows(opt_fn(spark, sf))

    def q_dataset_traits(spark, sf):
        return dataset_traits(opt_fn(spark, sf))

    def q_sample_sequences(spark, sf):
        o = opt_fn(spark, sf)
        good = probe_quality(o, key="prb_id", dst="dst_addr_display")
        return sample_sequences(training_windows(o), good, 20)

    def q_window_sequences(spark, sf):
        s = window_sequences(ipv4_only(opt_fn(spark, sf)))
        us = F.transform("latency", lambda x: F.coalesce(F.round(x * 1000).cast("bigint").cast("string"), F.lit("-")))
        return s.select("prb_id", F.col("size").cast("bigint").alias("size"), F.col("wid").cast("bigint").alias("wid"), "condition",
                        F.array_join("tokens", " ").alias("tokens"), F.array_join(us, " ").alias("latency_us"),
                        F.array_join("week_time", " ").alias("week_time"), F.array_join("gap", " ").alias("gap"),
                        "target_success", r6("target_latency").alias("target_latency"))

    def q_evaluate(spark, sf):
        errors = window_errors(baselines(edges_fn(spark, sf)), METHODS, ["src", "dst"])
        overall = delta_mae(errors, METHODS[0], METHODS[1:], ["length"])
        hourly = delta_mae(errors, METHODS[0], METHODS[1:], ["length", "hour"])
        return overall.withColumn("hour", F.lit(None).cast(hourly.schema["hour"].dataType)).unionByName(hourly)

    def q_evaluate_mae(spark, sf):
        return evaluate(baselines(edges_fn(spark, sf)).withColumn("hour", hour_of("ts")), p=METHODS[0], by=["hour"])

    def q_success_accuracy(spark, sf):
        e = success_label(edges_fn(spark, sf)).select("src", "dst", "ts", "avg", "success")
        idx = ordered_index(e, ["src", "dst"], "ts", ["avg", "success"])
        pred = with_lags(idx, ["src", "dst"], "success", 1).withColumn("hour", hour_of("ts"))
        return success_accuracy(pred, p="lag_1", by=["hour"])

    return {"tokenize": q_tokenize, "validate_tokens": q_validate_tokens, "decode_tokens": q_decode_tokens,
            "token_stats": q_token_stats, "pad_and_mask": q_pad_and_mask, "byte_sequence": q_byte_sequence,
            "split": q_split, "training_windows": q_training_windows, "dataset_traits": q_dataset_traits,
            "sample_sequences": q_sample_sequences, "window_sequences": q_window_sequences, "evaluate": q_evaluate,
            "evaluate_mae": q_evaluate_mae, "success_accuracy": q_success_accuracy}
