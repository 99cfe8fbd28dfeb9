from pyspark.sql import functions as F

from rttlab.operators import sequences as J


def _opt_rows(spark, n, prb=1):
    rows = [(prb, 1_700_000_000 + 10 * i, 3, 3, 12.5, "10.0.0.1", 167772161, None, False, 167772162, None)
            for i in range(n)]
    return spark.createDataFrame(rows, "prb_id long, ts long, sent short, rcvd short, avg float, "
                                       "dst_addr_display string, dst_ipv4_int long, dst_ipv6_bytes binary, "
                                       "src_is_ipv6 boolean, src_ipv4_int long, src_ipv6_bytes binary"
                                 ).withColumn("dst_is_ipv6", F.lit(False))


def test_training_window_counts(spark):
    # edge_windows expectations of FIXTURES.md (sizes 20/40/80/128).
    expected = {20: 0, 21: 1, 40: 2, 100: 12, 129: 19, 300: 50}
    for n, want in expected.items():
        w = J.training_windows(_opt_rows(spark, n))
        got = w.where(F.col("condition") == "TEMPORAL").count()
        assert got == want, (n, got)
        if want:
            assert w.where(F.col("n") != F.col("size")).count() == 0


def test_tokens_valid_and_padding(spark):
    t = J.tokenize(_opt_rows(spark, 5))
    v = J.validate_tokens(t).collect()
    assert all(r.valid for r in v)
    assert all(r.length == 1 + 4 + 4 + 2 + 2 + 1 for r in v)
    p = J.pad_and_mask(t, 20).collect()
    for r in p:
        assert len(r.padded) == 20 and r.padded[r.lengths:] == [J.PAD] * (20 - r.lengths)
        assert r.attention_mask == [True] * r.lengths + [False] * (20 - r.lengths)
    long = J.pad_and_mask(t, 4).collect()
    assert all(r.padded == r.tokens for r in long)  # never truncated


def test_rows_without_a_known_address_keep_their_sequence(spark):
    opt = (_opt_rows(spark, 3).withColumn("src_is_ipv6", F.lit(None).cast("boolean"))
           .withColumn("dst_ipv4_int", F.lit(0).cast("bigint")))
    rows = J.validate_tokens(J.tokenize(opt)).withColumn("names", J.decode_tokens()).collect()
    assert len(rows) == 3
    for r in rows:
        assert r.valid and r.tokens.count(J.UNKNOWN_ADDRESS) == 2 and r.names.count("UNKNOWN_ADDRESS") == 2


def test_validate_flags_bad_sequences(spark):
    df = spark.createDataFrame([([1, 2, 3],), ([0, 2, 3, 6, 99999999, 1],)], "tokens array<int>")
    v = J.validate_tokens(df).collect()
    assert "first token is not START" in v[0].violations and "missing LATENCY" in v[0].violations
    assert v[1].violations == ["token outside vocabulary"]


def _measurements(spark, n=45, key=7):
    rows = [(key, 1_700_000_000 + 61 * i, 3, 3 if i % 9 else 1, float(i % 9) / 8 if i % 9 else -1.0, 167772161, 167772162 + i, f"10.0.0.{i}")
            for i in range(n)]
    return rows, spark.createDataFrame(rows, "prb_id long, ts long, sent long, rcvd long, avg double, src_ipv4_int long, dst_ipv4_int long, "
                                             "dst_addr_display string")


def test_window_sequences_hold_latency_time_and_target(spark):
    from rttlab.operators import sequences as J
    rows, df = _measurements(spark)
    got = {(r["size"], r.wid, r.condition): r for r in J.window_sequences(df.repartition(3), sizes=[20, 8]).collect()}
    windows = [(s, w) for s in (20, 8) for w in range((45 - s - 1) // (s // 2) + 1)]
    assert set(got) == {(s, w, c) for s, w in windows for c in ("TEMPORAL", "NO_TEMPORAL")}
    for (size, wid, condition), r in got.items():
        part = rows[wid * (size // 2):wid * (size // 2) + size]
        ok = [p[2] == p[3] and p[4] > 0 for p in part]
        octets = lambda x: [x >> 24 & 255, x >> 16 & 255, x >> 8 & 255, x & 255]
        tokens = [259 if condition == "TEMPORAL" else 260]
        for k, p in enumerate(part):
            tokens += octets(p[5]) + octets(p[6]) + ([256 if ok[k] else 257, 258] if k < size - 1 else [])
        assert r.tokens == tokens
        assert r.latency == [p[4] if good else None for p, good in zip(part, ok)][:-1]
        times = [p[1] for p in part]
        if condition == "TEMPORAL":
            assert r.week_time == [(t + 259200) % 604800 // 600 for t in times]
            assert r.gap == [0, *(b - a for a, b in zip(times, times[1:]))]
        else:
            assert r.week_time is None and r.gap is None
        assert r.target_success == ok[-1] and r.target_latency == (part[-1][4] if ok[-1] else None)


def test_paired_differences(spark):
    import random
    import statistics
    from rttlab.operators import sequences as J
    rng = random.Random(4)
    rows = []
    for pair in range(3):
        for rn in range(1, 100):
            y = rng.random() * 10
            a = None if rn == 1 else y + rng.choice([-2.0, 2.0])
            b = None if rn < 3 else y + rng.choice([-1.0, 1.5])
            rows.append((pair, rn, 1_700_000_000 + rn * 300, None if rn == 50 else y, a, b))
    df = spark.createDataFrame(rows, "k long, rn long, ts long, y double, a double, b double").repartition(4)
    windows = J.window_errors(df, ["a", "b"], ["k"], [20, 8]).collect()
    want = {}
    for pair in range(3):
        for size in (20, 8):
            for w in range(99 // size):
                part = [r for r in rows if r[0] == pair and (r[1] - 1) // size == w]
                use = [r for r in part if None not in r[3:]]
                want[pair, size, w] = (len(use), part[0][2] % 86400 // 3600, *(sum(abs(r[3] - r[c]) for r in use) / len(use) for c in (4, 5)))
    got = {(r.k, r.length, r.wid): (r.n, r.hour, r.a, r.b) for r in windows}
    assert set(got) == set(want) and all(abs(x - y) < 1e-9 for k in got for x, y in zip(got[k], want[k]))
    out = {(r.length, r.method): r for r in J.delta_mae(spark.createDataFrame(windows), "a", ["b"], ["length"]).collect()}
    for size in (20, 8):
        d = [v[2] - v[3] for k, v in want.items() if k[1] == size]
        r, m, se = out[size, "b"], statistics.mean(d), statistics.stdev(d) / len(d) ** 0.5
        assert r.n_windows == len(d) and abs(r.delta_mae - m) < 2e-6 and abs(r.t_stat - m / se) < 2e-6
        assert abs(r.ci_lo - (m - 1.96 * se)) < 2e-6 and abs(r.ci_hi - (m + 1.96 * se)) < 2e-6 and r.significant == (abs(m / se) > 1.96)
    alike = spark.createDataFrame([(1.0, 0.5), (1.0, 0.5)], "a double, b double")
    r = J.delta_mae(alike, "a", ["b"]).head()
    assert (r.n_windows, r.delta_mae, r.t_stat, r.significant) == (2, 0.5, None, False)


def test_success_accuracy(spark):
    from rttlab.operators import sequences as J
    df = spark.createDataFrame([(1, True, True), (1, False, True), (1, True, True), (1, None, True), (2, False, None), (2, False, False)],
                               "h long, success boolean, pred_success boolean")
    got = {r.h: (r.n, r.accuracy) for r in J.success_accuracy(df, by=["h"]).collect()}
    assert got == {1: (3, 0.666667), 2: (1, 1.0)}


def test_pair_variation_against_pandas(spark):
    import random
    import pandas as pd
    from rttlab.operators.pairs import pair_variation
    rng = random.Random(2)
    rows = [(s, d, 1_700_000_000 + rng.randint(0, 86_400 * 15), None if rng.random() < 0.05 else 5000 + rng.random()) for s in range(2) for d in range(3)
            for _ in range(rng.choice([1, 2, 400]))] + [(9, 9, 5, None)]
    pdf = pd.DataFrame(rows, columns=["src", "dst", "ts", "avg"])
    t = pd.to_datetime(pdf.ts, unit="s")
    got = {(r.src, r.dst): r for r in pair_variation(spark.createDataFrame(rows, "src long, dst long, ts long, avg double")).collect()}
    assert set(got) == set(zip(pdf.src, pdf.dst))
    for key, g in pdf.groupby(["src", "dst"]):
        r = got[key]
        same = lambda x, y: (x is None and pd.isna(y)) or abs(x - y) < 2e-6
        assert r["count"] == len(g) and same(r.mean_latency, g.avg.mean()) and same(r.std_latency, g.avg.std())
        assert same(r.hourly_variation, g.avg.groupby(t[g.index].dt.hour).std().mean())
        assert same(r.daily_variation, g.avg.groupby(t[g.index].dt.weekday).std().mean())
