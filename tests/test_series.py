import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rttlab.operators import ordering as O
from rttlab.operators import series as I


def _edges(spark, series):
    rows = []
    for (src, dst), xs in series.items():
        for i, x in enumerate(xs):
            rows.append((src, dst, 1_700_000_000 + 37 * i, float(x), 3, 3))
    return spark.createDataFrame(rows, "src long, dst long, ts long, avg double, sent long, rcvd long")


def _pearson(a, b):
    a, b = np.asarray(a, float), np.asarray(b, float)
    if len(a) < 2 or a.std() == 0 or b.std() == 0:
        return None
    return float(np.corrcoef(a, b)[0, 1])


def test_lag1_known_series(spark):
    series = {(0, 1): list(range(1, 30)), (0, 2): [(-1) ** i for i in range(30)],
              (0, 3): [5.0] * 30, (0, 4): [0.1] * 30, (0, 5): [1.0], (0, 6): [1.0, 2.0],
              (0, 7): [1.0, 2.0, 4.0]}
    out = {(r.src, r.dst): r.autocorr for r in I.autocorr_lag1(_edges(spark, series)).collect()}
    assert out[(0, 1)] == pytest.approx(1.0)
    assert out[(0, 2)] == pytest.approx(-1.0)
    assert out[(0, 3)] is None and out[(0, 4)] is None
    assert out[(0, 5)] is None and out[(0, 6)] is None
    assert out[(0, 7)] == pytest.approx(1.0)


def test_ordered_index_hot_pair_small_blocks(spark):
    rng = random.Random(7)
    rows = []
    for i in range(3000):  # one hot pair with a third of the rows and duplicate timestamps
        rows.append((1, 2, 1000 + rng.randint(0, 400), float(rng.randint(1, 50))))
    for i in range(6000):
        rows.append((rng.randint(3, 9), rng.randint(3, 9), 1000 + rng.randint(0, 8000), rng.random()))
    df = spark.createDataFrame(rows, "src long, dst long, ts long, avg double")
    idx = O.ordered_index(df, ["src", "dst"], "ts", ["avg"], cell_rows=40)
    got = sorted((r.src, r.dst, r.rn, r.ts, r.avg) for r in idx.collect())
    exp = []
    for key in sorted({(r[0], r[1]) for r in rows}):
        xs = sorted((r[2], r[3]) for r in rows if (r[0], r[1]) == key)
        exp += [(key[0], key[1], i + 1, t, a) for i, (t, a) in enumerate(xs)]
    assert got == sorted(exp)
    lag = O.with_lags(idx, ["src", "dst"], "avg", 3, block=50)
    by = {(r.src, r.dst, r.rn): r for r in lag.collect()}
    for (s, d, rn), r in by.items():
        for k in (1, 2, 3):
            prev = by.get((s, d, rn - k))
            assert getattr(r, f"lag_{k}") == (prev.avg if prev else None)


def test_autocorr_multi_brute_force(spark):
    rng = np.random.default_rng(3)
    series = {(1, 2): list(np.cumsum(rng.normal(size=200)) + 100), (1, 3): list(rng.random(70) + 1),
              (2, 3): list(rng.random(40) + 1)}
    out = I.autocorr_multi(_edges(spark, series), max_lag=20, min_n=60).collect()
    got = {(r.src, r.dst, r.lag): r.autocorr for r in out}
    assert {(k[0], k[1]) for k in got} == {(1, 2), (1, 3)}
    for (s, d), xs in series.items():
        if len(xs) < 60:
            continue
        for lag in range(1, 21):
            r = _pearson(xs[:-lag], xs[lag:])
            assert got[(s, d, lag)] == pytest.approx(0.0 if r is None else r, abs=1e-6)


@pytest.mark.parametrize("n", [19, 60, 101, 217, 400])
def test_rolling_cv_and_moving_average_brute_force(spark, n):
    rng = np.random.default_rng(n)
    xs = list(rng.random(n) * 10 + 1)
    e = _edges(spark, {(4, 5): xs})
    got = sorted((r.chunk, r.cv) for r in I.rolling_cv(e).collect())
    c = max(10, n // 20)
    exp = []
    for j, i in enumerate(range(0, n - c + 1, c // 2)):
        ch = np.asarray(xs[i:i + c])
        exp.append((j, round(float(ch.std() / ch.mean()), 6)))
    assert [g[0] for g in got] == [e_[0] for e_ in exp]
    assert [g[1] for g in got] == pytest.approx([e_[1] for e_ in exp], abs=1e-6)
    w = min(20, n // 10)
    ma = sorted((r.rn, r.ma) for r in I.moving_average(e).collect())
    if w > 1:
        conv = np.convolve(xs, np.ones(w) / w, mode="valid")
        assert [m[1] for m in ma] == pytest.approx(list(conv), abs=1e-6)
        assert ma[0][0] == w
    else:
        assert ma == []


def test_autocorr_matrix_diagonal_and_bound(spark):
    rng = np.random.default_rng(11)
    series = {(1, 2): list(rng.random(80) + 1), (2, 1): list(rng.random(5) + 1), (1, 3): list(rng.random(30) + 1)}
    e = _edges(spark, series)
    m = {(r.src, r.dst): r.autocorr for r in I.autocorr_matrix(e, n_nodes=3, bound=50).collect()}
    assert m[(1, 1)] == 1.0 and m[(2, 2)] == 1.0 and m[(3, 3)] == 1.0
    assert (2, 1) not in m  # fewer than 10 rows
    xs = series[(1, 2)][:50]
    assert m[(1, 2)] == pytest.approx(_pearson(xs[:-1], xs[1:]), abs=1e-6)


def test_ordered_index_exchanges_rows_once_and_not_by_time(spark):
    import re
    rows = [(1, 2, 1000 + i % 7, float(i)) for i in range(300)] + [(3, i % 5, 1000 * i, 1.0) for i in range(600)]
    df = spark.createDataFrame(rows, "src long, dst long, ts long, avg double")
    plan = O.ordered_index(df, ["src", "dst"], "ts", ["avg"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan
    physical = O.ordered_index(df, ["src", "dst"], "ts", ["avg"])._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"hashpartitioning\(([^)]*)\)", physical)
    assert keys and not any(re.search(r"\bts#", k) for k in keys)
    assert sum("_cell#" in k for k in keys) <= 2              # the rows, and the few offsets


def test_ordered_index_cuts_cells_down_to_seconds(spark):
    # a third of the rows in one pair, most of them in one minute
    rng = random.Random(5)
    rows = [(1, 2, 86_400 * 3 + rng.randint(0, 50), float(rng.randint(0, 5))) for _ in range(1000)]
    rows += [(1, 2, rng.randint(0, 86_400 * 9), 0.5) for _ in range(300)]
    rows += [(rng.randint(1, 4), rng.randint(3, 9), rng.randint(0, 86_400 * 9), rng.random()) for _ in range(2000)]
    rows += [(1, 2, None, 1.0), (None, 2, 5, 1.0)]            # no position
    df = spark.createDataFrame(rows, "src long, dst long, ts long, avg double")
    for bound in (5, 60, 10_000):
        got = sorted((r.src, r.dst, r.rn, r.ts, r.avg) for r in O.ordered_index(df, ["src", "dst"], "ts", ["avg"], cell_rows=bound).collect())
        want = []
        for key in sorted({r[:2] for r in rows if None not in r[:3]}):
            xs = sorted(r[2:] for r in rows if r[:2] == key and r[2] is not None)
            want += [(*key, i + 1, t, a) for i, (t, a) in enumerate(xs)]
        assert got == sorted(want)
    assert O.ordered_index(df.limit(0), ["src", "dst"]).count() == 0


def test_autocorr_multi_against_numpy(spark):
    rng = random.Random(11)
    series = {(0, 1): [rng.random() * 100 + 5000 for _ in range(200)], (0, 2): [3.0] * 80, (0, 3): [2.0] * 70 + [9.0],
              (0, 4): [1.0] + [2.0] * 64, (0, 5): list(range(1, 61)), (0, 6): [rng.choice([1.0, 4.0]) for _ in range(61)],
              (0, 7): [1.0] * 59, (0, 8): [1.0] * 30 + [5.0] * 60}
    got = {(r.src, r.dst, r.lag): r.autocorr for r in I.autocorr_multi(_edges(spark, series)).collect()}
    want = {}
    for key, xs in series.items():
        if len(xs) >= 60:
            for k in range(1, 61):
                r = _pearson(xs[:-k], xs[k:]) if len(xs) - k >= 2 else None
                want[(*key, k)] = 0.0 if r is None else r
    assert set(got) == set(want)
    for k, v in want.items():
        assert got[k] == pytest.approx(v, abs=2e-6), k
    plan = I.autocorr_multi(_edges(spark, series))._jdf.queryExecution().optimizedPlan().toString()
    # what is generated per lag lies above the aggregate by pair: no Generate of the lags below a Window
    assert plan.index("posexplode") < plan.index("Window")
