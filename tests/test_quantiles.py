import numpy as np
import pytest

from rttlab.operators.quantiles import exact_quantiles


def test_exact_quantiles_iterative_matches_numpy(spark):
    rng = np.random.default_rng(5)
    rows = [(0, float(v)) for v in rng.normal(50, 10, 5000)]           # hot key
    rows += [(1, float(v)) for v in rng.integers(0, 5, 300)]           # many ties
    rows += [(2, 7.0)] * 50                                           # constant
    rows += [(3, 1.0)]                                                # single value
    df = spark.createDataFrame(rows, "k long, v double")
    probs = {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p99": 0.99}
    out = {r.k: r for r in exact_quantiles(df, ["k"], "v", probs, nbins=16, small=40).collect()}
    for k in (0, 1, 2, 3):
        xs = np.array([v for kk, v in rows if kk == k])
        for name, p in probs.items():
            assert getattr(out[k], name) == pytest.approx(float(np.quantile(xs, p)), abs=1e-9)


def test_global_quantile(spark):
    df = spark.range(1, 1001).selectExpr("cast(id as double) as v")
    r = exact_quantiles(df, [], "v", {"med": 0.5}, small=10).collect()[0]
    assert r.med == pytest.approx(500.5)


def test_global_quantile_joins_no_range_to_the_values(spark, capsys):
    df = spark.range(2000).selectExpr("cast(id % 700 as double) as v")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        q = exact_quantiles(df, [], "v", {"lo": 0.25, "med": 0.5}, small=50, nbins=8)
        q.explain()
        assert q.collect()[0].asDict() == {"lo": 166.0, "med": 333.0}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    plan = capsys.readouterr().out
    assert "NestedLoop" not in plan


def test_a_row_is_not_copied_per_rank(spark, capsys):
    df = spark.range(3000).selectExpr("id % 3 as k", "cast(id * 7 % 1000 as double) as v")
    q = exact_quantiles(df, ["k"], "v", {f"p{i}": i / 10 for i in range(1, 10)})
    rows = {r.k: r for r in q.collect()}
    for k in range(3):
        xs = np.array([i * 7 % 1000 for i in range(3000) if i % 3 == k], float)
        assert all(getattr(rows[k], f"p{i}") == pytest.approx(np.quantile(xs, i / 10)) for i in range(1, 10))
    q.explain()
    plan = capsys.readouterr().out
    scan = plan[plan.rindex("Window"):]          # below the window over the values
    assert "explode" not in scan


def test_large_groups_narrow_to_disjoint_ranges(spark):
    rng = np.random.default_rng(8)
    rows = [(0, float(v)) for v in rng.exponential(3, 4000)] + [(0, 2.0)] * 1500 + [(k, float(v)) for k in (1, 2) for v in rng.normal(0, 1, 30)]
    df = spark.createDataFrame(rows, "k long, v double").repartition(5)
    probs = {f"p{i}": i / 20 for i in range(21)}
    got = {r.k: r for r in exact_quantiles(df, ["k"], "v", probs, nbins=8, small=25).collect()}
    for k in range(3):
        xs = np.array([v for kk, v in rows if kk == k])
        for name, p in probs.items():
            assert getattr(got[k], name) == pytest.approx(float(np.quantile(xs, p)), abs=1e-9)
