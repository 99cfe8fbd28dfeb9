import bz2
import json
import os

from pyspark.sql import functions as F

from rttlab.operators import filters as C
from rttlab.operators import joins as D
from rttlab.sinks import layout as B
from rttlab.sources import files as A
from rttlab.sources import raw as RAW
from rttlab.sources.fixtures import ping, probe_ip_map
from rttlab.streaming import ingest as K

SF = "/root/testdata/sf0.001"


def _write_bz2(path, lines):
    with bz2.open(path, "wt") as f:
        for line in lines:
            f.write(line + "\n")


def test_raw_dump_quarantine_and_parse(spark, tmp_dir):
    base = {"prb_id": 1, "src_addr": "10.0.0.1", "dst_addr": "10.0.0.2", "timestamp": 100, "rcvd": 3,
            "avg": 5.5, "result": [{"rtt": 5.0}, {"x": "*"}, {"rtt": 6.0}, {"rtt": 7.0}, {"rtt": 8.0}]}
    lines = [json.dumps({**base, "sent": 3}),
             json.dumps({k: v for k, v in base.items()}),                 # sent missing
             json.dumps({**base, "sent": 2}),
             json.dumps({**base, "sent": 3, "avg": None}),
             json.dumps({k: v for k, v in {**base, "sent": 3}.items() if k != "result"}),
             json.dumps({**base, "sent": 3, "result": [{"rtt": 1.5}]}),
             "this is not json"]
    _write_bz2(os.path.join(tmp_dir, "ping-2024-01-01T0000.bz2"), lines)
    raw = RAW.read_raw_dump(spark, tmp_dir)
    good, bad = RAW.quarantine(raw)
    assert len(bad.select("_corrupt_record", "prb_id").collect()) == 1
    rep = B.ingest_report(raw).collect()
    assert rep[0].rows == 7 and rep[0].corrupt_rows == 1
    p = C.parse_measurements(good)
    assert p.count() == 4
    rt = C.parse_rtts(p).orderBy("avg").collect()
    assert {r.result for r in p.collect() if r.result == "null"} == {"null"}
    assert any(r.rtt_1 == 1.5 and r.rtt_2 is None for r in rt)
    assert any(r.rtt_1 == 5.0 and r.rtt_2 is None and r.rtt_3 == 6.0 for r in rt)


def test_manifest_listing_missing(spark, tmp_dir):
    m = A.hourly_manifest(spark, "2024-01-01 22:00:00", "2024-01-02 01:00:00").collect()
    assert [r.path for r in m] == ["2024-01-01/ping-2024-01-01T2200.bz2", "2024-01-01/ping-2024-01-01T2300.bz2",
                                   "2024-01-02/ping-2024-01-02T0000.bz2", "2024-01-02/ping-2024-01-02T0100.bz2"]
    for name in ["ping-2024-01-01T2200.bz2", "ping-2024-01-02T0100.bz2", "ping-2024-13-01T0100.bz2"]:
        _write_bz2(os.path.join(tmp_dir, name), ["{}"])
    lst = A.listing(spark, tmp_dir)
    f = A.filter_listing(lst, "2024-01-01 23:00:00", "2024-01-02 05:00:00").collect()
    assert [os.path.basename(r.path) for r in f] == ["ping-2024-01-02T0100.bz2"]
    miss = A.missing_files(A.hourly_manifest(spark, "2024-01-01 22:00:00", "2024-01-02 01:00:00"), lst)
    assert sorted(r.path for r in miss.collect()) == ["2024-01-01/ping-2024-01-01T2300.bz2",
                                                      "2024-01-02/ping-2024-01-02T0000.bz2"]


def test_source_ip_join_does_not_fan_out(spark, tmp_dir):
    p = ping(spark, SF)
    m = probe_ip_map(spark)
    n = p.count()
    assert D.add_source_ip(p, m).count() == n
    assert D.add_source_ip_fanout(p, m).count() > n      # probes 0, 3, 6 have two IPs
    dm = {r.dst_prb_id: r.ip for r in D.dedup_probe_map(m).collect()}
    assert dm[0] == "10.0.0.1" and dm[9] == "2001:db8::9"
    from rttlab.operators.profile import multi_ip_probes
    assert sorted(r.dst_prb_id for r in multi_ip_probes(m).collect()) == [0, 3, 6]


def test_rejected_write_leaves_the_table(spark, tmp_dir):
    import pytest
    p = ping(spark, SF)
    n = p.count()
    table = os.path.join(tmp_dir, "table")
    with pytest.raises(ValueError):
        B.write_checked(p.limit(3), table, expected_rows=n)
    with pytest.raises(FileNotFoundError):
        B.read_published(spark, table)
    assert B.write_checked(p, table, expected_rows=n) == n
    with pytest.raises(ValueError):
        B.write_checked(p.limit(10), table, expected_rows=n)
    assert B.read_published(spark, table).count() == n          # the good version is whole
    assert B.write_checked(p.limit(7), table) == 7
    assert B.read_published(spark, table).count() == 7 and B.read_published(spark, table, 1).count() == n
    with pytest.raises(FileNotFoundError):
        B.read_published(spark, table, 9)


def test_compact_without_shuffle_in_time_order(spark, tmp_dir):
    import pytest
    p = ping(spark, SF)
    src, out = os.path.join(tmp_dir, "parts"), os.path.join(tmp_dir, "compact")
    hour = F.date_format(F.timestamp_seconds("ts"), "yyyy-MM-dd-HH")
    p.withColumn("h", hour).repartition("h").write.partitionBy("h").parquet(src)
    many = B.file_ledger(spark, src).count()
    assert many > 20 and B.compact(spark, src, out, target_files=4, order="ts") <= 5
    files = sorted(B.file_ledger(spark, out).collect(), key=lambda r: r.file)
    assert len(files) <= 5 and B.verify_readback(spark, out) == p.count()
    last = None
    for f in files:  # each file is sorted and begins where the one before ends
        ts = [r.ts for r in spark.read.parquet(f.path).select("ts").collect()]
        assert ts == sorted(ts) and (last is None or last // 3600 <= ts[0] // 3600)
        last = ts[-1]
    assert sorted(spark.read.parquet(out).collect(), key=str) == sorted(p.select(spark.read.parquet(out).columns).collect(), key=str)
    os.makedirs(os.path.join(tmp_dir, "none"))
    with pytest.raises(FileNotFoundError):
        B.compact(spark, os.path.join(tmp_dir, "none"), out)
    plan = []
    real = spark.read.parquet(*[f.path for f in files[:2]]).coalesce(1).union(spark.read.parquet(files[-1].path).coalesce(1)).sortWithinPartitions("ts")
    plan = real._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def _sorted_files(spark, out, order):
    """Rows of each file in name order, after a look at the order within."""
    found = []
    for f in sorted(B.file_ledger(spark, out).collect(), key=lambda r: r.file):
        rows = spark.read.parquet(f.path).coalesce(1).collect()
        keys = [(r[order] is not None, r[order] or 0) for r in rows]  # nulls first
        assert keys == sorted(keys)
        found.append(rows)
    return found


def test_compact_writes_the_files_it_counts(spark, tmp_dir):
    src = os.path.join(tmp_dir, "parts")
    spark.range(1000).repartition(20).write.parquet(src)
    before = spark.conf.get("spark.sql.unionOutputPartitioning", None)
    for order in (None, "id"):
        out = os.path.join(tmp_dir, f"out-{order}")
        assert B.compact(spark, src, out, target_files=4, order=order) == B.file_ledger(spark, out).count() == 4
        assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(1000))
    assert spark.conf.get("spark.sql.unionOutputPartitioning", None) == before


def test_compact_sorts_large_files_in_pieces(spark, tmp_dir, monkeypatch):
    src, out, one = (os.path.join(tmp_dir, n) for n in ("parts", "compact", "one"))
    rows = spark.range(6000)
    # half of the rows share a value, some have none; names that the pieces use, too; the second half of the files is of the second run
    ts = F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 97 == 0, None).otherwise(F.col("id") * 7919 % 6007)
    rows = rows.select(ts.alias("ts"), F.col("id").alias("run"), F.concat(F.lit("r"), F.col("id")).alias("row"),
                       F.col("id").alias("key"), F.lit(None).cast("string").alias("a.b"), (F.col("id") >= 3000).cast("int").alias("half"))
    rows.repartition(8).write.partitionBy("half").parquet(src)
    monkeypatch.setattr(B, "SORT_ROWS", 300)
    pieces, real = [], B.shared_path
    monkeypatch.setattr(B, "shared_path", lambda *a: pieces.append(real(*a)) or pieces[-1])
    assert B.compact(spark, src, out, target_files=2, order="ts") == 2
    files = _sorted_files(spark, out, "ts")
    assert [len(f) for f in files] == [3000, 3000]
    assert [{r.run >= 3000 for r in f} for f in files] == [{False}, {True}]  # each file holds its run's rows
    assert sorted((r for f in files for r in f), key=lambda r: r.run) == rows.drop("half").orderBy("run").collect()
    counts = [spark.read.parquet(r.path).count() for r in B.file_ledger(spark, pieces[0]).collect()]
    assert len(counts) >= 20 and max(counts) <= 900  # no task sorts much more than it should, however many rows share a value
    monkeypatch.setattr(B, "JOB_SCANS", 5)  # a job for each file
    assert B.compact(spark, src, one, target_files=2, order="ts") == B.file_ledger(spark, one).count() == 2
    assert spark.read.parquet(one).count() == 6000


def test_size_report_by_value(spark, tmp_dir):
    p = ping(spark, SF)
    src, out = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    p.repartition(3).write.parquet(src)
    B.batch_transform_write(spark, src, out, lambda df: df.drop("result"), rows_per_file=50, keep_source=True)
    rep = {r.file: r for r in B.size_report(spark, src, out).collect()}
    sizes = {f: os.path.getsize(os.path.join(src, f)) for f in os.listdir(src) if f.endswith(".parquet")}
    assert set(rep) == {*sizes, "*"} and len(sizes) == 3
    for name, size in sizes.items():
        folder = os.path.join(out, f"source_file={name}")
        parts = [os.path.getsize(os.path.join(folder, f)) for f in os.listdir(folder) if f.endswith(".parquet")]
        assert (rep[name].in_bytes, rep[name].out_files, rep[name].out_bytes) == (size, len(parts), sum(parts))
        assert rep[name].reduction_pct == round((1 - sum(parts) / size) * 100, 2)
    assert rep["*"].in_bytes == sum(sizes.values()) and rep["*"].out_bytes == sum(r.out_bytes for f, r in rep.items() if f != "*")
    plain = os.path.join(tmp_dir, "plain")
    B.write_ping(p, plain)                                       # no lineage: a row of its own, and the totals
    rep = B.size_report(spark, src, plain).collect()
    assert sorted((r.file or "", r.in_bytes, bool(r.out_bytes)) for r in rep) == sorted(
        [("", None, True), ("*", sum(sizes.values()), True), *[(f, n, False) for f, n in sizes.items()]], key=lambda x: (x[0], x[1] or 0))


def test_stream_ingest_once_and_incremental(spark, tmp_dir):
    p = ping(spark, SF)
    src, out, ck = (os.path.join(tmp_dir, d) for d in ("src", "out", "ck"))
    RAW.write_raw_dump(p.where("prb_id < 5"), os.path.join(src, "a"))
    K.stream_ingest(spark, src, out, ck)
    n1 = K.ingested(spark, out).count()
    assert n1 == p.where("prb_id < 5").count()
    K.stream_ingest(spark, src, out, ck)             # rerun adds nothing
    assert K.ingested(spark, out).count() == n1
    RAW.write_raw_dump(p.where("prb_id >= 5"), os.path.join(src, "b"))
    K.stream_ingest(spark, src, out, ck)             # only the new files
    assert K.ingested(spark, out).count() == p.count()


def test_stream_ledger_and_rejects(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, d) for d in ("src", "out", "ck"))
    os.makedirs(src)
    good = json.dumps({"prb_id": 1, "dst_addr": "10.0.0.2", "timestamp": 100, "sent": 3, "rcvd": 3, "avg": 5.5, "result": [{"rtt": 5.0}]})
    other = json.dumps({"prb_id": 2, "dst_addr": "10.0.0.2", "timestamp": 100, "sent": 2, "rcvd": 2, "avg": 5.5, "result": []})
    _write_bz2(os.path.join(src, "a.bz2"), [good, "not json", good, '{"prb_id": '])
    _write_bz2(os.path.join(src, "b.bz2"), [good, other])
    K.stream_ingest(spark, src, out, ck, max_files_per_trigger=1)
    led = {os.path.basename(r.file): (r["rows"], r.ok_rows, r.corrupt_rows, r.ok) for r in K.ingest_ledger(spark, out).collect()}
    assert led == {"a.bz2": (4, 2, 2, False), "b.bz2": (2, 2, 0, True)}
    assert sorted((os.path.basename(r.file), r.line) for r in K.rejects(spark, out).collect()) == [("a.bz2", "not json"), ("a.bz2", '{"prb_id": ')]
    assert K.ingested(spark, out).count() == 3
    s = B.ingest_summary(K.ingest_ledger(spark, out)).head()
    assert (s.files, s.ok_files, s.failed_files, s["rows"], s.ok_rows, s.corrupt_rows) == (2, 1, 1, 6, 4, 2)
    # a batch that is run again overwrites its folders
    batch = K.raw_stream(spark, src)  # noqa: F841  (the stream itself is not started)
    K._write(K.ingested(spark, out).limit(1), os.path.join(tmp_dir, "again"), 0)
    K._write(K.ingested(spark, out), os.path.join(tmp_dir, "again"), 0)
    assert spark.read.parquet(os.path.join(tmp_dir, "again")).count() == 3


def test_probe_map_readers(spark, tmp_dir):
    path = os.path.join(tmp_dir, "map.csv")
    with open(path, "w") as f:
        f.write("ip,prb_id\n10.0.0.1,1\n2001:db8::1,1\n")
    m = RAW.read_probe_map(spark, path).collect()
    assert [(r.ip, r.dst_prb_id) for r in m] == [("10.0.0.1", 1), ("2001:db8::1", 1)]
    rec = spark.createDataFrame([(1, "10.0.0.1", None), (2, "10.0.0.2", "2001:db8::2")],
                                "id long, address_v4 string, address_v6 string")
    rows = sorted((r.dst_prb_id, r.ip) for r in RAW.probe_map_from_records(rec).collect())
    assert rows == [(1, "10.0.0.1"), (2, "10.0.0.2"), (2, "2001:db8::2")]


def test_downcast_overflow_raises(spark):
    import pytest
    ok = spark.createDataFrame([(1, 3, 3, 1.5)], "prb_id long, sent long, rcvd long, avg double")
    assert C.downcast(ok).schema["sent"].dataType.simpleString() == "smallint"
    bad = spark.createDataFrame([(1, 300, 3, 1.5)], "prb_id long, sent long, rcvd long, avg double")
    with pytest.raises(Exception):
        C.downcast(bad).collect()


def test_stream_windows_merge_panes_of_batches_and_count_late_rows(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, d) for d in ("src", "out", "ck"))
    os.makedirs(src)
    line = lambda ts, avg=5.0, prb=1: json.dumps({"prb_id": prb, "dst_addr": "10.0.0.2", "timestamp": ts, "sent": 3, "rcvd": 3, "avg": avg, "result": []})
    runs = [[line(10_000), line(10_040, -1.0), "broken"], [line(10_010, 7.0), line(6_440), line(6_441), line(20_000)],
            [line(16_400), line(16_401, 1.25), line(30_000, prb=2)]]
    times = []
    for i, lines in enumerate(runs):
        _write_bz2(os.path.join(src, f"{i}.bz2"), lines)
        times += [(json.loads(x)["prb_id"], json.loads(x)["timestamp"], json.loads(x)["avg"]) for x in lines if x != "broken"]
        K.stream_panes(spark, src, out, ck, 30)
    log = {r.batch: (r["lines"], r.rejects, r["rows"], r.late_rows, r.max_ts) for r in K.stream_log(spark, out).collect()}
    assert log == {0: (3, 1, 2, 0, 10_040), 1: (4, 0, 4, 1, 20_000), 2: (3, 0, 3, 1, 30_000)}
    got = {(r.prb_id, r.window_start): (r.n, r.n_ok, r["mean"]) for r in K.stream_windows(spark, out, 300, 30).collect()}
    want = {}
    for prb, ts, avg in times:
        for k in range(10):
            n, ok = want.setdefault((prb, ts // 30 * 30 - 30 * k), ([], []))
            n.append(ts)
            ok += [avg] * (avg > 0)
    assert got == {k: (len(n), len(ok), sum(ok) / len(ok) if ok else None) for k, (n, ok) in want.items()}


def test_dense_latency_matrix_and_batch_write(spark, tmp_dir):
    from rttlab.operators.profile import latency_matrix, latency_matrix_dense
    e = spark.createDataFrame([(1, 2, 0, 10.0), (2, 1, 0, 20.0), (1, 3, 0, 5.0)],
                              "src long, dst long, ts long, avg double")
    nodes = spark.createDataFrame([(1,), (2,)], "node long")
    long = latency_matrix(e, nodes)
    dense = {r.src: r for r in latency_matrix_dense(long, [1, 2]).collect()}
    assert dense[1]["2"] == 10.0 and dense[1]["1"] is None and dense[2]["1"] == 20.0
    src = os.path.join(tmp_dir, "in")
    B.write_ping(ping(spark, SF), src)
    out = os.path.join(tmp_dir, "out")
    B.batch_transform_write(spark, src, out, C.partial_loss, rows_per_file=100)
    assert B.verify_readback(spark, out) == C.partial_loss(ping(spark, SF)).count()
