"""

Every query reads the driver tables through the fixture views in
``rttlab.sources.fixtures`` (ping rows from ``events``) and runs the
library operators over the whole table. Each oracle is DuckDB SQL over the
same base tables; the view text is inlined as CTEs.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rttlab.functions import ip as IP
from rttlab.functions.json import extract_rtts, rtts_array, rtts_from_array
from rttlab.functions.time import hour_of, r6, weekday_of
from rttlab.operators import filters as C
from rttlab.operators import joins as D
from rttlab.operators import pairs as H
from rttlab.operators import profile as G
from rttlab.operators import series as I
from rttlab.operators import sequences as J
from rttlab.plans import optimize as OPT
from rttlab.session import apply_defaults
from rttlab.sinks import layout as B
from rttlab.sources import fixtures as FX
from rttlab.sources import raw as RAW
from rttlab.streaming import ingest as K

SF_SMOKE = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- views
def _ping(spark, sf):
    apply_defaults(spark)
    return FX.ping(spark, sf)


def _map(spark):
    return FX.probe_ip_map(spark)


def _edges(spark, sf):
    return D.resolve_dst_probe(_ping(spark, sf), _map(spark))


def _succ(spark, sf):
    return C.successful(_edges(spark, sf))


def _opt(spark, sf):
    return OPT.optimize_from_ping(_ping(spark, sf), _map(spark))


def _hexed(opt: DataFrame) -> DataFrame:
    cols = [F.hex(c).alias(c.replace("bytes", "hex")) if c.endswith("_bytes") else F.col(c)
            for c in opt.columns]
    return opt.select(*cols)


# ------------------------------------------------------------- queries
def q_top_pairs(spark, sf):
    return H.top_pairs(_edges(spark, sf), k=10, min_count=20)


def q_parse_measurements(spark, sf):
    """A-1 + C-1 + C-2 + E-1: ping rows written as raw JSON lines (bz2),
    read back with the raw reader, filtered/projected and parsed."""
    return _parsed(RAW.raw_dump_roundtrip(_ping(spark, sf)))


def _parsed(raw):
    good, _ = RAW.quarantine(raw)
    return C.parse_measurements(good).select("prb_id", "dst_addr", "ts", "sent", "rcvd", "avg", *extract_rtts("result"))


def q_resolve_dst_probe(spark, sf):
    return _edges(spark, sf)


def q_resolve_dst_probe_inner(spark, sf):
    return D.resolve_dst_probe_inner(_ping(spark, sf), _map(spark))


def q_partial_loss(spark, sf):
    return C.partial_loss(_ping(spark, sf))


def q_self_loops(spark, sf):
    return C.self_loops(_edges(spark, sf)).drop("result")


def q_successful(spark, sf):
    return _succ(spark, sf).drop("result")


def q_extract_rtts(spark, sf):
    return C.parse_rtts(_ping(spark, sf))


def q_rtts_array(spark, sf):
    p = _ping(spark, sf)
    return p.select("prb_id", "dst_addr", "ts", *rtts_from_array(rtts_array("result")))


def q_unpack_ts(spark, sf):
    p = _ping(spark, sf)
    return p.select("prb_id", "ts", hour_of("ts").alias("hour"), weekday_of("ts").alias("weekday"))


def q_hours_from_start(spark, sf):
    return I.hours_from_start(_edges(spark, sf))


def q_packet_loss(spark, sf):
    return G.packet_loss(_edges(spark, sf))


def q_ip_columns(spark, sf):
    p = IP.with_ipv6_bytes(_ping(spark, sf), "dst_addr", "bytes")
    return p.select("dst_addr", IP.is_ipv6("dst_addr").alias("is_ipv6"),
                    IP.ipv4_to_int("dst_addr").alias("ipv4_int"),
                    IP.int_to_ipv4(IP.ipv4_to_int("dst_addr")).alias("ipv4_text"),
                    F.hex("bytes").alias("ipv6_hex"))


def q_optimize_dataset(spark, sf):
    return _hexed(_opt(spark, sf))


def q_ipv4_only(spark, sf):
    return _hexed(C.ipv4_only(_opt(spark, sf)))


def q_add_source_ip(spark, sf):
    p = C.parse_rtts(_ping(spark, sf)).select("prb_id", "ts", "dst_addr", "avg")
    return _hexed(D.add_source_ip(p, _map(spark)))


def q_distinct_edges(spark, sf):
    return D.distinct_edges(_edges(spark, sf))


def q_out_degree(spark, sf):
    return G.out_degree(_edges(spark, sf))


def q_top_sources(spark, sf):
    return H.top_sources_by_degree(_edges(spark, sf), k=5)


def q_filter_top_endpoints(spark, sf):
    return D.filter_top_endpoints(_edges(spark, sf), k=5).drop("result")


def q_mapped_probe_coverage(spark, sf):
    return D.mapped_probe_coverage(_ping(spark, sf), _map(spark))


def q_column_counts(spark, sf):
    return G.column_counts(C.parse_rtts(_ping(spark, sf)))


def q_range_profile(spark, sf):
    return G.range_profile(_edges(spark, sf), ["src", "dst", "ts", "avg", "sent", "rcvd"])


def q_describe_ts(spark, sf):
    return G.describe(_edges(spark, sf), "ts")


def q_time_steps(spark, sf):
    return G.time_steps(_edges(spark, sf), "ts")


def q_completeness(spark, sf):
    return G.completeness(_edges(spark, sf))


def q_dup_measurements(spark, sf):
    return G.dup_measurements(_edges(spark, sf))


def q_hourly_counts(spark, sf):
    return G.hourly_counts(_edges(spark, sf))


def q_dow_counts(spark, sf):
    return G.dow_counts(_edges(spark, sf))


def q_temporal_summary(spark, sf):
    return G.temporal_summary(_edges(spark, sf))


def q_overview(spark, sf):
    return G.overview(_edges(spark, sf))


def q_summary(spark, sf):
    return G.summary(_edges(spark, sf))


def q_latency_matrix(spark, sf):
    e = _edges(spark, sf)
    top20 = H.top_sources_by_degree(e, k=20).select("src")
    return G.latency_matrix(e, top20)


def q_ipv4_retention(spark, sf):
    return G.ipv4_retention(_opt(spark, sf))


def q_ip_pair_distribution(spark, sf):
    return G.ip_pair_distribution(_opt(spark, sf))


def q_storage_breakdown(spark, sf):
    return G.storage_breakdown(_opt(spark, sf))


def q_ip_version_distribution(spark, sf):
    return G.ip_version_distribution(_ping(spark, sf), "dst_addr")


def q_ip_storage_estimate(spark, sf):
    return G.ip_storage_estimate(_ping(spark, sf), "dst_addr")


def q_node_activity(spark, sf):
    return I.node_activity(C.successful(OPT.optimized_edges(_opt(spark, sf))), n_nodes=50)


def q_probe_quality(spark, sf):
    return G.probe_quality(_edges(spark, sf))


def q_pair_variation(spark, sf):
    return H.pair_variation(_edges(spark, sf))


def q_pair_stddev_matrix(spark, sf):
    return H.pair_stddev_matrix(_edges(spark, sf))


def q_pair_latency_stats(spark, sf):
    return H.pair_latency_stats(_edges(spark, sf))


def q_histogram(spark, sf):
    return H.histogram(_edges(spark, sf), "avg", 30, keys=["src", "dst"])


def q_boxplot_stats(spark, sf):
    return H.boxplot_stats(_edges(spark, sf))


def q_pair_cv(spark, sf):
    return H.pair_cv(_edges(spark, sf))


def q_trend(spark, sf):
    return H.trend(_edges(spark, sf))


def q_modelability(spark, sf):
    return H.modelability_ranking(H.trend_scores(_edges(spark, sf)), k=15)


def q_modelability_share(spark, sf):
    return H.modelability_share(H.trend_scores(_edges(spark, sf)))


def q_class_counts(spark, sf):
    return H.class_counts(H.trend_scores(_edges(spark, sf)))


def q_autocorr_lag1(spark, sf):
    return I.autocorr_lag1(_edges(spark, sf))


def q_autocorr_multi(spark, sf):
    return I.autocorr_multi(_edges(spark, sf), max_lag=60, min_n=60)


def q_bounded_series(spark, sf):
    return I.bounded_series(_succ(spark, sf), 50).drop("result")


def q_autocorr_matrix(spark, sf):
    return I.autocorr_matrix(C.successful(OPT.optimized_edges(_opt(spark, sf))), n_nodes=50)


def q_matrix_coverage(spark, sf):
    m = I.autocorr_matrix(C.successful(OPT.optimized_edges(_opt(spark, sf))), n_nodes=50, rounded=False)
    return I.matrix_coverage(m)


def q_moving_average(spark, sf):
    return I.moving_average(_edges(spark, sf))


def q_rolling_cv(spark, sf):
    return I.rolling_cv(_edges(spark, sf))


def q_stability_status(spark, sf):
    return I.stability_status(I.rolling_cv(_edges(spark, sf), rounded=False))


def q_autocorr_over_time(spark, sf):
    return I.autocorr_over_time(_edges(spark, sf))


def q_baseline_mae(spark, sf):
    return I.baseline_mae(_edges(spark, sf), 7)


def _stream_folders(spark):
    from rttlab.session import shared_path
    return [shared_path(spark, n) for n in ("stream-src", "stream-out", "stream-ck")]


def q_stream_ingest(spark, sf):
    """K-1: ping rows written as raw dump files, consumed by the file stream
    (availableNow, checkpointed) into Parquet, read back."""
    src, out, ck = _stream_folders(spark)
    RAW.write_raw_dump(_ping(spark, sf), src)
    K.stream_ingest(spark, src, out, ck)
    return K.ingested(spark, out)


def _ingest_lines(spark, sf):
    """K-1 over dumps with lines that do not parse; where the results are."""
    apply_defaults(spark)
    src, out, ck = _stream_folders(spark)
    RAW.write_raw_lines(FX.raw_lines(spark, sf), src)
    K.stream_ingest(spark, src, out, ck, max_files_per_trigger=2)
    return out


def _dump():
    return F.regexp_extract("file", r"dump=(\d+)", 1).cast("bigint").alias("dump")


def q_stream_rows(spark, sf):
    return K.ingested(spark, _ingest_lines(spark, sf))


def q_stream_rejects(spark, sf):
    return K.rejects(spark, _ingest_lines(spark, sf)).select(_dump(), "line")


def q_ingest_report(spark, sf):
    return K.ingest_ledger(spark, _ingest_lines(spark, sf)).select(_dump(), "rows", "ok_rows", "corrupt_rows", "ok")


def q_ingest_summary(spark, sf):
    return B.ingest_summary(K.ingest_ledger(spark, _ingest_lines(spark, sf)))


def q_stream_windows(spark, sf):
    """K-2: windows of 5 minutes every 30 seconds from the stream's panes of 30 seconds."""
    apply_defaults(spark)
    src, out, ck = _stream_folders(spark)
    RAW.write_raw_lines(FX.raw_lines(spark, sf), src)
    K.stream_panes(spark, src, out, ck, 30, max_files_per_trigger=2)
    return K.stream_windows(spark, out, 300, 30)


def q_optimize_write_readback(spark, sf):
    """F-6 + B-1/B-4/B-5: optimized table published after a row-count check
    against its input, then read back."""
    from rttlab.session import shared_path
    p = _ping(spark, sf)
    path = shared_path(spark, "optimized")
    B.write_checked(OPT.optimize_from_ping(p, _map(spark)), path, expected_rows=p.count())
    return _hexed(B.read_published(spark, path))


def q_multi_resolution_windows(spark, sf):
    return I.multi_resolution_windows(_ping(spark, sf))


# ---- inputs with awkward rows, and jobs over written files
def _ping_edge(spark, sf):
    apply_defaults(spark)
    return FX.ping_edge(spark, sf)


def q_parse_measurements_edge(spark, sf):
    """C-1 where other packet counts and missing results occur."""
    return _parsed(RAW.raw_dump_roundtrip(_ping_edge(spark, sf)))


def q_resolve_dst_probe_edge(spark, sf):
    return D.resolve_dst_probe(_ping_edge(spark, sf), _map(spark))


def q_mapped_probe_coverage_edge(spark, sf):
    return D.mapped_probe_coverage(_ping_edge(spark, sf), _map(spark))


def q_optimize_dataset_edge(spark, sf):
    return _hexed(OPT.optimize_from_ping(_ping_edge(spark, sf), _map(spark)))


def q_ip_pair_distribution_edge(spark, sf):
    return G.ip_pair_distribution(OPT.optimize_from_ping(_ping_edge(spark, sf), _map(spark)))


def q_tokenize_edge(spark, sf):
    t = J.tokenize(OPT.optimize_from_ping(_ping_edge(spark, sf), _map(spark)))
    return t.select("prb_id", "ts", "dst_addr_display", F.array_join("tokens", " ").alias("tokens"),
                    F.col("length").cast("bigint").alias("length"))


def _ping_files(spark, sf):
    """``ping`` in files by day; its folder."""
    from rttlab.session import shared_path
    path = shared_path(spark, "ping-files")
    B.write_ping(_ping(spark, sf).withColumn("day", F.to_date(F.timestamp_seconds("ts")).cast("string")), path,
                 partition_by=["day"], max_records_per_file=500)
    return path


def q_write_read_ping(spark, sf):
    """B-1 + A-2: nested folders, bounded files, three columns read."""
    return RAW.read_ping(spark, _ping_files(spark, sf), ["prb_id", "ts", "avg"])


def q_sample_head(spark, sf):
    """A-8 over the rows in time order (the first rows of an unordered table are any rows)."""
    return RAW.sample_head(_ping(spark, sf).orderBy("ts", "prb_id", "dst_addr", "avg"), 100, ["prb_id", "ts", "dst_addr", "avg"])


def q_sample_sorted(spark, sf):
    """A-8: what of a seeded sample SQL can tell: its share is near the asked one, it is sorted and from the table."""
    p = _ping(spark, sf).select("prb_id", "ts", "dst_addr")
    s = RAW.sample_sorted(p, 0.25)
    n, drawn = p.count(), s.count()
    foreign = s.join(p.distinct(), ["prb_id", "ts", "dst_addr"], "left_anti").count()
    return spark.createDataFrame([(n, abs(drawn / n - 0.25) < 0.02, foreign)], "n_rows bigint, near_share boolean, foreign_rows bigint")


def q_batch_transform_write(spark, sf):
    """B-3: partial loss of all files, written in files of at most 100 rows, read back."""
    from rttlab.session import shared_path
    out = shared_path(spark, "partial-loss")
    B.batch_transform_write(spark, _ping_files(spark, sf), out, lambda df: C.partial_loss(df.drop("day")), rows_per_file=100)
    return spark.read.parquet(out)


def q_compact(spark, sf):
    """B-2: the small files as three, all rows kept."""
    from rttlab.session import shared_path
    out = shared_path(spark, "compact")
    B.compact(spark, _ping_files(spark, sf), out, target_files=3, order="ts")
    return spark.read.parquet(out).drop("day")


def q_concat_files(spark, sf):
    """D-9: the files' rows put together by one multi-path read."""
    path = _ping_files(spark, sf)
    days = [r.day for r in spark.read.parquet(path).select("day").distinct().orderBy("day").collect()]
    return D.concat_files(*[spark.read.parquet(f"{path}/day={d}") for d in days])


def q_project_rtt(spark, sf):
    """C-2 of a raw dump (whose writer has no source address)."""
    good, _ = RAW.quarantine(RAW.raw_dump_roundtrip(_ping_edge(spark, sf)))
    return C.project_rtt(good)


def q_success_label(spark, sf):
    return C.success_label(_ping_edge(spark, sf)).select("prb_id", "ts", "sent", "rcvd", "success")


def q_add_source_ip_fanout(spark, sf):
    """D-4: rows per probe before and after the join that multiplies them."""
    p = _ping(spark, sf)
    n = p.groupBy("prb_id").agg(F.count(F.lit(1)).alias("n_rows"))
    return n.join(D.add_source_ip_fanout(p, _map(spark)).groupBy("prb_id").agg(F.count(F.lit(1)).alias("n_joined")), "prb_id")


def q_multi_ip_probes(spark, sf):
    """G-17 over the addresses that measurements were sent to."""
    seen = _ping(spark, sf).select(F.col("dst_addr").alias("ip"), (F.col("prb_id") % 3).alias("dst_prb_id")).distinct()
    return G.multi_ip_probes(seen)


def q_bounded_series_files(spark, sf):
    """I-3 in file-then-row order: successful measurements in files, the first 50 rows of each pair."""
    from rttlab.session import shared_path
    path = shared_path(spark, "edge-files")
    e = table_of_events(spark, sf)
    e.repartition("part").sortWithinPartitions("part", "event_id").write.partitionBy("part").parquet(path)
    return I.bounded_series_of_files(spark.read.parquet(path), 50).select("src", "dst", "event_id", "avg")


def table_of_events(spark, sf):
    """Edges with their event's number, in parts whose order is not that of time."""
    apply_defaults(spark)
    e = FX.table(spark, sf, "events")
    return e.select((e.user_id % 10).alias("src"), ((e.event_id * 7 + e.user_id) % 10).alias("dst"), "event_id",
                    e.value.cast("double").alias("avg"), ((e.event_id * 13) % 4).alias("part")).where("avg > 0")


def q_range_profile_sketch(spark, sf):
    """G-2 from daily sketches beside the exact counts: the estimate is within 5 % (three standard errors)."""
    cols = ["src", "dst", "ts", "avg", "sent", "rcvd"]
    e = _edges(spark, sf).withColumn("day", F.to_date(F.timestamp_seconds("ts")))
    est = G.merge_sketches(G.range_sketches(e, cols, ["day"])).withColumnRenamed("n_unique", "estimate")
    j = G.range_profile(e, cols).join(est.select("column", "estimate"), "column")
    return j.select("column", "min", "max", "n_unique", (F.abs(F.col("estimate") - F.col("n_unique")) <= 0.05 * F.col("n_unique")).alias("within_error"))


# ---- the same operators on the larger table of edges
def _big(operator):
    def run(spark, sf):
        apply_defaults(spark)
        return operator(FX.edge_big(spark, sf))
    return run


BIG = {
    "big_top_pairs": _big(lambda e: H.top_pairs(e, 10, 20)),
    "big_summary": _big(G.summary),
    "big_pair_latency_stats": _big(H.pair_latency_stats),
    "big_autocorr_lag1": _big(I.autocorr_lag1),
    "big_autocorr_multi": _big(lambda e: I.autocorr_multi(e, max_lag=60, min_n=60)),
    "big_rolling_cv": _big(I.rolling_cv),
    "big_trend": _big(H.trend),
}


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "top_pairs": q_top_pairs,
    "parse_measurements": q_parse_measurements,
    "resolve_dst_probe": q_resolve_dst_probe,
    "resolve_dst_probe_inner": q_resolve_dst_probe_inner,
    "partial_loss": q_partial_loss,
    "self_loops": q_self_loops,
    "successful": q_successful,
    "extract_rtts": q_extract_rtts,
    "rtts_array": q_rtts_array,
    "unpack_ts": q_unpack_ts,
    "hours_from_start": q_hours_from_start,
    "packet_loss": q_packet_loss,
    "ip_columns": q_ip_columns,
    "optimize_dataset": q_optimize_dataset,
    "ipv4_only": q_ipv4_only,
    "add_source_ip": q_add_source_ip,
    "distinct_edges": q_distinct_edges,
    "out_degree": q_out_degree,
    "top_sources": q_top_sources,
    "filter_top_endpoints": q_filter_top_endpoints,
    "mapped_probe_coverage": q_mapped_probe_coverage,
    "column_counts": q_column_counts,
    "range_profile": q_range_profile,
    "describe_ts": q_describe_ts,
    "time_steps": q_time_steps,
    "completeness": q_completeness,
    "dup_measurements": q_dup_measurements,
    "hourly_counts": q_hourly_counts,
    "dow_counts": q_dow_counts,
    "temporal_summary": q_temporal_summary,
    "overview": q_overview,
    "summary": q_summary,
    "latency_matrix": q_latency_matrix,
    "ipv4_retention": q_ipv4_retention,
    "ip_pair_distribution": q_ip_pair_distribution,
    "storage_breakdown": q_storage_breakdown,
    "ip_version_distribution": q_ip_version_distribution,
    "ip_storage_estimate": q_ip_storage_estimate,
    "node_activity": q_node_activity,
    "probe_quality": q_probe_quality,
    "pair_variation": q_pair_variation,
    "pair_stddev_matrix": q_pair_stddev_matrix,
    "pair_latency_stats": q_pair_latency_stats,
    "histogram": q_histogram,
    "boxplot_stats": q_boxplot_stats,
    "pair_cv": q_pair_cv,
    "trend": q_trend,
    "modelability": q_modelability,
    "modelability_share": q_modelability_share,
    "class_counts": q_class_counts,
    "autocorr_lag1": q_autocorr_lag1,
    "autocorr_multi": q_autocorr_multi,
    "bounded_series": q_bounded_series,
    "autocorr_matrix": q_autocorr_matrix,
    "matrix_coverage": q_matrix_coverage,
    "moving_average": q_moving_average,
    "rolling_cv": q_rolling_cv,
    "stability_status": q_stability_status,
    "autocorr_over_time": q_autocorr_over_time,
    "baseline_mae": q_baseline_mae,
    "multi_resolution_windows": q_multi_resolution_windows,
    "stream_ingest": q_stream_ingest,
    "optimize_write_readback": q_optimize_write_readback,
    "stream_rows": q_stream_rows,
    "stream_rejects": q_stream_rejects,
    "ingest_report": q_ingest_report,
    "ingest_summary": q_ingest_summary,
    "stream_windows": q_stream_windows,
    "parse_measurements_edge": q_parse_measurements_edge,
    "resolve_dst_probe_edge": q_resolve_dst_probe_edge,
    "mapped_probe_coverage_edge": q_mapped_probe_coverage_edge,
    "optimize_dataset_edge": q_optimize_dataset_edge,
    "ip_pair_distribution_edge": q_ip_pair_distribution_edge,
    "tokenize_edge": q_tokenize_edge,
    "write_read_ping": q_write_read_ping,
    "sample_head": q_sample_head,
    "sample_sorted": q_sample_sorted,
    "batch_transform_write": q_batch_transform_write,
    "compact": q_compact,
    "concat_files": q_concat_files,
    "project_rtt": q_project_rtt,
    "success_label": q_success_label,
    "add_source_ip_fanout": q_add_source_ip_fanout,
    "multi_ip_probes": q_multi_ip_probes,
    "bounded_series_files": q_bounded_series_files,
    "range_profile_sketch": q_range_profile_sketch,
}
QUERIES.update(BIG)
QUERIES.update(J.entry_queries(_opt, _edges))


try:
    from rttlab.llm import queries as _llm
except ImportError as gone:  # the subpackage and its pipeline may be left out
    if (gone.name or "").split(".")[:2] not in (["rttlab", "llm"], ["corpus_pipeline"]):
        raise
    _llm = None
else:
    def _with_defaults(query):
        def run(spark, sf):
            apply_defaults(spark)
            # workers started from another folder find the package, too; a cluster gets it with --py-files
            here = os.path.dirname(os.path.abspath(__file__))
            path = spark.sparkContext.environment.get("PYTHONPATH", "")
            if here not in path.split(os.pathsep):
                spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [here, path]))
            return query(spark, sf)
        return run

    QUERIES.update({name: _with_defaults(f) for name, f in _llm.QUERIES.items()})


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: ping -> resolve destination probe -> top measured pairs."""
    return q_top_pairs(spark, SF_SMOKE)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from rttlab.oracle import ORACLE
    sql = {**ORACLE, **(_llm.ORACLE if _llm else {})}
    return {k: v for k, v in sql.items() if k in QUERIES}
