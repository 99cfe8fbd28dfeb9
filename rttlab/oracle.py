"""DuckDB oracle SQL for the registered queries (the correctness gate).

The oracle is written independently of the Spark code: plain SQL windows
and aggregates over the same fixture views (inlined as CTEs).
"""

from __future__ import annotations

from .sources.fixtures import DUCK_EDGE_BIG, DUCK_PING, DUCK_PING_EDGE, DUCK_PROBE_IP_MAP

H = "100.0::double"


def v4int(x: str) -> str:
    parts = f"string_split({x}, '.')"
    return (f"(case when {x} not like '%:%' and len({parts}) = 4 and list_bool_and(list_transform({parts}, "
            f"lambda o: coalesce(try_cast(o as bigint) between 0 and 255, false))) then "
            f"try_cast({parts}[1] as bigint) * 16777216 + try_cast({parts}[2] as bigint) * 65536 + "
            f"try_cast({parts}[3] as bigint) * 256 + try_cast({parts}[4] as bigint) else 0::bigint end)")


def v4text(x: str) -> str:
    return (f"(case when {x} is not null and {x} > 0 then concat_ws('.', cast(cast(floor({x} / 16777216) as bigint) as varchar), "
            f"cast(cast(floor({x} / 65536) as bigint) % 256 as varchar), cast(cast(floor({x} / 256) as bigint) % 256 as varchar), "
            f"cast({x} % 256 as varchar)) end)")


def v6hex(x: str) -> str:
    s = f"lower({x})"
    halves = f"string_split({s}, '::')"
    lg = f"(case when {halves}[1] = '' then []::varchar[] else string_split({halves}[1], ':') end)"
    rg = f"(case when len({halves}) < 2 or {halves}[2] = '' then []::varchar[] else string_split({halves}[2], ':') end)"
    missing = f"(8 - len({lg}) - len({rg}))"
    groups = (f"(case when len({halves}) = 2 then list_concat({lg}, list_transform(range(greatest({missing}, 0)), lambda i: '0'), {rg}) "
              f"else string_split({s}, ':') end)")
    valid = (f"({s} like '%:%' and regexp_full_match({s}, '[0-9a-f:]+') and len({halves}) <= 2 and {s} not like '%:::%' "
             f"and (case when len({halves}) = 2 then {missing} >= 1 else true end) and len({groups}) = 8 "
             f"and list_bool_and(list_transform({groups}, lambda g: regexp_full_match(g, '[0-9a-f]{{1,4}}'))))")
    return f"(case when {valid} then upper(array_to_string(list_transform({groups}, lambda g: lpad(g, 4, '0')), '')) end)"


def pearson(x: str, y: str) -> str:
    yy = f"(case when {x} is not null then {y} end)"
    return (f"(case when not (max({x}) = min({x}) or max({yy}) = min({yy})) "
            f"then greatest(-1.0, least(1.0, corr({yy}, {x}))) end)")


TS = "make_timestamp(ts * 1000000)"

EDGES = """edges as (select p.prb_id as src, m.dst_prb_id as dst, p.ts, p.avg, p.result, p.sent, p.rcvd
          from ping p join probe_ip_map m on p.dst_addr = m.ip)"""

BASE = f"""
ping as ({DUCK_PING}),
probe_ip_map as ({DUCK_PROBE_IP_MAP}),
{EDGES},
succ as (select * from edges where avg > 0 and sent = rcvd),
parsed as (select prb_id, dst_addr, ts, sent, rcvd, avg,
                  try_cast(json_extract_string(result, '$[0].rtt') as double) as rtt_1,
                  try_cast(json_extract_string(result, '$[1].rtt') as double) as rtt_2,
                  try_cast(json_extract_string(result, '$[2].rtt') as double) as rtt_3
           from ping),
dmap as (select dst_prb_id, first(ip order by (case when ip like '%:%' then 1 else 0 end), ip) as ip
         from probe_ip_map group by dst_prb_id),
srcmap as (select dst_prb_id, ip like '%:%' as src_is_ipv6, {v4int('ip')} as src_ipv4_int,
                  {v6hex('ip')} as src_ipv6_hex from dmap),
opt0 as (select p.*, p.dst_addr like '%:%' as dst_is_ipv6, {v4int('p.dst_addr')} as dst_ipv4_int,
                {v6hex('p.dst_addr')} as dst_ipv6_hex, s.src_is_ipv6, s.src_ipv4_int, s.src_ipv6_hex
         from parsed p left join srcmap s on p.prb_id = s.dst_prb_id),
opt as (select prb_id, ts, cast(sent as smallint) as sent, cast(rcvd as smallint) as rcvd,
               cast(avg as float) as avg, cast(rtt_1 as float) as rtt_1, cast(rtt_2 as float) as rtt_2,
               cast(rtt_3 as float) as rtt_3, dst_is_ipv6, dst_ipv4_int, dst_ipv6_hex,
               src_is_ipv6, src_ipv4_int, src_ipv6_hex,
               case when dst_is_ipv6 then dst_addr else {v4text('dst_ipv4_int')} end as dst_addr_display,
               case when coalesce(src_is_ipv6, false) then null else {v4text('src_ipv4_int')} end as src_addr_display
        from opt0),
oedges as (select src_ipv4_int as src, dst_ipv4_int as dst, ts, cast(avg as double) as avg,
                  cast(sent as bigint) as sent, cast(rcvd as bigint) as rcvd from opt),
osucc as (select * from oedges where avg > 0 and sent = rcvd),
degree as (select src, count(*) as out_degree from (select distinct src, dst from edges) group by src)
"""


def q(body: str, extra: str = "") -> str:
    return "with " + BASE + ("," + extra if extra else "") + "\n" + body


def lag1(src: str, keys: str, min_n: int = 3, digits: int | None = 6) -> str:
    """autocorr_lag1 over relation ``src`` keyed by ``keys``, rounded unless ``digits`` is None."""
    r = f"case when count(*) >= {min_n} then {pearson('prev', 'avg')} end"
    r = r if digits is None else f"round({r}, {digits})"
    return f"""(select {keys}, count(*) as n,
        {r} as autocorr
        from (select {keys}, avg, lag(avg) over (partition by {keys} order by ts, avg) as prev from {src})
        group by {keys})"""


TREND = """
te as (select src, dst, ts, avg, row_number() over (partition by src, dst order by ts, avg) as rn
       from edges where avg > 0),
ta as (select src, dst, count(*) as count, avg(avg) as mean, stddev_pop(avg) as std,
              regr_slope(avg, rn::double) as slope from te group by src, dst having count(*) >= 20),
tb as (select src, dst, count, mean, case when mean > 0 then std / mean else 0.0 end as cv,
              coalesce(slope, 0.0) as slope from ta),
tc as (select *, case when cv < 0.2 then 'Highly Stable' when cv < 0.4 then 'Moderately Stable' else 'Variable' end
                 as stability_class,
              case when abs(slope) * count < 1 then 'No Trend' when slope > 0 then 'Increasing' else 'Decreasing' end
                 as trend_class from tb),
trend0 as (select src, dst, concat_ws('→', src::varchar, dst::varchar) as pair, count, mean, cv, slope, stability_class, trend_class,
                  ((1 - cv) + case when trend_class = 'No Trend' then 1.0 else 0.5 end) / 2 as modelability from tc),
trend as (select src, dst, pair, count, round(mean, 6) as mean, round(cv, 6) as cv, round(slope, 6) as slope, stability_class,
                 trend_class, round(modelability, 6) as modelability from trend0)
"""

ROLLING = """
re as (select src, dst, ts, avg from edges where avg > 0),
rs as (select src, dst, count(*) as n, min(ts) as t0, greatest(10, floor(count(*) / 20))::bigint as c
       from re group by src, dst),
rs2 as (select *, c // 2 as st from rs where n >= c),
rr as (select re.src, re.dst, re.ts, re.avg, rs2.n, rs2.t0, rs2.c, rs2.st,
              row_number() over (partition by re.src, re.dst order by re.ts, re.avg) - 1 as p
       from re join rs2 using (src, dst)),
rb as (select *, greatest(0, floor((p - c) / st) + 1)::bigint as lo, least(p // st, (n - c) // st)::bigint as hi from rr),
rc as (select src, dst, ts, avg, p, c, st, t0, unnest(range(lo, hi + 1)) as chunk from rb where lo <= hi),
ra as (select src, dst, chunk, t0, avg(avg) as mean, stddev_pop(avg) as std,
              max(case when p = chunk * st + c // 2 then ts end) as t_mid from rc group by src, dst, chunk, t0),
rolling as (select src, dst, chunk::bigint as chunk, round((t_mid - t0) / 3600.0::double, 6) as hours,
                   case when mean > 0 then std / mean else 0.0 end as cv from ra)
"""

MATRIX = f"""
top as (select node, count(*) as activity from (select src as node from osucc union all select dst from osucc)
        where node is not null and node <> 0 group by node order by activity desc, node limit 50),
me as (select * from osucc where src in (select node from top) and dst in (select node from top) and src <> dst),
ms as (select src, dst, avg, lag(avg) over (partition by src, dst order by ts, avg) as prev from me),
mx as (select src, dst, count(*) as n, {pearson('prev', 'avg')} as r from ms group by src, dst),
matrix as (select src, dst, coalesce(r, 0.0) as autocorr from mx where n >= 10
           union all select node, node, 1.0::double from top)
"""

BASELINE = """
be as (select src, dst, ts, avg, row_number() over (partition by src, dst order by ts, avg) as rn from edges),
bb as (select src, dst, rn, avg as y,
              lag(avg, 1) over w as persistence,
              avg(avg) over (w rows between 7 preceding and 1 preceding) as moving_avg,
              count(avg) over (w rows between 7 preceding and 1 preceding) as m,
              regr_slope(avg, rn::double) over (w rows between 7 preceding and 1 preceding) as sl,
              regr_intercept(avg, rn::double) over (w rows between 7 preceding and 1 preceding) as ic
       from be window w as (partition by src, dst order by rn)),
bl as (select src, dst, 'persistence' as method, y, persistence as pred from bb
       union all select src, dst, 'moving_avg', y, moving_avg from bb
       union all select src, dst, 'linear', y, case when m >= 2 then ic + sl * rn end from bb)
"""

RES = [("10 seconds", "1 second", 10, 1), ("5 minutes", "30 seconds", 300, 30),
       ("2 hours", "15 minutes", 7200, 900), ("1 day", "4 hours", 86400, 14400)]


# in whole millionths: a sum of doubles depends on the order of its rows, which decides ties of the rounding
PANE_MEAN = ("((2 * coalesce(sum(round(avg * 1000000.0::double)::bigint) filter (avg > 0), 0) + count(*) filter (avg > 0))"
             " // (2 * nullif(count(*) filter (avg > 0), 0)))::double / 1000000.0::double")


def _mrw() -> str:
    parts = []
    for size, slide, s, sl in RES:
        parts.append(f"""select '{size}/{slide}' as resolution, prb_id,
            (ts - ts % {sl}) - k * {sl} as window_start, count(*) as n, count_if(avg > 0) as n_ok,
            {PANE_MEAN} as mean
            from ping cross join range(0, {s // sl}) t(k) group by all""")
    return "\nunion all\n".join(parts)


def _range_profile() -> str:
    cols = ["src", "dst", "ts", "avg", "sent", "rcvd"]
    return "\nunion all\n".join(
        f"select '{c}' as \"column\", cast(min({c}) as double) as min, cast(max({c}) as double) as max, "
        f"count(distinct {c}) as n_unique from edges" for c in cols)


ORACLE = {
    "top_pairs": q("""select src, dst, count(*) as count from edges where src <> dst group by src, dst
                      having count(*) >= 20 order by count desc, src, dst limit 10"""),
    "parse_measurements": q("select prb_id, dst_addr, ts, sent, rcvd, avg, rtt_1, rtt_2, rtt_3 from parsed where sent = 3"),
    "resolve_dst_probe": q("select src, dst, ts, avg, result, sent, rcvd from edges"),
    "resolve_dst_probe_inner": q("select src, dst, ts, avg, sent, rcvd from edges"),
    "partial_loss": q("select * from ping where rcvd < 3 and rcvd > 0"),
    "self_loops": q("select src, dst, ts, avg, sent, rcvd from edges where src = dst"),
    "successful": q("select src, dst, ts, avg, sent, rcvd from succ"),
    "extract_rtts": q("select prb_id, dst_addr, ts, sent, rcvd, avg, rtt_1, rtt_2, rtt_3 from parsed"),
    "rtts_array": q("select prb_id, dst_addr, ts, rtt_1, rtt_2, rtt_3 from parsed"),
    "unpack_ts": q(f"""select prb_id, ts, cast(hour({TS}) as bigint) as hour,
                       cast(isodow({TS}) - 1 as bigint) as weekday from ping"""),
    "hours_from_start": q("""select src, dst, ts, round((ts - min(ts) over (partition by src, dst)) / 3600.0::double, 6)
                             as hours from edges"""),
    "packet_loss": q(f"""select sent, rcvd, count(*) as count,
        round(case when sent > 0 then (sent - rcvd)::double / sent * 100.0::double else 0.0 end, 6) as loss_rate,
        round(count(*) * {H} / sum(count(*)) over (), 6) as pct_of_total,
        (case when sent > 0 then (sent - rcvd)::double / sent * 100.0::double else 0.0 end) = 0 as successful
        from edges group by sent, rcvd"""),
    "ip_columns": q(f"""select dst_addr, dst_addr like '%:%' as is_ipv6, {v4int('dst_addr')} as ipv4_int,
        {v4text(v4int('dst_addr'))} as ipv4_text, {v6hex('dst_addr')} as ipv6_hex from ping"""),
    "optimize_dataset": q("select * from opt"),
    "ipv4_only": q("""select * from opt where src_ipv4_int is not null and src_ipv4_int > 0
                      and dst_ipv4_int is not null and dst_ipv4_int > 0"""),
    "add_source_ip": q("""select p.prb_id, p.ts, p.dst_addr, p.avg, s.src_is_ipv6, s.src_ipv4_int, s.src_ipv6_hex
                          from ping p left join srcmap s on p.prb_id = s.dst_prb_id"""),
    "distinct_edges": q("select distinct src, dst from edges"),
    "out_degree": q("select src, out_degree from degree"),
    "top_sources": q("select src, out_degree from degree order by out_degree desc, src limit 5"),
    "filter_top_endpoints": q("""select src, dst, ts, avg, sent, rcvd from edges
        where src in (select src from top5) and dst in (select src from top5)""",
        "top5 as (select src from degree order by out_degree desc, src limit 5)"),
    "mapped_probe_coverage": q(f"""select count(*) as n_probes, count(m.p) as n_mapped,
        round(count(m.p) * {H} / count(*), 6) as pct_mapped
        from (select distinct prb_id as p from ping) a left join (select distinct dst_prb_id as p from probe_ip_map) m
        on a.p = m.p"""),
    "column_counts": q("""select count(prb_id) as prb_id, count(dst_addr) as dst_addr, count(ts) as ts,
        count(sent) as sent, count(rcvd) as rcvd, count(avg) as avg, count(rtt_1) as rtt_1,
        count(rtt_2) as rtt_2, count(rtt_3) as rtt_3 from parsed"""),
    "range_profile": q(_range_profile()),
    "describe_ts": q("""select count(ts) as count, round(avg(ts), 6) as mean, round(stddev_samp(ts), 6) as std,
        round(min(ts)::double, 6) as min, round(quantile_cont(ts, 0.25), 6) as p25,
        round(quantile_cont(ts, 0.5), 6) as p50, round(quantile_cont(ts, 0.75), 6) as p75,
        round(max(ts)::double, 6) as max from edges"""),
    "time_steps": q("""select (select count(*) from gaps) as n_gaps, (select min(d) from gaps) as min_step,
        (select max(d) from gaps) as max_step,
        (select d from gaps group by d order by count(*) desc, d limit 1) as mode_step,
        (select string_agg(cast(d as varchar), ',' order by ts) from (select ts, d from gaps order by ts limit 10))
            as first_steps""",
        """tsd as (select distinct ts from edges),
           gaps as (select * from (select ts, ts - lag(ts) over (order by ts) as d from tsd) where d is not null)"""),
    "completeness": q(f"""select count(*) as "rows", count(distinct src) as n_src, count(distinct dst) as n_dst,
        count(distinct ts) as n_ts,
        count(distinct src)::double * count(distinct dst) * count(distinct ts) as theoretical,
        round(count(*) / (count(distinct src)::double * count(distinct dst) * count(distinct ts)) * {H}, 6)
            as completeness_pct from edges"""),
    "dup_measurements": q("""select count(*) as n_keys, max(c) as max_per_key, round(avg(c), 6) as mean_per_key
        from (select src, dst, ts, count(*) as c from edges group by src, dst, ts)"""),
    "hourly_counts": q(f"select cast(hour({TS}) as bigint) as hour, count(*) as count from edges group by 1"),
    "dow_counts": q(f"select cast(isodow({TS}) - 1 as bigint) as day_of_week, count(*) as count from edges group by 1"),
    "temporal_summary": q("""select (select count(*) from hc) as hours_with_data,
        (select round(avg(c), 6) from hc) as mean_per_hour, (select round(stddev_samp(c), 6) from hc) as std_per_hour,
        (select count(*) from dc) as days_with_data, (select round(avg(c), 6) from dc) as mean_per_day,
        (select round(stddev_samp(c), 6) from dc) as std_per_day,
        min(ts) as min_ts, max(ts) as max_ts, count(distinct ts) as n_unique_ts from edges""",
        f"""hc as (select hour({TS}) as h, count(*) as c from edges group by 1),
            dc as (select isodow({TS}) as d, count(*) as c from edges group by 1)"""),
    "overview": q("""select count(*) as total_measurements, count(distinct src) as unique_sources,
        count(distinct dst) as unique_destinations, count(distinct ts) as unique_timestamps,
        min(ts) as min_ts, max(ts) as max_ts, round(min(avg), 6) as min_latency, round(max(avg), 6) as max_latency,
        round(avg(avg), 6) as mean_latency, round(stddev_samp(avg), 6) as std_latency from edges"""),
    "summary": q(f"""select a.*, p.unique_pairs, t.top_src, t.top_dst, t.top_count from
        (select count(*) as total_measurements, round((max(ts) - min(ts)) / 3600.0::double, 6) as time_span_hours,
                round(avg(avg), 6) as mean_latency, round(stddev_samp(avg), 6) as std_latency,
                count_if(rcvd = 3) as successful_measurements,
                round(count_if(rcvd = 3) * {H} / count(*), 6) as success_pct from edges) a
        cross join (select count(*) as unique_pairs from (select distinct src, dst from edges)) p
        left join (select src as top_src, dst as top_dst, count(*) as top_count from edges where src <> dst
                   group by src, dst having count(*) >= 20 order by top_count desc, src, dst limit 1) t on true"""),
    "latency_matrix": q("""select src, dst, round(avg(avg), 6) as avg_latency from edges
        where src in (select src from top20) and dst in (select src from top20) group by src, dst""",
        "top20 as (select src from degree order by out_degree desc, src limit 20)"),
    "ipv4_retention": q(f"""select total, kept, total - kept as removed, round(kept * {H} / total, 6) as kept_pct,
        round((total - kept) * {H} / total, 6) as removed_pct from
        (select count(*) as total, count_if(src_ipv4_int is not null and src_ipv4_int > 0
                and dst_ipv4_int is not null and dst_ipv4_int > 0) as kept from opt)"""),
    "ip_pair_distribution": q(f"""select src_version, dst_version, count(*) as count,
        round(count(*) * {H} / sum(count(*)) over (), 6) as pct from
        (select case when src_is_ipv6 is null then 'unmapped' when src_is_ipv6 then 'ipv6' else 'ipv4' end as src_version,
                case when dst_is_ipv6 then 'ipv6' else 'ipv4' end as dst_version from opt)
        group by src_version, dst_version"""),
    "storage_breakdown": q(f"""select count(*) as "rows", count_if(not dst_is_ipv6) as dst_ipv4,
        count_if(dst_is_ipv6) as dst_ipv6, count_if(src_is_ipv6 is not null) as src_mapped,
        count_if(src_is_ipv6 = false) as src_ipv4, count_if(src_is_ipv6) as src_ipv6,
        round(count_if(src_is_ipv6 is not null) * {H} / count(*), 6) as mapped_pct from opt"""),
    "ip_version_distribution": q(f"""select version, count(*) as count,
        round(count(*) * {H} / sum(count(*)) over (), 6) as pct from
        (select case when ip like '%:%' then 'ipv6' else 'ipv4' end as version
         from (select distinct dst_addr as ip from ping where dst_addr is not null)) group by version"""),
    "ip_storage_estimate": q(f"""select count(*) as n_ips, sum(length(ip))::bigint as text_bytes,
        sum(case when ip like '%:%' then 16 else 4 end)::bigint as packed_bytes,
        round((1 - sum(case when ip like '%:%' then 16 else 4 end)::double / sum(length(ip))) * {H}, 6) as saving_pct
        from (select distinct dst_addr as ip from ping where dst_addr is not null)"""),
    "node_activity": q("""select node, count(*) as activity from
        (select src as node from osucc union all select dst from osucc)
        where node is not null and node <> 0 group by node order by activity desc, node limit 50"""),
    "probe_quality": q("""select src, count(*) as n_rows, count(distinct dst) as n_dsts,
        count(*) >= 20 and count(distinct dst) >= 5 as good from edges group by src"""),
    "pair_variation": q("""select b.src, b.dst, b.count, round(bh.hourly_variation, 6) as hourly_variation,
        round(bd.daily_variation, 6) as daily_variation,
        round(case when b.mean_latency <> 0 then b.std_latency / b.mean_latency else 0.0 end, 6) as coefficient_of_variation,
        round(ac.autocorr, 6) as autocorrelation, round(b.mean_latency, 6) as mean_latency,
        round(b.std_latency, 6) as std_latency
        from pv_base b left join bh using (src, dst) left join bd using (src, dst) left join ac using (src, dst)""",
        f"""pv_base as (select src, dst, count(*) as count, avg(avg) as mean_latency, stddev_samp(avg) as std_latency
                        from edges group by src, dst),
            bh as (select src, dst, avg(s) as hourly_variation from
                   (select src, dst, hour({TS}) as h, stddev_samp(avg) as s from edges group by all) group by src, dst),
            bd as (select src, dst, avg(s) as daily_variation from
                   (select src, dst, isodow({TS}) as d, stddev_samp(avg) as s from edges group by all) group by src, dst),
            ac as {lag1('edges', 'src, dst', 3)}"""),
    "pair_stddev_matrix": q("""select src, dst, count(*) as n, round(stddev_pop(avg), 6) as stddev from edges
        group by src, dst having count(*) > 1"""),
    "pair_latency_stats": q("""select src, dst, count(*) as count, round(avg(avg), 6) as mean,
        round(quantile_cont(avg, 0.5), 6) as median, round(stddev_samp(avg), 6) as std_samp,
        round(stddev_pop(avg), 6) as std_pop, round(min(avg), 6) as min, round(max(avg), 6) as max
        from edges where avg > 0 group by src, dst"""),
    "histogram": q("""select src, dst, bin, round(lo + (bin - 1) * ((hi - lo) / 30), 6) as bin_lo,
        round(case when bin = 30 then hi else lo + bin * ((hi - lo) / 30) end, 6) as bin_hi, count(*) as count
        from (select d.src, d.dst, lo, hi,
                     (case when hi = lo then 1 else least(floor(30 * (v - lo) / (hi - lo)) + 1, 30) end)::bigint as bin
              from hd d join hr using (src, dst))
        group by src, dst, bin, lo, hi""",
        """hd as (select src, dst, avg::double as v from edges where avg > 0),
           hr as (select src, dst, min(v) as lo, max(v) as hi from hd group by src, dst)"""),
    "boxplot_stats": q("""select src, dst, round(q1, 6) as q1, round(q2, 6) as median, round(q3, 6) as q3,
        round(min(case when avg between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1) then avg end), 6) as whisker_lo,
        round(max(case when avg between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1) then avg end), 6) as whisker_hi,
        count_if(not (avg between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1))) as n_outliers
        from be2 join bq using (src, dst) group by src, dst, q1, q2, q3""",
        """be2 as (select src, dst, avg from edges where avg > 0),
           bq as (select src, dst, quantile_cont(avg, 0.25) as q1, quantile_cont(avg, 0.5) as q2,
                         quantile_cont(avg, 0.75) as q3 from be2 group by src, dst)"""),
    "pair_cv": q("""select src, dst, concat_ws('→', src::varchar, dst::varchar) as pair, round(avg(avg), 6) as mean,
        round(stddev_pop(avg), 6) as std,
        round(case when avg(avg) > 0 then stddev_pop(avg) / avg(avg) else 0.0 end, 6) as cv, count(*) as count
        from edges where avg > 0 group by src, dst having count(*) > 1"""),
    "trend": q("select * from trend", TREND),
    "modelability": q("""select src, dst, pair, count, round(mean, 6) as mean, round(cv, 6) as cv, round(slope, 6) as slope,
        stability_class, trend_class, round(modelability, 6) as modelability, modelability > 0.7 as high_modelability from trend0
        order by trend0.modelability desc, src, dst limit 15""", TREND),
    "modelability_share": q("""select count(*) as n_pairs, count_if(modelability > 0.7) as n_high,
        round(count_if(modelability > 0.7) * 100.0::double / nullif(count(*), 0), 6) as high_pct from trend0""", TREND),
    "class_counts": q("""select 'stability' as kind, stability_class as "class", count(*) as n,
            round(count(*) * 100.0::double / (select count(*) from trend), 6) as pct from trend group by 2
        union all select 'trend', trend_class, count(*), round(count(*) * 100.0::double / (select count(*) from trend), 6)
        from trend group by 2""", TREND),
    "autocorr_lag1": q(f"select * from {lag1('edges', 'src, dst', 3)}"),
    "autocorr_multi": q(f"""select s.src, s.dst, l.lag::bigint as lag,
        round(case when ag.m >= 2 then coalesce(ag.r, 0.0) else 0.0 end, 6) as autocorr
        from am_s s cross join range(1, 61) l(lag)
        left join ag on ag.src = s.src and ag.dst = s.dst and ag.lag = l.lag""",
        f"""am_e as (select src, dst, ts, avg from edges where avg > 0),
            am_s as (select src, dst from am_e group by src, dst having count(*) >= 60),
            am_r as (select e.src, e.dst, e.avg, row_number() over (partition by e.src, e.dst order by e.ts, e.avg) as rn
                     from am_e e join am_s using (src, dst)),
            am_p as (select a.src, a.dst, l.lag, b.avg as x, a.avg as y from am_r a cross join range(1, 61) l(lag)
                     join am_r b on b.src = a.src and b.dst = a.dst and b.rn = a.rn - l.lag),
            ag as (select src, dst, lag, count(*) as m, {pearson('x', 'y')} as r from am_p group by src, dst, lag)"""),
    "bounded_series": q("""select src, dst, ts, avg, sent, rcvd from
        (select *, row_number() over (partition by src, dst order by ts, avg) as rn from succ) where rn <= 50"""),
    "autocorr_matrix": q("select src, dst, round(autocorr, 6) as autocorr from matrix", MATRIX),
    "matrix_coverage": q(f"""select count(*) as n_valid, round(count(*) * {H} / (count_if(src = dst) * count_if(src = dst)), 6) as coverage_pct,
        count_if(src <> dst) as n_offdiag, round(min(case when src <> dst then autocorr end), 6) as min_offdiag,
        round(max(case when src <> dst then autocorr end), 6) as max_offdiag,
        round(avg(case when src <> dst then autocorr end), 6) as mean_offdiag from matrix""", MATRIX),
    "moving_average": q("""select src, dst, rn, round((ts - t0) / 3600.0::double, 6) as hours, w::bigint as w,
        round(s / w, 6) as ma from
        (select *, sum(avg) over (partition by src, dst order by rn rows between 19 preceding and current row) as s19,
                list(avg) over (partition by src, dst order by rn rows between 19 preceding and current row) as l
         from ma_r) x, lateral (select list_sum(list_slice(l, len(l) - w::int + 1, len(l))) as s)
        where rn >= w""",
        """ma_e as (select src, dst, ts, avg from edges where avg > 0),
           ma_s as (select src, dst, min(ts) as t0, least(20, floor(count(*) / 10)) as w from ma_e group by src, dst
                    having least(20, floor(count(*) / 10)) > 1),
           ma_r as (select e.src, e.dst, e.ts, e.avg, s.t0, s.w,
                           row_number() over (partition by e.src, e.dst order by e.ts, e.avg) as rn
                    from ma_e e join ma_s s using (src, dst))"""),
    "rolling_cv": q("select src, dst, chunk, hours, round(cv, 6) as cv from rolling", ROLLING),
    "stability_status": q("""select src, dst, round(avg(cv), 6) as mean_cv,
        case when avg(cv) < 0.3 then 'Stable' when avg(cv) < 0.6 then 'Variable' else 'Highly Variable' end as status
        from rolling group by src, dst""", ROLLING),
    "autocorr_over_time": q(f"""select src, dst, day, n, round(autocorr, 6) as autocorr,
        round(case when 1.0 - autocorr * autocorr < 1e-9 then null
                   else autocorr * sqrt((n - 2.0) / (1.0 - autocorr * autocorr)) end, 6) as t_stat
        from {lag1('aot', 'src, dst, day', 3, None)}""",
        f"aot as (select src, dst, ts, avg, cast(cast({TS} as date) as varchar) as day from edges)"),
    "baseline_mae": q("""select src, dst, method, count(*) as n, round(avg(abs(y - pred)), 6) as mae,
        round(stddev_samp(abs(y - pred)) / sqrt(count(*)), 6) as mae_se
        from bl where pred is not null group by src, dst, method""", BASELINE),
    "multi_resolution_windows": q(_mrw()),
}


# ---------------------------------------------------------------- sequences
def _shorts6(h: str) -> str:
    return "[" + ", ".join(f"9 + ('0x' || substr({h}, {4 * i + 1}, 4))::int" for i in range(8)) + "]"


def _ip_block(marker: int, v6: str, v4: str, hx: str) -> str:
    return (f"(case when not coalesce(({v6} and {hx} is not null) or (not {v6} and {v4} > 0), false) then [{marker}, 67593] "
            f"when {v6} then [{marker}, 5] || {_shorts6(hx)} "
            f"else [{marker}, 4, (9 + floor({v4} / 65536))::int, (9 + {v4} % 65536)::int] end)")


def _key(name: str) -> str:
    return f"md5(concat_ws('|', '42', prb_id::varchar, ts::varchar, dst_addr_display, '{name}'))"


SEQ = f"""
tok as (select prb_id, ts, dst_addr_display,
          [0] || flatten(list_transform(list_sort([
             {{'h': {_key('src')}, 'b': {_ip_block(2, 'src_is_ipv6', 'src_ipv4_int', 'src_ipv6_hex')}}},
             {{'h': {_key('dst')}, 'b': {_ip_block(3, 'dst_is_ipv6', 'dst_ipv4_int', 'dst_ipv6_hex')}}},
             {{'h': {_key('lat')}, 'b': [6, (65545 + case when avg > 0 then least(1023, greatest(1, floor(ln(1.0 + avg::double) * 94.0))) else 0 end)::int]}},
             {{'h': {_key('ts')}, 'b': [7, (66569 + floor(((ts + 259200) % 604800) / 600))::int]}}
          ]), lambda s: s.b)) || [1] as t
        from opt)
"""

TW = """
tw_r as (select prb_id, ts, avg, sent, rcvd,
                row_number() over (partition by prb_id order by ts, dst_addr_display, avg) - 1 as p,
                count(*) over (partition by prb_id) as n from opt),
tw_x as (select r.*, s.size, unnest([p // (s.size // 2), p // (s.size // 2) - 1]) as wid
         from tw_r r cross join (values (20), (40), (80), (128)) s(size)),
tw as (select prb_id, size::bigint as size, wid::bigint as wid, count(*) as n, min(ts) as first_ts,
              max(ts) as last_ts, round(avg(avg::double), 6) as mean_latency,
              round(count_if(sent = rcvd and avg > 0) * 100.0::double / count(*), 6) as success_pct
       from tw_x where wid >= 0 and wid * (size // 2) < n - size group by prb_id, size, wid),
twc as (select tw.*, c.condition from tw cross join (values ('TEMPORAL'), ('NO_TEMPORAL')) c(condition))
"""


def _decode() -> str:
    names = ["START", "END", "SRC", "DST", "V4", "V6", "LATENCY", "TIMESTAMP", "PAD"]
    whens = " ".join(f"when x = {i} then '{n}'" for i, n in enumerate(names))
    return (f"list_transform(t, lambda x: case {whens} "
            "when x between 9 and 65544 then 'SHORT(' || (x - 9)::varchar || ')' "
            "when x between 65545 and 66568 then 'LAT(' || (x - 65545)::varchar || ')' "
            "when x between 66569 and 67592 then 'TIME(' || (x - 66569)::varchar || ')' "
            "when x = 67593 then 'UNKNOWN_ADDRESS' else 'UNKNOWN(' || x::varchar || ')' end)")


def _octets(x: str) -> str:
    return " || ' ' || ".join(f"(floor({x} / {1 << s})::bigint % 256)::varchar" for s in (24, 16, 8, 0))


def _delta(hour: str) -> str:
    se = "stddev_samp(a - e) / sqrt(count(*))"
    some = "count(*) > 1 and max(a - e) > min(a - e)"
    return f"""select length, {hour} as hour, method, count(*) as n_windows, round(avg(a), 6) as mae_a, round(avg(e), 6) as mae,
        round(avg(a - e), 6) as delta_mae, round(case when {some} then avg(a - e) - 1.96 * {se} end, 6) as ci_lo,
        round(case when {some} then avg(a - e) + 1.96 * {se} end, 6) as ci_hi,
        round(case when {some} then avg(a - e) / ({se}) end, 6) as t_stat,
        coalesce(case when {some} then abs(avg(a - e) / ({se})) > 1.96 end, false) as significant
        from ev group by length, {'method' if hour.startswith('null') else 'hour, method'}"""


ORACLE.update({
    "tokenize": q("select prb_id, ts, dst_addr_display, array_to_string(t, ' ') as tokens, len(t)::bigint as length from tok", SEQ),
    "validate_tokens": q("""select count(*) as n_sequences,
        count_if(t[1] = 0 and t[-1] = 1 and list_bool_and(list_transform(t, lambda x: x >= 0 and x < 67594))
                 and list_contains(t, 2) and list_contains(t, 3) and list_contains(t, 6)) as n_valid from tok""", SEQ),
    "decode_tokens": q(f"select prb_id, ts, dst_addr_display, array_to_string({_decode()}, ' ') as names from tok", SEQ),
    "token_stats": q("""select count(*) as n_sequences, min(len(t)) as min_length, max(len(t)) as max_length,
        round(avg(len(t)), 6) as mean_length, sum(len(t))::bigint as total_tokens,
        round(quantile_cont(len(t), 0.5), 6) as median_length,
        (select count(distinct x) from (select unnest(t) as x from tok)) as unique_tokens,
        (select count_if(x <= 8 or x = 67593) from (select unnest(t) as x from tok)) as structural,
        (select count_if(x between 9 and 65544) from (select unnest(t) as x from tok)) as short,
        (select count_if(x between 65545 and 66568) from (select unnest(t) as x from tok)) as latency,
        (select count_if(x between 66569 and 67592) from (select unnest(t) as x from tok)) as "timestamp"
        from tok""", SEQ),
    "pad_and_mask": q("""select prb_id, ts, dst_addr_display,
        array_to_string(t || list_transform(range(greatest(0, 24 - len(t))), lambda i: 8), ' ') as padded,
        len(t)::bigint as mask_true, greatest(24, len(t))::bigint as mask_len, len(t)::bigint as lengths from tok""", SEQ),
    "byte_sequence": q(f"""select prb_id, ts, dst_ipv4_int, array_to_string([
        {", ".join(f"floor(src_ipv4_int / {1 << s})::bigint % 256" for s in (24, 16, 8, 0))},
        {", ".join(f"floor(dst_ipv4_int / {1 << s})::bigint % 256" for s in (24, 16, 8, 0))},
        case when sent = rcvd and avg > 0 then 256 else 257 end, 258], ' ') as byte_tokens
        from opt where src_ipv4_int is not null and src_ipv4_int > 0 and dst_ipv4_int is not null and dst_ipv4_int > 0"""),
    "split": q("""select split, count(*) as n_rows, count(distinct prb_id) as n_probes from
        (select prb_id, case when md5(prb_id::varchar) < 'b333' and day between 1 and 5 then 'train'
                             when md5(prb_id::varchar) < 'b333' and day = 6 then 'val'
                             when md5(prb_id::varchar) >= 'b333' and day = 7 then 'test' else 'unused' end as split
         from (select prb_id, (floor((ts - (select min(ts) from opt)) / 86400) + 1)::bigint as day from opt))
        group by split"""),
    "training_windows": q("select * from twc", TW),
    "dataset_traits": q("""select round(avg(avg::double), 6) as mean_latency, round(stddev_samp(avg::double), 6) as std_latency,
        round(min(avg::double), 6) as min_latency, round(max(avg::double), 6) as max_latency,
        round(count_if(sent = rcvd) * 100.0::double / count(*), 6) as success_pct,
        (select count(*) from pp) as n_probes, (select min(c) from pp) as min_rows_per_probe,
        (select max(c) from pp) as max_rows_per_probe,
        (select round(quantile_cont(c, 0.25), 6) from pp) as p25_rows_per_probe,
        (select round(quantile_cont(c, 0.5), 6) from pp) as median_rows_per_probe,
        (select round(quantile_cont(c, 0.75), 6) from pp) as p75_rows_per_probe from opt""",
        "pp as (select prb_id, count(*) as c from opt group by prb_id)"),
    "sample_sequences": q("""select prb_id, size, wid, n, first_ts, last_ts, mean_latency, success_pct, c.condition from
        (select * from tw where prb_id in (select prb_id from opt group by prb_id
                                           having count(*) >= 20 and count(distinct dst_addr_display) >= 5)
         order by md5(concat_ws('|', '42', prb_id::varchar, size::varchar, wid::varchar)) limit 20)
        cross join (values ('TEMPORAL'), ('NO_TEMPORAL')) c(condition)""", TW),
    "window_sequences": q(f"""select prb_id, size, wid, c.condition, (c.token::varchar || ' ' ||
            string_agg(case when k < size then {_octets('src_ipv4_int')} || ' ' || {_octets('dst_ipv4_int')} || ' ' || (case when ok then 256 else 257 end)::varchar || ' 258'
                            else {_octets('src_ipv4_int')} || ' ' || {_octets('dst_ipv4_int')} end, ' ' order by k)) as tokens,
        string_agg(coalesce(case when ok then round(avg::double * 1000)::bigint::varchar end, '-'), ' ' order by k) filter (k < size) as latency_us,
        case when c.condition = 'TEMPORAL' then string_agg(floor(((ts + 259200) % 604800) / 600)::bigint::varchar, ' ' order by k) end as week_time,
        case when c.condition = 'TEMPORAL' then string_agg((ts - prev)::varchar, ' ' order by k) end as gap,
        bool_or(ok) filter (k = size) as target_success, round(max(case when ok and k = size then avg::double end), 6) as target_latency
        from (select *, row_number() over (partition by prb_id, size, wid order by p) as k,
                     coalesce(lag(ts) over (partition by prb_id, size, wid order by p), ts) as prev
              from ws_x where wid >= 0 and wid * (size // 2) < n - size)
        cross join (values (259, 'TEMPORAL'), (260, 'NO_TEMPORAL')) c(token, condition)
        group by prb_id, size, wid, c.condition, c.token""",
        """ws_r as (select *, coalesce(sent = rcvd and avg > 0, false) as ok,
                          row_number() over (partition by prb_id order by ts, dst_addr_display, avg) - 1 as p,
                          count(*) over (partition by prb_id) as n
                   from opt where src_ipv4_int is not null and src_ipv4_int > 0
                              and dst_ipv4_int is not null and dst_ipv4_int > 0),
           ws_x as (select r.*, s.size::bigint as size, unnest([p // (s.size // 2), p // (s.size // 2) - 1])::bigint as wid
                    from ws_r r cross join (values (20), (40), (80), (128)) s(size))"""),
    "evaluate": q(f"""{_delta('null::bigint')} union all {_delta('hour')}""", BASELINE + f""",
ev_b as (select b.*, e.ts from bb b join be e using (src, dst, rn)),
ev_w as (select src, dst, k.length::bigint as length, (rn - 1) // k.length as wid, min(ts) as t0, count(*) as c,
                avg(abs(y - persistence)) filter (ok) as e_persistence, avg(abs(y - moving_avg)) filter (ok) as e_moving_avg,
                avg(abs(y - case when m >= 2 then ic + sl * rn end)) filter (ok) as e_linear
         from (select *, y is not null and persistence is not null and moving_avg is not null and m >= 2
                         and ic + sl * rn is not null as ok from ev_b) cross join (values (20), (40), (80), (128)) k(length)
         group by src, dst, k.length, (rn - 1) // k.length having count(*) = k.length and count_if(ok) > 0),
ev as (select w.length, hour(make_timestamp(t0 * 1000000))::bigint as hour, o.method, e_persistence as a,
              case o.method when 'linear' then e_linear else e_moving_avg end as e
       from ev_w w cross join (values ('moving_avg'), ('linear')) o(method))"""),
    "evaluate_mae": q(f"""select hour, count(*) as n, round(avg(abs(y - persistence)), 6) as mae,
        round(avg(abs(y - persistence)) - 1.96 * stddev_samp(abs(y - persistence)) / sqrt(count(*)), 6) as ci_lo,
        round(avg(abs(y - persistence)) + 1.96 * stddev_samp(abs(y - persistence)) / sqrt(count(*)), 6) as ci_hi
        from (select cast(hour({TS}) as bigint) as hour, b.y, b.persistence from bb b join be using (src, dst, rn))
        where persistence is not null group by hour""", BASELINE),
    "success_accuracy": q(f"""select hour, count(*) as n, round(avg(hit), 6) as accuracy,
        round(avg(hit) - 1.96 * sqrt(avg(hit) * (1 - avg(hit)) / count(*)), 6) as ci_lo,
        round(avg(hit) + 1.96 * sqrt(avg(hit) * (1 - avg(hit)) / count(*)), 6) as ci_hi from
        (select cast(hour({TS}) as bigint) as hour, (success = prev)::int::double as hit from
         (select ts, success, lag(success) over (partition by src, dst order by ts, avg, success) as prev
          from (select *, sent = rcvd as success from edges))) where hit is not null group by hour"""),
})

ORACLE["stream_ingest"] = ORACLE["parse_measurements"]
ORACLE["optimize_write_readback"] = ORACLE["optimize_dataset"]


# ---------------------------------------------------------------- awkward rows, files, streams
def edge(sql: str) -> str:
    """The same query over the view with awkward rows."""
    return sql.replace(DUCK_PING, DUCK_PING_EDGE)


for _name in ("parse_measurements", "resolve_dst_probe", "mapped_probe_coverage", "optimize_dataset", "ip_pair_distribution", "tokenize"):
    ORACLE[_name + "_edge"] = edge(ORACLE[_name])

LINES = """lines as (select *, ts % 5 as dump, ts % 7 = 3 and ts % 5 < 4 as bad from ping)"""

ORACLE.update({
    "stream_rows": edge(q("""select prb_id, dst_addr, ts, sent, rcvd, avg, rtt_1, rtt_2, rtt_3 from parsed
        where sent = 3 and not (ts % 7 = 3 and ts % 5 < 4)""")),
    "stream_rejects": edge(q("""select dump, '{"prb_id": ' || prb_id::varchar || ', "timestamp": ' || ts::varchar
        || ', "dst_addr": "10.' as line from lines where bad""", LINES)),
    "ingest_report": edge(q("""select dump, count(*) as "rows", count_if(not bad) as ok_rows, count_if(bad) as corrupt_rows,
        count_if(bad) = 0 as ok from lines group by dump""", LINES)),
    "ingest_summary": edge(q("""select count(*) as files, count_if(c = 0) as ok_files, count_if(c > 0) as failed_files,
        sum(n)::bigint as "rows", sum(n - c)::bigint as ok_rows, sum(c)::bigint as corrupt_rows
        from (select dump, count(*) as n, count_if(bad) as c from lines group by dump)""", LINES)),
    "stream_windows": edge(q("""select prb_id, (ts - ts % 30) - k * 30 as window_start, count(*) as n, count(*) filter (avg > 0) as n_ok,
        """ + PANE_MEAN + """ as mean
        from lines cross join range(0, 10) t(k) where not bad and sent = 3 group by all""", LINES)),
    "write_read_ping": q("select prb_id, ts, avg from ping"),
    "sample_head": q("select prb_id, ts, dst_addr, avg from ping order by ts, prb_id, dst_addr, avg limit 100"),
    "sample_sorted": q("select count(*) as n_rows, true as near_share, 0::bigint as foreign_rows from ping"),
    "batch_transform_write": q("select * from ping where rcvd < 3 and rcvd > 0"),
    "compact": q("select * from ping"),
    "concat_files": q("select * from ping"),
    "project_rtt": edge(q("""select null::varchar as src_addr, dst_addr, ts as "timestamp", avg as rtt from ping""")),
    "success_label": edge(q("select prb_id, ts, sent, rcvd, sent = rcvd as success from ping")),
    "add_source_ip_fanout": q("""select a.prb_id, a.n_rows, a.n_rows * b.n_ips as n_joined
        from (select prb_id, count(*) as n_rows from ping group by prb_id) a
        join (select dst_prb_id, count(*) as n_ips from probe_ip_map group by dst_prb_id) b on a.prb_id = b.dst_prb_id"""),
    "multi_ip_probes": q("""select prb_id % 3 as dst_prb_id, count(distinct dst_addr) as n_ips from ping group by 1
        having count(distinct dst_addr) > 1"""),
    "bounded_series_files": """with e as (select user_id % 10 as src, (event_id * 7 + user_id) % 10 as dst, event_id,
            cast(value as double) as avg, (event_id * 13) % 4 as part from events)
        select src, dst, event_id, avg from (select *, row_number() over (partition by src, dst order by part, event_id) as rn
                                             from e where avg > 0) where rn <= 50""",
    "range_profile_sketch": q(f"""select *, true as within_error from ({_range_profile()})"""),
})

for _name in ("top_pairs", "summary", "pair_latency_stats", "autocorr_lag1", "autocorr_multi", "rolling_cv", "trend"):
    ORACLE["big_" + _name] = ORACLE[_name].replace(EDGES, f"edges as ({DUCK_EDGE_BIG})")
