"""Queries over packets: fields, keys, directions, gaps, flows."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlab.functions import scalars as S
from flowlab.operators import flows as fl
from flowlab.plans.registry import query, with_views
from flowlab.schema import FLOW_FEATURES
from flowlab.sources import labels, tables as t

TIMEOUT = 5.0
KEY = "a_ip, b_ip, a_port, b_port, protocol"
INTEGER_FEATURES = {"fwd_packet_count", "bwd_packet_count", "total_fwd_bytes", "total_bwd_bytes"}


def rounded(df, digits=6, skip=()):
    """Doubles to a fixed number of digits, for comparison across engines."""
    return df.select(
        *[
            F.round(c, digits).alias(c) if ty == "double" and c not in skip else F.col(c)
            for c, ty in df.dtypes
        ]
    )


# --- SQL building blocks ---------------------------------------------------

SWAP = "(src_ip > dst_ip or (src_ip = dst_ip and src_port > dst_port))"
KEYED = (
    "keyed",
    f"""select *, case when {SWAP} then dst_ip else src_ip end as a_ip,
  case when {SWAP} then src_ip else dst_ip end as b_ip,
  case when {SWAP} then dst_port else src_port end as a_port,
  case when {SWAP} then src_port else dst_port end as b_port from packets""",
)


def sequenced(timeout, fin):
    conditions = ["false"]
    if timeout is not None:
        conditions.append(f"coalesce(ts - lag(ts) over w > {timeout}, false)")
    if fin:
        conditions.append(
            "coalesce(lag(case when protocol = 6 and (tcp_flags & 5) <> 0 then true else false end)"
            " over w, false)"
        )
    return [
        (
            "marked",
            f"""select *, case when {' or '.join(conditions)} then 1 else 0 end as starts
 from keyed window w as (partition by {KEY} order by ts, packet_id)""",
        ),
        (
            "seqd",
            f"""select *, cast(sum(starts) over (partition by {KEY} order by ts, packet_id
  rows unbounded preceding) as bigint) as flow_seq from marked""",
        ),
        (
            "described",
            f"""select *, first_value(src_ip) over f as first_src,
  src_ip = first_value(src_ip) over f as is_fwd,
  ts - lag(ts) over f as iat,
  ts - lag(ts) over (partition by {KEY}, flow_seq, src_ip order by ts, packet_id) as dir_iat
 from seqd window f as (partition by {KEY}, flow_seq order by ts, packet_id)""",
        ),
    ]


def exact_flow_sql(n, group="described"):
    def both(side, flag):
        size = f"case when {flag} then size end"
        gap = f"case when {flag} then dir_iat end"
        return f"""
  coalesce(avg({size}), 0) as {side}_pkt_len_mean, coalesce(stddev_pop({size}), 0) as {side}_pkt_len_std,
  cast(coalesce(min({size}), 0) as double) as {side}_pkt_len_min, cast(coalesce(max({size}), 0) as double) as {side}_pkt_len_max,
  coalesce(avg({gap}), 0) as {side}_iat_mean, coalesce(stddev_pop({gap}), 0) as {side}_iat_std,
  coalesce(min({gap}), 0) as {side}_iat_min, coalesce(max({gap}), 0) as {side}_iat_max,
  count(case when {flag} then 1 end) as {side}_packet_count,
  cast(coalesce(sum({size}), 0) as bigint) as total_{side}_bytes,"""

    return f"""select {KEY}, flow_seq, min(ts) as start_ts, max(ts) as end_ts, count(*) as n_packets,
 {both('fwd', 'is_fwd')}{both('bwd', 'not is_fwd')}
  greatest(max(ts) - min(ts), 1e-6) as flow_duration,
  sum(size) / greatest(max(ts) - min(ts), 1e-6) as flow_bytes_per_sec,
  count(*) / greatest(max(ts) - min(ts), 1e-6) as flow_pkts_per_sec,
  coalesce(avg(iat), 0) as iat_mean, coalesce(stddev_pop(iat), 0) as iat_std,
  coalesce(min(iat), 0) as iat_min, coalesce(max(iat), 0) as iat_max,
  coalesce(sum(case when is_fwd then size end), 0) / greatest(coalesce(sum(case when not is_fwd then size end), 0), 1) as fwd_bwd_byte_ratio,
  count(case when is_fwd then 1 end) / greatest(count(case when not is_fwd then 1 end), 1) as fwd_bwd_pkt_ratio,
  sum(header_size) / greatest(sum(size), 1) as header_ratio,
  (sum(size) - sum(header_size)) / greatest(sum(size), 1) as payload_ratio,
  coalesce(avg(case when iat < 1.0 then iat end), 0) as active_mean,
  coalesce(avg(case when iat >= 1.0 then iat end), 0) as idle_mean
 from {group} group by {KEY}, flow_seq having count(*) >= {n}"""


ESTIMATED_SQL = f"""select {KEY}, flow_seq, start_ts, end_ts, n_packets,
  nf as fwd_packet_count, nb as bwd_packet_count, bf as total_fwd_bytes, bb as total_bwd_bytes,
  fm as fwd_pkt_len_mean, fm * 0.2 as fwd_pkt_len_std, greatest(fm * 0.5, 40) as fwd_pkt_len_min, least(fm * 1.5, 1500) as fwd_pkt_len_max,
  bm as bwd_pkt_len_mean, bm * 0.2 as bwd_pkt_len_std, greatest(bm * 0.5, 40) as bwd_pkt_len_min, least(bm * 1.5, 1500) as bwd_pkt_len_max,
  dur as flow_duration, (bf + bb) / dur as flow_bytes_per_sec, n_packets / dur as flow_pkts_per_sec,
  im as iat_mean, s as iat_std, im as iat_min, im + 2 * s as iat_max,
  fim as fwd_iat_mean, s as fwd_iat_std, fim as fwd_iat_min, fim + 2 * s as fwd_iat_max,
  bim as bwd_iat_mean, d as bwd_iat_std, bim as bwd_iat_min, bim + 2 * d as bwd_iat_max,
  bf / greatest(bb, 1) as fwd_bwd_byte_ratio, nf / greatest(nb, 1) as fwd_bwd_pkt_ratio,
  least(n_packets * 40 / greatest(bf + bb, 1), 1) as header_ratio,
  1 - least(n_packets * 40 / greatest(bf + bb, 1), 1) as payload_ratio,
  dur * 0.7 as active_mean, dur * 0.3 as idle_mean
 from (select {KEY}, flow_seq, min(ts) as start_ts, max(ts) as end_ts, count(*) as n_packets,
  count(case when src_ip = a_ip then 1 end) as nf, count(case when src_ip <> a_ip then 1 end) as nb,
  cast(coalesce(sum(case when src_ip = a_ip then size end), 0) as bigint) as bf,
  cast(coalesce(sum(case when src_ip <> a_ip then size end), 0) as bigint) as bb,
  coalesce(avg(case when src_ip = a_ip then size end), 0) as fm,
  coalesce(avg(case when src_ip <> a_ip then size end), 0) as bm,
  greatest(max(ts) - min(ts), 1e-6) as dur,
  coalesce(avg(iat), 0) as im, coalesce(stddev_pop(iat), 0) as s,
  coalesce(avg(case when src_ip = a_ip then dir_iat end), 0) as fim,
  coalesce(avg(case when src_ip <> a_ip then dir_iat end), 0) as bim,
  coalesce(stddev_pop(case when src_ip <> a_ip then dir_iat end), 0) as d
  from described group by {KEY}, flow_seq having count(*) >= 5)"""


def feature_list(digits=6):
    return ", ".join(
        f if f in INTEGER_FEATURES else f"round({f}, {digits}) as {f}" for f in FLOW_FEATURES
    )


def flow_sql(timeout, fin, n, body=None):
    return with_views(
        "packets", KEYED, *sequenced(timeout, fin), ("flows", body or exact_flow_sql(n)),
        then=f"select {KEY}, flow_seq, round(start_ts, 6) as start_ts, round(end_ts, 6) as end_ts,"
        f" n_packets, {feature_list()} from flows",
    )


# --- packet level ----------------------------------------------------------

@query("packet_fields", with_views("packets", then="""
select packet_id, size, protocol,
 case when protocol in (6, 17) then src_port + 7 else 0 end as src_port,
 case when protocol in (6, 17) then dst_port + 7 else 0 end as dst_port,
 cast(case protocol when 6 then 20 + 4 * (5 + packet_id % 4) when 17 then 28 else 20 end as bigint) as header_size,
 case when protocol = 6 then tcp_flags else 0 end as tcp_flags from packets"""))
def _packet_fields(spark, sf):
    raw = t.packets(spark, sf).select(
        "packet_id", "size", "protocol", "tcp_flags",
        (F.col("src_port") + 7).alias("src_port"), (F.col("dst_port") + 7).alias("dst_port"),
        (5 + F.col("packet_id") % 4).alias("tcp_data_offset"),
    )
    return fl.packet_fields(raw)


@query("ipv4_only", with_views("packets", then="""
select protocol, count(*) as n, cast(sum(size) as bigint) as bytes from packets
 where packet_id % 7 <> 3 group by protocol"""))
def _ipv4_only(spark, sf):
    mixed = t.packets(spark, sf).withColumn(
        "ip_version", F.when(F.col("packet_id") % 7 == 3, 6).otherwise(4)
    )
    return fl.ipv4_only(mixed).groupBy("protocol").agg(
        F.count("*").alias("n"), F.sum("size").alias("bytes")
    )


@query("label_from_path", """
select doc_id, source, case
 when contains(lower(source), 'src1') then 'streaming'
 when contains(lower(source), 'src10') then 'voip'
 when contains(lower(source), '3') then 'web' else 'unknown' end as label from documents""")
def _label_from_path(spark, sf):
    docs = t.table(spark, sf, "documents").select("doc_id", "source")
    return labels.label_from_path(
        docs, {"SRC1": "streaming", "src10": "voip", "3": "web"}, path="source"
    )


@query("label_map_join", """
with m(ordinal, pattern, label) as (values (0, 'src1', 'streaming'), (1, 'src10', 'voip'), (2, '3', 'web'))
select doc_id, source, coalesce(min_by(m.label, ordinal), 'unknown') as label
from documents left join m on contains(lower(source), pattern) group by doc_id, source""")
def _label_map_join(spark, sf):
    docs = t.table(spark, sf, "documents").select("doc_id", "source")
    mapping = spark.createDataFrame(
        [(0, "SRC1", "streaming"), (1, "src10", "voip"), (2, "3", "web")],
        "ordinal int, pattern string, label string",
    )
    return labels.label_from_table(docs, mapping, path="source")


@query("flow_key", with_views("packets", KEYED, then=f"select packet_id, {KEY} from keyed"))
def _flow_key(spark, sf):
    return fl.with_flow_key(t.packets(spark, sf)).select(
        "packet_id", "a_ip", "b_ip", "a_port", "b_port", "protocol"
    )


@query("direction_by_key", with_views("packets", KEYED, then="""
select packet_id, case when src_ip = a_ip then 'fwd' else 'bwd' end as direction from keyed"""))
def _direction_by_key(spark, sf):
    return fl.with_direction(t.packets(spark, sf), "key").select("packet_id", "direction")


@query("direction_by_first_source", with_views("packets", KEYED, *sequenced(None, False), then="""
select packet_id, case when is_fwd then 'fwd' else 'bwd' end as direction from described"""))
def _direction_by_first(spark, sf):
    return fl.with_direction(t.packets(spark, sf), "first").select("packet_id", "direction")


@query("first_source", with_views("packets", KEYED, *sequenced(TIMEOUT, True), then="""
select packet_id, flow_seq, first_src from described"""))
def _first_source(spark, sf):
    return fl.with_first_source(
        t.packets(spark, sf), timeout=TIMEOUT, split_on_fin=True
    ).select("packet_id", "flow_seq", "first_src")


@query("inter_arrival", with_views("packets", KEYED, *sequenced(None, False), then="""
select packet_id, round(iat, 9) as iat from described"""))
def _iat(spark, sf):
    return rounded(fl.with_iat(t.packets(spark, sf)).select("packet_id", "iat"), 9)


@query("directional_inter_arrival", with_views("packets", KEYED, *sequenced(TIMEOUT, True), then="""
select packet_id, is_fwd, round(dir_iat, 9) as dir_iat from described"""))
def _dir_iat(spark, sf):
    df = fl.with_directional_iat(t.packets(spark, sf), timeout=TIMEOUT, split_on_fin=True)
    return rounded(df.select("packet_id", "is_fwd", "dir_iat"), 9)


@query("split_by_inactivity", with_views("packets", KEYED, *sequenced(TIMEOUT, False), then="""
select packet_id, flow_seq from described"""))
def _split_timeout(spark, sf):
    return fl.split_flows(t.packets(spark, sf), TIMEOUT).select("packet_id", "flow_seq")


@query("split_by_fin", with_views("packets", KEYED, *sequenced(None, True), then="""
select packet_id, flow_seq from described"""))
def _split_fin(spark, sf):
    return fl.split_flows(t.packets(spark, sf), None, True).select("packet_id", "flow_seq")


@query("split_hot_keys", with_views("packets", KEYED, *sequenced(TIMEOUT, True), then="""
select packet_id, flow_seq, first_src, round(iat, 9) as iat, round(dir_iat, 9) as dir_iat
from described"""))
def _split_hot(spark, sf):
    """The chunked path: every key above 20 packets counts as hot."""
    df = fl.split_flows(
        t.packets(spark, sf), TIMEOUT, True, hot_rows=20, chunk_seconds=7.0
    )
    return rounded(df.select("packet_id", "flow_seq", "first_src", "iat", "dir_iat"), 9)


@query("protocol_name", with_views("packets", then="""
select case protocol when 6 then 'TCP' when 17 then 'UDP' else cast(protocol as varchar) end as protocol_name,
 count(*) as n from packets group by 1"""))
def _protocol_name(spark, sf):
    return fl.protocol_name(t.packets(spark, sf)).groupBy("protocol_name").agg(
        F.count("*").alias("n")
    )


# --- flows -------------------------------------------------------------------

def _flow_view(df):
    return rounded(df)


@query("flow_features", flow_sql(None, False, 5))
def _flow_features(spark, sf):
    return _flow_view(fl.flow_features(t.packets(spark, sf)))


@query("flow_features_split", flow_sql(TIMEOUT, True, 5))
def flow_features_split(spark, sf):
    return _flow_view(fl.flow_features(t.packets(spark, sf), TIMEOUT, True))


@query("flow_features_hot_keys", flow_sql(TIMEOUT, True, 1))
def _flow_features_hot(spark, sf):
    return _flow_view(
        fl.flow_features(
            t.packets(spark, sf), TIMEOUT, True, 1, hot_rows=20, chunk_seconds=7.0
        )
    )


@query("flow_features_estimated", flow_sql(TIMEOUT, False, 5, ESTIMATED_SQL))
def _flow_estimated(spark, sf):
    return _flow_view(fl.flow_features(t.packets(spark, sf), TIMEOUT, profile="estimated"))


@query("min_packets", with_views("packets", KEYED, then=f"""
select {KEY}, count(*) as n_packets from keyed group by {KEY} having count(*) >= 66"""))
def _min_packets(spark, sf):
    keyed = fl.with_flow_key(t.packets(spark, sf))
    counts = keyed.groupBy("a_ip", "b_ip", "a_port", "b_port", "protocol").agg(
        F.count("*").alias("n_packets")
    )
    return fl.min_packets(counts, 66)


@query("flow_text", with_views("packets", KEYED, then="""
select packet_id, concat(a_ip, ':', a_port, ' → ', b_ip, ':', b_port, ' (',
 case protocol when 6 then 'TCP' when 17 then 'UDP' else cast(protocol as varchar) end, ')') as endpoints,
 concat_ws(',', a_ip, b_ip, a_port, b_port, protocol) as flow_key,
 strftime(make_timestamp(cast(round(ts * 1e6) as bigint)), '%Y-%m-%dT%H:%M:%S.%f') as seen_at from keyed"""))
def _flow_text(spark, sf):
    keyed = fl.with_flow_key(t.packets(spark, sf))
    return keyed.select(
        "packet_id", S.endpoint_text().alias("endpoints"), S.key_text().alias("flow_key"),
        S.iso_time("ts").alias("seen_at"),
    )
