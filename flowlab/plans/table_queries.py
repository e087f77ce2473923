"""Queries over the flow table: loaders, cleaning, sampling, profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlab.operators import cleaning as C
from flowlab.operators import profiling as P
from flowlab.operators import sampling, scale
from flowlab.plans.packet_queries import KEYED, rounded, sequenced
from flowlab.plans.registry import query, with_views
from flowlab.schema import CIC_COLUMNS, FLOW_FEATURES, HARD_CAPS, ISCX_COLUMNS, UNSW_COLUMNS
from flowlab.sources import datasets, tables as t

RAW = [
    "fwd_packet_count", "bwd_packet_count", "total_fwd_bytes", "total_bwd_bytes",
    "flow_duration", "flow_bytes_per_sec",
]
NUMERIC = [*RAW, "fwd_bwd_byte_ratio", "fwd_bwd_pkt_ratio"]

# --- SQL building blocks ------------------------------------------------------

MAPPED_LABEL = """case when label is null or trim(label) in ('', 'nan') then 'Normal'
  when contains(label, 'Web Attack') then 'Web Attack'
  when trim(label) = 'BENIGN' then 'Normal'
  when trim(label) in ('DoS Hulk', 'DDoS') then 'DoS'
  when trim(label) in ('FTP-Patator') then 'Brute Force'
  when trim(label) in ('Bot', 'PortScan') then 'Reconnaissance' else trim(label) end"""
BYTE_RATIO = "total_fwd_bytes / case when total_bwd_bytes = 0 then 1 else total_bwd_bytes end"
PKT_RATIO = (
    "cast(fwd_packet_count as double) / case when bwd_packet_count = 0 then 1 else bwd_packet_count end"
)
FINITE_RATE = "case when isinf(flow_bytes_per_sec) then null else flow_bytes_per_sec end"
LABELED = (
    "cic_labeled",
    f"""select row_id, fwd_packet_count, bwd_packet_count, total_fwd_bytes, total_bwd_bytes, flow_duration,
 {FINITE_RATE} as flow_bytes_per_sec, {BYTE_RATIO} as fwd_bwd_byte_ratio,
 {PKT_RATIO} as fwd_bwd_pkt_ratio, {MAPPED_LABEL} as label from cic_raw""",
)


def labeled_sql(then, *steps):
    return with_views("cic_raw", LABELED, *steps, then=then)


def raw_sql(then):
    return with_views("cic_raw", then=then)


def cic_labeled(spark, sf):
    df = C.derive_ratios(t.cic_raw(spark, sf))
    df = C.clean_label(C.map_labels(df.withColumn("label", F.trim("label"))))
    return C.inf_to_null(df, ["flow_bytes_per_sec"])


def union_sql(template, cols=NUMERIC, source="cic_labeled"):
    """One ``select`` per feature, united."""
    return " union all ".join(
        "select '" + c + "' as feature, " + template.replace("{c}", c) + f" from {source}" for c in cols
    )


def features_sql(known: dict[str, str], table: str, digits=6):
    fields = ", ".join(
        f"round(cast({known[f]} as double), {digits}) as {f}" if f in known else f"cast(0 as double) as {f}"
        for f in FLOW_FEATURES
    )
    return f"select row_id, {fields}, label from {table}"


def _raw_names(df, mapping, extra=()):
    back = {canonical: raw for raw, canonical in mapping.items()}
    return df.select("row_id", *[F.col(c).alias(back[c]) for c in (*RAW, "label")], *extra)


# --- loaders --------------------------------------------------------------------

@query("load_unsw", with_views("cic_raw", ("u", """select *, case when label is null or trim(label) = '' then 'Normal' else trim(label) end as clean from cic_raw"""),
    ("v", "select * exclude (label), clean as label from u"),
    then=features_sql({
        "fwd_packet_count": "fwd_packet_count", "bwd_packet_count": "bwd_packet_count",
        "total_fwd_bytes": "total_fwd_bytes", "total_bwd_bytes": "total_bwd_bytes",
        "flow_duration": "flow_duration",
        "flow_bytes_per_sec": "flow_bytes_per_sec",
        "fwd_bwd_byte_ratio": BYTE_RATIO, "fwd_bwd_pkt_ratio": PKT_RATIO,
        "flow_pkts_per_sec": "(fwd_packet_count + bwd_packet_count) / case when flow_duration = 0 then 1e-6 else flow_duration end",
    }, "v")))
def _load_unsw(spark, sf):
    raw = _raw_names(t.cic_raw(spark, sf), UNSW_COLUMNS).withColumn("label", F.lit(1))
    return rounded(datasets.load_unsw(raw, keep=["row_id"]))


@query("load_iscx", raw_sql(features_sql({c: c for c in RAW}, "cic_raw")))
def _load_iscx(spark, sf):
    df = _raw_names(t.cic_raw(spark, sf), ISCX_COLUMNS | {"Traffic Class": "label"})
    stray = df.toDF(*[f" {c.replace('_', ' ').title()} " if c != "row_id" else c for c in df.columns])
    return rounded(datasets.load_iscx(stray, keep=["row_id"]))


CIC_FEATURES = {c: c for c in RAW} | {
    "fwd_bwd_byte_ratio": BYTE_RATIO,
    "fwd_bwd_pkt_ratio": PKT_RATIO,
    "header_ratio": "least((fwd_packet_count + bwd_packet_count) * 40 / greatest(total_fwd_bytes + total_bwd_bytes, 1), 1)",
    "payload_ratio": "1 - least((fwd_packet_count + bwd_packet_count) * 40 / greatest(total_fwd_bytes + total_bwd_bytes, 1), 1)",
    "active_mean": "flow_duration * 0.7",
    "idle_mean": "flow_duration * 0.3",
}


@query("load_cic", with_views("cic_raw", ("v", f"select * exclude (label), {MAPPED_LABEL} as label from cic_raw"),
    then=features_sql(CIC_FEATURES, "v")))
def _load_cic(spark, sf):
    df = _raw_names(t.cic_raw(spark, sf), CIC_COLUMNS)
    stray = df.toDF(*[f" {c}" if c != "row_id" else c for c in df.columns])
    return rounded(datasets.load_cic(stray, keep=["row_id"]))


@query("union_by_name", raw_sql("""
select row_id, fwd_packet_count, case when row_id % 2 = 0 then total_fwd_bytes end as total_fwd_bytes from cic_raw"""))
def _union(spark, sf):
    raw = t.cic_raw(spark, sf)
    even = raw.where("row_id % 2 = 0").select("row_id", "fwd_packet_count", "total_fwd_bytes")
    odd = raw.where("row_id % 2 <> 0").select("fwd_packet_count", "row_id")
    return C.union_all([even, odd])


@query("ensure_and_project", raw_sql("""
select row_id, fwd_packet_count, cast(0 as double) as iat_mean, cast(0 as double) as idle_mean, label from cic_raw"""))
def _ensure(spark, sf):
    names = ["fwd_packet_count", "iat_mean", "idle_mean"]
    return C.project_flow(C.ensure_features(t.cic_raw(spark, sf), names), names, keep=["row_id"])


@query("normalize_and_find_label", raw_sql("select row_id, label, label as traffic_category from cic_raw"))
def _normalize(spark, sf):
    raw = t.cic_raw(spark, sf).select("row_id", F.col("label").alias(" Traffic Category "))
    return C.find_label(C.normalize_columns(raw))


# --- labels -----------------------------------------------------------------------

@query("clean_label", raw_sql("""
select row_id, case when label is null or trim(label) in ('', 'nan') then 'Normal' else trim(label) end as label from cic_raw"""))
def _clean_label(spark, sf):
    return C.clean_label(t.cic_raw(spark, sf)).select("row_id", "label")


@query("map_labels", labeled_sql("select row_id, label from cic_labeled"))
def _map_labels(spark, sf):
    return cic_labeled(spark, sf).select("row_id", "label")


@query("drop_unlabeled", raw_sql("select row_id, label from cic_raw where label is not null"))
def _drop_unlabeled(spark, sf):
    return C.drop_unlabeled(t.cic_raw(spark, sf)).select("row_id", "label")


@query("drop_classes", labeled_sql("select row_id, label from cic_labeled where label <> 'Infiltration'"))
def _drop_classes(spark, sf):
    return C.drop_classes(cic_labeled(spark, sf), ["Infiltration"]).select("row_id", "label")


@query("drop_classes_by_table", labeled_sql("""
select row_id, label from cic_labeled where label not in (select label from cic_labeled group by label having count(*) > 5000)"""))
def _drop_by_table(spark, sf):
    df = cic_labeled(spark, sf).select("row_id", "label")
    frequent = df.groupBy("label").count().where("count > 5000")
    return C.drop_classes(df, frequent)


@query("min_support", labeled_sql("""
select row_id, label from cic_labeled where label in (select label from cic_labeled group by label having count(*) >= 660)"""))
def _min_support(spark, sf):
    return C.min_support(cic_labeled(spark, sf).select("row_id", "label"), 660)


# --- numbers ------------------------------------------------------------------------

@query("coerce_numbers", raw_sql("""
select row_id, case when row_id % 10 = 3 then cast(0 as double) else flow_duration end as flow_duration from cic_raw"""))
def _coerce(spark, sf):
    text = t.cic_raw(spark, sf).select(
        "row_id",
        F.when(F.col("row_id") % 10 == 3, "n/a").otherwise(F.col("flow_duration").cast("string")).alias("flow_duration"),
    )
    return C.coerce(text, ["flow_duration"])


@query("inf_to_null", raw_sql(f"select row_id, round({FINITE_RATE}, 6) as flow_bytes_per_sec from cic_raw"))
def _inf(spark, sf):
    df = C.inf_to_null(t.cic_raw(spark, sf), ["flow_bytes_per_sec"])
    return rounded(df.select("row_id", "flow_bytes_per_sec"))


@query("finite_or_zero", raw_sql(f"select row_id, round(coalesce({FINITE_RATE}, 0), 6) as flow_bytes_per_sec from cic_raw"))
def _finite_or_zero(spark, sf):
    df = C.finite_or_zero(t.cic_raw(spark, sf), ["flow_bytes_per_sec"])
    return rounded(df.select("row_id", "flow_bytes_per_sec"))


@query("clip_lower", raw_sql("select row_id, greatest(total_fwd_bytes - 100000, 0) as total_fwd_bytes from cic_raw"))
def _clip_lower(spark, sf):
    df = t.cic_raw(spark, sf).select("row_id", (F.col("total_fwd_bytes") - 100000).alias("total_fwd_bytes"))
    return C.clip_lower(df, ["total_fwd_bytes"])


@query("hard_caps", raw_sql("""
select row_id, cast(least(fwd_packet_count, 10000) as double) as fwd_packet_count, least(flow_duration, 100) as flow_duration,
 round(least(flow_bytes_per_sec, 125000), 6) as flow_bytes_per_sec,
 least(total_fwd_bytes, 100000000) as total_fwd_bytes from cic_raw"""))
def _hard_caps(spark, sf):
    df = C.hard_caps(t.cic_raw(spark, sf), HARD_CAPS)
    return rounded(df.select("row_id", "fwd_packet_count", "flow_duration", "flow_bytes_per_sec", "total_fwd_bytes"))


@query("micros_to_seconds", raw_sql("""
select row_id, round(least(flow_duration / 1e6, 100), 6) as flow_duration,
 round(least(flow_duration, 100) / 1e6, 9) as legacy_duration from cic_raw"""))
def _micros(spark, sf):
    raw = t.cic_raw(spark, sf).select("row_id", "flow_duration", F.col("flow_duration").alias("legacy_duration"))
    df = C.micros_to_seconds(raw)
    df = C.micros_to_seconds(df, "legacy_duration", legacy=True)
    return df.select("row_id", F.round("flow_duration", 6).alias("flow_duration"),
                     F.round("legacy_duration", 9).alias("legacy_duration"))


@query("percentile_clip", labeled_sql("""
select row_id,
 round(least(coalesce(flow_bytes_per_sec, 0), (select quantile_cont(flow_bytes_per_sec, 0.95) from cic_labeled)), 6) as flow_bytes_per_sec,
 round(least(total_fwd_bytes, (select quantile_cont(total_fwd_bytes, 0.95) from cic_labeled)), 6) as total_fwd_bytes
 from cic_labeled"""))
def _percentile_clip(spark, sf):
    df = C.percentile_clip(cic_labeled(spark, sf), ["flow_bytes_per_sec", "total_fwd_bytes"])
    return rounded(df.select("row_id", "flow_bytes_per_sec", "total_fwd_bytes"))


@query("log1p_features", raw_sql("""
select row_id, round(ln(1 + fwd_packet_count), 6) as fwd_packet_count, round(ln(1 + total_bwd_bytes), 6) as total_bwd_bytes from cic_raw"""))
def _log1p(spark, sf):
    df = C.log1p_features(t.cic_raw(spark, sf))
    return rounded(df.select("row_id", "fwd_packet_count", "total_bwd_bytes"))


@query("repair_iat", raw_sql("""
select row_id, greatest(m, 0) as iat_min, greatest(m + 1, 0) as fwd_iat_min, greatest(m - 1, 0) as bwd_iat_min,
 (m - 1) * 0.5 as bwd_iat_std from (select row_id, flow_duration / 1000000 - 70 as m from cic_raw)"""))
def _repair(spark, sf):
    m = F.col("flow_duration") / 1000000 - 70
    df = t.cic_raw(spark, sf).select(
        "row_id", m.alias("iat_mean"), (m + 1).alias("fwd_iat_mean"), (m - 1).alias("bwd_iat_mean")
    )
    return C.repair_iat(df).select("row_id", "iat_min", "fwd_iat_min", "bwd_iat_min", "bwd_iat_std")


@query("derive_ratios", raw_sql(f"""
select row_id, round({BYTE_RATIO}, 6) as fwd_bwd_byte_ratio, round({PKT_RATIO}, 6) as fwd_bwd_pkt_ratio from cic_raw"""))
def _ratios(spark, sf):
    df = C.derive_ratios(t.cic_raw(spark, sf))
    return rounded(df.select("row_id", "fwd_bwd_byte_ratio", "fwd_bwd_pkt_ratio"))


@query("estimate_header_and_activity", raw_sql(f"""
select row_id, round({CIC_FEATURES['header_ratio']}, 8) as header_ratio, round({CIC_FEATURES['payload_ratio']}, 8) as payload_ratio,
 round(flow_duration * 0.7, 6) as active_mean, round(flow_duration * 0.3, 6) as idle_mean from cic_raw"""))
def _estimate(spark, sf):
    df = C.estimate_active_idle(C.estimate_header(t.cic_raw(spark, sf)))
    return df.select(
        "row_id", F.round("header_ratio", 8).alias("header_ratio"), F.round("payload_ratio", 8).alias("payload_ratio"),
        F.round("active_mean", 6).alias("active_mean"), F.round("idle_mean", 6).alias("idle_mean"),
    )


# --- samples, shuffles, splits ---------------------------------------------------------

HASHED = ("hashed", "select *, md5(concat('42:', cast(row_id as varchar))) as h from cic_labeled")


@query("sample_per_class", labeled_sql("""
select row_id, label from (select *, row_number() over (partition by label order by h, row_id) as rn from hashed) where rn <= 650""", HASHED))
def _sample_per_class(spark, sf):
    return sampling.sample_per_class(cic_labeled(spark, sf).select("row_id", "label"), 650)


@query("shuffle_positions", labeled_sql("""
select row_id, row_number() over (order by h, row_id) as position from hashed""", HASHED))
def _shuffle_positions(spark, sf):
    return scale.number_by_hash(
        cic_labeled(spark, sf).select("row_id"), ["row_id"], 42, out="position"
    )


@query("shuffle", labeled_sql("select row_id, label from hashed order by h, row_id", HASHED))
def _shuffle(spark, sf):
    return sampling.shuffle(cic_labeled(spark, sf).select("row_id", "label"))


@query("bounded_sample", labeled_sql("select row_id, label from hashed order by h, row_id limit 1000", HASHED))
def _bounded_sample(spark, sf):
    return sampling.bounded_sample(cic_labeled(spark, sf).select("row_id", "label"), 1000)


SPLIT = (
    "split_table",
    """select *, case when rn <= floor(total * 0.2 + 0.5) then 'test'
  when rn <= floor(total * 0.2 + 0.5) + floor((total - floor(total * 0.2 + 0.5)) * 0.125 + 0.5) then 'val'
  else 'train' end as split
 from (select *, row_number() over (partition by label order by h, row_id) as rn,
  count(*) over (partition by label) as total from hashed)""",
)


@query("stratified_split", labeled_sql("select row_id, label, split from split_table", HASHED, SPLIT))
def _split(spark, sf):
    return sampling.stratified_split(cic_labeled(spark, sf).select("row_id", "label"))


@query("stratified_folds", labeled_sql("""
select row_id, label, cast((row_number() over (partition by label order by h, row_id) - 1) % 5 as integer) as fold from hashed""", HASHED))
def _folds(spark, sf):
    return sampling.stratified_folds(cic_labeled(spark, sf).select("row_id", "label"))


# --- profiling ------------------------------------------------------------------------------

@query("class_counts", labeled_sql("select label, count(*) as n from cic_labeled group by label"))
def _class_counts(spark, sf):
    return P.class_counts(cic_labeled(spark, sf))


@query("class_share", labeled_sql("""
select label, count(*) as n, round(count(*) / (sum(count(*)) over ()), 9) as share from cic_labeled group by label"""))
def _class_share(spark, sf):
    return rounded(P.class_share(cic_labeled(spark, sf)), 9)


@query("class_list", labeled_sql("""
select label, cast(row_number() over (order by label) - 1 as integer) as code from (select distinct label from cic_labeled)"""))
def _class_list(spark, sf):
    return P.class_list(cic_labeled(spark, sf))


@query("zero_features", labeled_sql(f"""
select feature from ({union_sql('max(case when {c} <> 0 then 1 end) as used', [*NUMERIC, 'row_id - row_id'])})
 where used is null""").replace("'row_id - row_id' as feature", "'idle_mean' as feature"))
def _zero_features(spark, sf):
    df = cic_labeled(spark, sf).withColumn("idle_mean", F.lit(0.0))
    return P.zero_features(df, [*NUMERIC, "idle_mean"])


@query("describe", labeled_sql(union_sql("""count({c}) as n, round(avg({c}), 4) as mean, round(stddev_samp({c}), 4) as std,
 cast(min({c}) as double) as min, cast(max({c}) as double) as max, round(quantile_cont({c}, 0.25), 4) as p25,
 round(quantile_cont({c}, 0.5), 4) as p50, round(quantile_cont({c}, 0.75), 4) as p75""")))
def _describe(spark, sf):
    return rounded(P.describe(cic_labeled(spark, sf), NUMERIC), 4, skip=("min", "max"))


@query("low_variance", labeled_sql(f"""
select feature, round(std, 4) as std from ({union_sql('stddev_pop({c}) as std')}) where std < 100"""))
def _low_variance(spark, sf):
    return rounded(P.low_variance(cic_labeled(spark, sf), NUMERIC, 100.0), 4)


@query("range_check", labeled_sql(f"""
select feature, min, max, round(mean, 4) as mean, min < -10 as far_below, (max > 20 or min < -5) as out_of_range from (
 {union_sql('cast(min({c}) as double) as min, cast(max({c}) as double) as max, avg({c}) as mean')})"""))
def _range_check(spark, sf):
    return rounded(P.range_check(cic_labeled(spark, sf), NUMERIC), 4, skip=("min", "max"))


@query("overall_range", labeled_sql(f"""
select min(lo) as min, max(hi) as max, round(sum(s) / sum(n), 4) as mean from (
 {union_sql('cast(min({c}) as double) as lo, cast(max({c}) as double) as hi, cast(sum({c}) as double) as s, count({c}) as n')})"""))
def _overall_range(spark, sf):
    return rounded(P.overall_range(cic_labeled(spark, sf), NUMERIC), 4, skip=("min", "max"))


@query("class_means", labeled_sql(
    "select label, " + ", ".join(f"round(avg({c}), 2) as {c}" for c in NUMERIC) + " from cic_labeled group by label"))
def _class_means(spark, sf):
    return P.class_means(cic_labeled(spark, sf), NUMERIC)


@query("feature_variability", labeled_sql(union_sql("round(stddev_samp({c}), 4) as std, count(distinct {c}) as n_distinct")))
def _variability(spark, sf):
    return rounded(P.feature_variability(cic_labeled(spark, sf), NUMERIC), 4)


@query("correlations", labeled_sql(" union all ".join(
    f"select '{a}' as feature_a, '{b}' as feature_b, round(corr({a}, {b}), 6) as corr from cic_labeled"
    for a in NUMERIC for b in NUMERIC)))
def _correlations(spark, sf):
    return rounded(P.correlations(cic_labeled(spark, sf), NUMERIC))


def _histogram_sql(value):
    return labeled_sql("""
select label, bin, round(lo + bin * step, 6) as bin_start, round(lo + (bin + 1) * step, 6) as bin_end, count(*) as n
 from (select label, lo, step, cast(least(floor((v - lo) / step), 29) as integer) as bin
  from (select label, v, lo, (hi - lo) / 30 as step from
   (select label, v, min(v) over (partition by label) as lo, max(v) over (partition by label) as hi from vals)))
 group by label, bin, lo, step""", ("vals", f"select label, {value} as v from cic_labeled where {value} is not null"))


@query("histogram", _histogram_sql("total_fwd_bytes"))
def _histogram(spark, sf):
    return rounded(P.histogram(cic_labeled(spark, sf), "total_fwd_bytes"))


@query("histogram_log", _histogram_sql("ln(1 + flow_duration)"))
def _histogram_log(spark, sf):
    return rounded(P.histogram(cic_labeled(spark, sf), F.log(1 + F.col("flow_duration"))))


@query("box_stats", labeled_sql("""
select label, round(q1, 6) as q1, round(median, 6) as median, round(q3, 6) as q3, count(v) as n,
 round(least(coalesce(min(case when inside then v end), q1), q1), 6) as whisker_low,
 round(greatest(coalesce(max(case when inside then v end), q3), q3), 6) as whisker_high,
 count(case when not inside then v end) as n_outliers
from (select *, v >= q1 - 1.5 * (q3 - q1) and v <= q3 + 1.5 * (q3 - q1) as inside from
 (select c.label, c.flow_bytes_per_sec as v, q1, median, q3 from cic_labeled c join quart using (label)))
group by label, q1, median, q3""", ("quart", """select label, quantile_cont(flow_bytes_per_sec, 0.25) as q1,
 quantile_cont(flow_bytes_per_sec, 0.5) as median, quantile_cont(flow_bytes_per_sec, 0.75) as q3 from cic_labeled group by label""")))
def _box_stats(spark, sf):
    return rounded(P.box_stats(cic_labeled(spark, sf), "flow_bytes_per_sec"))


@query("cluster_profiles", "select label as cluster, " + ", ".join(
    f"round(avg(cast(embedding[{i}] as double)), 4) as x{i}" for i in range(1, 9)) + " from embeddings group by label")
def _cluster_profiles(spark, sf):
    df = t.embeddings(spark, sf).select(
        F.col("label").alias("cluster"),
        *[F.element_at("embedding", i).cast("double").alias(f"x{i}") for i in range(1, 9)],
    )
    return P.cluster_profiles(df, "cluster", [f"x{i}" for i in range(1, 9)])


@query("live_totals", with_views("packets", KEYED, *sequenced(5.0, True), ("flows", """
select a_ip, b_ip, a_port, b_port, protocol, flow_seq, count(*) as n_packets,
 case protocol when 6 then 'tcp' when 17 then 'udp' end as predicted_class from described
 group by a_ip, b_ip, a_port, b_port, protocol, flow_seq having count(*) >= 5"""), then="""
select 'packets' as metric, cast(sum(n_packets) as bigint) as value from flows
union all select 'flows', count(*) from flows union all select 'classified', count(predicted_class) from flows
union all select 'errors', count(*) - count(predicted_class) from flows
union all select concat('class:', predicted_class), count(*) from flows where predicted_class is not null group by predicted_class"""))
def _live_totals(spark, sf):
    from flowlab.operators import flows as fl

    flows = fl.flow_features(t.packets(spark, sf), 5.0, True)
    return P.live_totals(flows.withColumn(
        "predicted_class", F.when(F.col("protocol") == 6, "tcp").when(F.col("protocol") == 17, "udp")
    ))
