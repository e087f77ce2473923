"""Queries for fitted preprocessing, evaluation and decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlab.operators import metrics as M
from flowlab.operators import preparing as R
from flowlab.plans.packet_queries import rounded
from flowlab.plans.registry import query, with_views
from flowlab.plans.table_queries import HASHED, LABELED, NUMERIC, SPLIT, cic_labeled
from flowlab.sources import tables as t

CLASSES = ["Brute Force", "DoS", "Infiltration", "Normal", "Reconnaissance", "Web Attack"]

# --- estimators -------------------------------------------------------------------

def _quantile(c, p, where="split = 'train'"):
    return f"(select quantile_cont({c}, {p}) from split_table where {where})"


def labeled_sql(then, *steps):
    return with_views("cic_raw", LABELED, *steps, then=then)


@query("impute_median", labeled_sql("""
select row_id, round(coalesce(flow_bytes_per_sec, (select quantile_cont(flow_bytes_per_sec, 0.5) from cic_labeled)), 6) as flow_bytes_per_sec from cic_labeled"""))
def _impute(spark, sf):
    df = cic_labeled(spark, sf)
    params = R.fit_params(df, ["flow_bytes_per_sec"], "median")
    return rounded(R.apply_params(df, params).select("row_id", "flow_bytes_per_sec"))


def _scaled_sql(center, spread):
    return labeled_sql("select row_id, " + ", ".join(
        f"round(({c} - {center.format(c=c)}) / coalesce(nullif({spread.format(c=c)}, 0), 1), 6) as {c}" for c in NUMERIC
    ) + " from cic_labeled, fitted", ("fitted", "select " + ", ".join(
        f"quantile_cont({c}, 0.5) as {c}_mid, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) as {c}_iqr, "
        f"avg({c}) as {c}_avg, stddev_pop({c}) as {c}_sd" for c in NUMERIC) + " from cic_labeled"))


@query("robust_scale", _scaled_sql("{c}_mid", "{c}_iqr"))
def _robust(spark, sf):
    df = cic_labeled(spark, sf)
    params = R.fit_params(df, NUMERIC, "robust")
    return rounded(R.apply_params(df, params).select("row_id", *NUMERIC))


@query("standard_scale", _scaled_sql("{c}_avg", "{c}_sd"))
def _standard(spark, sf):
    df = cic_labeled(spark, sf)
    params = R.fit_params(df, NUMERIC, "standard")
    return rounded(R.apply_params(df, params).select("row_id", *NUMERIC))


@query("fitted_parameters", labeled_sql(" union all ".join(
    f"select '{c}' as feature, cast(null as double) as fill, round(quantile_cont({c}, 0.5), 6) as center, "
    f"round(coalesce(nullif(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25), 0), 1), 6) as scale from cic_labeled"
    for c in NUMERIC)))
def _fitted(spark, sf):
    params = R.fit_params(cic_labeled(spark, sf), NUMERIC, "robust")
    return rounded(R.params_table(spark, params, NUMERIC))


CODED = ("coded", "select label, cast(row_number() over (order by label) - 1 as integer) as label_idx from (select distinct label from cic_labeled)")


@query("encode_labels", labeled_sql("select row_id, label, label_idx from cic_labeled join coded using (label)", CODED))
def _encode(spark, sf):
    return R.encode_labels(cic_labeled(spark, sf).select("row_id", "label"))


@query("decode_labels", labeled_sql("""
select row_id, coalesce(coded.label, cast(row_id % 8 as varchar)) as label from cic_labeled left join coded on row_id % 8 = label_idx""", CODED))
def _decode(spark, sf):
    df = cic_labeled(spark, sf).select("row_id", (F.col("row_id") % 8).cast("int").alias("label_idx"))
    return R.decode_labels(df, CLASSES).select("row_id", "label")


@query("class_weights", labeled_sql("""
select label, count(*) as n, round(sum(count(*)) over () / ((count(*) over ()) * count(*)), 6) as weight from cic_labeled group by label"""))
def _weights(spark, sf):
    return rounded(R.class_weights(cic_labeled(spark, sf)))


@query("attach_weights", labeled_sql("""
select row_id, label, round(w, 6) as weight from cic_labeled join
 (select label, sum(count(*)) over () / ((count(*) over ()) * count(*)) as w from cic_labeled group by label) using (label)"""))
def _attach(spark, sf):
    return rounded(R.attach_weights(cic_labeled(spark, sf).select("row_id", "label")))


def _plain_sql():
    filled = ("filled", "select row_id, label, split, " + ", ".join(
        f"coalesce({c}, {_quantile(c, 0.5)}) as {c}" for c in NUMERIC) + " from split_table")
    fitted = ("fitted", "select " + ", ".join(
        f"quantile_cont({c}, 0.5) as {c}_mid, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) as {c}_iqr" for c in NUMERIC)
        + " from filled where split = 'train'")
    fields = ", ".join(f"round(({c} - {c}_mid) / coalesce(nullif({c}_iqr, 0), 1), 6) as {c}" for c in NUMERIC)
    return labeled_sql(f"select row_id, label, label_idx, split, {fields} from filled join coded using (label), fitted",
                       HASHED, SPLIT, CODED, filled, fitted)


@query("preprocess", _plain_sql())
def _preprocess(spark, sf):
    """Fill, drop infinities, impute, encode, split 70/10/20, scale."""
    _, df = R.fit_preprocessor(cic_labeled(spark, sf), NUMERIC)
    return rounded(df.select("row_id", "label", "label_idx", "split", *NUMERIC))


@query("transform_new_data", _plain_sql().replace("label_idx, split,", "label_idx,"))
def _transform(spark, sf):
    """Fitted state, through its JSON form, on raw rows."""
    model, _ = R.fit_preprocessor(cic_labeled(spark, sf), NUMERIC)
    again = R.Preprocessor.from_json(model.to_json())
    df = R.transform(cic_labeled(spark, sf), again)
    return rounded(df.select("row_id", "label", "label_idx", *NUMERIC))


CIC_PROFILE = ["fwd_packet_count", "bwd_packet_count", "total_fwd_bytes", "total_bwd_bytes",
               "flow_duration", "flow_bytes_per_sec", "fwd_bwd_byte_ratio"]
CAP = {"fwd_packet_count": "10000", "bwd_packet_count": "10000", "total_fwd_bytes": "100000000",
       "total_bwd_bytes": "100000000", "flow_bytes_per_sec": "125000", "fwd_bwd_byte_ratio": "1000"}


def _cic_sql():
    source = ("source", f"""select row_id, label, least(flow_duration / 1e6, 100) as flow_duration, {', '.join(
        f'least(coalesce({c}, 0), {cap}) as {c}' for c, cap in CAP.items())} from cic_labeled""")
    bounds = ("bounds", "select " + ", ".join(f"quantile_cont({c}, 0.95) as {c}_p95" for c in CIC_PROFILE) + " from source")
    logged = ("logged", "select row_id, label, " + ", ".join(
        (f"least({c}, {c}_p95) as {c}" if c == "flow_duration" else f"ln(1 + least({c}, {c}_p95)) as {c}") for c in CIC_PROFILE)
        + " from source, bounds")
    hashed = ("hashed", "select *, md5(concat('42:', cast(row_id as varchar))) as h from logged")
    fitted = ("fitted", "select " + ", ".join(
        f"quantile_cont({c}, 0.5) as {c}_mid, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) as {c}_iqr" for c in CIC_PROFILE)
        + " from split_table where split = 'train'")
    kept = ("kept", "select label, cast(row_number() over (order by label) - 1 as integer) as label_idx from (select distinct label from cic_labeled where label <> 'Infiltration')")
    fields = ", ".join(f"round(({c} - {c}_mid) / coalesce(nullif({c}_iqr, 0), 1), 5) as {c}" for c in CIC_PROFILE)
    return labeled_sql(f"select row_id, label, label_idx, split, {fields} from split_table join kept using (label), fitted",
                       source, bounds, logged, hashed, SPLIT, fitted, kept)


@query("preprocess_cic_profile", _cic_sql())
def _preprocess_cic(spark, sf):
    """Caps, unit conversion, p95, log1p, impute, encode, split, scale, class drop."""
    _, df = R.fit_preprocessor(cic_labeled(spark, sf), CIC_PROFILE, profile="cic")
    return rounded(df.select("row_id", "label", "label_idx", "split", *CIC_PROFILE), 5)


LIVE = ["fwd_packet_count", "bwd_packet_count", "total_fwd_bytes", "flow_bytes_per_sec"]


def _live_sql():
    source = ("source", "select row_id, label, " + ", ".join(
        f"ln(1 + least(coalesce({c}, 0), {CAP[c]})) as {c}" for c in LIVE) + " from cic_labeled")
    hashed = ("hashed", "select *, md5(concat('42:', cast(row_id as varchar))) as h from source")
    fitted = ("fitted", "select " + ", ".join(
        f"quantile_cont({c}, 0.5) as {c}_mid, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) as {c}_iqr" for c in LIVE)
        + " from split_table where split = 'train'")
    fields = ", ".join(f"round(({c} - {c}_mid) / coalesce(nullif({c}_iqr, 0), 1), 5) as {c}" for c in LIVE)
    return labeled_sql(f"select row_id, {fields} from source, fitted", source, hashed, SPLIT, fitted)


@query("preprocess_live_profile", _live_sql())
def _preprocess_live(spark, sf):
    """The scoring-time path: caps, log1p, non-finite to zero, scale."""
    model, _ = R.fit_preprocessor(cic_labeled(spark, sf), LIVE, profile="live")
    df = R.transform(cic_labeled(spark, sf).drop("label"), model)
    return rounded(df.select("row_id", *LIVE), 5)


# --- evaluation ------------------------------------------------------------------------

PER_CLASS = (
    "per_class",
    """select c, sum(sup) as sup, sum(pre) as pre, sum(hit) as hit,
  case when sum(pre) = 0 then 0 else sum(hit) / sum(pre) end as p, case when sum(sup) = 0 then 0 else sum(hit) / sum(sup) end as r,
  case when sum(sup) + sum(pre) = 0 then 0 else 2 * sum(hit) / (sum(sup) + sum(pre)) end as f
 from (select y_true as c, 1 as sup, 0 as pre, cast(y_true = y_pred as integer) as hit from predictions
  union all select y_pred, 0, 1, 0 from predictions) group by c""",
)
SUMMARY = "sum(hit) / sum(sup) as acc, sum(p * sup) / sum(sup) as wp, sum(r * sup) / sum(sup) as wr, sum(f * sup) / sum(sup) as wf, avg(p) as mp, avg(r) as mr, avg(f) as mf, cast(sum(sup) as bigint) as n"


def pred_sql(then, *steps):
    return with_views("predictions", *steps, then=then)


@query("weighted_metrics", pred_sql(f"""
select round(acc, 9) as accuracy, round(wf, 9) as f1_weighted, round(wp, 9) as precision_weighted, round(wr, 9) as recall_weighted
 from (select {SUMMARY} from per_class)""", PER_CLASS))
def _weighted(spark, sf):
    return rounded(M.weighted_metrics(t.predictions(spark, sf)), 9)


@query("class_report", pred_sql(f"""
select cast(c as varchar) as name, round(p, 9) as precision, round(r, 9) as recall, round(f, 9) as f1, cast(sup as bigint) as support from per_class
union all select 'accuracy', round(acc, 9), round(acc, 9), round(acc, 9), n from (select {SUMMARY} from per_class)
union all select 'macro avg', round(mp, 9), round(mr, 9), round(mf, 9), n from (select {SUMMARY} from per_class)
union all select 'weighted avg', round(wp, 9), round(wr, 9), round(wf, 9), n from (select {SUMMARY} from per_class)""", PER_CLASS))
def _report(spark, sf):
    return rounded(M.class_report(t.predictions(spark, sf)), 9)


@query("confusion_matrix", pred_sql("""
select y_true, count(case when y_pred = 0 then 1 end) as pred_0, count(case when y_pred = 1 then 1 end) as pred_1,
 count(case when y_pred = 2 then 1 end) as pred_2, count(case when y_pred = 3 then 1 end) as pred_3 from predictions group by y_true"""))
def _confusion(spark, sf):
    return M.confusion(t.predictions(spark, sf), [0, 1, 2, 3])


@query("class_accuracy", pred_sql("""
select y_true, count(case when y_true = y_pred then 1 end) as correct, count(*) as total,
 round(count(case when y_true = y_pred then 1 end) / count(*), 9) as accuracy from predictions group by y_true"""))
def _class_accuracy(spark, sf):
    return rounded(M.class_accuracy(t.predictions(spark, sf)), 9)


MODEL_ROWS = ("models", """select 'a' as model, y_true, y_pred from predictions
 union all select 'b', y_true, cast(case when row_id % 2 = 0 then y_true else 1 end as integer) from predictions""")


@query("compare_models", pred_sql("""
select model, round(acc, 9) as accuracy, round(f1, 9) as f1_weighted, row_number() over (order by f1 desc, model desc) = 1 as is_best from (
 select model, sum(hit) / sum(sup) as acc, sum(sup * 2 * hit / (sup + pre)) / sum(sup) as f1 from (
  select model, c, cast(sum(sup) as double) as sup, sum(pre) as pre, sum(hit) as hit from (
   select model, y_true as c, 1 as sup, 0 as pre, cast(y_true = y_pred as integer) as hit from models
   union all select model, y_pred, 0, 1, 0 from models) group by model, c) group by model)""", MODEL_ROWS))
def _compare(spark, sf):
    p = t.predictions(spark, sf)
    other = F.when(F.col("row_id") % 2 == 0, F.col("y_true")).otherwise(1).cast("int")
    both = p.select(F.lit("a").alias("model"), "y_true", "y_pred").unionByName(
        p.select(F.lit("b").alias("model"), "y_true", other.alias("y_pred"))
    )
    return rounded(M.compare_models(both), 9)


@query("best_by_metric", pred_sql("""
select min(y_pred) as y_pred, max(m) as m from (select y_pred, round(avg(score), 1) as m from predictions group by y_pred)
 where m = (select max(m) from (select y_pred, round(avg(score), 1) as m from predictions group by y_pred))"""))
def _best(spark, sf):
    sweep = t.predictions(spark, sf).groupBy("y_pred").agg(F.round(F.avg("score"), 1).alias("m"))
    return M.best_by(sweep, "y_pred", "m")


def _auc_sql(classes):
    scores = ", ".join(f"({c}, case when {c} % 2 = 0 then score else 1 - score end)" for c in classes)
    return pred_sql("""
select round(sum(auc * npos) / sum(npos), 9) as roc_auc_ovr from (
 select c, sum(pos) as npos, (sum(case when pos = 1 then rk end) - sum(pos) * (sum(pos) + 1) / 2) / (sum(pos) * sum(1 - pos)) as auc from (
  select c, pos, rank() over (partition by c order by s) + (count(*) over (partition by c, s) - 1) / 2 as rk from (
   select v.c as c, cast(y_true = v.c as integer) as pos, case when v.c % 2 = 0 then score else 1 - score end as s
   from predictions, (values (0), (1), (2), (3)) v(c))) group by c)""")


@query("roc_auc_ovr", _auc_sql([0, 1, 2, 3]))
def _auc(spark, sf):
    p = t.predictions(spark, sf).withColumn("other", 1 - F.col("score"))
    return rounded(M.auc_ovr(p, {0: "score", 1: "other", 2: "score", 3: "other"}), 9)


PROBS = ("probs", """select row_id, [score / 2, (1 - score) / 2, 0.25 + 0.25 * (row_id % 2), 0.25 - 0.25 * (row_id % 2)] as p from predictions""")
ARGMAX = ("decided", """select row_id, list_position(p, list_max(p)) - 1 as class_idx,
 case list_position(p, list_max(p)) - 1 when 0 then 'Normal' when 1 then 'DoS' else cast(list_position(p, list_max(p)) - 1 as varchar) end as predicted_class,
 list_max(p) as confidence from probs""")


def _probabilities(spark, sf):
    odd = F.col("row_id") % 2
    return t.predictions(spark, sf).select(
        "row_id",
        F.array(F.col("score") / 2, (1 - F.col("score")) / 2, 0.25 + 0.25 * odd, 0.25 - 0.25 * odd).alias("p"),
    )


@query("argmax_class", pred_sql("""
select row_id, class_idx, predicted_class, round(confidence, 9) as confidence from decided""", PROBS, ARGMAX))
def _argmax(spark, sf):
    df = M.argmax_class(_probabilities(spark, sf), "p", ["Normal", "DoS"])
    return rounded(df.select("row_id", "class_idx", "predicted_class", "confidence"), 9)


def _threshold_sql():
    return pred_sql("""
select row_id, case when confidence < lim then 'Normal' else predicted_class end as predicted_class,
 round(case when confidence < lim then 1 - confidence else confidence end, 9) as confidence
 from (select *, case predicted_class when 'Normal' then 0.48 when 'DoS' then 0.4 else 0.45 end as lim from decided)""", PROBS, ARGMAX)


@query("apply_thresholds", _threshold_sql())
def _thresholds(spark, sf):
    df = M.argmax_class(_probabilities(spark, sf), "p", ["Normal", "DoS"])
    df = M.apply_thresholds(df, {"Normal": 0.48, "DoS": 0.4}, default=0.45)
    return rounded(df.select("row_id", "predicted_class", "confidence"), 9)


@query("apply_threshold_table", _threshold_sql())
def _threshold_table(spark, sf):
    df = M.argmax_class(_probabilities(spark, sf), "p", ["Normal", "DoS"])
    limits = spark.createDataFrame([("Normal", 0.48), ("DoS", 0.4)], "predicted_class string, threshold double")
    df = M.apply_thresholds(df, limits, default=0.45)
    return rounded(df.select("row_id", "predicted_class", "confidence"), 9)


@query("adjusted_rand", pred_sql("""
select round((s - a * b / t) / ((a + b) / 2 - a * b / t), 9) as adjusted_rand_index from
 (select sum(n * (n - 1) / 2) as s from (select count(*) as n from predictions group by y_true, y_pred)),
 (select sum(n * (n - 1) / 2) as a from (select count(*) as n from predictions group by y_true)),
 (select sum(n * (n - 1) / 2) as b from (select count(*) as n from predictions group by y_pred)),
 (select count(*) * (count(*) - 1) / 2 as t from predictions)"""))
def _ari(spark, sf):
    return rounded(M.adjusted_rand(t.predictions(spark, sf)), 9)


@query("normalized_mutual_information", pred_sql("""
select round(mi / ((ha + hp) / 2), 9) as nmi from
 (select sum(n / t * ln(n * t / (na * np))) as mi from (select cast(n as double) as n, sum(n) over (partition by y_true) as na,
   sum(n) over (partition by y_pred) as np, sum(n) over () as t from (select y_true, y_pred, count(*) as n from predictions group by all))),
 (select -sum(n / t * ln(n / t)) as ha from (select cast(count(*) as double) as n, sum(count(*)) over () as t from predictions group by y_true)),
 (select -sum(n / t * ln(n / t)) as hp from (select cast(count(*) as double) as n, sum(count(*)) over () as t from predictions group by y_pred))"""))
def _nmi(spark, sf):
    return rounded(M.nmi(t.predictions(spark, sf)), 9)
