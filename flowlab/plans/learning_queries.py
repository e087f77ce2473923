"""Queries that train, score and window."""

from __future__ import annotations

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from flowlab.operators import classifying as S
from flowlab.operators import preparing as R
from flowlab.operators import windows as W
from flowlab.plans import training
from flowlab.plans.cluster_queries import wide
from flowlab.plans.model_queries import CODED
from flowlab.plans.packet_queries import rounded
from flowlab.plans.registry import query, with_views
from flowlab.plans.table_queries import LABELED, NUMERIC, cic_labeled
from flowlab.session import checkpoint_dir, cut_lineage, stored
from flowlab.sources import sinks


def labeled_sql(then, *steps):
    return with_views("cic_raw", LABELED, *steps, then=then)


def prepared(spark, sf, **kw):
    return R.fit_preprocessor(cic_labeled(spark, sf), NUMERIC, **kw)


def embedded(spark, sf):
    """Embeddings with class codes, as model input."""
    df = wide(spark, sf).withColumnRenamed("id", "row_id")
    return df.select("row_id", F.col("label").cast("int").alias("label_idx"), "features")


def shared_folder(spark):
    """A new folder beside the checkpoints, on storage every executor sees."""
    return f"{checkpoint_dir(spark).rstrip('/')}/run-{uuid.uuid4().hex}"


# --- windows ----------------------------------------------------------------------

WINDOWED = ("windowed", """select *, (rn - 1) // 20 as window_id from (
 select *, row_number() over (order by row_id) as rn, count(*) over () as total from cic_labeled join coded using (label))
 where (rn - 1) // 20 < total // 20""")
CELLS = ["fwd_packet_count", "total_fwd_bytes"]
WINDOW_FIELDS = """cast(window_id as bigint) as window_id, count(*) as n, cast(min_by(fwd_packet_count, rn) as double) as first_count,
 max_by(total_fwd_bytes, rn) as last_bytes, cast(sum(fwd_packet_count) as double) as sum_count"""


def _window_fields(df):
    m = F.col("matrix")
    return (
        F.size(m).cast("long").alias("n"),
        m[0][0].alias("first_count"),
        F.element_at(m, -1)[1].alias("last_bytes"),
        F.aggregate(m, F.lit(0.0), lambda s, r: s + r[0]).alias("sum_count"),
    )


@query("count_windows", labeled_sql(f"select {WINDOW_FIELDS} from windowed group by window_id", CODED, WINDOWED))
def _count_windows(spark, sf):
    df = W.count_windows(cic_labeled(spark, sf), CELLS)
    return df.select("window_id", *_window_fields(df))


@query("count_windows_bucketed", labeled_sql(f"select {WINDOW_FIELDS} from windowed group by window_id", CODED, WINDOWED))
def _count_windows_bucketed(spark, sf):
    """Numbering over range buckets of about 700 rows."""
    df = W.count_windows(cic_labeled(spark, sf), CELLS, target_rows=700)
    return df.select("window_id", *_window_fields(df))


@query("sorted_windows", labeled_sql(f"select min_by(label, rn) as label, {WINDOW_FIELDS} from windowed group by window_id", CODED,
    ("windowed", WINDOWED[1].replace("order by row_id", "order by label, row_id"))))
def _sorted_windows(spark, sf):
    df = W.sorted_windows(cic_labeled(spark, sf), CELLS, target_rows=700)
    return df.select("window_id", "label", *_window_fields(df))


MAJORITY = """
select cast(window_id as bigint) as window_id, arg_max(label_idx, n * 1000 - label_idx) as label_idx
 from (select window_id, label_idx, count(*) as n from windowed group by all) group by window_id"""


@query("majority_label", labeled_sql(MAJORITY, CODED, WINDOWED))
def _majority(spark, sf):
    return W.majority_label(R.encode_labels(cic_labeled(spark, sf)))


@query("labeled_windows", labeled_sql(MAJORITY, CODED, WINDOWED))
def _labeled_windows(spark, sf):
    df = R.encode_labels(cic_labeled(spark, sf))
    return W.labeled_windows(df, CELLS).select("window_id", "label_idx")


@query("window_classifier")
def _window_classifier(spark, sf):
    _, df = prepared(spark, sf)
    model, metrics = training.run_windows(
        df, NUMERIC, sort_by_label=True, method="mlp", layers=(32, 16), max_iters=(20, 40)
    )
    return metrics


@query("score_single_flow")
def _single_flow(spark, sf):
    model, df = prepared(spark, sf)
    train = W.sorted_windows(df.where("split = 'train'"), NUMERIC, "label_idx")
    window_model = S.window_classifier(train, method="forest", n_trees=10, max_depth=6)
    scored = S.score_single_flow(df.where("split = 'test'"), window_model, model.kept_classes)
    return scored.select("row_id", "predicted_class", "confidence")


@query("reload_window_models", labeled_sql("""select kind, count(*) as n, 0 as moved from cic_labeled
 cross join (select unnest(['forest', 'perceptron']) as kind) group by kind"""))
def _reload_windows(spark, sf):
    """Window models of both kinds score all rows as before they were saved."""
    pre, df = prepared(spark, sf)
    # numbered once for all kinds
    train = stored(W.sorted_windows(df.where("split = 'train'"), NUMERIC, "label_idx"), "windows")
    everything = R.transform(cic_labeled(spark, sf), pre)
    fitted, loaded = {}, {}
    for kind, how in (("forest", dict(method="forest", n_trees=10, max_depth=6)), ("perceptron", dict(layers=(32,), max_iters=(20,)))):
        fitted[kind] = sinks.State(pre, S.window_classifier(train, **how), pre.kept_classes)
        folder = f"{shared_folder(spark)}/state"
        sinks.save_state(spark, fitted[kind], folder)
        loaded[kind] = sinks.load_state(spark, folder)
    # every kind has saved the same preprocessor: rows are transformed and joined once for all
    first = next(iter(loaded.values())).preprocessor
    assert all(state.preprocessor == first for state in loaded.values())
    before = _scored_by(everything, fitted, "_was")
    again = _scored_by(R.transform(cic_labeled(spark, sf), first), loaded, "_is")
    both = before.join(again, "row_id")
    counts = [F.count("*").alias("n")]
    for kind in fitted:
        was, now = F.col(f"{kind}_was"), F.col(f"{kind}_is")
        same = was["predicted_class"].eqNullSafe(now["predicted_class"]) & (F.abs(was["confidence"] - now["confidence"]) < 1e-12)
        counts.append(F.count_if(~same).cast("int").alias(kind))
    rows = both.agg(*counts)
    return rows.select(F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), "n", F.col(k).alias("moved")) for k in fitted])))


def _scored_by(df, states, suffix):
    """``row_id`` and, for every kind of model, class and confidence."""
    for kind, state in states.items():
        kept = [c for c in df.columns if c == "row_id" or c.endswith(suffix)]
        scored = S.score_single_flow(df.withColumn("_flow", F.col("features")), state.model, state.classes)
        df = scored.select(*kept, F.struct("predicted_class", "confidence").alias(f"{kind}{suffix}"), F.col("_flow").alias("features"))
    return df.drop("features")


# --- models ---------------------------------------------------------------------------

@query("random_forest")
def _forest(spark, sf):
    model, df = prepared(spark, sf)
    forest = S.random_forest(df.where("split = 'train'"), n_trees=20, max_depth=8)
    scored = S.score(df.where("split = 'test'"), forest, model.kept_classes)
    return scored.select("row_id", "label", "predicted_class", "confidence")


@query("feature_importance", "select cast(count(*) as bigint) as n, true as named, true as in_range, true as sum_is_one from (select unnest(["
    + ", ".join(f"'{c}'" for c in NUMERIC) + "])) where exists (select 1 from orders)")
def _importance(spark, sf):
    """An importance for every feature, and they add up to one."""
    _, df = prepared(spark, sf)
    forest = S.random_forest(df.where("split = 'train'"), n_trees=20, max_depth=8)
    return S.importances(forest, NUMERIC, spark).agg(
        F.count("*").alias("n"),
        F.bool_and(F.col("feature").isin(NUMERIC)).alias("named"),
        F.bool_and(F.col("importance").between(0, 1)).alias("in_range"),
        (F.sum("importance") > 0.99).alias("sum_is_one"),
    )


@query("cross_validation")
def _cross_validation(spark, sf):
    return S.cross_validate(embedded(spark, sf), 3, n_trees=10, max_depth=6)


QUADRANT = "cast(embedding[{0}] > 0 as int) + 2 * cast(embedding[{1}] > 0 as int)"


def quadrants(spark, sf):
    """Embeddings whose class is the quadrant of their first two coordinates:
    unlike the labels of the table, something that can be learned."""
    df = embedded(spark, sf)
    x = vector_to_array("features")
    return df.withColumn("label_idx", ((x[0] > 0).cast("int") + 2 * (x[1] > 0).cast("int")))


@query("kernel_svm", f"""select vec_id as row_id, {QUADRANT.format(1, 2)} as label_idx, true as known_class, true as confidence_in_range,
 true as above_floor from embeddings where vec_id % 5 = 0""")
def _svm(spark, sf):
    """Trained on four fifths, scored on the rest, of which at least 35 % must
    be right (the commonest class has less than 30 %)."""
    df = quadrants(spark, sf)
    test = F.col("row_id") % 5 == 0
    scored = S.score(df.where(test), S.svm(df.where(~test))).select(
        "row_id", "label_idx",
        F.col("prediction").isin([0, 1, 2, 3]).alias("known_class"),
        F.col("confidence").between(0, 1).alias("confidence_in_range"),
        (F.col("prediction") == F.col("label_idx")).cast("int").alias("right"),
    )
    scored = cut_lineage(scored)
    right = scored.agg((F.avg("right") >= 0.35).alias("above_floor"))
    return scored.drop("right").join(F.broadcast(right))


@query("svm_grid_search", """select c as "C", gamma, kernel, true as in_range, cast(1 as bigint) as n_best, true as above_floor
 from (select unnest([0.1, 1.0, 10.0, 100.0]::double[]) as c), (select unnest(['scale', 'auto', '0.01', '0.1']) as gamma),
 (select unnest(['rbf', 'linear']) as kernel) where exists (select 1 from embeddings)""")
def _grid(spark, sf):
    """All 32 combinations in three folds; one is the best, and at least 0.5."""
    whole = Window.partitionBy()  # one row per combination
    best = F.max(F.when(F.col("is_best"), F.col("f1_weighted"))).over(whole)
    return S.svm_grid(quadrants(spark, sf)).select(
        "C", "gamma", "kernel",
        F.col("f1_weighted").between(0, 1).alias("in_range"),
        F.sum(F.col("is_best").cast("int")).over(whole).alias("n_best"),
        ((best == F.max("f1_weighted").over(whole)) & (best >= 0.5)).alias("above_floor"),
    )


@query("unsupervised_run")
def _unsupervised(spark, sf):
    df = embedded(spark, sf)
    vec = vector_to_array("features")
    df = df.select("*", *[vec[i].alias(f"x{i}") for i in range(4)])
    train, test = df.where("row_id % 5 <> 0"), df.where("row_id % 5 = 0")
    return training.run_unsupervised(
        train, test, [f"x{i}" for i in range(4)],
        {"kmeans": {"n_init": 2, "max_iter": 50}, "dbscan": {"eps": 0.8}},
    )


@query("supervised_run")
def _supervised(spark, sf):
    _, df = prepared(spark, sf)
    return training.run_supervised(
        df, NUMERIC,
        {"svm": {"n_components": 64, "max_iter": 10}, "random_forest": {"n_trees": 10, "max_depth": 6}},
    )


@query("evaluate_saved_model")
def _evaluate_saved(spark, sf):
    """Train, save, load, transform the raw rows, evaluate."""
    pre, df = prepared(spark, sf)
    forest = S.random_forest(df.where("split = 'train'"), n_trees=10, max_depth=6)
    path = shared_folder(spark)
    sinks.save_state(spark, sinks.State(pre, forest, pre.kept_classes), path)
    return training.evaluate_saved(spark, cic_labeled(spark, sf), path)


@query("training_report")
def _training_report(spark, sf):
    _, df = prepared(spark, sf)
    train, test = df.where("split = 'train'"), df.where("split = 'test'")
    table = None
    for name, depth in (("shallow", 2), ("deep", 8)):
        forest = S.random_forest(train, n_trees=8, max_depth=depth)
        found = S.evaluate(S.score(test, forest)).withColumn("model", F.lit(name))
        table = found if table is None else table.unionByName(found)
    report = sinks.report_table(table, ["a"], test.count())
    return rounded(report.select(
        "model", "is_best", "test_size", F.col("metrics")["accuracy"].alias("accuracy"),
        F.col("metrics")["f1_weighted"].alias("f1_weighted"),
    ))
