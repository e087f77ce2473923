"""Learning: invariants and thresholds, state round trips, loaders."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from flowlab.operators import classifying as S
from flowlab.operators import metrics as M
from flowlab.operators import preparing as R
from flowlab.operators import windows as W
from flowlab.plans import training
from flowlab.schema import FLOW_FEATURES, SELECTED_FEATURES
from flowlab.sources import datasets, sinks
from flowlab.sources.synthetic import synthetic_flows


@pytest.fixture(scope="module")
def flows(spark):
    return synthetic_flows(spark, 500, 4, 42).cache()


@pytest.fixture(scope="module")
def prepared(flows):
    model, df = R.fit_preprocessor(flows)
    return model, df.cache()


def test_synthetic(flows):
    assert flows.count() == 500
    assert {r["count"] for r in flows.groupBy("label").count().collect()} == {125}
    assert set(FLOW_FEATURES) <= set(flows.columns)
    low = flows.agg(*[F.min(c).alias(c) for c in ("fwd_pkt_len_mean", "iat_mean", "flow_duration")]).first()
    assert low.fwd_pkt_len_mean >= 64 and low.iat_mean >= 0.001 and low.flow_duration >= 1


def test_preprocessor(prepared):
    model, df = prepared
    assert len(model.classes) == 4 and model.features == FLOW_FEATURES
    counts = {r["split"]: r["count"] for r in df.groupBy("split").count().collect()}
    assert counts == {"train": 348, "val": 52, "test": 100}
    holes = df.select(*[F.count_if(F.col(c).isNull() | F.isnan(c)).alias(c) for c in FLOW_FEATURES]).first()
    assert sum(holes) == 0
    assert df.agg(F.max("label_idx")).first()[0] == 3


def test_imputer_sees_only_training_rows_by_default(spark):
    rows = [(i, "a", None if i % 3 == 0 else float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "row_id long, label string, x double")
    m1, out = R.fit_preprocessor(df, ["x"])
    m2, _ = R.fit_preprocessor(df, ["x"], fit_on="all")
    train = sorted(r.row_id for r in out.where("split = 'train'").collect() if r.row_id % 3)
    assert m1.params.fill["x"] == pytest.approx((train[(len(train) - 1) // 2] + train[len(train) // 2]) / 2)
    assert m2.params.fill["x"] == pytest.approx(30.0)  # median of all


def test_unseen_label_is_an_error(spark, prepared):
    model, _ = prepared
    df = spark.createDataFrame([("Gaming",)], "label string")
    with pytest.raises(Exception, match="unseen label"):
        R.encode_labels(df, model.classes).collect()


def test_unfitted_transform(flows):
    with pytest.raises(ValueError):
        R.transform(flows, None)


def test_windows(prepared):
    _, df = prepared
    train = df.where("split = 'train'")
    out = W.labeled_windows(train, FLOW_FEATURES, size=10)
    assert out.count() == 34
    row = out.first()
    assert len(row.matrix) == 10 and len(row.matrix[0]) == 33
    with pytest.raises(ValueError):
        W.count_windows(train.limit(5), FLOW_FEATURES, size=10)
    pure = W.sorted_windows(train, FLOW_FEATURES, "label_idx", size=10, per_class=True)
    assert pure.count() == 4 * 8


def test_forest_accuracy_importances_state(spark, prepared, flows, tmp_path):
    model, df = prepared
    forest = S.random_forest(df.where("split = 'train'"), 20, 5)
    scored = S.score(df.where("split = 'test'"), forest, model.classes)
    metrics = {r.metric: r.value for r in S.evaluate(scored, 4).collect()}
    assert metrics["accuracy"] > 0.8 and metrics["roc_auc_ovr"] > 0.9
    assert S.importances(forest, FLOW_FEATURES, spark).agg(F.sum("importance")).first()[0] > 0.99
    assert S.top_importances(forest, FLOW_FEATURES, spark, 5).count() == 5
    assert scored.where("abs(aggregate(probability, 0D, (a, x) -> a + x) - 1) > 1e-6").count() == 0
    path = str(tmp_path / "forest")
    sinks.save_state(spark, sinks.State(model, forest, model.classes), path)
    again = {r.metric: r.value for r in training.evaluate_saved(spark, flows, path).collect()}
    first = {r.metric: r.value for r in S.evaluate(S.score(df, forest), 4).collect()}
    assert again == pytest.approx(first)


def test_svm(spark, prepared, flows, tmp_path):
    model, df = prepared
    train, test = df.where("split = 'train'"), df.where("split = 'test'")
    svm = S.svm(train, C=1.0, max_iter=30, n_components=128)
    accuracy = M.weighted_metrics(svm.score(test), "label_idx", "prediction").first().accuracy
    assert accuracy > 0.6
    assert 0 <= svm.kernel_error < 0.2
    path = str(tmp_path / "svm")
    sinks.save_state(spark, sinks.State(model, svm, model.classes), path)
    assert sinks.load_state(spark, path).model.score(test).select("prediction", "probability").collect() == \
        svm.score(test).select("prediction", "probability").collect()
    linear = S.svm(train, "linear", max_iter=20)
    assert M.weighted_metrics(linear.score(test), "label_idx", "prediction").first().accuracy > 0.6


def test_kernel_gamma(spark):
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(Vectors.dense([0.0, 2.0]),), (Vectors.dense([4.0, 6.0]),)], ["features"])
    gamma, dims = S.kernel_gamma(df, "scale")
    assert dims == 2 and gamma == pytest.approx(1 / (2 * 5.0))
    assert S.kernel_gamma(df, "auto")[0] == 0.5


def test_window_classifier_and_single_flow(prepared):
    model, df = prepared
    window_model, metrics = training.run_windows(
        df, FLOW_FEATURES, size=5, sort_by_label=True, method="forest", n_trees=10, max_depth=5
    )
    found = {r.metric: r.value for r in metrics.collect()}
    assert found["accuracy"] > 0.6
    out = S.score_single_flow(df.where("split = 'test'"), window_model, model.classes)
    assert out.count() == 100 and out.where("confidence > 1 or confidence <= 0").count() == 0


def test_weights_balance(prepared):
    _, df = prepared
    w = R.attach_weights(df, "label_idx").groupBy("label_idx").agg(F.sum("weight").alias("w")).collect()
    assert len({round(r.w, 6) for r in w}) == 1


def test_best_by_takes_the_smallest_on_ties(spark):
    df = spark.createDataFrame([(4, 0.5), (2, 0.7), (3, 0.7)], "k int, m double")
    assert M.best_by(df, "k", "m").first().k == 2


def test_dispatch(spark, tmp_path):
    unsw = tmp_path / "UNSW_NB15_training.csv"
    unsw.write_text("spkts,dpkts,sbytes,dbytes,dur,rate,attack_cat,label\n3,0,100,0,0,5,,0\n1,2,10,20,2.0,5, DoS ,1\n")
    rows = datasets.load_dataset(spark, str(unsw)).orderBy("fwd_packet_count").collect()
    assert [r.label for r in rows] == ["DoS", "Normal"]
    assert rows[1].fwd_bwd_pkt_ratio == 3.0 and rows[1].flow_pkts_per_sec == pytest.approx(3e6)
    iscx = tmp_path / "vpn.csv"
    iscx.write_text("Total Fwd Packets , Fwd IAT Total,Fwd IAT Mean,Class\n5,9.0,3.0,VPN\n")
    row = datasets.load_dataset(spark, str(iscx)).first()
    assert (row.fwd_packet_count, row.fwd_iat_mean, row.label) == (5.0, 3.0, "VPN")
    with pytest.raises(ValueError):
        datasets.load_dataset(spark, str(iscx), "other")
    bad = tmp_path / "nolabel.csv"
    bad.write_text("a,b\n1,2\n")
    with pytest.raises(ValueError):
        datasets.load_dataset(spark, str(bad))


def test_cic_folder_with_different_headers(spark, tmp_path):
    (tmp_path / "mon.csv").write_text(" Total Fwd Packets, Flow Bytes/s, Label\n5,Infinity,BENIGN\n")
    (tmp_path / "tue.csv").write_text(" Label, Total Fwd Packets\nWeb Attack – XSS,7\n,8\n")
    rows = datasets.read_cic(spark, str(tmp_path)).orderBy("fwd_packet_count").collect()
    assert [(r.fwd_packet_count, r.label) for r in rows] == [(5.0, "Normal"), (7.0, "Web Attack"), (8.0, "Normal")]


def test_report(spark, tmp_path):
    table = spark.createDataFrame(
        [("a", "f1_weighted", 0.5), ("b", "f1_weighted", 0.8), ("b", "accuracy", 0.9)],
        "model string, metric string, value double",
    )
    report = sinks.report_table(table, ["x", "y"], 7)
    sinks.write_report(report, str(tmp_path / "report"))
    back = spark.read.json(str(tmp_path / "report"))
    assert [(r.model, r.is_best, r.test_size) for r in back.orderBy("model").collect()] == [("a", False, 7), ("b", True, 7)]


def test_runs(spark, prepared, tmp_path):
    model, df = prepared
    table = training.run_supervised(
        df, model.features,
        {"svm": {"n_components": 32, "max_iter": 5}, "random_forest": {"n_trees": 5, "max_depth": 4}},
        preprocessor=model, output=str(tmp_path / "sup"),
    )
    assert {r.model for r in table.collect()} == {"svm", "random_forest"}
    assert sinks.load_state(spark, str(tmp_path / "sup" / "random_forest")).classes == model.classes
    found = training.run_unsupervised(
        df.where("split = 'train'"), df.where("split = 'test'"), SELECTED_FEATURES,
        {"kmeans": {"k": 4, "n_init": 1, "max_iter": 20}, "dbscan": {"eps": 1.0, "min_samples": 5}},
        output=str(tmp_path / "uns"),
    )
    rows = {(r.model, r.metric): r.value for r in found.collect()}
    assert ("kmeans", "adjusted_rand_index") in rows and ("dbscan", "noise_ratio") in rows
    assert spark.read.option("header", True).csv(str(tmp_path / "uns" / "kmeans_cluster_profiles")).count() == rows[("kmeans", "n_clusters")]


def test_window_vector_computes_each_sum_once(spark):
    rows = np.array([[1.0, 5.0], [4.0, 5.0], [2.0, -1.0]])
    df = spark.createDataFrame([(rows.tolist(),)], "m array<array<double>>").select(W.window_vector("m").alias("v"))
    # mean, spread and step: nothing is folded again for every entry of another fold
    assert df._jdf.queryExecution().analyzed().toString().count("aggregate(") == 3
    expected = [f(rows[:, i]) for i in range(2) for f in (np.mean, np.std, np.min, np.max, lambda x: np.abs(np.diff(x)).mean())]
    assert np.allclose(df.first()["v"], expected, atol=1e-12)


def test_rows_are_scored_once_for_all_metrics(spark):
    scored_rows = spark.sparkContext.accumulator(0)

    @F.udf("array<double>")
    def probability(x):
        scored_rows.add(1)
        return [x, 1 - x]

    rows = spark.range(1_000).select(
        (F.col("id") % 2).cast("int").alias("label_idx"), (F.col("id") % 3 % 2).cast("int").alias("prediction"),
        probability(F.col("id") % 7 / 7).alias("probability"),
    )
    found = {r.metric: r.value for r in S.evaluate(rows, 2).collect()}
    assert "roc_auc_ovr" in found and scored_rows.value == 1_000


@pytest.mark.parametrize("size", [1, 3, 20])
def test_statistics_of_a_repeated_row(spark, size):
    odd = [0.0, -0.0, 0.1, 1e308, -1e308, 5e-324, math.inf, -math.inf, math.nan, 3.0]
    rng = np.random.default_rng(4)
    rows = [[odd[(i + j) % 10] for j in range(4)] for i in range(10)] + (rng.normal(0, 1, (90, 4)) * 10.0 ** rng.integers(-9, 9, (90, 4))).tolist()
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "id long, x array<double>")
    both = df.select(W.window_vector(W.tile("x", size)).alias("a"), W.tiled_vector(F.col("x"), size).alias("b")).collect()
    assert len(both) == 100 and all(repr(r["a"]) == repr(r["b"]) for r in both)


def test_single_flows_are_scored_without_windows(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(i % 2, 0.3, 3).tolist(), i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "row_id long, x array<double>, label_idx int")
    flows = df.withColumn("features", array_to_vector("x"))
    windows = df.select(W.tile("x", 20).alias("matrix"), "label_idx")
    model = S.window_classifier(windows, method="forest", n_trees=3, max_depth=3)
    wanted = model.score(df.withColumn("matrix", W.tile("x", 20))).select("row_id", "prediction", "confidence").orderBy("row_id").collect()
    monkeypatch.setattr(W, "window_vector", None)
    scored = S.score_single_flow(flows, model, ["a", "b"]).orderBy("row_id")
    got = scored.select("row_id", "prediction", "confidence", "predicted_class", F.size("matrix").alias("n")).collect()
    assert [tuple(r)[:3] for r in got] == [tuple(r) for r in wanted]
    assert {(r["prediction"], r["predicted_class"], r["n"]) for r in got} == {(0, "a", 20), (1, "b", 20)}
