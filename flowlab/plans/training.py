"""Composed jobs: unsupervised and supervised runs, evaluation of saved models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlab.operators import classifying as S
from flowlab.operators import clustering as K
from flowlab.operators import profiling as P
from flowlab.operators import sampling
from flowlab.operators import windows as W
from flowlab.operators.preparing import Preprocessor, class_names, transform
from flowlab.sources import sinks

# Defaults of the training configuration.
KMEANS = {"k": 8, "max_iter": 500, "n_init": 20, "seed": 42}
DBSCAN = {"eps": 0.5, "min_samples": 10}
SVM = {"kernel": "rbf", "C": 10.0, "gamma": "scale"}
FOREST = {"n_trees": 200, "max_depth": 20, "min_split": 5, "seed": 42}


def _named(model: str, table: DataFrame) -> DataFrame:
    return table.select(F.lit(model).alias("model"), "metric", F.col("value").cast("double"))


def run_unsupervised(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    config: Mapping | None = None,
    *,
    id: str = "row_id",
    dbscan_sample: int | None = None,
    output: str | None = None,
) -> DataFrame:
    """K-means on the training rows evaluated on the test rows, then DBSCAN.

    Inputs have ``features`` and, for the test rows, ``label_idx`` and the
    feature columns. DBSCAN takes all training rows, or a sample of
    ``dbscan_sample`` rows where one is wanted.
    """
    config = config or {}
    model = K.fit_kmeans(train, **(KMEANS | dict(config.get("kmeans", {}))))
    scored = K.with_vec(model.transform(test))
    report = K.cluster_report(scored, "cluster", id, actual="label_idx", inertia=model.cost)
    profiles = P.cluster_profiles(scored, "cluster", features)
    chosen = train if dbscan_sample is None else sampling.bounded_sample(train, dbscan_sample, 42, [id])
    points = K.with_vec(chosen).select(id, "vec")
    labels = K.dbscan(points, id=id, **(DBSCAN | dict(config.get("dbscan", {}))))
    dense = K.cluster_report(points.join(labels, id), "cluster", id, noise=True)
    if output:
        sinks.write_profiles(profiles, f"{output}/kmeans_cluster_profiles")
        sinks.write_model(train.sparkSession, model, f"{output}/kmeans_model")
        sinks.write_flows(labels, f"{output}/dbscan_labels")
    return _named("kmeans", report).unionByName(_named("dbscan", dense))


def run_supervised(
    prepared: DataFrame,
    features: Sequence[str],
    config: Mapping | None = None,
    *,
    preprocessor: Preprocessor | None = None,
    output: str | None = None,
) -> DataFrame:
    """SVM and forest on the training split, measured on the test split.

    Returns ``(model, metric, value)`` for both, and saves models and report
    when ``output`` is given.
    """
    config = config or {}
    train = prepared.where(F.col("split") == "train").persist()
    test = prepared.where(F.col("split") == "test")
    try:
        classes = class_names(prepared)
        models = {
            "svm": S.svm(train, n_classes=len(classes), **(SVM | dict(config.get("svm", {})))),
            "random_forest": S.random_forest(train, **(FOREST | dict(config.get("random_forest", {})))),
        }
    finally:
        train.unpersist()
    table = None
    for name, model in models.items():
        found = _named(name, S.evaluate(S.score(test, model), len(classes)))
        table = found if table is None else table.unionByName(found)
        if output and preprocessor is not None:
            sinks.save_state(
                prepared.sparkSession, sinks.State(preprocessor, model, classes), f"{output}/{name}"
            )
    if output:
        sinks.write_report(table, f"{output}/training_report")
        top = S.top_importances(models["random_forest"], features, prepared.sparkSession)
        sinks.write_report(top, f"{output}/feature_importance")
    return table


def run_windows(
    prepared: DataFrame,
    features: Sequence[str],
    *,
    size: int = 20,
    order: str = "row_id",
    sort_by_label: bool = False,
    **kw,
) -> tuple[S.WindowModel, DataFrame]:
    """The window classifier on count windows of each split."""

    def windows(split):
        part = prepared.where(F.col("split") == split)
        if sort_by_label:
            return W.sorted_windows(part, features, S.LABEL, order, size)
        return W.labeled_windows(part, features, S.LABEL, order, size)

    model = S.window_classifier(windows("train"), windows("val"), size=size, **kw)
    return model, _named("windows", S.evaluate(model.score(windows("test"))))


def evaluate_saved(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """Load saved state, transform raw rows with it and measure the model."""
    state = sinks.load_state(spark, path)
    prepared = transform(df.where(F.col("label").isNotNull()), state.preprocessor)
    return S.evaluate(S.score(prepared, state.model), len(state.classes))
