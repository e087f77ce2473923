"""Sinks for tables, results, reports and fitted state."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import MultilayerPerceptronClassificationModel, RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlab.operators.classifying import SvmModel, WindowModel
from flowlab.operators.lloyd import KMeansFit
from flowlab.operators.preparing import Preprocessor, load_preprocessor, save_preprocessor


def _write(df: DataFrame, path: str, fmt: str, mode: str) -> None:
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", "true")
    writer.format(fmt).save(path)


def write_flows(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    _write(df, path, fmt, mode)


def write_results(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "append") -> None:
    """Classification results: the seven result fields and the key, if present."""
    fields = [
        "timestamp", "flow_key", "predicted_class", "confidence",
        "flow_bytes_per_sec", "flow_pkts_per_sec", "flow_duration",
    ]
    _write(df.select(*[c for c in fields if c in df.columns]), path, fmt, mode)


def write_report(metrics: DataFrame, path: str, fmt: str = "json", mode: str = "overwrite") -> None:
    """Metrics per model, one JSON line each (tens of rows)."""
    _write(metrics.coalesce(1), path, fmt, mode)


def write_profiles(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> None:
    """Cluster profiles: one row per cluster."""
    _write(df.coalesce(1), path, fmt, mode)


def report_table(metrics: DataFrame, classes: Sequence[str], test_size: int) -> DataFrame:
    """One row per model with a map of its metrics, and the best model."""
    per_model = metrics.groupBy("model").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("metric", "value")))).alias("metrics")
    )
    f1 = F.try_element_at("metrics", F.lit("f1_weighted"))
    from pyspark.sql import Window

    best = F.max_by("model", F.struct(f1.alias("f1"), "model")).over(Window.partitionBy())  # one row per model
    return per_model.withColumns(
        {
            "is_best": F.col("model") == best,
            "classes": F.array(*[F.lit(c) for c in classes]),
            "test_size": F.lit(test_size).cast("long"),
        }
    )


# --- fitted state ---------------------------------------------------------------------

@dataclass
class State:
    """What a later run needs: preprocessor, model and class names."""

    preprocessor: Preprocessor
    model: object
    classes: list[str]


#: models with files of their own, and models kept as one JSON text
_SAVED = {
    "forest": RandomForestClassificationModel, "pipeline": PipelineModel,
    "perceptron": MultilayerPerceptronClassificationModel,
}
_TEXTS = {"svm": SvmModel, "kmeans": KMeansFit}


def _kind(model) -> str:
    for kind, cls in (_SAVED | _TEXTS | {"windows": WindowModel}).items():
        if isinstance(model, cls):
            return kind
    raise ValueError(f"cannot save {type(model).__name__}")


def write_model(spark: SparkSession, model, path: str) -> None:
    """A fitted model in the form of its kind."""
    if isinstance(model, WindowModel):
        write_model(spark, model.model, f"{path}/model")
        form = {"inner": _kind(model.model), "size": model.size, "kind": model.kind}
        _write_text(spark, json.dumps(form), f"{path}/form")
    elif _kind(model) in _TEXTS:
        _write_text(spark, model.to_json(), path)
    else:
        model.write().overwrite().save(path)


def _write_text(spark: SparkSession, text: str, path: str) -> None:
    _write(spark.createDataFrame([(text,)], "value string").coalesce(1), path, "text", "overwrite")


def read_model(spark: SparkSession, kind: str, path: str):
    if kind == "windows":
        form = json.loads(spark.read.text(f"{path}/form").first()[0])
        return WindowModel(read_model(spark, form["inner"], f"{path}/model"), form["size"], form["kind"])
    if kind in _TEXTS:
        return _TEXTS[kind].from_json(spark.read.text(path).first()[0])
    return _SAVED[kind].load(path)


def save_state(spark: SparkSession, state: State, path: str) -> None:
    kind = _kind(state.model)
    save_preprocessor(spark, state.preprocessor, f"{path}/preprocessor")
    write_model(spark, state.model, f"{path}/model")
    _write_text(spark, json.dumps({"kind": kind, "classes": state.classes}), f"{path}/meta")


def load_state(spark: SparkSession, path: str) -> State:
    meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
    model = read_model(spark, meta["kind"], f"{path}/model")
    return State(load_preprocessor(spark, f"{path}/preprocessor"), model, meta["classes"])
