"""Scoring closed flows as they appear, callbacks, totals and sinks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowlab.functions import scalars as S
from flowlab.operators import classifying
from flowlab.operators.metrics import apply_thresholds
from flowlab.operators.preparing import Preprocessor, transform


def score_stream(
    flows: DataFrame,
    preprocessor: Preprocessor,
    model,
    classes: Sequence[str],
    thresholds: dict | None = None,
    use_thresholds: bool = False,
) -> DataFrame:
    """Result rows of closed flows; also works on a batch of flows.

    The features are transformed by the expressions of the training job. The
    time of a result is the end of its flow, so a replay gives equal rows. A
    model of windows gets each flow repeated to a window.
    """
    kept = flows.withColumns(
        {
            "timestamp": S.iso_time("end_ts"),
            "flow_key": S.key_text(),
            "_bytes_rate": F.col("flow_bytes_per_sec"),
            "_packet_rate": F.col("flow_pkts_per_sec"),
            "_duration": F.col("flow_duration"),
        }
    ).drop("label")
    of_windows = isinstance(model, classifying.WindowModel)
    score = classifying.score_single_flow if of_windows else classifying.score
    scored = score(transform(kept, preprocessor), model, classes)
    if use_thresholds:
        scored = apply_thresholds(scored, thresholds)
    return scored.select(
        "timestamp", "flow_key", "predicted_class", "confidence", "n_packets",
        F.col("_bytes_rate").alias("flow_bytes_per_sec"),
        F.col("_packet_rate").alias("flow_pkts_per_sec"),
        F.col("_duration").alias("flow_duration"),
    )


def start(
    results: DataFrame,
    on_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    available_now: bool = False,
    interval: str = "5 seconds",
) -> StreamingQuery:
    """Call ``on_batch(batch, batch_id)`` for every micro-batch of results."""
    writer = results.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def write_stream(
    results: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    available_now: bool = False,
    interval: str = "5 seconds",
) -> StreamingQuery:
    """Append results to files; exactly once through the checkpoint."""
    writer = (
        results.writeStream.format(fmt)
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if fmt == "csv":
        writer = writer.option("header", "true")
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def running_totals(results: DataFrame) -> DataFrame:
    """Flows per class so far; for ``complete`` or ``update`` output of a
    stream that reads the result sink, or for a batch of it."""
    return results.groupBy("predicted_class").agg(F.count(F.lit(1)).alias("n"))
