"""Evaluation of classifiers and of clusterings against labels.

Everything reduces the rows to a confusion or contingency table first, with
map-side partial aggregation; the rest works on that small table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlab.operators import scale
from flowlab.operators.preparing import class_name
from flowlab.schema import CLASS_THRESHOLDS, DEFAULT_LABEL, DEFAULT_THRESHOLD


def _cells(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(actual).alias("a"), F.col(predicted).alias("p")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _div(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def _per_class(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Support, predictions and hits of every class seen on either side."""
    both = _cells(df, actual, predicted).select(
        "n",
        F.explode(
            F.array(
                F.struct(F.col("a").alias("c"), F.lit(True).alias("is_actual"), (F.col("a") == F.col("p")).alias("hit")),
                F.struct(F.col("p").alias("c"), F.lit(False).alias("is_actual"), F.lit(False).alias("hit")),
            )
        ).alias("s"),
    )
    counts = both.groupBy(F.col("s.c").alias("class")).agg(
        F.sum(F.when(F.col("s.is_actual"), F.col("n")).otherwise(0)).alias("support"),
        F.sum(F.when(~F.col("s.is_actual"), F.col("n")).otherwise(0)).alias("predicted"),
        F.sum(F.when(F.col("s.hit"), F.col("n")).otherwise(0)).alias("hits"),
    )
    precision = _div(F.col("hits"), F.col("predicted"))
    recall = _div(F.col("hits"), F.col("support"))
    return counts.withColumns({"precision": precision, "recall": recall}).withColumn(
        "f1",
        _div(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
    )


def _summary(per_class: DataFrame) -> DataFrame:
    total = F.sum("support")

    def weighted(c):
        return F.sum(F.col(c) * F.col("support")) / total

    return per_class.agg(
        (F.sum("hits") / total).alias("accuracy"),
        weighted("precision").alias("precision_weighted"),
        weighted("recall").alias("recall_weighted"),
        weighted("f1").alias("f1_weighted"),
        F.avg("precision").alias("precision_macro"),
        F.avg("recall").alias("recall_macro"),
        F.avg("f1").alias("f1_macro"),
        total.alias("support"),
    )


def weighted_metrics(
    df: DataFrame, actual: str = "y_true", predicted: str = "y_pred"
) -> DataFrame:
    """Accuracy and support-weighted precision, recall, F1; 0/0 counts as 0."""
    return _summary(_per_class(df, actual, predicted)).select(
        "accuracy", "f1_weighted", "precision_weighted", "recall_weighted"
    )


def class_report(df: DataFrame, actual: str = "y_true", predicted: str = "y_pred") -> DataFrame:
    """One row per class, then accuracy, macro and weighted averages."""
    per_class = _per_class(df, actual, predicted)
    s = _summary(per_class)
    rows = per_class.select(
        F.col("class").cast("string").alias("name"), "precision", "recall", "f1", "support"
    )

    def line(name, p, r, f):
        return F.struct(
            F.lit(name).alias("name"), p.alias("precision"), r.alias("recall"),
            f.alias("f1"), F.col("support").alias("support"),
        )

    a = F.col("accuracy")
    extra = s.select(
        F.inline(
            F.array(
                line("accuracy", a, a, a),
                line("macro avg", F.col("precision_macro"), F.col("recall_macro"), F.col("f1_macro")),
                line("weighted avg", F.col("precision_weighted"), F.col("recall_weighted"), F.col("f1_weighted")),
            )
        )
    )
    return rows.unionByName(extra)


def confusion(
    df: DataFrame,
    classes: Sequence,
    actual: str = "y_true",
    predicted: str = "y_pred",
    prefix: str = "pred_",
) -> DataFrame:
    """Actual by predicted counts, zero-filled; classes are given, not scanned for."""
    cells = _cells(df, actual, predicted)
    return cells.groupBy(F.col("a").alias(actual)).agg(
        *[
            F.coalesce(F.sum(F.when(F.col("p") == F.lit(c), F.col("n"))), F.lit(0)).alias(f"{prefix}{c}")
            for c in classes
        ]
    )


def class_accuracy(df: DataFrame, actual: str = "y_true", predicted: str = "y_pred") -> DataFrame:
    return df.groupBy(actual).agg(
        F.count_if(F.col(actual) == F.col(predicted)).alias("correct"),
        F.count(F.lit(1)).alias("total"),
    ).withColumn("accuracy", F.col("correct") / F.col("total"))


def auc_binary(
    df: DataFrame,
    positive: Column,
    score: str,
    group: Sequence[str] = (),
    target_rows: int = scale.TASK_ROWS,
) -> DataFrame:
    """Area under the ROC curve by ranks, ties averaged, per ``group``.

    Rows collapse to counts per distinct score. Positives below a score are a
    running sum inside a score bucket plus the total of the lower buckets. The
    bucket borders are quantiles of the scores, so no task orders all scores of
    a class, however closely they crowd together.
    """
    scored = df.select(
        *group, F.col(score).cast("double").alias("_s"), positive.cast("int").alias("_pos")
    )
    ties = scale.range_bucket(scored, "_s", "_b", target_rows).groupBy(*group, "_b", "_s").agg(
        F.sum("_pos").alias("pos"), F.sum(1 - F.col("_pos")).alias("neg")
    )
    within = Window.partitionBy(*group, "_b").orderBy("_s").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # sum over scores of pos * (neg_below_in_bucket + neg / 2), then bucket offsets
    inner = ties.withColumn(
        "_below", F.coalesce(F.sum("neg").over(within), F.lit(0))
    )
    per_bucket = inner.groupBy(*group, "_b").agg(
        F.sum(F.col("pos") * (F.col("_below") + F.col("neg") / 2)).alias("u"),
        F.sum("pos").alias("pos"),
        F.sum("neg").alias("neg"),
    )
    lower = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    shifted = per_bucket.withColumn("_offset", F.coalesce(F.sum("neg").over(lower), F.lit(0)))
    pairs = F.sum("pos") * F.sum("neg")
    return shifted.groupBy(*group).agg(
        F.sum("pos").alias("n_pos"),
        F.sum("neg").alias("n_neg"),
        F.when(
            pairs > 0,
            F.sum(F.col("u") + F.col("pos") * F.col("_offset")) / pairs.cast("double"),
        ).alias("auc"),
    )


def auc_ovr(df: DataFrame, scores: dict, actual: str = "y_true") -> DataFrame:
    """One-versus-rest AUC weighted by prevalence.

    ``scores`` maps each class value to the column of its score. NULL when a
    class has no positive or no negative rows.
    """
    long = df.select(
        F.col(actual).alias("_a"),
        F.inline(
            F.array(
                *[F.struct(F.lit(c).alias("class"), F.col(s).alias("score")) for c, s in scores.items()]
            )
        ),
    )
    per_class = auc_binary(long, F.col("_a") == F.col("class"), "score", ["class"])
    valid = F.count_if(F.col("auc").isNull()) == 0
    return per_class.agg(
        F.when(valid, F.sum(F.col("auc") * F.col("n_pos")) / F.sum("n_pos")).alias("roc_auc_ovr")
    )


# --- comparing models -----------------------------------------------------------------

def compare_models(
    predictions: DataFrame, model: str = "model", actual: str = "y_true", predicted: str = "y_pred"
) -> DataFrame:
    """Accuracy and weighted F1 per model, with the best model marked.

    ``predictions`` has one row per model and example; each model is reduced
    to its confusion cells.
    """
    cells = predictions.groupBy(
        model, F.col(actual).alias("a"), F.col(predicted).alias("p")
    ).agg(F.count(F.lit(1)).alias("n"))
    sides = cells.select(
        model, "n",
        F.inline(
            F.array(
                F.struct(F.col("a").alias("c"), F.col("n").alias("sup"), F.lit(0).cast("long").alias("pre"),
                         F.when(F.col("a") == F.col("p"), F.col("n")).otherwise(0).alias("hit")),
                F.struct(F.col("p").alias("c"), F.lit(0).cast("long").alias("sup"), F.col("n").alias("pre"),
                         F.lit(0).cast("long").alias("hit")),
            )
        ),
    )
    per_class = sides.groupBy(model, "c").agg(
        F.sum("sup").alias("sup"), F.sum("pre").alias("pre"), F.sum("hit").alias("hit")
    )
    f1 = _div(2 * F.col("hit"), F.col("sup") + F.col("pre"))
    table = per_class.groupBy(model).agg(
        (F.sum("hit") / F.sum("sup")).alias("accuracy"),
        (F.sum(f1 * F.col("sup")) / F.sum("sup")).alias("f1_weighted"),
    )
    best = F.max_by(model, F.struct("f1_weighted", model)).over(Window.partitionBy())  # one row per model
    return table.withColumn("is_best", F.col(model) == best)


def best_by(df: DataFrame, key: str, metric: str, ties: str = "smallest") -> DataFrame:
    """The key with the largest metric; ties go to the smallest key."""
    if ties != "smallest":
        raise ValueError("only ties='smallest' is supported")
    best = df.agg(F.max(metric).alias("_best")).first()["_best"]
    return (
        df.where(F.col(metric) == F.lit(best))
        .agg(F.min(key).alias(key), F.max(metric).alias(metric))
    )


# --- decisions ---------------------------------------------------------------------------

def argmax_class(df: DataFrame, probabilities: str, classes: Sequence[str]) -> DataFrame:
    """First class of highest probability and its confidence."""
    top = F.array_max(probabilities)
    index = (F.array_position(F.col(probabilities), top) - 1).cast("int")
    return df.withColumns(
        {"class_idx": index, "predicted_class": class_name(index, classes), "confidence": top}
    )


def apply_thresholds(
    df: DataFrame,
    thresholds: dict[str, float] | DataFrame | None = None,
    default: float = DEFAULT_THRESHOLD,
    enabled: bool = True,
    fallback: str = DEFAULT_LABEL,
) -> DataFrame:
    """Below its class threshold a prediction becomes ``fallback`` and the

    confidence its complement. Thresholds are a dict or a table
    ``(predicted_class, threshold)``.
    """
    if not enabled:
        return df
    if isinstance(thresholds, DataFrame):
        df = df.join(scale.checked_broadcast(thresholds), "predicted_class", "left")
        limit = F.coalesce(F.col("threshold"), F.lit(default))
    else:
        table = CLASS_THRESHOLDS if thresholds is None else thresholds
        lookup = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
        limit = F.coalesce(F.try_element_at(lookup, F.col("predicted_class")), F.lit(default))
    low = F.col("confidence") < limit
    return df.withColumns(
        {
            "predicted_class": F.when(low, fallback).otherwise(F.col("predicted_class")),
            "confidence": F.when(low, 1.0 - F.col("confidence")).otherwise(F.col("confidence")),
        }
    ).drop("threshold")


# --- clusterings against labels ----------------------------------------------------------

def _choose2(c: Column) -> Column:
    d = c.cast("double")
    return d * (d - 1.0) / 2.0


def adjusted_rand(df: DataFrame, actual: str = "y_true", cluster: str = "y_pred") -> DataFrame:
    """Adjusted Rand index from the contingency table."""
    cells = _cells(df, actual, cluster)
    by_class = cells.groupBy("a").agg(F.sum("n").alias("n"))
    by_cluster = cells.groupBy("p").agg(F.sum("n").alias("n"))
    parts = (
        cells.select(F.lit("cell").alias("part"), "n")
        .unionByName(by_class.select(F.lit("class").alias("part"), "n"))
        .unionByName(by_cluster.select(F.lit("cluster").alias("part"), "n"))
    )

    def pairs(part):
        return F.sum(F.when(F.col("part") == part, _choose2(F.col("n"))).otherwise(0.0))

    sums = parts.agg(
        pairs("cell").alias("both"), pairs("class").alias("a"), pairs("cluster").alias("b"),
        F.sum(F.when(F.col("part") == "cell", F.col("n"))).alias("n"),
    )
    expected = F.col("a") * F.col("b") / _choose2(F.col("n"))
    highest = (F.col("a") + F.col("b")) / 2
    return sums.select(
        F.when(highest == expected, 1.0)
        .otherwise((F.col("both") - expected) / (highest - expected))
        .alias("adjusted_rand_index")
    )


def nmi(df: DataFrame, actual: str = "y_true", cluster: str = "y_pred") -> DataFrame:
    """Mutual information over the arithmetic mean of the entropies."""
    cells = _cells(df, actual, cluster)
    # windows over contingency cells: classes x clusters rows
    cells = cells.withColumns(
        {
            "na": F.sum("n").over(Window.partitionBy("a")),
            "np": F.sum("n").over(Window.partitionBy("p")),
            "all": F.sum("n").over(Window.partitionBy()),
        }
    )
    n = F.col("n").cast("double")
    share = n / F.col("all")
    # each cell carries its share of the marginal entropies
    sums = cells.agg(
        F.sum(share * F.log(n * F.col("all") / (F.col("na").cast("double") * F.col("np")))).alias("mi"),
        F.sum(-share * F.log(F.col("na") / F.col("all"))).alias("ha"),
        F.sum(-share * F.log(F.col("np") / F.col("all"))).alias("hp"),
    )
    mean = (F.col("ha") + F.col("hp")) / 2
    return sums.select(F.when(mean == 0, 1.0).otherwise(F.col("mi") / mean).alias("nmi"))
