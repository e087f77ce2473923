"""Class distributions, feature checks and the tables behind the charts."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlab.operators import scale


def class_counts(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def class_share(df: DataFrame, label: str = "label") -> DataFrame:
    """Counts with their share of all rows (the window sees one row per class)."""
    return class_counts(df, label).withColumn(
        "share", F.col("n") / F.sum("n").over(Window.partitionBy())
    )


def class_list(df: DataFrame, label: str = "label") -> DataFrame:
    """The sorted classes with their codes 0, 1, ..."""
    order = Window.orderBy(label)
    return (
        df.select(label).where(F.col(label).isNotNull()).distinct()
        .withColumn("code", (F.row_number().over(order) - 1).cast("int"))
    )


def _long(one_row: DataFrame, cols: Sequence[str], fields: dict[str, str]) -> DataFrame:
    """A single aggregate row with ``{prefix}{i}`` columns to one row per feature."""
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                *[F.col(f"{prefix}{i}").alias(name) for prefix, name in fields.items()],
            )
            for i, c in enumerate(cols)
        ]
    )
    return one_row.select(F.inline(rows))


def _aggregate(df: DataFrame, cols: Sequence[str], measures: dict[str, object]) -> DataFrame:
    return df.agg(
        *[fn(F.col(c)).alias(f"{prefix}{i}") for i, c in enumerate(cols) for prefix, fn in measures.items()]
    )


def zero_features(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Features without any value other than zero."""
    row = _aggregate(df, cols, {"used": lambda c: F.max(F.when(c != 0, F.lit(1)))})
    return _long(row, cols, {"used": "used"}).where(F.col("used").isNull()).select("feature")


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, sample standard deviation and exact quartiles per feature."""
    row = _aggregate(
        df,
        cols,
        {
            "n": F.count,
            "avg": F.avg,
            "sd": F.stddev_samp,
            "lo": lambda c: F.min(c).cast("double"),
            "hi": lambda c: F.max(c).cast("double"),
        },
    )
    quartiles = scale.exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    table = _long(
        row, cols, {"n": "n", "avg": "mean", "sd": "std", "lo": "min", "hi": "max"}
    )
    for j, name in enumerate(["p25", "p50", "p75"]):
        value = F.lit(None).cast("double")
        for c in cols:
            value = F.when(F.col("feature") == c, F.lit(quartiles[c][j])).otherwise(value)
        table = table.withColumn(name, value)
    return table


def low_variance(df: DataFrame, cols: Sequence[str], below: float = 0.1) -> DataFrame:
    row = _aggregate(df, cols, {"sd": F.stddev_pop})
    return _long(row, cols, {"sd": "std"}).where(F.col("std") < below)


def range_check(
    df: DataFrame,
    cols: Sequence[str],
    strict_low: float = -10.0,
    low: float = -5.0,
    high: float = 20.0,
) -> DataFrame:
    """Extremes of each feature with the two flags of the quality check."""
    row = _aggregate(
        df,
        cols,
        {
            "lo": lambda c: F.min(c).cast("double"),
            "hi": lambda c: F.max(c).cast("double"),
            "avg": F.avg,
        },
    )
    return _long(row, cols, {"lo": "min", "hi": "max", "avg": "mean"}).withColumns(
        {
            "far_below": F.col("min") < strict_low,
            "out_of_range": (F.col("max") > high) | (F.col("min") < low),
        }
    )


def overall_range(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Smallest, largest and mean entry of the whole feature matrix."""
    row = _aggregate(
        df,
        cols,
        {
            "lo": lambda c: F.min(c).cast("double"),
            "hi": lambda c: F.max(c).cast("double"),
            "sum": lambda c: F.sum(c.cast("double")),
            "n": F.count,
        },
    )
    return _long(row, cols, {"lo": "lo", "hi": "hi", "sum": "s", "n": "n"}).agg(
        F.min("lo").alias("min"),
        F.max("hi").alias("max"),
        (F.sum("s") / F.sum("n")).alias("mean"),
    )


def class_means(
    df: DataFrame, cols: Sequence[str], label: str = "label", digits: int = 2
) -> DataFrame:
    return df.groupBy(label).agg(*[F.round(F.avg(c), digits).alias(c) for c in cols])


def cluster_profiles(
    df: DataFrame, cluster: str, cols: Sequence[str], digits: int = 4
) -> DataFrame:
    return class_means(df, cols, cluster, digits)


def feature_variability(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """Sample standard deviation and number of distinct values.

    Several distinct counts in one aggregation would copy every row for every
    column through the shuffle. Here a task sends each value of a column once.
    """
    if not exact:
        row = _aggregate(df, cols, {"sd": F.stddev_samp, "d": F.approx_count_distinct})
        return _long(row, cols, {"sd": "std", "d": "n_distinct"})
    spread = _long(_aggregate(df, cols, {"sd": F.stddev_samp}), cols, {"sd": "std"})
    values = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("_name"), F.when(F.col(c) == 0, "0").otherwise(F.col(c).cast("string")).alias("_value")) for c in cols])))
    counts = values.where(F.col("_value").isNotNull()).distinct().groupBy("_name").agg(F.count(F.lit(1)).alias("n_distinct"))
    name = spread.columns[0]
    joined = spread.join(scale.checked_broadcast(counts), F.col(name) == F.col("_name"), "left")
    return joined.select(name, "std", F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"))


def correlations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson matrix in long form, all pairs from a single pass."""
    pairs = list(combinations(range(len(cols)), 2))
    row = df.agg(
        *[F.corr(cols[i], cols[j]).alias(f"r_{i}_{j}") for i, j in pairs],
        *[F.corr(c, c).alias(f"r_{i}_{i}") for i, c in enumerate(cols)],
    )

    def entry(i, j):
        return F.struct(
            F.lit(cols[i]).alias("feature_a"),
            F.lit(cols[j]).alias("feature_b"),
            F.col(f"r_{min(i, j)}_{max(i, j)}").alias("corr"),
        )

    size = range(len(cols))
    return row.select(F.inline(F.array(*[entry(i, j) for i in size for j in size])))


def histogram(
    df: DataFrame, value: str | Column, bins: int = 30, by: str = "label"
) -> DataFrame:
    """Equal-width bins over each class's own range; the last bin is closed."""
    v = F.col(value) if isinstance(value, str) else value
    data = df.select(F.col(by), v.cast("double").alias("_v")).where(F.col("_v").isNotNull())
    ranges = data.groupBy(by).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    flat = F.col("_lo") == F.col("_hi")
    ranges = ranges.select(
        F.col(by).alias("_by"),
        F.when(flat, F.col("_lo") - 0.5).otherwise(F.col("_lo")).alias("lo"),
        F.when(flat, F.col("_hi") + 0.5).otherwise(F.col("_hi")).alias("hi"),
    )
    placed = data.join(
        scale.checked_broadcast(ranges), F.col(by).eqNullSafe(F.col("_by"))
    )
    step = (F.col("hi") - F.col("lo")) / bins
    number = F.least(F.floor((F.col("_v") - F.col("lo")) / step), F.lit(bins - 1)).cast("int")
    return (
        placed.groupBy(by, "lo", "hi", number.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            by,
            "bin",
            (F.col("lo") + F.col("bin") * step).alias("bin_start"),
            (F.col("lo") + (F.col("bin") + 1) * step).alias("bin_end"),
            "n",
        )
    )


def box_stats(df: DataFrame, value: str, by: str = "label", **kw) -> DataFrame:
    """Quartiles, whiskers (last value within 1.5 IQR) and outliers per class."""
    fitted = scale.exact_quantiles(df, [value], [0.25, 0.5, 0.75], by=by, **kw)
    by_type = df.schema[by].dataType.simpleString()
    # one row per class
    params = df.sparkSession.createDataFrame(
        [(g, *map(float, q[value])) for g, q in fitted.items() if q[value][0] is not None],
        f"_by {by_type}, q1 double, median double, q3 double",
    )
    v = F.col(value).cast("double")
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = (v >= F.col("q1") - reach) & (v <= F.col("q3") + reach)
    return (
        df.join(scale.checked_broadcast(params), F.col(by).eqNullSafe(F.col("_by")))
        .groupBy(by, "q1", "median", "q3")
        .agg(
            F.count(value).alias("n"),
            F.least(F.coalesce(F.min(F.when(inside, v)), F.col("q1")), F.col("q1")).alias("whisker_low"),
            F.greatest(F.coalesce(F.max(F.when(inside, v)), F.col("q3")), F.col("q3")).alias("whisker_high"),
            F.count(F.when(~inside, v)).alias("n_outliers"),
        )
    )


def live_totals(df: DataFrame, predicted: str = "predicted_class") -> DataFrame:
    """Packets, flows, classified, errors and flows per class, from one rollup.

    A flow whose prediction is NULL counts as an error.
    """
    totals = df.rollup(predicted).agg(
        F.grouping(predicted).alias("all_rows"),
        F.count(F.lit(1)).alias("flows"),
        F.count(predicted).alias("classified"),
        F.sum("n_packets").alias("packets"),
    )
    whole = F.array(
        *[
            F.struct(F.lit(name).alias("metric"), value.cast("long").alias("value"))
            for name, value in (
                ("packets", F.col("packets")),
                ("flows", F.col("flows")),
                ("classified", F.col("classified")),
                ("errors", F.col("flows") - F.col("classified")),
            )
        ]
    )
    one = F.array(
        F.struct(
            F.concat(F.lit("class:"), F.col(predicted)).alias("metric"),
            F.col("flows").cast("long").alias("value"),
        )
    )
    return totals.select(F.inline(F.when(F.col("all_rows") == 1, whole).otherwise(one))).where(
        F.col("metric").isNotNull()
    )
