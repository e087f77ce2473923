"""Count windows of consecutive rows ("flow images") and their labels."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlab.operators import scale


def number_windows(
    df: DataFrame,
    order: str = "row_id",
    size: int = 20,
    prefix: Sequence[str] = (),
    target_rows: int = scale.TASK_ROWS,
) -> DataFrame:
    """Adds ``rn`` and ``window_id``; rows of an incomplete last window are dropped."""
    numbered = scale.number_rows(
        df, order, prefix=prefix, target_rows=target_rows, out="rn", total="_total"
    )
    return (
        numbered.withColumn("window_id", F.floor((F.col("rn") - 1) / size))
        .where(F.col("window_id") < F.floor(F.col("_total") / size))
        .drop("_total")
    )


def _matrix(cols: Sequence[str]) -> Column:
    """The rows of a window in order; at most ``size`` of them, so bounded."""
    row = F.struct("rn", F.array(*[F.col(c).cast("double") for c in cols]).alias("x"))
    return F.transform(F.array_sort(F.collect_list(row)), lambda r: r["x"])


def count_windows(
    df: DataFrame, cols: Sequence[str], order: str = "row_id", size: int = 20, **kw
) -> DataFrame:
    """One row per tumbling window with its ``matrix`` (size x columns)."""
    _require_window(df, size)
    return number_windows(df, order, size, **kw).groupBy("window_id").agg(
        _matrix(cols).alias("matrix")
    )


def sorted_windows(
    df: DataFrame,
    cols: Sequence[str],
    label: str = "label",
    order: str = "row_id",
    size: int = 20,
    per_class: bool = False,
    **kw,
) -> DataFrame:
    """Windows over rows sorted by label; the label of a window is its first row's.

    Windows at class borders mix classes. ``per_class`` restarts the numbering
    in each class instead, so no window does.
    """
    _require_window(df, size)
    if per_class:
        numbered = scale.number_rows(df, order, within=[label], out="rn", total="_total", **kw)
        numbered = numbered.withColumn("window_id", F.floor((F.col("rn") - 1) / size)).where(
            F.col("window_id") < F.floor(F.col("_total") / size)
        )
        return numbered.groupBy(label, "window_id").agg(_matrix(cols).alias("matrix"))
    return number_windows(df, order, size, [label], **kw).groupBy("window_id").agg(
        F.min_by(label, "rn").alias(label), _matrix(cols).alias("matrix")
    )


def majority_label(
    df: DataFrame, label: str = "label_idx", order: str = "row_id", size: int = 20, **kw
) -> DataFrame:
    """Most frequent code per window, the smallest code on ties."""
    _require_window(df, size)
    counts = number_windows(df, order, size, **kw).groupBy("window_id", label).agg(
        F.count(F.lit(1)).alias("n")
    )
    return counts.groupBy("window_id").agg(
        F.max_by(label, F.struct("n", -F.col(label))).alias(label)
    )


def labeled_windows(
    df: DataFrame, cols: Sequence[str], label: str = "label_idx", order: str = "row_id", size: int = 20, **kw
) -> DataFrame:
    """Matrix and majority label of each window from a single numbering.

    The label counts of a window are taken from its own (bounded) rows.
    """
    _require_window(df, size)
    return (
        number_windows(df, order, size, **kw)
        .groupBy("window_id")
        .agg(_matrix(cols).alias("matrix"), F.collect_list(label).alias("_labels"))
        .withColumn(label, _most_frequent(F.col("_labels")))
        .drop("_labels")
    )


def _most_frequent(labels: Column) -> Column:
    ranked = F.transform(
        F.array_distinct(labels),
        lambda v: F.struct(
            F.size(F.filter(labels, lambda x: x == v)).alias("n"), (-v).alias("minus"), v.alias("v")
        ),
    )
    return F.array_max(ranked)["v"]


def tile(features: str | Column, size: int = 20) -> Column:
    """A window that repeats one row, for scoring a single flow."""
    return F.array_repeat(F.col(features) if isinstance(features, str) else features, size)


def window_vector(matrix: str | Column, kind: str = "stats") -> Column:
    """Feature array of a window.

    ``flat``: all entries row by row. ``stats``: per column the mean, standard
    deviation, minimum, maximum and mean absolute step along the window.
    """
    m = F.col(matrix) if isinstance(matrix, str) else matrix
    if kind == "flat":
        return F.flatten(m)
    if kind != "stats":
        raise ValueError(f"unknown kind: {kind}")

    def fold(values, fn):
        return F.aggregate(values, F.lit(0.0), fn)

    def bound(value, fn):
        # a lambda's variable: an expression would be computed again for every entry
        return F.element_at(F.transform(F.array(value), fn), 1)

    def summary(i):
        n = F.size(m)

        def of_values(values):
            mean = fold(values, lambda s, x: s + x) / n
            later, earlier = F.slice(values, 2, n), F.slice(values, 1, n - 1)
            steps = F.zip_with(later, earlier, lambda a, b: F.abs(F.coalesce(a - b, F.lit(0.0))))
            step = fold(steps, lambda s, x: s + x) / F.greatest(n - 1, F.lit(1))

            def of_mean(mean):
                spread = F.sqrt(fold(values, lambda s, x: s + (x - mean) * (x - mean)) / n)
                return F.array(mean, spread, F.array_min(values), F.array_max(values), step)

            return bound(mean, of_mean)

        return bound(F.transform(m, lambda row: F.element_at(row, i)), of_values)

    width = F.size(F.element_at(m, 1))
    return F.flatten(F.transform(F.sequence(F.lit(1), width), summary))


def tiled_vector(row: Column, size: int) -> Column:
    """What ``window_vector(tile(row, size))`` is, without building windows.

    Equal entries are added in the order in which a window is folded, so the
    values are the same; a batch of rows is added at once.
    """

    @F.arrow_udf("array<double>")
    def summary(rows: pa.Array) -> pa.Array:
        values = rows.flatten()
        if rows.null_count or values.null_count:
            raise ValueError("a row of numbers has NULLs")
        x = values.to_numpy(zero_copy_only=False).reshape(len(rows), -1) if len(values) else np.zeros((len(rows), 0))

        def total(v):
            return sum([v] * size, np.zeros_like(v)) / size

        with np.errstate(over="ignore", invalid="ignore"):
            mean = total(x)
            spread = np.sqrt(total((x - mean) * (x - mean)))
            # neighbours are equal: steps of zero, but for values that are not finite
            step = np.abs(x - x) if size > 1 else np.zeros_like(x)
        out = np.stack([mean, spread, x, x, step], axis=2)
        ends = np.arange(len(rows) + 1, dtype=np.int32) * (out.shape[1] * out.shape[2])
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(out.ravel()))

    return summary(row)


def _require_window(df: DataFrame, size: int) -> None:
    if df.limit(size).count() < size:
        raise ValueError(f"not enough rows for one window of {size}")
