"""Reproducible samples, shuffles, splits and folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlab.operators import scale
from flowlab.schema import MAX_PER_CLASS


def shuffle(df: DataFrame, seed: int = 42, ids: Sequence[str] = ("row_id",)) -> DataFrame:
    """A deterministic random order: a range-partitioned global sort."""
    return df.orderBy(scale.seeded_hash(seed, *ids), *ids)


def bounded_sample(
    df: DataFrame, n: int, seed: int = 42, ids: Sequence[str] = ("row_id",)
) -> DataFrame:
    """``n`` rows at random; each task keeps its own ``n`` best (top-k)."""
    return df.orderBy(scale.seeded_hash(seed, *ids), *ids).limit(n)


def _with_cuts(df: DataFrame, ids, seed, label, ranks) -> DataFrame:
    """Attach the rank cuts of each class; the table of cuts has a row per class."""
    cuts = scale.hash_cuts(df, ids, seed, ranks, within=label)
    return df.withColumn("_md5", scale.seeded_hash(seed, *ids)).join(
        scale.checked_broadcast(cuts), F.col(label).eqNullSafe(F.col("_class"))
    )


def sample_per_class(
    df: DataFrame,
    n: int = MAX_PER_CLASS,
    seed: int = 42,
    ids: Sequence[str] = ("row_id",),
    label: str = "label",
) -> DataFrame:
    """At most ``n`` random rows of each class: a filter, once the cuts are known."""
    near = _with_cuts(df, ids, seed, label, lambda total: [F.lit(n)])
    return near.where(F.col("_md5") <= F.col("_cut_0")).select(*df.columns)


def stratified_split(
    df: DataFrame,
    test: float = 0.2,
    val: float = 0.1,
    seed: int = 42,
    ids: Sequence[str] = ("row_id",),
    label: str = "label",
) -> DataFrame:
    """Column ``split``: per class first the test share, then ``val/(1-test)``

    of the remainder, the rest for training; sizes are rounded half up. The
    assignment is a projection, so the table is not shuffled.
    """

    def ranks(total):
        n_test = F.floor(total * F.lit(test) + 0.5)
        n_val = F.floor((total - n_test) * F.lit(val / (1.0 - test)) + 0.5)
        return [n_test, n_test + n_val]

    cut = _with_cuts(df, ids, seed, label, ranks)
    split = (
        F.when(F.col("_md5") <= F.col("_cut_0"), "test")
        .when(F.col("_md5") <= F.col("_cut_1"), "val")
        .otherwise("train")
    )
    return cut.select(*df.columns, split.alias("split"))


def stratified_folds(
    df: DataFrame,
    k: int = 5,
    seed: int = 42,
    ids: Sequence[str] = ("row_id",),
    label: str = "label",
) -> DataFrame:
    """Column ``fold`` in 0..k-1, balanced within each class."""
    ranked = scale.number_by_hash(df, ids, seed, within=[label], out="_rn")
    return ranked.withColumn("fold", ((F.col("_rn") - 1) % k).cast("int")).drop("_rn")
