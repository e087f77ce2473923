"""Building blocks that keep results exact when one group holds most rows.

Everything that must number, order or take quantiles of a whole relation goes
through this module, so no operator has to put a class, a flow or the whole
table into one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: rows one task may sort without trouble
TASK_ROWS = 5_000_000
#: upper bound of the list of hot groups that is kept on the driver
MAX_HOT_GROUPS = 10_000
#: counters of the frequent-items sketch
SKETCH_ITEMS = 100_000
#: rows of a table that may be sent to every task
BROADCAST_ROWS = 100_000
#: most split points a range numbering uses
MAX_SPLITS = 20_000


def checked_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``limit`` rows, else as is.

    For tables with a row per class, cluster or file that meet a large table:
    the planner cannot know that an aggregate is small and would shuffle the
    large side by a key of which one value may hold most rows. The rows are
    fetched once, so the small table is not computed again.
    """
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def hot_groups(df: DataFrame, keys: Sequence[str], hot_rows: int = TASK_ROWS) -> list[int]:
    """Hashes of the key groups that hold more than ``hot_rows`` rows.

    One map-side combined pass with a frequent-items sketch: the state and the
    result are bounded (``MAX_HOT_GROUPS`` 64-bit values) whatever the number
    of groups. The sketch overlooks no group above ``rows / 75,000``. A wrong
    positive, like a hash collision, only splits a group that needed no split.
    """
    items = (
        df.select(F.xxhash64(*keys).alias("h"))
        .agg(F.expr(f"approx_top_k(h, {MAX_HOT_GROUPS}, {SKETCH_ITEMS})").alias("top"))
        .select(F.explode("top").alias("t"))
        .where(F.col("t.count") > F.lit(hot_rows))
        .select("t.item")
    )
    return [r[0] for r in items.collect()]


def mark_hot(df: DataFrame, keys: Sequence[str], hashes: Sequence[int], out: str) -> DataFrame:
    """Whether a row belongs to a hot group; ``hashes`` is the bounded list above."""
    listed = df.sparkSession.createDataFrame(
        [(int(h), True) for h in hashes], f"_hash long, {out} boolean"
    )
    marked = df.withColumn("_hash", F.xxhash64(*keys)).join(F.broadcast(listed), "_hash", "left")
    return marked.drop("_hash").withColumn(out, F.coalesce(out, F.lit(False)))


def seeded_hash(seed: int, *ids: str) -> Column:
    """A reproducible pseudo-random order, the same in every engine with md5."""
    return F.md5(F.concat(F.lit(f"{seed}:"), *[F.col(i).cast("string") for i in ids]))


def _split_points(df: DataFrame, order: str, target_rows: int) -> list[float]:
    n = df.count()
    buckets = min(math.ceil(n / target_rows), MAX_SPLITS)
    if buckets <= 1:
        return []
    probabilities = [i / buckets for i in range(1, buckets)]
    points = df.agg(
        F.percentile_approx(F.col(order).cast("double"), probabilities, 10 * buckets)
    ).first()[0]
    return sorted(set(points or []))


def range_bucket(df: DataFrame, order: str, out: str, target_rows: int = TASK_ROWS) -> DataFrame:
    """Add a bucket that grows with ``order`` and holds about ``target_rows`` rows."""
    points = _split_points(df, order, target_rows)
    if not points:
        return df.withColumn(out, F.lit(0))
    source = f"{out}__value"
    cut = Bucketizer(
        splits=[-math.inf, *points, math.inf], inputCol=source, outputCol=out
    )
    return cut.transform(df.withColumn(source, F.col(order).cast("double"))).drop(source)


def number_rows(
    df: DataFrame,
    order: str | Column,
    *,
    within: Sequence[str] = (),
    prefix: Sequence[str] = (),
    bucket: Column | None = None,
    target_rows: int = TASK_ROWS,
    out: str = "rn",
    total: str | None = None,
) -> DataFrame:
    """``row_number()`` over ``prefix, order`` within ``within``, from 1.

    ``order`` must be unique. Rows are numbered inside buckets that follow the
    order; the sizes of the preceding buckets are added from a small table of
    counts. ``bucket`` is any expression that never decreases with ``order``;
    without it, split points are taken from approximate quantiles. ``total``
    names an optional column with the number of rows of the ``within`` group.
    """
    order_col = F.col(order) if isinstance(order, str) else order
    if bucket is None:
        if not isinstance(order, str):
            raise ValueError("a bucket expression is needed when order is an expression")
        marked = range_bucket(df, order, "_bucket", target_rows)
    else:
        marked = df.withColumn("_bucket", bucket)
    # One struct key: NULL groups compare equal inside it, and the join and the
    # window below ask for the same hash partitioning, hence a single exchange.
    marked = marked.withColumn("_grp", F.struct(*within, *prefix, "_bucket")).drop("_bucket")
    whole = Window.partitionBy(*[F.col(f"_grp.{c}") for c in within])
    before = whole.orderBy(
        *[F.col(f"_grp.{c}") for c in prefix], F.col("_grp._bucket")
    ).rowsBetween(Window.unboundedPreceding, -1)
    columns = [F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")]
    if total:
        columns.append(F.sum("_n").over(whole).alias(total))
    offsets = (
        marked.groupBy("_grp").agg(F.count(F.lit(1)).alias("_n")).select("_grp", *columns)
    )
    local = F.row_number().over(Window.partitionBy("_grp").orderBy(order_col))
    return (
        marked.join(offsets, "_grp")
        .withColumn(out, (F.col("_before") + local).cast("long"))
        .drop("_grp", "_before")
    )


def number_by_hash(
    df: DataFrame,
    ids: Sequence[str],
    seed: int,
    *,
    within: Sequence[str] = (),
    digits: int = 4,
    out: str = "rn",
    total: str | None = None,
) -> DataFrame:
    """Number rows in the pseudo-random order of :func:`seeded_hash`.

    The leading hex digits are the buckets: 65,536 of equal expected size with
    four digits, whatever the sizes of the ``within`` groups.
    """
    hashed = df.withColumn("_md5", seeded_hash(seed, *ids))
    return number_rows(
        hashed,
        F.struct("_md5", *ids),
        within=within,
        bucket=F.substring("_md5", 1, digits),
        out=out,
        total=total,
    ).drop("_md5")


def hash_cuts(
    df: DataFrame,
    ids: Sequence[str],
    seed: int,
    ranks,
    *,
    within: str,
    digits: int = 4,
) -> DataFrame:
    """Hash values at given ranks of the pseudo-random order of each class.

    ``ranks(total)`` lists rank expressions, given the size of the class. The
    result has one row per class: the class as ``_class`` and ``_cut_0, ...``;
    a row is among the first ``rank`` ones exactly when its hash is not above
    the cut. Rows are only counted by class and hash prefix; those that share
    the prefix with a cut, one in 65,536, are ranked to find it. So choosing
    rows by rank needs no shuffle of the table.
    """
    hashed = df.select(
        F.struct(F.col(within).alias("c")).alias("_class"), seeded_hash(seed, *ids).alias("_md5")
    ).withColumn("_prefix", F.substring("_md5", 1, digits))
    whole = Window.partitionBy("_class")
    running = whole.orderBy("_prefix")
    counts = (
        hashed.groupBy("_class", "_prefix")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumns({"_upto": F.sum("_n").over(running), "_total": F.sum("_n").over(whole)})
    )
    wanted = ranks(F.col("_total"))
    n_cuts = len(wanted)
    placed = counts.select(
        "_class", "_prefix", "_n", "_upto", F.posexplode(F.array(*[r.cast("long") for r in wanted]))
    ).toDF("_class", "_prefix", "_n", "_upto", "_j", "_rank")
    targets = placed.where(
        (F.col("_rank") > F.col("_upto") - F.col("_n")) & (F.col("_rank") <= F.col("_upto"))
    ).select("_class", "_prefix", "_j", (F.col("_rank") - F.col("_upto") + F.col("_n")).alias("_local"))
    order = Window.partitionBy("_class", "_prefix", "_j").orderBy("_md5")
    found = (
        # a few rows per class: without the broadcast every row would be shuffled
        hashed.join(checked_broadcast(targets), ["_class", "_prefix"])
        .withColumn("_rn", F.row_number().over(order))
        .where(F.col("_rn") == F.col("_local"))
        .groupBy("_class")
        .agg(*[F.max(F.when(F.col("_j") == j, F.col("_md5"))).alias(f"_cut_{j}") for j in range(n_cuts)])
    )
    # nothing is below a rank of zero, everything below a rank beyond the class
    sizes = counts.groupBy("_class").agg(F.max("_total").alias("_total"))
    table = sizes.join(found, "_class", "left").select(
        F.col("_class.c").alias("_class"),
        *[
            F.when(r <= 0, F.lit("")).when(r > F.col("_total"), F.lit("g")).otherwise(F.col(f"_cut_{j}")).alias(f"_cut_{j}")
            for j, r in enumerate(wanted)
        ],
    )
    schema = table.schema
    return df.sparkSession.createDataFrame(table.collect(), schema)  # one row per class


# ---------------------------------------------------------------------------
# exact quantiles
# ---------------------------------------------------------------------------

#: values for which the built-in exact percentile (a map of all distinct
#: values in one buffer) is still the cheapest way
PERCENTILE_ROWS = 200_000
BRACKET_ACCURACY = 100_000
#: groups times columns times probabilities that may be fitted at once
BOUND_ROWS = 1_000_000


def exact_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probabilities: Sequence[float],
    by: str | None = None,
    small: int = PERCENTILE_ROWS,
    accuracy: int = BRACKET_ACCURACY,
    counts: dict | None = None,
) -> dict:
    """Exact quantiles with linear interpolation, NULL and NaN left out.

    Infinities are ordinary values at the ends of the order; between two equal
    ones lies the same infinity.

    Returns ``{column: [value, ...]}``, or ``{group: {column: [...]}}`` with
    ``by`` (a column of few values, such as a class label). The result holds a
    few numbers per column and is meant as fitted state. ``counts``, if given,
    receives the rows per group under ``None`` and the values per column.

    Small inputs take the built-in ``percentile``. On large ones that would
    keep every distinct value in one aggregation buffer, so a first pass
    brackets each quantile with a sketch and a second pass counts values
    exactly, but only those inside the brackets. Both give the same numbers.
    """
    cols, probabilities = list(cols), list(probabilities)
    floating = [c for c in cols if df.schema[c].dataType.typeName() in ("double", "float")]
    df = df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floating}) if floating else df
    groups = [by] if by else []
    margin = 2.0 / accuracy
    edges = [
        min(max(p + d, 0.0), 1.0) for p in probabilities for d in (-margin, margin)
    ]
    first = df.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(c).alias(f"n_{i}") for i, c in enumerate(cols)],
        *[
            F.percentile_approx(c, edges, accuracy).alias(f"e_{i}")
            for i, c in enumerate(cols)
        ],
    )
    brackets = first.collect()  # one row per class
    if counts is not None:
        counts[None] = sum(r["n"] for r in brackets)
        counts.update({c: sum(r[f"n_{i}"] for r in brackets) for i, c in enumerate(cols)})
    if max([r[f"n_{i}"] for r in brackets for i in range(len(cols))], default=0) <= small:
        exact = df.groupBy(*groups).agg(
            *[F.percentile(c, probabilities).alias(f"q_{i}") for i, c in enumerate(cols)]
        )
        found = {
            (r[by] if by else None): {c: r[f"q_{i}"] for i, c in enumerate(cols)}
            for r in exact.collect()
        }
    else:
        found = _refine(df, cols, probabilities, by, brackets, accuracy)
    for per_column in found.values():
        for c in cols:
            per_column[c] = per_column[c] or [None] * len(probabilities)
    return found if by else found.get(None, {c: [None] * len(probabilities) for c in cols})


def _refine(df, cols, probabilities, by, brackets, accuracy):
    """Second pass: rank arithmetic inside the brackets of the first."""
    spark = df.sparkSession
    cells = []
    for r in brackets:
        for i, c in enumerate(cols):
            n, edges = r[f"n_{i}"], r[f"e_{i}"]
            if not n:
                continue
            for j, p in enumerate(probabilities):
                lo, hi = float(edges[2 * j]), float(edges[2 * j + 1])
                if n <= 4 * accuracy:  # too few rows for the margin to span a rank
                    lo, hi = -math.inf, math.inf
                cells.append((r[by] if by else None, i, j, lo, hi, p * (n - 1)))
    by_type = df.schema[by].dataType.simpleString() if by else "string"
    bounds = spark.createDataFrame(
        cells, f"_g {by_type}, _c int, _p int, _lo double, _hi double, _pos double"
    )
    values = df.select(
        (F.col(by) if by else F.lit(None).cast("string")).alias("_v_g"),
        F.posexplode(F.array(*[F.col(c).cast("double") for c in cols])).alias("_v_c", "_v"),
    ).where(F.col("_v").isNotNull())
    # bounds: groups x columns x probabilities rows, a fitted-state sized table
    placed = values.join(
        checked_broadcast(bounds, BOUND_ROWS),
        F.col("_v_g").eqNullSafe(F.col("_g")) & (F.col("_v_c") == F.col("_c")),
    ).where(F.col("_v") <= F.col("_hi"))
    # everything below a bracket collapses into one counter
    counted = (
        placed.withColumn("_in", F.when(F.col("_v") >= F.col("_lo"), F.col("_v")))
        .groupBy("_g", "_c", "_p", "_pos", "_in")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    running = Window.partitionBy("_g", "_c", "_p").orderBy(F.col("_in").asc_nulls_first())
    ranked = counted.withColumn("_upto", F.sum("_n").over(running)).where(
        F.col("_in").isNotNull()
    )

    def at(rank):
        return F.min(F.when(F.col("_upto") > rank, F.col("_in")))

    picked = ranked.groupBy("_g", "_c", "_p", "_pos").agg(
        at(F.floor("_pos")).alias("lo"), at(F.ceil("_pos")).alias("hi")
    )
    found: dict = {(r[by] if by else None): {c: None for c in cols} for r in brackets}
    for r in picked.collect():  # one row per fitted number
        slots = found[r["_g"]]
        name = cols[r["_c"]]
        if slots[name] is None:
            slots[name] = [None] * len(probabilities)
        share = r["_pos"] - math.floor(r["_pos"])
        slots[name][r["_p"]] = r["lo"] if share == 0 or r["lo"] == r["hi"] else r["lo"] + (r["hi"] - r["lo"]) * share
    return found
