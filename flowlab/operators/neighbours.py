"""Exact nearest neighbours: cells, a growing reach and a certificate per point.

Points are mapped to a few coordinates by a map that lengthens no distance: the
leading principal axes and, as one more coordinate, the length of what the axes
leave out. A k-d tree over these coordinates cuts the fitted points into cells
of bounded size, each with the bounding box of its points.

A point visits the cells in the order of their boxes' distance, a few more in
every round. It is settled when its k-th distance is at most the distance of
the next box: no unseen cell can hold a nearer point. Settled points leave, so
later rounds carry only those that need them. Pairs are never written; a visit
returns at most ``k`` fitted points, and the state of a point is its ``k``
nearest so far and the number of cells it has seen.

Equal vectors are one point with a count, on both sides, so copies cost nothing.
The tree comes from a bounded sample (``SAMPLE_POINTS``) and holds at most
``MOST_CELLS`` cells; both decide the balance alone. Cells with more points than
``cell_rows``, and visits of a cell beyond ``VISIT_ROWS``, are cut into parts
that meet in tasks of their own.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlab.session import cut_lineage

#: fitted points of a cell
CELL_ROWS = 4_096
#: cells of points with many coordinates, and most fitted points of one
WIDE_CELLS, WIDE_ROWS = 32, 16_384
#: visits of a cell that one task answers
VISIT_ROWS = 8_192
#: cells of a tree; their boxes go to every task (8 coordinates: 8 MB)
MOST_CELLS = 65_536
#: points from which the tree is built on the driver
SAMPLE_POINTS = 200_000
#: principal axes the cells are cut along
AXES = 6
#: cells of the first rounds; a round takes four times as many as the one before
FIRST_CELLS, GROWTH = 1, 4
#: a vector with more than this share of the rows is joined in parts
HOT_SHARE = 1 / 10_000


def nearest(
    queries: DataFrame,
    fitted: DataFrame,
    k: int = 1,
    *,
    carry: Sequence[str] = (),
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """The ``k`` nearest fitted points of every query.

    Both inputs have ``id`` and ``vec`` (``array<double>``, equally long). The
    result has the columns of ``queries``, ``near`` (at most ``k`` structs of
    distance ``d``, smallest ``id`` of the fitted vector, its number of copies
    ``n`` and its ``carry`` columns, by distance, then id) and ``radius``, the
    distance within which ``k`` fitted points lie, copies counted; ``near`` holds
    nothing beyond it.

    ``radius`` is NULL where fewer than ``k`` points are fitted. Vectors that
    are NULL or hold NULL, NaN or infinite values are compared with nothing:
    such queries have ``near`` NULL. Repeated ids are rows of their own.
    """
    known = _distinct(fitted.where(_finite("vec")), carry)
    asked = queries.where(_finite("vec")).groupBy("vec").agg(F.count(F.lit(1)).alias("_copies"))
    known = cut_lineage(known)
    size = known.count()
    cell_rows = _wide_cells(known, size, cell_rows)
    names = ["d", "id", "n", *carry]
    types = {"d": "double", "n": "bigint"} | {c: known.schema[c].dataType.simpleString() for c in ["id", *carry]}
    near_type = f"array<struct<{','.join(f'`{c}`:{types[c]}' for c in names)}>>"
    if size == 0:
        nothing = queries.withColumn("near", F.when(_finite("vec"), F.array().cast(near_type)))
        return nothing.withColumn("radius", F.lit(None).cast("double"))

    place = _map(known)
    cells = _Cells(known.withColumn("_at", place(F.col("vec"))), size, cell_rows)
    stored = cut_lineage(cells.place(known.withColumn("_at", place(F.col("vec"))).select("vec", "id", "n", *carry, "_at")))
    cells.measure(stored)

    state = asked.select(
        F.monotonically_increasing_id().alias("_q"), "vec", "_copies", place(F.col("vec")).alias("_at"),
        F.array().cast(near_type).alias("near"), F.lit(0).alias("_seen"),
    )
    settled, step = [], FIRST_CELLS
    while True:
        state = cut_lineage(state.withColumn("radius", _radius(k)).withColumn("_visits", cells.visits(step)))
        # a struct beyond the radius was met on the way; nearer ones may be unseen
        within = F.filter("near", lambda x: F.col("radius").isNull() | (x["d"] <= F.col("radius")))
        settled.append(state.where(F.size("_visits") == 0).select("vec", within.alias("near"), "radius", "_copies"))
        active = state.where(F.size("_visits") > 0)
        if active.isEmpty():
            break
        found = _meet(active, stored, cells, k, names, types)
        merged = F.slice(F.array_sort(F.concat("near", F.coalesce("_found", F.array().cast(near_type)))), 1, k)
        state = (
            active.join(found, "_q", "left")
            .withColumn("near", merged)
            .withColumn("_seen", F.col("_seen") + F.size("_visits"))
            .drop("_found", "_visits", "radius")
        )
        step *= GROWTH
    answers = settled[0]
    for more in settled[1:]:
        answers = answers.unionByName(more)
    return _joined(queries, cut_lineage(answers))


def _wide_cells(known: DataFrame, size: int, cell_rows: int) -> int:
    """With many coordinates, where few cells can be excluded, cells grow with the
    points up to ``WIDE_ROWS``: a query is sent to fewer of them."""
    if size and known.select(F.size("vec")).first()[0] > AXES + 1:
        return max(cell_rows, min(WIDE_ROWS, math.ceil(size / WIDE_CELLS)))
    return cell_rows


def _finite(vec: str) -> Column:
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf)))
    return F.col(vec).isNotNull() & ~F.coalesce(bad, F.lit(False))


def _distinct(fitted: DataFrame, carry: Sequence[str]) -> DataFrame:
    """One row per vector: its smallest id with the columns of that row, and its copies."""
    first = F.min(F.struct("id", *carry)).alias("_first")
    return fitted.groupBy("vec").agg(first, F.count(F.lit(1)).alias("n")).select("vec", "_first.*", "n")


def _radius(k: int) -> Column:
    """Distance at which the copies of ``near`` reach ``k``."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("double").alias("d"))

    def add(s, x):
        reached = s["n"] >= F.lit(k)
        return F.struct(
            (s["n"] + x["n"]).alias("n"),
            F.when(reached, s["d"]).when(s["n"] + x["n"] >= F.lit(k), x["d"]).alias("d"),
        )

    return F.aggregate("near", start, add, lambda s: s["d"])


# --- the map and the cells -------------------------------------------------------

def _map(known: DataFrame):
    """Expression of the coordinates the cells are cut along; lengthens no
    distance but for rounding, for which :class:`_Cells` leaves room."""
    dims = known.select(F.size("vec")).first()[0]
    if dims <= AXES + 1:
        return lambda vec: vec
    points = known.select(array_to_vector("vec").alias("v"))
    axes = PCA(k=AXES, inputCol="v", outputCol="p").fit(points).pc.toArray()

    @F.pandas_udf("array<double>")
    def coordinates(vec: pd.Series) -> pd.Series:
        x = np.array(vec.tolist(), dtype=np.float64).reshape(len(vec), dims)
        on = x @ axes
        rest = np.sqrt(np.square(x - on @ axes.T).sum(axis=1))
        return pd.Series(list(np.column_stack([on, rest])))

    return coordinates


class _Cells:
    """A k-d tree over the mapped points and the boxes of its cells."""

    def __init__(self, placed: DataFrame, size: int, cell_rows: int):
        parallel = placed.sparkSession.sparkContext.defaultParallelism
        wanted = max(math.ceil(size / cell_rows), min(parallel, math.ceil(size / 256)))
        self.cell_rows = cell_rows
        share = min(1.0, 0.9 * SAMPLE_POINTS / size)
        sample = placed.select("_at") if share >= 0.9 else placed.select("_at").sample(share, seed=42)
        rows = sample.limit(SAMPLE_POINTS).collect()
        points = np.array([r[0] for r in rows], dtype=np.float64).reshape(len(rows), -1)
        self.tree: list[tuple[int, float, int, int]] = []  # axis, border, nodes below; axis -1: a cell
        self._grow(points, min(wanted, MOST_CELLS))
        self.spark = placed.sparkSession

    def _grow(self, points: np.ndarray, cells: int) -> int:
        node = len(self.tree)
        self.tree.append((-1, 0.0, -1, -1))
        if cells < 2 or len(points) < 2:
            return node
        spread = points.max(axis=0) - points.min(axis=0)
        axis = int(spread.argmax())
        if not spread[axis] > 0:
            return node
        left = cells // 2
        values = np.sort(points[:, axis])
        border = values[min(len(values) - 1, max(1, len(values) * left // cells))]
        below = points[:, axis] < border
        if not below.any():  # equal values at the low end
            border = values[np.searchsorted(values, border, side="right")] if values[-1] > border else border
            below = points[:, axis] < border
        low = self._grow(points[below], left)
        high = self._grow(points[~below], cells - left)
        self.tree[node] = (axis, float(border), low, high)
        return node

    def place(self, points: DataFrame) -> DataFrame:
        """Column ``_cell``: the leaf of each point."""
        shared = self.spark.sparkContext.broadcast(np.array(self.tree, dtype=np.float64))

        @F.pandas_udf("int")
        def leaf(at: pd.Series) -> pd.Series:
            tree = shared.value
            axis, low, high = tree[:, 0].astype(int), tree[:, 2].astype(int), tree[:, 3].astype(int)
            x = np.array(at.tolist(), dtype=np.float64).reshape(len(at), -1)
            node = np.zeros(len(x), dtype=int)
            rows = np.arange(len(x))
            while True:
                inner = axis[node] >= 0
                if not inner.any():
                    return pd.Series(node.astype(np.int32))
                below = x[rows, np.maximum(axis[node], 0)] < tree[node, 1]
                node = np.where(inner, np.where(below, low[node], high[node]), node)

        return points.withColumn("_cell", leaf("_at"))

    def measure(self, stored: DataFrame) -> None:
        """Boxes and sizes of the cells that hold points, at most ``MOST_CELLS`` rows."""
        axes = range(len(stored.select("_at").first()[0]))
        on = [F.element_at("_at", i + 1) for i in axes]
        rows = (
            stored.groupBy("_cell")
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.array(*[F.min(c) for c in on]).alias("low"),
                F.array(*[F.max(c) for c in on]).alias("high"),
            )
            .orderBy("_cell")
            .collect()
        )
        self.numbers = np.array([r["_cell"] for r in rows], dtype=np.int32)
        self.low = np.array([r["low"] for r in rows])
        self.high = np.array([r["high"] for r in rows])
        self.parts = {r["_cell"]: math.ceil(r["n"] / self.cell_rows) for r in rows}
        # rounding of the mapped coordinates is far below this share of the largest
        largest = max(np.abs(self.low).max(), np.abs(self.high).max())
        self.slack = 1e-11 * largest * len(axes)

    def visits(self, step: int) -> Column:
        """The next ``step`` cells that may hold a nearer point; none: settled."""
        shared = self.spark.sparkContext.broadcast((self.numbers, self.low, self.high, self.slack))

        @F.pandas_udf("array<int>")
        def chosen(at: pd.Series, radius: pd.Series, seen: pd.Series) -> pd.Series:
            numbers, low, high, slack = shared.value
            x = np.array(at.tolist(), dtype=np.float64).reshape(len(at), -1)
            reach = radius.to_numpy(dtype=np.float64, na_value=np.nan)
            reach = np.where(np.isnan(reach), np.inf, reach)
            done, out = seen.to_numpy(), []
            for start in range(0, len(x), 64):
                part = x[start : start + 64, None, :]
                outside = np.maximum(np.maximum(low - part, part - high), 0.0)
                gap = np.sqrt(np.square(outside).sum(axis=2)) * (1 - 1e-9) - slack
                order = np.argsort(gap, axis=1, kind="stable")
                for i, row in enumerate(order):
                    at_row = start + i
                    following = row[done[at_row] : done[at_row] + step]
                    out.append(numbers[following[gap[i, following] <= reach[at_row]]])
            return pd.Series(out)

        return chosen("_at", "radius", "_seen")


# --- a round ---------------------------------------------------------------------

def _meet(active: DataFrame, stored: DataFrame, cells: _Cells, k: int, names: list[str], types: dict[str, str]) -> DataFrame:
    """``_q`` and ``_found``: the nearest points of the visited cells, at most
    ``k`` of each part of a cell."""
    visits = active.select("_q", "vec", "radius", F.explode("_visits").alias("_cell"))
    counts = visits.groupBy("_cell").count().collect()  # at most MOST_CELLS rows
    sides = [(r["_cell"], cells.parts[r["_cell"]], math.ceil(r["count"] / VISIT_ROWS)) for r in counts]
    parts = F.broadcast(active.sparkSession.createDataFrame(sides, "_cell int, _fitted int, _asking int"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - F.lit(1)))
    keys = ["_cell", "_i", "_j"]
    left = (
        visits.join(parts, "_cell")
        .withColumn("_i", F.pmod(F.xxhash64("_q"), F.col("_asking")).cast("int"))
        .withColumn("_j", every("_fitted"))
        .select(*keys, "_q", "vec", "radius")
    )
    payload = [c for c in names if c != "d"]
    right = (
        stored.join(parts, "_cell")
        .withColumn("_j", F.pmod(F.xxhash64("vec"), F.col("_fitted")).cast("int"))
        .withColumn("_i", every("_asking"))
        .select(*keys, F.col("vec").alias("p_vec"), *[F.col(c).alias(f"p_{c}") for c in payload])
    )

    def lists(values: list) -> pd.Series:
        # without any, pandas would take the column for numbers, which Arrow refuses as lists
        return pd.Series(values, dtype=object)

    def closest(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame({"_q": a["_q"][:0]} | {f"p_{c}": lists([]) for c in names})
        b = b.sort_values("p_id")
        x, y = (np.array(v.tolist(), dtype=np.float64) for v in (a["vec"], b["p_vec"]))
        columns = {c: b[f"p_{c}"].to_numpy() for c in payload}
        reach = a["radius"].to_numpy(dtype=np.float64, na_value=np.inf)
        reach = np.where(np.isnan(reach), np.inf, reach)
        out = {f"p_{c}": [] for c in names}
        asked = []
        for start in range(0, len(x), 256):
            for row, at, d in _nearer(x[start : start + 256], y, k, reach[start : start + 256]):
                asked.append(start + row)
                out["p_d"].append(d)
                for c in payload:
                    out[f"p_{c}"].append(columns[c][at])
        return pd.DataFrame({"_q": a["_q"].to_numpy()[asked]} | {c: lists(v) for c, v in out.items()})

    schema = "_q long, " + ", ".join(f"`p_{c}` array<{types[c]}>" for c in names)
    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(closest, schema)
    zipped = F.arrays_zip(*[F.col(f"p_{c}").alias(c) for c in names])
    return met.groupBy("_q").agg(F.flatten(F.collect_list(zipped)).alias("_found"))  # k structs a visit


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    total = np.zeros((len(a), len(b)))
    for i in range(a.shape[1]):
        gap = a[:, i][:, None] - b[:, i][None, :]
        total += gap * gap
    return np.sqrt(total)


def _nearer(x: np.ndarray, y: np.ndarray, k: int, reach: np.ndarray):
    """Row, positions and distances of the at most ``k`` nearest of ``y`` within
    ``reach`` of each row that has any, by distance, earlier positions on ties.

    With many coordinates a matrix product, allowing for its rounding, says which
    pairs can count; the distances are those of the differences.
    """
    m = min(k, len(y))
    if x.shape[1] <= 8:
        d = _distances(x, y)
        for row, at in enumerate(_first(d, m)):
            at = at[d[row, at] <= reach[row]]
            if len(at):
                yield row, at, d[row, at]
        return
    with np.errstate(over="ignore", invalid="ignore"):
        square_x, square_y = (x * x).sum(axis=1), (y * y).sum(axis=1)
        slack = 4e-16 * (x.shape[1] + 8) * (square_x + square_y.max())
        # (d^2 - x^2) / 2
        half = x @ y.T
        np.subtract(0.5 * square_y, half, out=half)
        limit = 0.5 * (np.square(reach) * (1 + 1e-12) + slack - square_x)
        far = np.flatnonzero(~np.isfinite(reach))
        if len(far):  # nothing is known of these yet
            last = np.partition(half[far], m - 1, axis=1)[:, m - 1]
            limit[far] = last + slack[far]
        i, j = np.nonzero(~(half > limit[:, None]))
    total = np.zeros(len(i))
    for c in range(x.shape[1]):
        gap = x[i, c] - y[j, c]
        total += gap * gap
    d = np.sqrt(total)
    order = np.lexsort((j, d, i))
    i, j, d = i[order], j[order], d[order]
    cuts = np.flatnonzero(np.append(True, i[1:] != i[:-1])) if len(i) else []
    for start, end in zip(cuts, [*cuts[1:], len(i)]):
        row = int(i[start])
        near = slice(start, min(end, start + m))
        at, gaps = j[near], d[near]
        at, gaps = at[gaps <= reach[row]], gaps[gaps <= reach[row]]
        if len(at):
            yield row, at, gaps


def _first(d: np.ndarray, m: int) -> np.ndarray:
    """Columns of the ``m`` smallest of each row, in order, earlier columns on ties."""
    if m == 1:
        return d.argmin(axis=1)[:, None]
    last = np.partition(d, m - 1, axis=1)[:, m - 1]
    tied = (d <= last[:, None]).sum(axis=1) > m
    at = np.sort(np.argpartition(d, m - 1, axis=1)[:, :m], axis=1)
    at = np.take_along_axis(at, np.argsort(np.take_along_axis(d, at, 1), axis=1, kind="stable"), 1)
    if tied.any():
        at[tied] = np.argsort(d[tied], axis=1, kind="stable")[:, :m]
    return at


def _joined(queries: DataFrame, answers: DataFrame) -> DataFrame:
    """Rows with the answer of their vector; vectors with many rows in parts."""
    total = answers.agg(F.sum("_copies")).first()[0] or 0
    hot_rows = max(CELL_ROWS, math.ceil(total * HOT_SHARE))
    parts = F.ceil(F.col("_copies") / F.lit(hot_rows)).cast("int")
    # less than 1 / HOT_SHARE rows
    hot = answers.where(F.col("_copies") > hot_rows).select(F.col("vec").alias("_hot"), parts.alias("_parts"))
    marked = queries.join(F.broadcast(hot), F.col("vec") == F.col("_hot"), "left").withColumn(
        "_part", F.floor(F.rand(42) * F.coalesce("_parts", F.lit(1))).cast("int")
    )
    spread = answers.select(
        F.col("vec").alias("_vec"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("_of"), "near", "radius"
    )
    same = (F.col("vec") == F.col("_vec")) & (F.col("_part") == F.col("_of"))
    return marked.join(spread, same, "left").select(*queries.columns, "near", "radius")
