"""Embedding near-duplicates: an exact range join in a metric space.

Vectors are scaled to length one, where cosine >= t means a Euclidean distance
of at most ``sqrt(2 - 2 t)``. Pivots cut the space into cells: every vector is
at home in the cell of its nearest pivot. By the triangle inequality a vector
``x`` can only have partners at home in cell ``i`` if

* ``d(x, p_i) <= d(x, p_home) + 2 r``, and
* ``d(x, p_i) <= radius_i + r``, where the cell's radius is the largest
  distance of its home vectors from the pivot;

it is copied to exactly these cells. Copies only answer; each vector is
counted in its home cell, against all that could be its partners, so every
link is found once on each side and cells join without knowing of each other.

Equal vectors are one point with a multiplicity from the start. Crowded cells
are cut into parts whose pairs are joined separately. A task returns the number
of partners per point and a spanning forest of the links, never all pairs.

Pivots are chosen from a bounded sample (``PIVOT_SAMPLE``); they decide where
work is done, not what is found.

Defined results: vectors that are null, of length zero, or hold null or
non-finite components, and of another dimension than the partner, link with
nothing: no links, their own component. Rows with equal ids are separate
vectors with one id. A null id links like any other; its component is null if
it has no smaller one. An empty table gives an empty result. Only ``key`` and
``vector`` are read, so other columns cannot clash.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlab.llm.common import stored
from flowlab.operators.clustering import connected_components
from flowlab.operators.scale import checked_broadcast

COSINE = 0.95
#: vectors that pivots are chosen from
PIVOT_SAMPLE = 20_000
#: home vectors a cell should have; the number of pivots follows
CELL_ROWS = 8_192
MOST_PIVOTS = 1_024
#: points of one part of a crowded cell
PART_ROWS = 16_384
#: vectors that are dealt, and rows of a cell that are compared, at once
STEP = 256
#: slack of a distance for rounding
SLACK = 1e-7


def points_of(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """``_row``, ``_key`` and ``_raw``: the components as bytes, behind their
    width; null if the vector links with nothing."""
    single = rows.schema[vector].dataType.simpleString() == "array<float>"
    source = rows.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col(key).alias("_key"),
        (F.col(vector) if single else F.col(vector).cast("array<double>")).alias("v"),
    )
    kind = source.schema["_key"].dataType.simpleString()
    width, tag = ("<f4", b"4") if single else ("<f8", b"8")

    def pack(batches):
        for batch in batches:
            packed = []
            for value in batch.column(2).to_pylist():
                raw = None
                if value and None not in value:
                    v = np.array(value, dtype=width)
                    if np.isfinite(v).all() and v.any():
                        raw = tag + v.tobytes()
                packed.append(raw)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["_row", "_key", "_raw"])

    return source.mapInArrow(pack, f"_row long, _key {kind}, _raw binary")


def units(packed: list[bytes]) -> np.ndarray:
    """Vectors of length one in double precision; all of one dimension."""
    x = np.array([np.frombuffer(p, "<f" + p[:1].decode(), offset=1) for p in packed], dtype=np.float64)
    # a power of two first: squares neither overflow nor vanish
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def choose_pivots(points: DataFrame, n: int) -> np.ndarray:
    """Pivots for ``n`` vectors of one dimension: far apart in a sample chosen
    by hash, then moved to the middle of what they are nearest to."""
    wanted = int(min(MOST_PIVOTS, max(1, math.ceil(n / CELL_ROWS))))
    sample = points.select("_raw").orderBy(F.xxhash64("_raw"), "_raw").limit(PIVOT_SAMPLE).collect()
    x = units([bytes(r[0]) for r in sample])
    chosen = [0]
    nearest = x @ x[0]
    while len(chosen) < min(wanted, len(x)):
        at = int(nearest.argmin())
        if nearest[at] > 1 - 1e-9:
            break
        chosen.append(at)
        nearest = np.maximum(nearest, x @ x[at])
    pivots = x[chosen]
    for _ in range(4):  # means of the sample's cells, back on the sphere
        home = (x @ pivots.T).argmax(axis=1)
        sums = np.zeros_like(pivots)
        np.add.at(sums, home, x)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        pivots = np.where(length > 1e-9, sums / np.maximum(length, 1e-9), pivots)
    return pivots


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1)[None, :] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def _cells(points: DataFrame, pivots: np.ndarray, reach: float) -> DataFrame:
    """``_point, _raw, _n, cell, home``: each point in its cell and, as a
    copy, in all cells that may hold partners."""
    shared = points.sparkSession.sparkContext.broadcast(pivots)

    def steps(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                d = _distances(units(part.column("_raw").to_pylist()), shared.value)
                yield part, d, d.argmin(axis=1)

    def homes(batches):
        for _, d, home in steps(batches):
            yield pa.RecordBatch.from_arrays([pa.array(home), pa.array(d[np.arange(len(home)), home])], names=["cell", "d"])

    radius = np.full(len(pivots), -1.0)
    for r in points.select("_raw").mapInArrow(homes, "cell long, d double").groupBy("cell").agg(F.max("d").alias("d")).collect():
        radius[r.cell] = r.d  # one row per pivot

    def deal(batches):
        for part, d, home in steps(batches):
            own = d[np.arange(len(home)), home][:, None]
            near = (d <= own + 2 * reach + SLACK) & (d <= radius[None, :] + reach + SLACK)
            near[np.arange(len(home)), home] = True
            row, cell = np.nonzero(near)
            out = part.take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.array(cell), pa.array(cell == home[row])], names=[*part.schema.names, "cell", "home"]
            )

    return points.select("_point", "_raw", "_n").mapInArrow(deal, "_point long, _raw binary, _n long, cell long, home boolean")


def _parted(dealt: DataFrame) -> DataFrame:
    """Cells as tasks: a crowded cell becomes a task per pair of parts of its
    home points and of all its points."""
    counts = dealt.groupBy("cell").agg(F.sum(F.col("home").cast("int")).alias("h"), F.count(F.lit(1)).alias("m"))
    parts = counts.select("cell", F.ceil(F.col("h") / PART_ROWS).cast("int").alias("hp"), F.ceil(F.col("m") / PART_ROWS).cast("int").alias("mp"))
    known = dealt.join(checked_broadcast(parts), "cell")
    tag = lambda a, b: F.struct(F.col("cell").alias("c"), a.alias("a"), b.alias("b"))
    part = lambda n: F.pmod(F.xxhash64("_point"), F.greatest(F.col(n), F.lit(1))).cast("int")
    asks = known.where("home").withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("mp") - 1)))
    asks = asks.select(tag(part("hp"), F.col("_other")).alias("task"), "_point", "_raw", "_n", F.lit(True).alias("asks"))
    answers = known.where("hp > 0").withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("hp") - 1)))
    answers = answers.select(tag(F.col("_other"), part("mp")).alias("task"), "_point", "_raw", "_n", F.lit(False).alias("asks"))
    return asks.unionByName(answers)


def _join_cell(cosine: float):
    def join(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy(zero_copy_only=False)
        point, n = table.column("_point").to_numpy(), table.column("_n").to_numpy()
        a, b = np.flatnonzero(asks), np.flatnonzero(~asks)
        unit = units(table.column("_raw").to_pylist()) if len(asks) else np.zeros((0, 1))
        asking, answering = unit[a], unit[b].T
        partners = np.zeros(len(a), np.int64)
        u, v = [], []
        root = np.arange(len(b))  # groups of the answers that are joined so far
        place = {p: i for i, p in enumerate(point[b].tolist())}
        for start in range(0, len(a), STEP):
            near = asking[start : start + STEP] @ answering >= cosine
            row, found = np.nonzero(near)
            partners[start : start + STEP] = np.bincount(row, weights=n[b[found]], minlength=len(near)).astype(np.int64)
            cuts = np.searchsorted(row, np.arange(len(near) + 1))
            # a point whose only partner is itself joins nothing
            for i in np.flatnonzero(np.diff(cuts)).tolist():
                partner = found[cuts[i] : cuts[i + 1]]
                me = int(point[a[start + i]])
                if len(partner) == 1 and point[b[partner[0]]] == me:
                    continue
                groups, first = np.unique(root[partner], return_index=True)
                own = place.get(me, -1)
                for g, k in zip(groups.tolist(), first.tolist()):
                    other = int(point[b[partner[k]]])
                    if other != me and (own < 0 or root[own] != g):
                        u.append(me)
                        v.append(other)
                if len(groups) > 1:
                    root[np.isin(root, groups)] = groups[0]
        return pa.table(
            {
                "_point": pa.array(np.concatenate([point[a], np.array(u, np.int64)]), pa.int64()),
                "partners": pa.array(np.concatenate([partners, np.zeros(len(u), np.int64)]), pa.int64()),
                "other": pa.array([None] * len(a) + v, pa.int64()),
            }
        )

    return join


def range_join(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """``key``, n_links, component_id, kept of each row."""
    reach = math.sqrt(max(2 - 2 * cosine, 0))
    all_rows = stored(points_of(rows, key, vector), "vectors")
    usable = all_rows.where(F.col("_raw").isNotNull())
    distinct = stored(
        usable.groupBy("_raw").agg(F.count(F.lit(1)).alias("_n"), F.min("_key").alias("_least"), F.min("_row").alias("_point")), "distinct"
    )
    widths = distinct.groupBy(F.length("_raw").alias("w")).agg(F.count(F.lit(1)).alias("n")).collect()  # one row per dimension
    answered = None
    for width, n in sorted(tuple(w) for w in widths):
        same = distinct.where(F.length("_raw") == width)
        dealt = _cells(same, choose_pivots(same, n), reach)
        part = _parted(dealt).groupBy("task").applyInArrow(_join_cell(cosine), "_point long, partners long, other long")
        answered = part if answered is None else answered.unionByName(part)
    kind = all_rows.schema["_key"].dataType.simpleString()
    if answered is None:
        answered = rows.sparkSession.createDataFrame([], "_point long, partners long, other long")
    answered = stored(answered, "answers")
    counted = answered.where("other is null").groupBy("_point").agg(F.sum("partners").alias("partners"))
    edges = stored(
        answered.where("other is not null")
        .select(F.greatest("_point", "other").alias("u"), F.least("_point", "other").alias("v"))
        .distinct(),
        "vector-links",
    )
    nodes = edges.select(F.col("u").alias("node")).union(edges.select("v")).distinct()
    roots = connected_components(nodes, edges)
    named = distinct.join(roots.select(F.col("node").alias("_point"), "root"), "_point", "left").withColumn(
        "root", F.coalesce("root", "_point")
    )
    least = named.groupBy("root").agg(F.min("_least").alias("_component"))
    classes = named.join(least, "root").join(counted, "_point", "left").select("_raw", "_component", "partners")
    salts = 8
    spread = classes.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    out = all_rows.withColumn("_salt", F.pmod(F.xxhash64("_row"), F.lit(salts)).cast("int")).join(spread, ["_raw", "_salt"], "left")
    return out.select(
        F.col("_key").alias(key),
        F.when(F.col("_raw").isNull(), F.lit(0)).otherwise(F.coalesce("partners", F.lit(1)) - 1).cast("long").alias("n_links"),
        F.when(F.col("_raw").isNull(), F.col("_key")).otherwise(F.col("_component")).cast(kind).alias("component_id"),
        F.when(F.col("_raw").isNull(), F.lit(True)).otherwise(F.col("_key").eqNullSafe(F.col("_component"))).alias("kept"),
    )
