"""K-means for many numbers of clusters and many starts in the same passes.

A pass over the points assigns them to the centres of every run at once: the
centres of all runs are one matrix, a task returns the sums of its points per
centre, and Spark adds them up. Runs leave the matrix when their centres rest.
Starts are chosen by k-means|| over all points (Bahmani et al., 2012), also for
all runs at once, with weighted draws without replacement in place of
independent ones: a start draws once and serves all numbers of clusters.

The driver holds the centres of the runs and the candidates of the starts; both
are parameters of the call and do not grow with the points.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlab.operators import distances as D
from flowlab.session import stored
from flowlab.sources import files

#: rows that meet all centres at once: their distances should fit a core's cache
BLOCK_ROWS = 256
#: rows of a packed row of the table the passes read, and bytes of points of a task
PACKED_ROWS, TASK_BYTES = 2_048, 256 << 20
#: points whose silhouettes a task finds at once
OWN_ROWS = 8_192
#: rounds of draws, and draws per round for each wanted cluster
ROUNDS, DRAWS = 2, 2


@dataclass
class KMeansFit:
    """Centres of one run, its cost (sum of squared distances) and how it came."""

    centres: list[list[float]]
    cost: float
    start: int = 0
    iterations: int = 0
    sizes: list[int] = field(default_factory=list)

    def clusterCenters(self) -> list[np.ndarray]:  # noqa: N802 (name of the Spark ML models)
        return [np.array(c) for c in self.centres]

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``cluster``, the nearest centre to ``features`` (the first on ties)."""
        centres = np.array(self.centres)

        @F.pandas_udf("int")
        def nearest(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype="int32")
            points = np.array(x.tolist(), dtype=np.float64)
            out = [
                ((points[i : i + 512, None, :] - centres) ** 2).sum(axis=2).argmin(axis=1)
                for i in range(0, len(points), 512)
            ]
            return pd.Series(np.concatenate(out).astype(np.int32))

        return df.withColumn("cluster", nearest(vector_to_array("features")))

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> KMeansFit:
        return KMeansFit(**json.loads(text))


def fit_all(
    df: DataFrame,
    ks: Sequence[int],
    n_init: int = 20,
    max_iter: int = 500,
    seed: int = 42,
    tol: float = 1e-4,
) -> dict[tuple[int, int], KMeansFit]:
    """A fit for every k and start; ``df`` has ``features``.

    A fit has the centres of its last pass and the cost that this pass found
    for them. A run ends when its centres move by less than ``tol`` times the mean
    variance of the features (squared and summed), or after ``max_iter`` passes.
    """
    if df.select("features").first() is None:
        raise ValueError("no points")
    found = df.select(
        Summarizer.metrics("mean", "variance", "count").summary(F.col("features")).alias("s")
    ).first()["s"]
    origin, limit = found["mean"].toArray(), tol * found["variance"].toArray().mean()
    points = _packed(df, found["count"], len(origin)).persist()
    try:
        ks = sorted(set(ks))
        centres = _starts(points, origin, ks, n_init, seed)
        fits: dict[tuple[int, int], KMeansFit] = {}
        moving = list(centres)
        for iteration in range(1, max_iter + 1):
            sums, sizes, costs = _assign(points, origin, [centres[r] for r in moving])
            still = []
            for run, total, size, cost in zip(moving, sums, sizes, costs):
                # a centre without points stays
                new = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], centres[run])
                shift = float(((new - centres[run]) ** 2).sum())
                fits[run] = KMeansFit((centres[run] + origin).tolist(), cost, run[1], iteration, size.astype(int).tolist())
                centres[run] = new
                if shift > limit:
                    still.append(run)
            moving = still
            if not moving:
                break
        return fits
    finally:
        points.unpersist()


def best_fits(fits: dict[tuple[int, int], KMeansFit]) -> dict[int, KMeansFit]:
    """Of every k the cheapest run, the first on ties."""
    out: dict[int, KMeansFit] = {}
    for (k, _), fit in sorted(fits.items()):
        if k not in out or fit.cost < out[k].cost:
            out[k] = fit
    return out


# --- passes --------------------------------------------------------------------------

def _packed(df: DataFrame, n: int, dims: int) -> DataFrame:
    """The points in even partitions, as few as there are cores unless they grow
    too large, as rows of many points: every pass reads them and returns sums per
    task. Files and row groups of the input do not decide how the passes are dealt.
    """
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(8 * n * dims / TASK_BYTES))

    def pack(batches):
        for batch in batches:
            values = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            blocks = [values[i : i + PACKED_ROWS].tobytes() for i in range(0, len(values), PACKED_ROWS)]
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.binary())], ["block"])

    dealt = df.select(vector_to_array("features").alias("vec")).repartition(tasks)
    return dealt.mapInArrow(pack, "block binary")


def _unpacked(points: DataFrame, dims: int) -> DataFrame:
    def unpack(batches):
        for batch in batches:
            for block in batch.column(0):
                values = pa.array(np.frombuffer(block.as_buffer()))
                ends = pa.array(np.arange(0, len(values) + 1, dims, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(ends, values)], ["vec"])

    return points.mapInArrow(unpack, "vec array<double>")


def _matrices(batches: Iterator[pa.RecordBatch], origin: np.ndarray) -> Iterator[np.ndarray]:
    for batch in batches:
        for block in batch.column(0):
            values = np.frombuffer(block.as_buffer()).reshape(-1, len(origin))
            for i in range(0, len(values), BLOCK_ROWS):
                yield values[i : i + BLOCK_ROWS] - origin


def _halves(x: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """Half the squared distances to all centres, less half the point's square."""
    return 0.5 * (flat * flat).sum(axis=1) - x @ flat.T


def _cuts(stacks: Sequence[np.ndarray]) -> list[tuple[int, int]]:
    ends = np.cumsum([len(s) for s in stacks]).tolist()
    return list(zip([0, *ends[:-1]], ends))


def _members(halves: np.ndarray, out: np.ndarray) -> np.ndarray:
    """Marks in ``out`` the nearest centre of every run (runs, centres, points),
    the first on ties; returns the distances of ``halves`` to them."""
    best = halves.min(axis=1)
    np.equal(halves, best[:, None, :], out=out)
    if out.sum() != best.size:  # ties, or values that are not numbers
        out[:] = 0.0
        np.put_along_axis(out, halves.argmin(axis=1)[:, None, :], 1.0, axis=1)
    return best


def _assign(points: DataFrame, origin: np.ndarray, stacks: list[np.ndarray]):
    """Sums, sizes and cost per run of the points nearest to its centres."""
    flat, cuts = np.concatenate(stacks), _cuts(stacks)
    # neighbouring runs with as many centres are compared at once
    sets = [(k, len(list(same))) for k, same in groupby(len(s) for s in stacks)]
    half_squares = 0.5 * (flat * flat).sum(axis=1)[:, None]
    names = ["centre", "sums"]

    def run(batches):
        # per centre: sum of points, number of points; the cost of a run is with its first centre
        total = np.zeros((len(flat), len(origin) + 2))
        for x in _matrices(batches, origin):
            halves = flat @ x.T
            np.subtract(half_squares, halves, out=halves)
            square = (x * x).sum(axis=1)
            member = np.empty(halves.shape)
            a = 0
            for k, runs in sets:
                b = a + k * runs
                shape = (runs, k, len(x))
                best = _members(halves[a:b].reshape(shape), member[a:b].reshape(shape))
                total[a:b:k, -1] += np.maximum(square + 2 * best, 0).sum(axis=1)
                a = b
            total[:, :-1] += member @ np.concatenate([x, np.ones((len(x), 1))], axis=1)
        used = np.flatnonzero(total.any(axis=1))
        ends = pa.array(np.arange(len(used) + 1, dtype=np.int32) * total.shape[1])
        sums = pa.ListArray.from_arrays(ends, pa.array(total[used].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(used), sums], names)

    parts = points.mapInArrow(run, "centre long, sums array<double>")
    merged = parts.groupBy("centre").agg(Summarizer.sum(array_to_vector("sums")).alias("sums"))
    total = np.zeros((len(flat), len(origin) + 2))
    for row in merged.collect():  # a row per centre of the call
        total[row["centre"]] = row["sums"].toArray()
    return (
        [total[a:b, :-2] for a, b in cuts],
        [np.rint(total[a:b, -2]) for a, b in cuts],  # Spark's sums come from running means
        [float(total[a:b, -1].sum()) for a, b in cuts],
    )


def _draw(points: DataFrame, origin: np.ndarray, stacks: list[np.ndarray], draws: int, seed: Sequence[int]):
    """Per start ``draws`` points, by squared distance to what it has."""
    flat, cuts = np.concatenate(stacks), _cuts(stacks)

    def run(batches):
        rng = np.random.default_rng([*seed, TaskContext.get().partitionId()])
        best = [(np.zeros(0), np.zeros((0, len(origin)))) for _ in stacks]
        for x in _matrices(batches, origin):
            halves = _halves(x, flat)
            square = (x * x).sum(axis=1)
            for s, (a, b) in enumerate(cuts):
                weight = square + 2 * halves[:, a:b].min(axis=1)
                far = np.flatnonzero(weight > 1e-12 * (1 + square))
                # the largest of these keys are a weighted draw without replacement
                key = np.concatenate([best[s][0], np.log(1 - rng.random(len(far))) / weight[far]])
                rows = np.concatenate([best[s][1], x[far]])
                top = np.argsort(-key, kind="stable")[:draws]
                best[s] = key[top], rows[top]
        for s, (key, rows) in enumerate(best):
            yield pa.RecordBatch.from_arrays(
                [pa.array([s] * len(key), pa.int32()), pa.array(key), pa.array(list(rows), pa.list_(pa.float64()))],
                ["start", "draw", "vec"],
            )

    drawn = points.mapInArrow(run, "start int, draw double, vec array<double>")
    order = Window.partitionBy("start").orderBy(F.col("draw").desc(), "vec")
    kept = drawn.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= draws)
    out: list[list] = [[] for _ in stacks]
    for row in kept.orderBy("start", "rank").collect():  # draws rows per start
        out[row["start"]].append(row["vec"])
    return [np.concatenate([s, np.array(o)]) if o else s for s, o in zip(stacks, out)]


def _starts(
    points: DataFrame, origin: np.ndarray, ks: Sequence[int], n_init: int, seed: int
) -> dict[tuple[int, int], np.ndarray]:
    first = _unpacked(points, len(origin)).agg(
        *[F.min_by("vec", F.struct(F.xxhash64(F.lit(seed + s), "vec"), "vec")).alias(f"s{s}") for s in range(n_init)]
    ).first()
    candidates = [np.array([v]) - origin for v in first]
    for step in range(ROUNDS):
        candidates = _draw(points, origin, candidates, DRAWS * max(ks), (seed, step))
    _, weights, _ = _assign(points, origin, candidates)
    return {
        (k, s): _local(candidates[s], weights[s], k, np.random.default_rng([seed, s, k]))
        for k in ks
        for s in range(n_init)
    }


def _local(x: np.ndarray, weight: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Weighted k-means++ and a few Lloyd steps on the candidates of a start;
    fewer than k candidates repeat."""
    used = weight > 0
    x, weight = x[used], weight[used]
    chosen = [int(rng.choice(len(x), p=weight / weight.sum()))]
    gap = ((x - x[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < k:
        share = weight * gap
        at = int(rng.choice(len(x), p=share / share.sum())) if share.sum() > 0 else chosen[len(chosen) % len(x)]
        chosen.append(at)
        gap = np.minimum(gap, ((x - x[at]) ** 2).sum(axis=1))
    centres = x[chosen].copy()
    for _ in range(30):
        own = ((x[:, None, :] - centres) ** 2).sum(axis=2).argmin(axis=1)
        member = np.zeros((len(x), k))
        member[np.arange(len(x)), own] = weight
        size = member.sum(axis=0)
        new = np.where(size[:, None] > 0, member.T @ x / np.maximum(size, 1e-300)[:, None], centres)
        if np.array_equal(new, centres):
            break
        centres = new
    return centres


# --- silhouettes of all runs -----------------------------------------------------------

def silhouettes(df: DataFrame, fits: dict[int, KMeansFit]) -> dict[int, float]:
    """Mean silhouette of every fit over all points, from one comparison of them.

    ``df`` has ``features``; rows without them count for nothing. Equal vectors
    are compared once. The points are written once, packed; a task holds the sums
    of its own points to the clusters of all fits while it reads the points of
    all tasks from there, so nothing but means leaves it and its memory does not
    grow with the points. The work is quadratic.
    """
    ks = sorted(fits)
    stacks = [np.array(fits[k].centres) for k in ks]
    vec = df.where(F.col("features").isNotNull()).select(vector_to_array("features").alias("vec"))
    blocks = stored(_owned(vec.groupBy("vec").agg(F.count(F.lit(1)).alias("n")), stacks), "points")
    rows, packed = blocks.agg(F.sum("rows"), F.count(F.lit(1))).first()
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = max(math.ceil((rows or 0) / OWN_ROWS), min(cores, packed), 1)
    width, cuts, places = stacks[0].shape[1], _cuts(stacks), blocks.inputFiles()

    def run(batches):
        held, n = [], 0
        for block in _blocks(batches, width, len(ks)):
            if held and n + len(block[0]) > OWN_ROWS:
                yield _means(held, places, cuts)
                held, n = [], 0
            held.append(block)
            n += len(block[0])
        if held:
            yield _means(held, places, cuts)

    parts = blocks.repartition(tasks).mapInArrow(run, "n double, sums array<double>")
    found = parts.agg(F.sum("n"), *[F.sum(F.col("sums")[j]) for j in range(len(ks))]).first()
    return {k: float(v / found[0]) if found[0] else 0.0 for k, v in zip(ks, found[1:])}


def _owned(spots: DataFrame, stacks: list[np.ndarray]) -> DataFrame:
    """Packed rows of vectors, their numbers of copies, and for every fit the
    position of the centre that has them among all centres."""
    flat, cuts = np.concatenate(stacks), _cuts(stacks)

    def owners(x: np.ndarray) -> np.ndarray:
        d = ((x[:, None, :] - flat) ** 2).sum(axis=2)
        return np.stack([a + d[:, a:b].argmin(axis=1) for a, b in cuts], axis=1)

    def pack(batches):
        for batch in batches:
            values = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, flat.shape[1])
            copies = batch.column(1).to_numpy(zero_copy_only=False).astype(np.float64)
            for i in range(0, len(values), BLOCK_ROWS):
                x, n = values[i : i + BLOCK_ROWS], copies[i : i + BLOCK_ROWS]
                columns = [[len(x)], [x.tobytes()], [n.tobytes()], [owners(x).astype(np.int32).tobytes()]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.binary(), pa.binary()))],
                    ["rows", "block", "copies", "owners"],
                )

    return spots.mapInArrow(pack, "rows long, block binary, copies binary, owners binary")


def _blocks(batches: Iterator[pa.RecordBatch], dims: int, fits: int) -> Iterator[tuple[np.ndarray, ...]]:
    for batch in batches:
        for block, copies, owners in zip(*(batch.column(c) for c in ("block", "copies", "owners"))):
            yield (
                np.frombuffer(block.as_buffer()).reshape(-1, dims),
                np.frombuffer(copies.as_buffer()),
                np.frombuffer(owners.as_buffer(), dtype=np.int32).reshape(-1, fits),
            )


def _met(places: Sequence[str], dims: int, fits: int) -> Iterator[tuple[np.ndarray, ...]]:
    """The packed rows of all files, a few at a time."""
    for place in places:
        with files.open_input(place) as f:
            yield from _blocks(pq.ParquetFile(f, buffer_size=1 << 20).iter_batches(batch_size=1), dims, fits)


def _means(held: list[tuple[np.ndarray, ...]], places: Sequence[str], cuts: list[tuple[int, int]]) -> pa.RecordBatch:
    """Number and summed silhouettes, one sum per fit, of the points of ``held``."""
    x, copies, own = (np.concatenate(parts) for parts in zip(*held))
    centres = cuts[-1][1]
    distance, size = np.zeros((len(x), centres)), np.zeros(centres)
    for y, n, owners in _met(places, x.shape[1], len(cuts)):
        member = np.zeros((len(y), centres))
        np.put_along_axis(member, owners, n[:, None], axis=1)
        size += member.sum(axis=0)
        for i in range(0, len(x), BLOCK_ROWS):
            distance[i : i + BLOCK_ROWS] += D._distances(x[i : i + BLOCK_ROWS], y) @ member
    rows, sums = np.arange(len(x)), []
    for j, (a, b) in enumerate(cuts):
        at = own[:, j]
        inner = distance[rows, at] / np.maximum(size[at] - 1, 1)
        mean = np.where(size[a:b] > 0, distance[:, a:b] / np.maximum(size[a:b], 1), np.inf)
        mean[rows, at - a] = np.inf
        outer = mean.min(axis=1)
        high = np.maximum(inner, outer)
        with np.errstate(invalid="ignore"):
            s = np.where((size[at] > 1) & (high > 0) & np.isfinite(outer), (outer - inner) / high, 0.0)
        sums.append(float(s @ copies))
    return pa.RecordBatch.from_arrays(
        [pa.array([float(copies.sum())]), pa.array([sums], pa.list_(pa.float64()))], ["n", "sums"]
    )
