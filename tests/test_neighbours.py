"""Nearest neighbours against brute force."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlab.operators import distances as D
from flowlab.operators import neighbours as N


def frame(spark, x, ids=None):
    ids = range(len(x)) if ids is None else ids
    kind = "string" if isinstance(next(iter(ids), 0), str) else "long"
    return spark.createDataFrame(
        [(i, None if v is None else [float(c) for c in v]) for i, v in zip(ids, x)], f"id {kind}, vec array<double>"
    )


def brute(x, y, ids, k):
    """(distance, smallest id) of the different vectors among the k nearest of y."""
    first, copies = {}, Counter(map(tuple, y))
    for i, v in sorted(zip(ids, map(tuple, y))):
        first.setdefault(v, i)
    out = []
    for p in x:
        near = sorted((math.sqrt(sum((a - b) ** 2 for a, b in zip(p, v))), i, copies[v]) for v, i in first.items())
        radius = [d for d, _, n in near for _ in range(n)][k - 1]
        out.append([(d, i) for d, i, _ in near if d <= radius][:k])
    return out


def uneven(dims, seed=0):
    rng = np.random.default_rng(seed)
    return np.concatenate([rng.normal(0, 0.01, (300, dims)), rng.uniform(-3, 3, (200, dims)), np.full((150, dims), 1.5)])


@pytest.mark.parametrize("dims", [1, 2, 12])
def test_neighbours_are_those_of_all_points(spark, dims):
    x = uneven(dims)
    q = np.concatenate([uneven(dims, 1)[::7], np.full((40, dims), 50.0)])
    got = N.nearest(frame(spark, q), frame(spark, x), 4, cell_rows=25).orderBy("id").collect()
    assert [r.id for r in got] == list(range(len(q)))
    for r, want in zip(got, brute(q, x, range(len(x)), 4)):
        assert len(r.near) == len(want) and np.allclose([n.d for n in r.near], [d for d, _ in want], atol=1e-12)
        assert [n.id for n in r.near] == [i for _, i in want]


def test_copies_count_and_ties_go_to_the_smallest_id(spark):
    fitted = frame(spark, [[0, 0], [0, 0], [0, 0], [3, 4], [-3, 4], [10, 0]], list("cbafed"))
    r = N.nearest(frame(spark, [[0, 0]], ["q"]), fitted, 4).first()
    assert [(n.d, n.id, n.n) for n in r.near] == [(0, "a", 3), (5, "e", 1), (5, "f", 1)]
    assert r.radius == 5.0


def test_odd_vectors_and_too_few_points(spark):
    points = frame(spark, [[0, 0], [1, 0], None, [math.nan, 0], [math.inf, 0], [0, 0]], [1, 2, 3, 4, 5, 1])
    got = sorted(((r.id, r.distance) for r in D.k_distance(points, 3).collect()), key=str)
    assert got == [(1, 1.0), (1, 1.0), (2, 1.0), (3, None), (4, None), (5, None)]
    assert {r.distance for r in D.k_distance(points, 4).collect()} == {None}
    none = N.nearest(points, points.limit(0), 2).collect()
    assert len(none) == 6 and all(not r.near and r.radius is None for r in none)
    assert N.nearest(points.limit(0), points, 2).count() == 0


def test_hot_vector_is_joined_in_parts(spark, monkeypatch):
    monkeypatch.setattr(N, "CELL_ROWS", 20)
    x = np.concatenate([np.zeros((500, 2)), np.random.default_rng(2).normal(2, 1, (100, 2))])
    got = D.k_distance(frame(spark, x, [i // 2 for i in range(600)]), 10)
    assert got.count() == 600 and got.where("distance = 0").count() == 500


def test_visits_of_crowded_cells_are_cut(spark, monkeypatch):
    monkeypatch.setattr(N, "VISIT_ROWS", 30)
    monkeypatch.setattr(N, "MOST_CELLS", 4)
    x = uneven(3)
    got = N.nearest(frame(spark, x), frame(spark, x), 3, cell_rows=40).orderBy("id").collect()
    for r, want in zip(got, brute(x, x, range(len(x)), 3)):
        assert [n.id for n in r.near] == [i for _, i in want]


def test_settled_points_see_few_cells(spark, monkeypatch):
    seen = []
    meet = N._meet

    def counted(active, *rest):
        seen.append(active.select(F.sum(F.size("_visits"))).first()[0])
        return meet(active, *rest)

    monkeypatch.setattr(N, "_meet", counted)
    x = np.random.default_rng(3).uniform(0, 1, (4_000, 2))
    N.nearest(frame(spark, x), frame(spark, x), 5, cell_rows=40).count()
    assert sum(seen) < 4_000 * 8  # of 100 cells


def test_label_through_cells_and_by_broadcast(spark):
    x, q = uneven(9), uneven(9, 5)[::5]
    fitted = frame(spark, x).withColumn("label", F.concat(F.lit("c"), (F.col("id") % 7).cast("string")))
    asked = frame(spark, q)
    one = D.nearest_label(asked, fitted).orderBy("id").collect()
    two = D.nearest_label(asked, fitted, broadcast_rows=0, block_rows=30).orderBy("id").collect()
    assert one == two


@pytest.mark.parametrize("dims", [2, 9])
def test_visited_cells_without_a_nearer_point(spark, dims):
    # a box reaches nearer than its points do: the corners of the two far cells are empty
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.uniform(-1, 1, (400, dims)), rng.uniform(3, 5, (400, dims))])
    x = x[np.abs(x - np.where(x[:, :1] > 2, 4, 0)).max(axis=1) > 0.6]
    q = np.concatenate([np.zeros((3, dims)), np.full((3, dims), 4.0), rng.uniform(-1, 5, (60, dims))])
    fitted = frame(spark, x).withColumn("label", F.when(F.col("id") % 5 > 0, (F.col("id") % 5).cast("int")))
    got = D.nearest_label(frame(spark, q), fitted, broadcast_rows=0, block_rows=9).orderBy("id").collect()
    want = [near[0] for near in brute(q, x, range(len(x)), 1)]
    assert np.allclose([r.distance for r in got], [d for d, _ in want], atol=1e-12)
    assert [r.label for r in got] == [i % 5 or None for _, i in want]


@pytest.mark.parametrize("k", [1, 3])
def test_products_find_what_differences_find(k):
    rng = np.random.default_rng(4)
    y = np.concatenate([rng.normal(0, 1, (300, 20)), 1e4 + rng.normal(0, 1e-3, (50, 20))])
    y = np.concatenate([y, y[:20]])  # ties: the earlier position
    x = np.concatenate([y[::7], rng.normal(0, 1, (30, 20))])
    d = N._distances(x, y)
    order = np.argsort(d, axis=1, kind="stable")[:, :k]
    reach = np.where(np.arange(len(x)) % 3 == 0, np.inf, np.sort(d, axis=1)[:, 4])
    found = {row: (at.tolist(), gaps.tolist()) for row, at, gaps in N._nearer(x, y, k, reach)}
    assert found == {r: (order[r].tolist(), d[r, order[r]].tolist()) for r in range(len(x))}
    assert list(N._nearer(x[:3], y, k, np.full(3, -1.0))) == []
