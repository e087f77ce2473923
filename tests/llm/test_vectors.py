import numpy as np
import pytest

from flowlab.llm import vectors
from flowlab.llm.queries import QUERIES


def plain(rows, cosine=0.95):
    """rows: (id, list or None), distinct ids; id -> (links, component)."""
    ok = []
    for i, v in rows:
        good = v is not None and len(v) and None not in v
        good = good and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float) != 0)
        ok.append(bool(good))
    root, links = {i: i for i, _ in rows}, {i: 0 for i, _ in rows}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for dims in {len(v) for (_, v), k in zip(rows, ok) if k}:
        own = sorted((i, v) for (i, v), k in zip(rows, ok) if k and len(v) == dims)
        x = np.array([v for _, v in own], float)
        x /= np.abs(x).max(axis=1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        near = x @ x.T >= cosine
        for a, b in zip(*np.nonzero(near)):
            if a != b:
                links[own[a][0]] += 1
                r, s = top(own[a][0]), top(own[b][0])
                root[max(r, s)] = min(r, s)
    return {i: (links[i], top(i), top(i) == i) for i, _ in rows}


def result(df):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in df.collect()}


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.1"])
def test_query_equals_brute_force(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert result(QUERIES["op8_vectors"](spark, sf_dir)) == plain(rows)


@pytest.mark.parametrize("part, cell", [(2_048, 40), (7, 10)])
def test_groups_chains_and_odd_vectors(spark, monkeypatch, part, cell):
    monkeypatch.setattr(vectors, "PART_ROWS", part)
    monkeypatch.setattr(vectors, "CELL_ROWS", cell)
    draw = np.random.default_rng(4)
    rows = [(i, (draw.normal(size=6)).tolist()) for i in range(60)]
    centre = draw.normal(size=6)
    rows += [(100 + i, (centre + 0.05 * draw.normal(size=6)).tolist()) for i in range(50)]
    rows += [(200 + i, [float(np.cos(i * 0.3)), float(np.sin(i * 0.3)), 0.0, 0.0, 0.0, 0.0]) for i in range(18)]
    rows += [(300 + i, rows[3][1]) for i in range(20)]
    rows += [(400, None), (401, []), (402, [0.0] * 6), (403, [1.0, None, 0, 0, 0, 0]), (404, [float("nan")] + [1.0] * 5)]
    rows += [(405, [float("inf")] + [1.0] * 5), (406, [1.0, 2.0]), (407, [2.0, 4.0]), (408, [1e300] * 6), (409, [1e-300] * 6)]
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows]
    source = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, cell int")
    assert result(vectors.range_join(source)) == plain(rows)


def test_repeated_and_null_ids_and_empty_table(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.01]), (2, [0.0, 1.0]), (None, None)]
    source = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(((r.vec_id or 0, r.n_links, r.component_id) for r in vectors.range_join(source).collect()), key=repr)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (0, 2, 1), (2, 0, 2), (0, 0, None)], key=repr)
    assert vectors.range_join(source.limit(0)).count() == 0
