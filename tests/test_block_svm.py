"""The block-wise SVM against a plain Newton solver on the same rows."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from flowlab.operators import block_svm as B
from flowlab.operators import classifying as S


def ring(n=400, seed=3):
    """Three classes by distance from the centre: no line parts them."""
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n, 3))
    y = np.digitize(np.hypot(x[:, 0], x[:, 1]), [0.7, 1.4])
    return x, y


def frame(spark, x, y):
    rows = [(i, [float(v) for v in p], int(c)) for i, (p, c) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "row_id long, vec array<double>, label_idx int")
    return df.withColumn("features", array_to_vector("vec"))


def plain_solver(z, sign, share, decay, steps=60):
    """Minimum of decay/2 |w|^2 + sum share max(0, 1 - sign f)^2 by Newton steps."""
    z = np.concatenate([z, np.ones((len(z), 1))], axis=1)
    ridge = np.full(z.shape[1], decay)
    ridge[-1] = 0.0

    def value(w):
        gap = np.maximum(1 - sign * (z @ w), 0)
        return 0.5 * (ridge * w * w).sum() + (share * gap * gap).sum()

    w = np.zeros(z.shape[1])
    for _ in range(steps):
        gap = np.maximum(1 - sign * (z @ w), 0)
        on = gap > 0
        slope = ridge * w - 2 * z.T @ (share * sign * gap)
        turn = 2 * (z[on] * share[on, None]).T @ z[on] + np.diag(ridge + 1e-12)
        move, t = np.linalg.solve(turn, -slope), 1.0
        while value(w + t * move) > value(w) and t > 1e-6:
            t *= 0.5
        w = w + t * move
    return w, value(w)


@pytest.mark.parametrize("kernel", ["rbf", "linear"])
def test_equals_a_plain_solver(spark, kernel):
    x, y = ring()
    fold = np.arange(len(x)) % 3
    df = frame(spark, x, y).withColumn("fold", (F.col("row_id") % 3).cast("int"))
    rows = S._svm_rows(df).persist()
    counts = B.class_counts(rows)
    mapped = S._fourier_map(kernel, 0.5, 40, 3, 42)
    problems = [B.Problem("k", C, f) for C in (0.1, 10.0) for f in (0, 1, None)]
    width = 40 if kernel == "rbf" else 3
    w = B.solve(rows, problems, {"k": mapped}, {"k": width}, counts, 3, 200, 1e-4)
    z = mapped(x)
    for i, p in enumerate(problems):
        kept = fold != (-1 if p.fold is None else p.fold)
        n = kept.sum()
        for c in range(3):
            share = 1.0 / (3 * np.array([(y[kept] == k).sum() for k in range(3)]))[y[kept]]
            sign = np.where(y[kept] == c, 1.0, -1.0)
            plain, least = plain_solver(z[kept], sign, share, 1.0 / (p.C * n))
            own = np.append(z[kept] @ w[i, c, :-1] + w[i, c, -1], 0)[:-1]
            gap = np.maximum(1 - sign * own, 0)
            found = 0.5 / (p.C * n) * (w[i, c, :-1] ** 2).sum() + (share * gap * gap).sum()
            assert found == pytest.approx(least, rel=1e-3)
            assert np.abs(own - (z[kept] @ plain[:-1] + plain[-1])).mean() < 0.02
    tables = B.confusion(rows, problems[:2], {"k": mapped}, w[:2])
    for f in range(2):
        out = z[fold == f] @ w[f, :, :-1].T + w[f, :, -1]
        table = np.zeros((3, 3))
        np.add.at(table, (y[fold == f], out.argmax(1)), 1)
        assert np.array_equal(tables[f], table)
    rows.unpersist()


def test_grid_is_the_single_fits(spark):
    x, y = ring(240)
    df = frame(spark, x, y)
    grid = {"C": [0.1, 10.0], "gamma": ["scale", 0.5], "kernel": ["rbf", "linear"]}
    found = {(r.C, r.gamma, r.kernel): r for r in S.svm_grid(df, grid, n_components=64).collect()}
    assert len(found) == 8 and sum(r.is_best for r in found.values()) == 1
    # the linear kernel has no gamma, and cannot part rings
    assert found[10.0, "scale", "linear"].f1_weighted == found[10.0, "0.5", "linear"].f1_weighted
    best = max(found.values(), key=lambda r: r.f1_weighted)
    assert best.is_best and best.kernel == "rbf" and best.f1_weighted > 0.75
    assert found[10.0, "scale", "linear"].f1_weighted < 0.6


def test_svm_learns_rings_and_gives_probabilities(spark):
    x, y = ring(600)
    df = frame(spark, x, y)
    model = S.svm(df.where("row_id % 4 <> 0"), gamma=0.5, n_components=128)
    rows = model.score(df.where("row_id % 4 = 0")).select("label_idx", "prediction", "probability").collect()
    assert np.mean([r.label_idx == r.prediction for r in rows]) > 0.8
    assert all(abs(sum(r.probability) - 1) < 1e-9 for r in rows)


def test_classes_without_rows(spark):
    x, y = ring(120)
    df = frame(spark, x, np.minimum(y, 1) * 2)  # class 1 is absent
    model = S.svm(df, n_classes=4, n_components=32, max_iter=50)
    assert {r.prediction for r in model.score(df).select("prediction").distinct().collect()} <= {0, 2}
