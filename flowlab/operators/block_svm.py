"""Kernel SVMs fitted over blocks of rows, many settings in the same passes.

A problem is a kernel, a C and a fold to leave out; each stands for one
one-versus-rest SVM per class. A pass maps a block of rows through the random
features of every kernel in the task, evaluates all problems of the kernel on
it and returns sums of losses and gradients, so mapped rows are never kept. The
driver takes the quasi-Newton steps (L-BFGS, Nocedal and Wright, 2006) of all
problems together, starting from the curvature that all rows together would
give: each pass evaluates every problem at its own next point.

The loss is the squared hinge, which has a gradient everywhere; the intercept
is not penalised. Rows are weighted by the balanced weights of the classes
among the rows that a problem is trained on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: rows that are mapped at once
BLOCK_ROWS = 512
#: pairs of steps that a quasi-Newton direction remembers
MEMORY = 10

Map = Callable[[np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Problem:
    """``kernel`` names a feature map; rows of ``fold`` are left out (None: none)."""

    kernel: object
    C: float
    fold: int | None = None


def class_counts(rows: DataFrame) -> np.ndarray:
    """Rows per fold and class of ``rows`` (vec, label, fold)."""
    found = rows.groupBy("fold", "label").count().collect()  # folds times classes
    counts = np.zeros((max(r["fold"] for r in found) + 1, max(r["label"] for r in found) + 1))
    for r in found:
        counts[r["fold"], r["label"]] = r["count"]
    return counts


def _trained_on(counts: np.ndarray, problem: Problem) -> np.ndarray:
    """``counts`` without the fold that the problem leaves out."""
    kept = counts.copy()
    if problem.fold is not None:
        kept[problem.fold] = 0
    return kept


def row_weights(counts: np.ndarray, problem: Problem) -> np.ndarray:
    """Weight of a row by fold and class, divided by the number of rows."""
    kept = _trained_on(counts, problem)
    per_class = kept.sum(axis=0)
    present = per_class > 0
    balanced = np.where(present, 1.0 / np.maximum(present.sum() * per_class, 1), 0.0)
    return np.where(kept > 0, balanced, 0.0)


# --- passes ---------------------------------------------------------------------------

def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
        y, fold = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
        for i in range(0, n, BLOCK_ROWS):
            yield x[i : i + BLOCK_ROWS], y[i : i + BLOCK_ROWS], fold[i : i + BLOCK_ROWS]


def _summed(rows: DataFrame, totals: Callable[[Iterator], np.ndarray], n: int) -> np.ndarray:
    """Sum over the tasks of ``totals``, a matrix of ``n`` rows."""

    def run(batches):
        total = totals(_blocks(batches))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(n)), pa.array(list(total), pa.list_(pa.float64()))], ["row", "total"]
        )

    parts = rows.mapInArrow(run, "row long, total array<double>")
    merged = parts.groupBy("row").agg(Summarizer.sum(array_to_vector("total")).alias("total"))
    found = {r["row"]: r["total"].toArray() for r in merged.collect()}  # a row per problem and class
    width = max(map(len, found.values()), default=0)
    return np.array([found.get(i, np.zeros(width)) for i in range(n)])


def _by_kernel(problems: Sequence[Problem]) -> dict[object, list[int]]:
    groups: dict[object, list[int]] = {}
    for i, p in enumerate(problems):
        groups.setdefault(p.kernel, []).append(i)
    return groups


def _outputs(mapped: Map, x: np.ndarray, w: np.ndarray, own: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Mapped rows with a one, and (row, problem, class) outputs."""
    z = np.concatenate([mapped(x), np.ones((len(x), 1))], axis=1)
    # coefficients are padded to a common width, the intercept is the last one
    part = np.concatenate([w[own, :, : z.shape[1] - 1], w[own, :, -1:]], axis=2)
    return z, np.einsum("nd,pkd->npk", z, part, optimize=True)


def evaluate(rows: DataFrame, problems, maps: dict, counts: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Loss and gradient of every problem and class at ``w`` (problem, class, coefficient)."""
    n_classes, width = w.shape[1], w.shape[2]
    weights = np.stack([row_weights(counts, p) for p in problems])
    groups = _by_kernel(problems)

    def totals(blocks):
        total = np.zeros((len(problems), n_classes, width + 1))
        for x, y, fold in blocks:
            sign = np.where(y[:, None] == np.arange(n_classes), 1.0, -1.0)
            for kernel, own in groups.items():
                z, out = _outputs(maps[kernel], x, w, own)
                share = weights[own][:, fold, y].T[:, :, None]
                gap = np.maximum(1.0 - sign[:, None, :] * out, 0.0)
                slope = np.einsum("npk,nd->pkd", -2.0 * share * sign[:, None, :] * gap, z, optimize=True)
                total[own, :, : z.shape[1] - 1] += slope[:, :, :-1]
                total[own, :, width - 1] += slope[:, :, -1]
                total[own, :, width] += (share * gap * gap).sum(axis=0)
        return total.reshape(-1, width + 1)

    total = _summed(rows, totals, len(problems) * n_classes).reshape(len(problems), n_classes, width + 1)
    # 1 / (C n) makes the objective the usual one, divided by C n
    decay = np.array([1.0 / (p.C * _trained_on(counts, p).sum()) for p in problems])[:, None]
    inner = w[:, :, :-1]
    loss = total[:, :, width] + 0.5 * decay * (inner**2).sum(axis=2)
    slope = total[:, :, :width]
    slope[:, :, :-1] += decay[:, :, None] * inner
    return loss, slope


def gram_matrices(rows: DataFrame, problems, maps: dict, widths: dict, counts: np.ndarray) -> dict:
    """Weighted sums of products of mapped rows by kernel and fold left out:
    twice that is the curvature where every row counts."""
    asked = list({(p.kernel, p.fold): p for p in problems}.values())
    weights = np.stack([row_weights(counts, p) for p in asked])
    groups = _by_kernel(asked)
    width = max(widths.values()) + 1

    def totals(blocks):
        total = np.zeros((len(asked), width, width))
        for x, y, fold in blocks:
            for kernel, own in groups.items():
                z = np.concatenate([maps[kernel](x), np.ones((len(x), 1))], axis=1)
                for i in own:
                    share = weights[i][fold, y]
                    total[i, : z.shape[1], : z.shape[1]] += (z * share[:, None]).T @ z
        return total.reshape(-1, width)

    total = _summed(rows, totals, len(asked) * width).reshape(len(asked), width, width)
    return {(p.kernel, p.fold): total[i, : widths[p.kernel] + 1, : widths[p.kernel] + 1] for i, p in enumerate(asked)}


class _Curvature:
    """Inverse of an upper bound of each problem's curvature."""

    def __init__(self, problems, grams: dict, counts: np.ndarray, n_classes: int):
        bases = {key: np.linalg.eigh((g + g.T) / 2) for key, g in grams.items()}
        self.parts = []
        for i, p in enumerate(problems):
            values, base = bases[p.kernel, p.fold]
            decay = 1.0 / (p.C * _trained_on(counts, p).sum())
            rows = slice(i * n_classes, (i + 1) * n_classes)
            self.parts.append((rows, base, 1.0 / (decay + 2 * np.maximum(values, 0))))

    def inverse(self, q: np.ndarray) -> np.ndarray:
        out = np.zeros_like(q)
        for rows, base, scale in self.parts:
            m = len(base) - 1  # the intercept is the last column of both
            part = np.concatenate([q[rows, :m], q[rows, -1:]], axis=1)
            part = ((part @ base) * scale) @ base.T
            out[rows, :m], out[rows, -1] = part[:, :m], part[:, m]
        return out


def confusion(rows: DataFrame, problems, maps: dict, w: np.ndarray) -> np.ndarray:
    """Per problem the confusion counts (actual, predicted) of the fold left out."""
    n_classes = w.shape[1]
    groups = _by_kernel(problems)

    def totals(blocks):
        total = np.zeros((len(problems), n_classes, n_classes))
        for x, y, fold in blocks:
            for kernel, own in groups.items():
                predicted = _outputs(maps[kernel], x, w, own)[1].argmax(axis=2)
                for j, i in enumerate(own):
                    left = fold == problems[i].fold
                    np.add.at(total[i], (y[left], predicted[left, j]), 1.0)
        return total.reshape(len(problems), -1)

    # Spark's sums come from running means
    return np.rint(_summed(rows, totals, len(problems))).reshape(-1, n_classes, n_classes)


def kernel_error(rows: DataFrame, mapped: Map, gamma: float) -> float:
    """Mean absolute error of the mapped kernel over neighbouring rows of the table."""

    def totals(blocks):
        total = np.zeros((1, 2))
        for x, _, _ in blocks:
            z = mapped(x)
            exact = np.exp(-gamma * ((x[1:] - x[:-1]) ** 2).sum(axis=1))
            total += [[np.abs((z[1:] * z[:-1]).sum(axis=1) - exact).sum(), len(x) - 1]]
        return total

    error, n = _summed(rows, totals, 1)[0]
    return float(error / n) if n else 0.0


# --- solver -----------------------------------------------------------------------------

def solve(
    rows: DataFrame,
    problems: Sequence[Problem],
    maps: dict,
    widths: dict,
    counts: np.ndarray,
    n_classes: int,
    passes: int = 200,
    tol: float = 1e-3,
) -> np.ndarray:
    """Coefficients (problem, class, coefficient); the intercept is the last one.

    ``rows`` has ``vec``, ``label`` and ``fold``; ``maps`` gives the feature map
    of a kernel, ``widths`` its number of features. A problem rests when no
    entry of its gradient is above ``tol`` times the first one's largest entry,
    or when ``passes`` are over.
    """
    if counts.shape[1] < n_classes:
        counts = np.pad(counts, ((0, 0), (0, n_classes - counts.shape[1])))
    shape = (len(problems), n_classes, max(widths[p.kernel] for p in problems) + 1)
    n, width = shape[0] * shape[1], shape[2]
    w = np.zeros((n, width))
    loss, slope = (a.reshape(n, -1) for a in evaluate(rows, problems, maps, counts, w.reshape(shape)))
    loss = loss[:, 0]
    limit = tol * np.maximum(np.abs(slope).max(axis=1), 1e-12)
    curvature = _Curvature(problems, gram_matrices(rows, problems, maps, widths, counts), counts, n_classes)
    state = _Directions(n, width, curvature.inverse)
    way = state.direction(slope)
    step = np.ones(n)
    moving = np.abs(slope).max(axis=1) > 1e-12
    for _ in range(passes):
        asked = np.flatnonzero(moving.reshape(shape[:2]).any(axis=1))
        if not len(asked):
            break
        trial = w + step[:, None] * way
        found = evaluate(rows, [problems[i] for i in asked], maps, counts, trial.reshape(shape)[asked])
        new_loss, new_slope = np.full(shape[:2], np.inf), np.zeros(shape)
        new_loss[asked], new_slope[asked] = found
        new_loss, new_slope = new_loss.reshape(n), new_slope.reshape(n, width)
        descent = (slope * way).sum(axis=1)
        taken = moving & (new_loss <= loss + 1e-4 * step * descent)
        state.remember(taken, trial - w, new_slope - slope)
        # a step that does not descend is cut at the minimum of a parabola
        with np.errstate(divide="ignore", invalid="ignore"):
            cut = -0.5 * descent * step / (new_loss - loss - descent * step)
        short = step * np.clip(np.nan_to_num(cut, nan=0.5), 0.1, 0.5)
        w[taken], loss[taken], slope[taken] = trial[taken], new_loss[taken], new_slope[taken]
        way = np.where(taken[:, None], state.direction(slope), way)
        uphill = (slope * way).sum(axis=1) >= 0
        way[uphill] = -slope[uphill]
        step = np.where(taken, 1.0, short)
        moving &= (np.abs(slope).max(axis=1) > limit) & (step > 1e-8)
    return w.reshape(shape)


class _Directions:
    """Quasi-Newton directions of many problems, each with its own memory."""

    def __init__(self, n: int, width: int, inverse: Callable[[np.ndarray], np.ndarray]):
        self.inverse = inverse
        self.moves = np.zeros((MEMORY, n, width))
        self.turns = np.zeros((MEMORY, n, width))
        self.products = np.zeros((MEMORY, n))  # zero: not used

    def remember(self, which: np.ndarray, move: np.ndarray, turn: np.ndarray) -> None:
        product = (move * turn).sum(axis=1)
        which = which & (product > 1e-14)
        for old, new in ((self.moves, move), (self.turns, turn), (self.products, product)):
            old[:-1, which] = old[1:, which]
            old[-1, which] = new[which]

    def direction(self, slope: np.ndarray) -> np.ndarray:
        q = slope.copy()
        used = self.products > 0
        rho = np.where(used, 1.0 / np.where(used, self.products, 1.0), 0.0)
        alpha = np.zeros_like(rho)
        for i in reversed(range(MEMORY)):
            alpha[i] = rho[i] * (self.moves[i] * q).sum(axis=1)
            q -= alpha[i][:, None] * self.turns[i]
        size = (self.turns[-1] * self.inverse(self.turns[-1])).sum(axis=1)
        q = self.inverse(q) * np.where(used[-1], self.products[-1] / np.where(size > 0, size, 1.0), 1.0)[:, None]
        for i in range(MEMORY):
            beta = rho[i] * (self.turns[i] * q).sum(axis=1)
            q += (alpha[i] - beta)[:, None] * self.moves[i]
        return -q


def weighted_f1(table: np.ndarray) -> float:
    """F1 of a confusion table, weighted by the actual rows of each class."""
    actual, predicted, right = table.sum(axis=1), table.sum(axis=0), np.diag(table)
    f1 = 2 * right / np.maximum(actual + predicted, 1)
    return float((f1 * actual).sum() / max(actual.sum(), 1))
