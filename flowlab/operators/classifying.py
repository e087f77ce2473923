"""Supervised models: forest, kernel SVM, window classifier, validation.

Training tables have ``features`` (ML vector) and ``label_idx``; rows are
weighted by balanced class weights. Scored tables have ``prediction`` (int)
and ``probability`` (array of doubles).
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass
from itertools import product

import numpy as np
import pandas as pd
from pyspark.ml.classification import (
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlab.operators import block_svm
from flowlab.operators import metrics as M
from flowlab.operators import sampling
from flowlab.operators import windows as W
from flowlab.operators.preparing import attach_weights, class_name
from flowlab.session import cut_lineage

LABEL = "label_idx"


def spread(df: DataFrame) -> DataFrame:
    """Even partitions for algorithms that pass over their input many times.

    One shuffle of the few columns they read, instead of a straggler (a large
    or unsplittable input file) in each of the passes.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


# --- scoring ---------------------------------------------------------------------------

def score(df: DataFrame, model, classes: Sequence[str] | None = None) -> DataFrame:
    """``prediction``, ``probability``, ``confidence`` and the class name.

    Any Spark ML classifier works; one without probabilities has confidence 1.
    """
    if hasattr(model, "score"):
        scored = model.score(df)
    else:
        scored = model.transform(df)
        if "probability" in scored.columns:
            scored = scored.withColumn("probability", vector_to_array("probability"))
        scored = scored.withColumn("prediction", F.col("prediction").cast("int"))
        scored = scored.drop("rawPrediction")
    if "probability" in scored.columns:
        scored = scored.withColumn("confidence", F.array_max("probability"))
    else:
        scored = scored.withColumn("confidence", F.lit(1.0))
    if classes is not None:
        scored = scored.withColumn("predicted_class", class_name("prediction", classes))
    return scored


def evaluate(scored: DataFrame, n_classes: int | None = None, label: str = LABEL) -> DataFrame:
    """Long table ``(metric, value)``: accuracy, weighted P/R/F1 and AUC.

    The AUC takes several passes; rows are scored once and written for them.
    """
    ranked = bool(n_classes) and "probability" in scored.columns
    if ranked:
        scored = cut_lineage(scored.select(label, "prediction", "probability"))
    wide = M.weighted_metrics(scored, label, "prediction")
    table = wide.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in wide.columns]))
    )
    if ranked:
        columns = {i: f"_p{i}" for i in range(n_classes)}
        split = scored.select(
            label, *[F.try_element_at("probability", F.lit(i + 1)).alias(c) for i, c in columns.items()]
        )
        auc = M.auc_ovr(split, columns, label)
        table = table.unionByName(
            auc.select(F.lit("roc_auc_ovr").alias("metric"), F.col("roc_auc_ovr").alias("value")).where(
                F.col("value").isNotNull()
            )
        )
    return table


# --- random forest --------------------------------------------------------------------

def random_forest(
    df: DataFrame,
    n_trees: int = 200,
    max_depth: int = 20,
    min_split: int = 5,
    seed: int = 42,
    balanced: bool = True,
):
    """A forest; ``min_split`` maps to the nearest leaf-size rule Spark has."""
    params = dict(
        numTrees=n_trees, maxDepth=max_depth, seed=seed, featureSubsetStrategy="sqrt",
        minInstancesPerNode=max(1, min_split // 2), labelCol=LABEL, featuresCol="features",
    )
    df = df.select("features", LABEL)
    if balanced:
        df = attach_weights(df, LABEL)
        params["weightCol"] = "weight"
    table = spread(df).persist()  # read for classes, split points and bagging
    try:
        return RandomForestClassifier(**params).fit(table)
    finally:
        table.unpersist()


def importances(model, names: Sequence[str], spark) -> DataFrame:
    values = model.featureImportances.toArray()
    return spark.createDataFrame(
        [(n, float(v)) for n, v in zip(names, values)], "feature string, importance double"
    )


def top_importances(model, names: Sequence[str], spark, k: int = 20) -> DataFrame:
    return importances(model, names, spark).orderBy(F.desc("importance"), "feature").limit(k)


def cross_validate(
    df: DataFrame, k: int = 5, fit=random_forest, seed: int = 42, ids: Sequence[str] = ("row_id",), **kw
) -> DataFrame:
    """Weighted F1 of each stratified fold, with mean and population deviation."""
    folds = sampling.stratified_folds(df, k, seed, ids, LABEL).persist()
    try:
        rows = []
        for i in range(k):
            model = fit(folds.where(F.col("fold") != i), **kw)
            scored = score(folds.where(F.col("fold") == i), model)
            f1 = M.weighted_metrics(scored, LABEL, "prediction").first()["f1_weighted"]
            rows.append((i, float(f1)))
    finally:
        folds.unpersist()
    table = df.sparkSession.createDataFrame(rows, "fold int, f1_weighted double")
    scores = [r[1] for r in rows]
    return table.withColumns(
        {"cv_mean": F.lit(float(np.mean(scores))), "cv_std": F.lit(float(np.std(scores)))}
    )


# --- kernel SVM ------------------------------------------------------------------------

@dataclass
class SvmModel:
    """One-versus-rest linear SVMs on random Fourier features.

    The kernel is approximated (Rahimi and Recht, 2007); ``kernel_error`` is
    the measured mean absolute error of the approximation on sampled pairs.
    The random matrix is reproduced from the seed, so the state is small.
    """

    kernel: str
    gamma: float
    n_components: int
    dims: int
    seed: int
    coefficients: list[list[float]]
    intercepts: list[float]
    calibration: list[list[float]]
    calibration_intercepts: list[float]
    kernel_error: float = 0.0

    def score(self, df: DataFrame) -> DataFrame:
        coef, bias = np.array(self.coefficients).T, np.array(self.intercepts)
        cal, cal_bias = np.array(self.calibration).T, np.array(self.calibration_intercepts)
        mapped = _fourier_map(self.kernel, self.gamma, self.n_components, self.dims, self.seed)

        @F.pandas_udf("struct<margins:array<double>,probability:array<double>>")
        def both(x: pd.Series) -> pd.DataFrame:
            margins = mapped(np.array(x.tolist(), dtype=np.float64)) @ coef + bias
            logits = margins @ cal + cal_bias
            logits -= logits.max(axis=1, keepdims=True)
            p = np.exp(logits)
            p /= p.sum(axis=1, keepdims=True)
            return pd.DataFrame({"margins": list(margins), "probability": list(p)})

        scored = df.withColumn("_svm", both(vector_to_array("features")))
        margins = F.col("_svm.margins")
        return scored.withColumns(
            {
                "prediction": (F.array_position(margins, F.array_max(margins)) - 1).cast("int"),
                "margins": margins,
                "probability": F.col("_svm.probability"),
            }
        ).drop("_svm")

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> SvmModel:
        return SvmModel(**json.loads(text))


def _fourier_map(kernel: str, gamma: float, n_components: int, dims: int, seed: int):
    if kernel == "linear":
        return lambda x: x
    if kernel != "rbf":
        raise ValueError(f"unknown kernel: {kernel}")
    rng = np.random.default_rng(seed)
    w = rng.normal(0.0, np.sqrt(2.0 * gamma), (dims, n_components))
    b = rng.uniform(0.0, 2.0 * np.pi, n_components)
    factor = np.sqrt(2.0 / n_components)
    return lambda x: factor * np.cos(x @ w + b)


def kernel_gamma(df: DataFrame, gamma: str | float) -> tuple[float, int]:
    """``scale`` is 1 / (d * variance of all entries), ``auto`` is 1 / d."""
    row = df.select(
        Summarizer.metrics("mean", "variance", "count").summary(F.col("features")).alias("s")
    ).first()["s"]
    means, variances, n = row["mean"].toArray(), row["variance"].toArray(), row["count"]
    dims = len(means)
    if gamma == "auto":
        return 1.0 / dims, dims
    if gamma == "scale":
        population = variances.mean() * (n - 1) / n if n > 1 else 0.0
        total = population + means.var()
        return (1.0 / (dims * total) if total > 0 else 1.0), dims
    return float(gamma), dims


def svm(
    df: DataFrame,
    kernel: str = "rbf",
    C: float = 10.0,
    gamma: str | float = "scale",
    max_iter: int = 200,
    n_components: int = 256,
    seed: int = 42,
    n_classes: int | None = None,
) -> SvmModel:
    """Balanced one-versus-rest SVMs with calibrated probabilities.

    Rows are mapped where they are read, in blocks; ``max_iter`` bounds the
    passes over them. All classes share the passes.
    """
    value, dims = kernel_gamma(df, gamma)
    mapped = _fourier_map(kernel, value, n_components, dims, seed)
    rows = _svm_rows(df.withColumn("fold", F.lit(0))).persist()
    try:
        counts = block_svm.class_counts(rows)
        n_classes = n_classes or counts.shape[1]
        w = block_svm.solve(
            rows, [block_svm.Problem(kernel, C)], {kernel: mapped},
            {kernel: dims if kernel == "linear" else n_components}, counts, n_classes, max_iter,
        )[0]
        coefficients, intercepts = w[:, :-1].tolist(), w[:, -1].tolist()
        calibration, offsets = calibrate(rows, mapped, coefficients, intercepts, n_classes)
        error = block_svm.kernel_error(rows, mapped, value) if kernel == "rbf" else 0.0
    finally:
        rows.unpersist()
    return SvmModel(
        kernel, value, n_components, dims, seed, coefficients, intercepts, calibration, offsets, error
    )


def _svm_rows(df: DataFrame) -> DataFrame:
    """``vec``, ``label``, ``fold`` in even partitions."""
    return spread(
        df.select(
            vector_to_array("features").alias("vec"),
            F.col(LABEL).cast("int").alias("label"),
            F.col("fold").cast("int").alias("fold"),
        )
    )


def calibrate(rows: DataFrame, mapped, coefficients, intercepts, n_classes: int):
    """Multinomial logistic regression on the one-versus-rest margins."""
    coef, bias = np.array(coefficients).T, np.array(intercepts)

    @F.pandas_udf("array<double>")
    def margins(x: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=object)
        return pd.Series(list(mapped(np.array(x.tolist(), dtype=np.float64)) @ coef + bias))

    scored = rows.select(array_to_vector(margins("vec")).alias("margins"), F.col("label").alias(LABEL))
    model = LogisticRegression(
        featuresCol="margins", labelCol=LABEL, family="multinomial", regParam=1e-4, maxIter=100
    ).fit(scored)
    matrix = np.zeros((n_classes, n_classes))
    offsets = np.full(n_classes, -1e9)  # classes without training rows stay improbable
    known = model.coefficientMatrix.toArray()
    matrix[: len(known)] = known
    offsets[: len(known)] = model.interceptVector.toArray()
    return matrix.tolist(), offsets.tolist()


#: The search grid.
SVM_GRID = {"C": [0.1, 1.0, 10.0, 100.0], "gamma": ["scale", "auto", 0.01, 0.1], "kernel": ["rbf", "linear"]}


def svm_grid(
    df: DataFrame,
    grid: dict | None = None,
    folds: int = 3,
    seed: int = 42,
    ids: Sequence[str] = ("row_id",),
    max_iter: int = 200,
    n_components: int = 256,
) -> DataFrame:
    """Cross-validated weighted F1 of every combination, the best one marked.

    All combinations and folds are fitted in the same passes over the rows;
    ``max_iter`` bounds the passes. A named gamma is that of the training rows
    of each fold. The linear kernel has no gamma, so it is fitted once per C
    and fold.
    """
    grid = grid or SVM_GRID
    folded = sampling.stratified_folds(df, folds, seed, ids, LABEL)
    rows = _svm_rows(folded).persist()
    try:
        counts = block_svm.class_counts(rows)
        gammas, dims = _fold_gammas(rows, folds, grid["gamma"])
        combinations = list(product(grid["C"], grid["gamma"], grid["kernel"]))

        def problem(C, gamma, kernel, fold):
            value = gammas[gamma, fold] if kernel == "rbf" else None
            return block_svm.Problem((kernel, value), C, fold)

        problems = list(dict.fromkeys(problem(*c, fold) for c in combinations for fold in range(folds)))
        kernels = {p.kernel for p in problems}
        maps = {k: _fourier_map(k[0], k[1], n_components, dims, seed) for k in kernels}
        widths = {k: n_components if k[0] == "rbf" else dims for k in kernels}
        w = block_svm.solve(rows, problems, maps, widths, counts, counts.shape[1], max_iter)
        tables = dict(zip(problems, block_svm.confusion(rows, problems, maps, w)))
    finally:
        rows.unpersist()
    found = [
        float(np.mean([block_svm.weighted_f1(tables[problem(*c, fold)]) for fold in range(folds)]))
        for c in combinations
    ]
    best = max(range(len(found)), key=lambda i: (found[i], -i))
    return df.sparkSession.createDataFrame(
        [(float(C), str(gamma), kernel, found[i], i == best) for i, (C, gamma, kernel) in enumerate(combinations)],
        "C double, gamma string, kernel string, f1_weighted double, is_best boolean",
    )


def _fold_gammas(rows: DataFrame, folds: int, names: Sequence) -> tuple[dict, int]:
    """The value of every gamma for the training rows of every fold."""
    per_fold = (
        rows.groupBy("fold")
        .agg(Summarizer.metrics("mean", "variance", "count").summary(array_to_vector("vec")).alias("s"))
        .select("fold", "s.*")
        .collect()
    )  # a row per fold
    mean = {r["fold"]: r["mean"].toArray() for r in per_fold}
    spread_ = {r["fold"]: r["variance"].toArray() * (r["count"] - 1) for r in per_fold}
    size = {r["fold"]: r["count"] for r in per_fold}
    dims = len(next(iter(mean.values())))
    out = {}
    for fold in range(folds):
        kept = [f for f in mean if f != fold]
        n = sum(size[f] for f in kept)
        center = sum(mean[f] * size[f] for f in kept) / n
        square = sum(spread_[f] + size[f] * (mean[f] - center) ** 2 for f in kept) / n
        total = square.mean() + center.var()  # of all entries
        values = {"auto": 1.0 / dims, "scale": 1.0 / (dims * total) if total > 0 else 1.0}
        out |= {(name, fold): values[name] if isinstance(name, str) else float(name) for name in names}
    return out, dims


# --- classifier on windows -----------------------------------------------------------------

@dataclass
class WindowModel:
    """A classifier of flow windows and the way windows become vectors."""

    model: object
    size: int
    kind: str

    def score(self, windows: DataFrame) -> DataFrame:
        vectors = windows.withColumn("features", array_to_vector(W.window_vector("matrix", self.kind)))
        return score(vectors, self.model)

    def score_tiled(self, df: DataFrame, row: Column) -> DataFrame:
        """:meth:`score` of windows that repeat ``row``, without building them for
        their statistics."""
        tiled = df.withColumn("matrix", W.tile(row, self.size))
        if self.kind != "stats":
            return self.score(tiled.drop("features"))
        return score(tiled.withColumn("features", array_to_vector(W.tiled_vector(row, self.size))), self.model)


def window_classifier(
    windows: DataFrame,
    validation: DataFrame | None = None,
    *,
    size: int = 20,
    kind: str = "stats",
    method: str = "mlp",
    layers: Sequence[int] = (256, 128),
    max_iters: Sequence[int] = (25, 50, 100),
    seed: int = 42,
    **kw,
) -> WindowModel:
    """Learn the class of windows (``matrix``, ``label_idx``).

    ``mlp``: a perceptron per ``max_iters`` entry, the one with the best
    validation accuracy is kept; classes are balanced by repeating rows, as
    it takes no weights. ``forest``: a weighted forest.
    """
    vectors = spread(
        windows.select(array_to_vector(W.window_vector("matrix", kind)).alias("features"), LABEL)
    ).persist()
    try:
        if method == "forest":
            return WindowModel(random_forest(vectors, seed=seed, **kw), size, kind)
        if method != "mlp":
            raise ValueError(f"unknown method: {method}")
        width = vectors.first()["features"].size
        n_classes = int(vectors.agg(F.max(LABEL)).first()[0]) + 1
        weighted = attach_weights(vectors, LABEL)
        copies = F.greatest(F.round("weight"), F.lit(1.0)).cast("int")
        balanced = weighted.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy", "weight")
        best, best_accuracy = None, -1.0
        for iterations in max_iters:
            model = MultilayerPerceptronClassifier(
                layers=[width, *layers, n_classes], maxIter=iterations, seed=seed,
                labelCol=LABEL, featuresCol="features", **kw,
            ).fit(balanced)
            candidate = WindowModel(model, size, kind)
            if validation is None:
                best = candidate
                continue
            scored = candidate.score(validation)
            accuracy = M.weighted_metrics(scored, LABEL, "prediction").first()["accuracy"] or 0.0
            if accuracy > best_accuracy:
                best, best_accuracy = candidate, accuracy
        return best
    finally:
        vectors.unpersist()


def score_single_flow(
    df: DataFrame, model: WindowModel, classes: Sequence[str], features: str = "features"
) -> DataFrame:
    """Class and confidence of single flows: each is repeated to a window."""
    vector = vector_to_array(features) if dict(df.dtypes)[features] == "vector" else F.col(features)
    scored = model.score_tiled(df, vector)
    return scored.withColumn("predicted_class", class_name("prediction", classes))
