"""Fitted preprocessing: imputation, scaling, label codes, whole profiles.

Fitted state is a handful of numbers per column. It is applied as literals in
a projection, so transforming data needs no join and no shuffle.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlab.functions import scalars as S
from flowlab.operators import cleaning as C
from flowlab.operators import sampling, scale
from flowlab.schema import (
    DROPPED_CLASSES,
    FLOW_FEATURES,
    HARD_CAPS,
    LIVE_CAPPED,
    LIVE_LOG_POSITIONS,
    LOG_FEATURES,
)
from flowlab.session import stored

LIVE_LOG_FEATURES = [FLOW_FEATURES[i] for i in LIVE_LOG_POSITIONS]


# --- single estimators ---------------------------------------------------------

@dataclass
class Params:
    """Per column: value for NULL, centre and scale."""

    fill: dict[str, float] = field(default_factory=dict)
    center: dict[str, float] = field(default_factory=dict)
    scale: dict[str, float] = field(default_factory=dict)


def _unit_if_zero(x: float | None) -> float:
    return 1.0 if not x else float(x)


def fit_params(df: DataFrame, cols: Sequence[str], kind: str, **kw) -> Params:
    """``median`` imputation, ``robust`` or ``standard`` scaling parameters.

    Robust is ``(x - median) / (q75 - q25)``, standard uses the population
    deviation; a zero spread divides by 1.
    """
    cols = list(cols)
    params = Params()
    if kind == "median":
        found = scale.exact_quantiles(df, cols, [0.5], **kw)
        params.fill = {c: float(v[0]) if v[0] is not None else 0.0 for c, v in found.items()}
    elif kind == "robust":
        params = robust_params(scale.exact_quantiles(df, cols, [0.25, 0.5, 0.75], **kw))
    elif kind == "standard":
        row = df.agg(
            *[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)],
            *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(cols)],
        ).first()
        for i, c in enumerate(cols):
            params.center[c] = float(row[f"m_{i}"] or 0.0)
            params.scale[c] = _unit_if_zero(row[f"s_{i}"])
    else:
        raise ValueError(f"unknown kind: {kind}")
    return params


def robust_params(quartiles: Mapping[str, Sequence]) -> Params:
    params = Params()
    for c, (low, mid, high) in quartiles.items():
        params.center[c] = float(mid or 0.0)
        params.scale[c] = _unit_if_zero((high or 0.0) - (low or 0.0))
    return params


def scaled(c: str, params: Params) -> Column:
    value = F.col(c).cast("double")
    if c in params.fill:
        value = F.coalesce(value, F.lit(params.fill[c]))
    if c in params.center:
        value = (value - F.lit(params.center[c])) / F.lit(params.scale[c])
    return value


def apply_params(df: DataFrame, params: Params) -> DataFrame:
    cols = {*params.fill, *params.center}
    return df.withColumns({c: scaled(c, params) for c in df.columns if c in cols})


# --- labels ------------------------------------------------------------------------

def class_names(df: DataFrame, label: str = "label") -> list[str]:
    """Sorted distinct labels: the fitted state of the encoder."""
    rows = df.select(label).where(F.col(label).isNotNull()).distinct().collect()
    return sorted(r[0] for r in rows)


def encode_labels(
    df: DataFrame, classes: Sequence[str] | None = None, label: str = "label", out: str = "label_idx"
) -> DataFrame:
    """Sorted names to codes 0, 1, ...; a label without a code is an error."""
    classes = list(classes) if classes is not None else class_names(df, label)
    position = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label))
    code = F.when(position > 0, (position - 1).cast("int"))
    unseen = F.raise_error(F.concat(F.lit("unseen label: "), F.coalesce(F.col(label), F.lit("NULL"))))
    return df.withColumn(out, F.coalesce(code, unseen.cast("int")))


def class_name(index: str | Column, classes: Sequence[str]) -> Column:
    """Name of a class index; an index outside the list becomes text."""
    i = S.col(index).cast("int")
    names = F.array(*[F.lit(c) for c in classes])
    inside = (i >= 0) & (i < len(classes))
    return F.when(inside, F.try_element_at(names, i + 1)).otherwise(i.cast("string"))


def decode_labels(
    df: DataFrame, classes: Sequence[str], index: str = "label_idx", out: str = "label"
) -> DataFrame:
    return df.withColumn(out, class_name(index, classes))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weights ``n / (k * n_c)``: one row per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    from pyspark.sql import Window

    every = Window.partitionBy()  # over one row per class
    return counts.withColumn(
        "weight", F.sum("n").over(every) / (F.count(F.lit(1)).over(every) * F.col("n"))
    )


def attach_weights(df: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    weights = class_weights(df, label).select(label, F.col("weight").alias(out))
    return df.join(scale.checked_broadcast(weights), label)


# --- complete profiles --------------------------------------------------------------

@dataclass
class Preprocessor:
    """Fitted state of a whole preprocessing profile.

    ``profile="plain"``: fill absent features, drop infinities, impute, scale.
    ``profile="cic"``: caps, unit conversion, percentile caps, log transform,
    gap repair, then impute and scale. ``profile="live"``: the caps and log
    set of the live scorers. Batch and stream use the same expressions.
    """

    features: list[str]
    profile: str
    classes: list[str]
    dropped: list[str] = field(default_factory=list)
    upper: dict[str, float] = field(default_factory=dict)
    params: Params = field(default_factory=Params)
    micros: bool = True
    legacy_duration: bool = False

    @property
    def kept_classes(self) -> list[str]:
        return [c for c in self.classes if c not in self.dropped]

    def clean(self, df: DataFrame) -> DataFrame:
        return _clean(df, self.features, self.profile, self.upper, self.micros, self.legacy_duration)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> Preprocessor:
        state = json.loads(text)
        return Preprocessor(**(state | {"params": Params(**state["params"])}))


def _capped(df: DataFrame, features, profile, micros, legacy) -> DataFrame:
    df = C.ensure_features(df, features)
    caps = HARD_CAPS if profile == "cic" else {c: HARD_CAPS[c] for c in LIVE_CAPPED}
    caps = {c: v for c, v in caps.items() if c in features}
    if profile == "cic" and micros and "flow_duration" in features:
        caps.pop("flow_duration")
        df = C.micros_to_seconds(df, legacy=legacy)
    return C.hard_caps(df, caps)


def _clean(df, features, profile, upper, micros, legacy) -> DataFrame:
    if profile == "plain":
        df = C.ensure_features(df, features)
        return C.inf_to_null(df, features)
    df = C.clip_upper(_capped(df, features, profile, micros, legacy), upper)
    df = C.inf_to_null(df, features)
    logged = LOG_FEATURES if profile == "cic" else LIVE_LOG_FEATURES
    df = C.log1p_features(df, [f for f in logged if f in features])
    if profile == "cic":
        need = {"iat_mean", "fwd_iat_mean", "bwd_iat_mean", "iat_min", "fwd_iat_min",
                "bwd_iat_min", "bwd_iat_std"}
        if need <= set(features):
            df = C.repair_iat(df)
    if profile == "live":
        df = C.finite_or_zero(df, features)
    return df


def _fit_imputed(train: DataFrame, fill_from: DataFrame | None, cols, scaler: str) -> Params:
    """Medians, then scaling parameters of the imputed columns.

    Without NULLs the median and the quartiles come from the same pass; only
    columns in which something was imputed are looked at again.
    """
    counts: dict = {}
    quartiles = scale.exact_quantiles(train, cols, [0.25, 0.5, 0.75], counts=counts)
    source = quartiles
    if fill_from is not None:
        source = scale.exact_quantiles(fill_from, cols, [0.25, 0.5, 0.75])
    fill = {c: float(v[1]) if v[1] is not None else 0.0 for c, v in source.items()}
    holes = [c for c in cols if counts[c] < counts[None]]
    params = Params()
    if scaler == "robust":
        params = robust_params(quartiles)
        again = holes
    else:
        again = list(cols)
    if again:
        filled = apply_params(train.select(*again), Params(fill={c: fill[c] for c in again}))
        refit = fit_params(filled, again, scaler)
        params.center |= refit.center
        params.scale |= refit.scale
    params.fill = fill
    return params


def fit_preprocessor(
    df: DataFrame,
    features: Sequence[str] = FLOW_FEATURES,
    *,
    profile: str = "plain",
    scaler: str = "robust",
    fit_on: str = "train",
    test: float = 0.2,
    val: float = 0.1,
    seed: int = 42,
    ids: Sequence[str] = ("row_id",),
    drop: Sequence[str] | None = None,
    micros: bool = True,
    legacy_duration: bool = False,
) -> tuple[Preprocessor, DataFrame]:
    """Fit on the training split and return the state and the prepared table.

    The table keeps the ids and has ``label``, ``label_idx``, ``split``, the
    scaled columns and the vector ``features``. ``fit_on="all"`` fits the
    imputer before the split, as single-machine pipelines often do.

    Fitting takes several passes. Except for the plain profile, whose expressions
    are short, the labelled rows and later the cleaned and split ones are written
    once: passes over the bare input would derive every column again, in
    expressions that grow with each step put on top of them.
    """
    features = list(features)
    used = {*ids, "label", *features}
    if profile != "plain":
        df = stored(df.select(*[c for c in df.columns if c in used]), "labeled")
    df = C.drop_unlabeled(df)
    upper: dict[str, float] = {}
    if profile == "cic":
        upper = C.upper_bounds(_capped(df, features, profile, micros, legacy_duration), features)
    if drop is None:
        drop = DROPPED_CLASSES if profile == "cic" else []
    model = Preprocessor(
        features, profile, class_names(df), list(drop), upper,
        micros=micros, legacy_duration=legacy_duration,
    )
    cleaned = model.clean(df).select(*ids, "label", *features)
    parts = sampling.stratified_split(cleaned, test, val, seed, ids)
    if profile != "plain":
        parts = stored(parts, "split")
    train = parts.where(F.col("split") == "train")
    model.params = _fit_imputed(train, None if fit_on == "train" else parts, features, scaler)
    return model, transform(parts, model, cleaned=True)


def transform(df: DataFrame, model: Preprocessor | None, *, cleaned: bool = False) -> DataFrame:
    """Apply fitted state; works on batch and streaming tables alike."""
    if model is None:
        raise ValueError("the preprocessor is not fitted")
    if not cleaned:
        df = model.clean(df)
    df = apply_params(df, model.params)
    if "label" in df.columns:
        df = C.drop_classes(df, model.dropped)
        df = encode_labels(df, model.kept_classes)
    return VectorAssembler(
        inputCols=model.features, outputCol="features", handleInvalid="keep"
    ).transform(df)


def save_preprocessor(spark: SparkSession, model: Preprocessor, path: str) -> None:
    spark.createDataFrame([(model.to_json(),)], "state string").coalesce(1).write.mode(
        "overwrite"
    ).text(path)


def load_preprocessor(spark: SparkSession, path: str) -> Preprocessor:
    return Preprocessor.from_json(spark.read.text(path).first()[0])


def params_table(spark: SparkSession, params: Params, cols: Sequence[str]) -> DataFrame:
    """Fitted parameters as a small table, for reports."""
    rows: list[Mapping] = [
        (c, params.fill.get(c), params.center.get(c), params.scale.get(c)) for c in cols
    ]
    return spark.createDataFrame(
        rows, "feature string, fill double, center double, scale double"
    )
