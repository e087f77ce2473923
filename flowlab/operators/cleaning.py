"""Column and label cleaning. Everything here is a projection or a filter,

except the percentile bounds, which are fitted first and then applied as
literals.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlab.functions import scalars as S
from flowlab.operators import scale
from flowlab.operators.flows import estimated_header_ratio
from flowlab.schema import (
    DEFAULT_LABEL,
    FLOW_FEATURES,
    HARD_CAPS,
    LABEL_CONTAINS,
    LABEL_TAXONOMY,
    LOG_FEATURES,
    MIN_PER_CLASS,
)


def _each(df: DataFrame, cols: Sequence[str], fn) -> DataFrame:
    return df.withColumns({c: fn(F.col(c)) for c in cols if c in df.columns})


# --- names and shape ---------------------------------------------------------

def normalize_columns(df: DataFrame, style: str = "snake") -> DataFrame:
    """``snake``: trim, lower case, blanks to underscores. ``trim``: trim only."""
    change = {"snake": S.snake, "trim": str.strip}[style]
    return df.toDF(*[change(c) for c in df.columns])


def find_label(df: DataFrame) -> DataFrame:
    """``label`` from the first column named like a label, class or category."""
    found = next(
        (c for c in df.columns if any(w in c.lower() for w in ("label", "class", "category"))),
        None,
    )
    if found is None:
        raise ValueError("no label, class or category column")
    return df if found == "label" else df.withColumn("label", F.col(f"`{found}`"))


def missing_features(df: DataFrame, names: Sequence[str] = FLOW_FEATURES) -> list[str]:
    return [n for n in names if n not in df.columns]


def ensure_features(df: DataFrame, names: Sequence[str] = FLOW_FEATURES) -> DataFrame:
    return df.withColumns({n: F.lit(0.0) for n in missing_features(df, names)})


def project_flow(
    df: DataFrame, names: Sequence[str] = FLOW_FEATURES, keep: Sequence[str] = ()
) -> DataFrame:
    return df.select(*keep, *names, "label")


def union_all(dfs: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; columns absent from one input are NULL there."""
    result = dfs[0]
    for df in dfs[1:]:
        result = result.unionByName(df, allowMissingColumns=True)
    return result


# --- labels --------------------------------------------------------------------

def clean_label(df: DataFrame, default: str = DEFAULT_LABEL) -> DataFrame:
    known = F.nullif(F.nullif(F.trim(F.col("label")), F.lit("")), F.lit("nan"))
    return df.withColumn("label", F.coalesce(known, F.lit(default)))


def map_labels(
    df: DataFrame,
    mapping: Mapping[str, str] = LABEL_TAXONOMY,
    contains: Mapping[str, str] = LABEL_CONTAINS,
) -> DataFrame:
    """Labels to the taxonomy; labels it does not know pass through."""
    label = F.col("label")
    branches = [(label.contains(part), name) for part, name in contains.items()]
    for name in dict.fromkeys(mapping.values()):
        branches.append((label.isin([k for k, v in mapping.items() if v == name]), name))
    if not branches:
        return df
    result = F.when(*branches[0])
    for condition, name in branches[1:]:
        result = result.when(condition, name)
    return df.withColumn("label", result.otherwise(label))


def drop_unlabeled(df: DataFrame, label: str = "label") -> DataFrame:
    return df.where(F.col(label).isNotNull())


def drop_classes(df: DataFrame, names: Sequence[str] | DataFrame) -> DataFrame:
    """Without the named classes; a table of names becomes an anti join."""
    if isinstance(names, DataFrame):
        return df.join(scale.checked_broadcast(names.select("label")), "label", "left_anti")
    if not names:
        return df
    return df.where(F.coalesce(~F.col("label").isin(list(names)), F.lit(True)))


def min_support(df: DataFrame, n: int = MIN_PER_CLASS) -> DataFrame:
    """Only classes with at least ``n`` rows.

    Counted with map-side combination; the frequent classes then filter the
    rows in place, so a class that holds most rows never meets in one task.
    """
    frequent = df.groupBy("label").count().where(F.col("count") >= n).select("label")
    return df.join(scale.checked_broadcast(frequent), "label", "left_semi")


# --- numbers -------------------------------------------------------------------

def coerce(df: DataFrame, cols: Sequence[str], default: float | None = 0.0) -> DataFrame:
    """Text to double; unparsable and NaN become ``default``."""
    def fn(c):
        value = S.number(c)
        value = F.when(~F.isnan(value), value)
        return value if default is None else F.coalesce(value, F.lit(default))

    return _each(df, cols, fn)


def inf_to_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return _each(df, cols, lambda c: S.finite(c.cast("double")))


def finite_or_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return _each(df, cols, lambda c: S.or_zero(S.finite(c.cast("double"))))


def clip_lower(df: DataFrame, cols: Sequence[str], bound: float = 0.0) -> DataFrame:
    return _each(df, cols, lambda c: S.at_least(c, bound))


def hard_caps(df: DataFrame, caps: Mapping[str, float] = HARD_CAPS) -> DataFrame:
    df = coerce(df, list(caps))
    return df.withColumns(
        {c: F.least(F.col(c), F.lit(float(cap))) for c, cap in caps.items() if c in df.columns}
    )


def micros_to_seconds(
    df: DataFrame, column: str = "flow_duration", cap: float = 100.0, legacy: bool = False
) -> DataFrame:
    """Microseconds to seconds, then the cap; ``legacy`` also caps before."""
    value = S.or_zero(S.number(column))
    if legacy:
        value = F.least(value, F.lit(cap))
    return df.withColumn(column, F.least(value / 1e6, F.lit(cap)))


def upper_bounds(df: DataFrame, cols: Sequence[str], p: float = 0.95, **kw) -> dict[str, float]:
    """The positive ``p`` quantiles of the columns, as fitted state."""
    cols = [c for c in cols if c in df.columns]
    numbers = coerce(df.select(*cols), cols, default=None)
    found = scale.exact_quantiles(numbers, cols, [p], **kw)
    return {c: v[0] for c, v in found.items() if v[0] is not None and v[0] > 0}


def clip_upper(df: DataFrame, bounds: Mapping[str, float]) -> DataFrame:
    return hard_caps(df, bounds)


def percentile_clip(df: DataFrame, cols: Sequence[str], p: float = 0.95, **kw) -> DataFrame:
    return clip_upper(df, upper_bounds(df, cols, p, **kw))


def log1p_features(df: DataFrame, cols: Sequence[str] = LOG_FEATURES) -> DataFrame:
    df = coerce(df, cols)
    return _each(df, cols, lambda c: F.log1p(F.greatest(c, F.lit(0.0))))


def repair_iat(df: DataFrame) -> DataFrame:
    """After the log transform: minima follow the means, backward spread halves."""
    return df.withColumns(
        {
            "iat_min": F.greatest(F.col("iat_mean"), F.lit(0.0)),
            "fwd_iat_min": F.greatest(F.col("fwd_iat_mean"), F.lit(0.0)),
            "bwd_iat_min": F.greatest(F.col("bwd_iat_mean"), F.lit(0.0)),
            "bwd_iat_std": F.col("bwd_iat_mean") * 0.5,
        }
    )


# --- derived features ------------------------------------------------------------

def derive_ratios(df: DataFrame, rate: bool = False) -> DataFrame:
    """Forward/backward ratios; with ``rate`` also packets per second."""
    df = df.withColumns(
        {
            "fwd_bwd_byte_ratio": S.ratio("total_fwd_bytes", "total_bwd_bytes"),
            "fwd_bwd_pkt_ratio": S.ratio("fwd_packet_count", "bwd_packet_count"),
        }
    )
    if rate:
        packets = F.col("fwd_packet_count") + F.col("bwd_packet_count")
        df = df.withColumn("flow_pkts_per_sec", S.ratio(packets, "flow_duration", 1e-6))
    return df


def estimate_header(df: DataFrame) -> DataFrame:
    packets = F.col("fwd_packet_count") + F.col("bwd_packet_count")
    size = F.col("total_fwd_bytes") + F.col("total_bwd_bytes")
    share = estimated_header_ratio(packets, F.when(size == 0, 1.0).otherwise(size))
    return df.withColumns(
        {
            "header_ratio": share,
            "payload_ratio": F.least(F.greatest(1.0 - share, F.lit(0.0)), F.lit(1.0)),
        }
    )


def estimate_active_idle(df: DataFrame) -> DataFrame:
    duration = S.or_zero(S.number("flow_duration"))
    return df.withColumns({"active_mean": duration * 0.7, "idle_mean": duration * 0.3})
