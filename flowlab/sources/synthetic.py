"""Synthetic labelled flows for demonstrations and tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlab.schema import FLOW_FEATURES, SYNTHETIC_CLASSES


def synthetic_flows(
    spark: SparkSession, n: int = 5_000, classes: int = 6, seed: int = 42
) -> DataFrame:
    """``n // classes`` flows of each class, generated where they are needed.

    Packet length, gap and duration are Gaussian with a floor, the counts are
    uniform, all else follows. The classes are interleaved.
    """
    chosen = SYNTHETIC_CLASSES[:classes]
    per_class = n // classes
    kind = (F.col("row_id") % len(chosen)).cast("int")

    def pick(values):
        return F.element_at(F.array(*[F.lit(v) for v in values]), kind + 1)

    def gaussian(which, floor, salt):
        mean, sd = pick([c[which][0] for c in chosen]), pick([c[which][1] for c in chosen])
        return F.greatest(mean + sd * F.randn(seed + salt), F.lit(float(floor)))

    def uniform(low, high, salt):
        return F.lit(low) + F.rand(seed + salt) * (high - low)

    drawn = spark.range(per_class * len(chosen)).withColumnRenamed("id", "row_id").select(
        "row_id",
        pick([c[0] for c in chosen]).alias("label"),
        gaussian(1, 64, 1).alias("m"),
        gaussian(2, 0.001, 2).alias("g"),
        gaussian(3, 1, 3).alias("d"),
        F.floor(uniform(10, 200, 4)).alias("nf"),
        F.floor(uniform(5, 100, 5)).alias("nb"),
        uniform(0.02, 0.1, 6).alias("header_ratio"),
        uniform(0.9, 0.98, 7).alias("payload_ratio"),
        uniform(0.01, 0.1, 8).alias("active_mean"),
        uniform(0.5, 5.0, 9).alias("idle_mean"),
    )
    m, g = F.col("m"), F.col("g")
    fwd, bwd = F.col("nf") * m, F.col("nb") * m * 0.6
    features = {
        "fwd_packet_count": F.col("nf"),
        "bwd_packet_count": F.col("nb"),
        "total_fwd_bytes": fwd,
        "total_bwd_bytes": bwd,
        "flow_duration": F.col("d"),
        "flow_bytes_per_sec": (fwd + bwd) / F.col("d"),
        "flow_pkts_per_sec": (F.col("nf") + F.col("nb")) / F.col("d"),
        "fwd_bwd_byte_ratio": fwd / F.greatest(bwd, F.lit(1.0)),
        "fwd_bwd_pkt_ratio": F.col("nf") / F.greatest(F.col("nb"), F.lit(1)),
        "header_ratio": F.col("header_ratio"),
        "payload_ratio": F.col("payload_ratio"),
        "active_mean": F.col("active_mean"),
        "idle_mean": F.col("idle_mean"),
    }
    # Share of the mean length, spread, lowest and highest.
    for side, share, spread, low, low_share, high_share in (
        ("fwd", 1.0, 0.2, 64.0, 0.5, 1.5), ("bwd", 0.7, 0.15, 40.0, 0.3, 1.2),
    ):
        features |= {
            f"{side}_pkt_len_mean": m * share,
            f"{side}_pkt_len_std": m * spread,
            f"{side}_pkt_len_min": F.greatest(m * low_share, F.lit(low)),
            f"{side}_pkt_len_max": F.least(m * high_share, F.lit(1500.0)),
        }
    # Mean, spread, lowest and highest gap relative to the gap.
    for name, mean, spread, low, high in (
        ("iat", 1.0, 0.5, 0.1, 5.0), ("fwd_iat", 1.1, 0.4, 0.1, 4.0), ("bwd_iat", 0.9, 0.3, 0.1, 3.0),
    ):
        features |= {
            f"{name}_mean": g * mean, f"{name}_std": g * spread,
            f"{name}_min": g * low, f"{name}_max": g * high,
        }
    return drawn.select("row_id", *[features[f].alias(f) for f in FLOW_FEATURES], "label")
