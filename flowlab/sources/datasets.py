"""Published flow tables on the canonical schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlab.operators import cleaning as C
from flowlab.schema import CIC_COLUMNS, FLOW_FEATURES, ISCX_COLUMNS, UNSW_COLUMNS
from flowlab.sources import files


#: columns the derived features of CIC-IDS-2017 are computed from
CIC_NEEDED = [
    "fwd_packet_count", "bwd_packet_count", "total_fwd_bytes", "total_bwd_bytes", "flow_duration",
]


def _features_as_double(df: DataFrame) -> DataFrame:
    return C.coerce(df, [f for f in FLOW_FEATURES if f in df.columns], default=None)


def load_unsw(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """A UNSW-NB15 frame (raw names) to features and label."""
    if "attack_cat" in df.columns and "label" in df.columns:
        df = df.drop("label")  # the numeric attack flag, not the category
    df = df.withColumnsRenamed(UNSW_COLUMNS)
    df = C.clean_label(df)
    df = _features_as_double(df)
    for name, default in (
        ("total_fwd_bytes", 0.0), ("total_bwd_bytes", 1.0),
        ("fwd_packet_count", 0.0), ("bwd_packet_count", 1.0),
    ):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(default))
    df = C.derive_ratios(df, rate=True)
    return C.project_flow(C.ensure_features(df), keep=keep)


def load_iscx(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """An ISCX VPN frame: normalised names, discovered label, renamed features."""
    df = C.find_label(C.normalize_columns(df))
    mapping = dict(ISCX_COLUMNS)
    for total, mean in (("fwd_iat_total", "fwd_iat_mean"), ("bwd_iat_total", "bwd_iat_mean")):
        if mean in df.columns:  # a measured mean wins over the total
            mapping.pop(total)
    df = _features_as_double(df.withColumnsRenamed(mapping))
    return C.project_flow(C.ensure_features(df), keep=keep)


def load_cic(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """A CIC-IDS-2017 frame: renamed, six derived features, label taxonomy."""
    df = C.normalize_columns(df, "trim").withColumnsRenamed(CIC_COLUMNS)
    df = C.ensure_features(_features_as_double(df), CIC_NEEDED)
    df = C.estimate_active_idle(C.estimate_header(C.derive_ratios(df)))
    df = C.clean_label(C.map_labels(df.withColumn("label", F.trim("label"))))
    return C.project_flow(C.ensure_features(df), keep=keep)


def read_unsw(spark: SparkSession, path: str) -> DataFrame:
    return load_unsw(files.read_csv(spark, path))


def read_iscx(spark: SparkSession, path: str) -> DataFrame:
    return load_iscx(files.read_csv(spark, path))


def read_cic(spark: SparkSession, path: str) -> DataFrame:
    """All CSV files of a folder, whatever the order of their columns."""
    return load_cic(C.normalize_columns(files.read_csv_by_name(spark, path), "trim"))


def load_dataset(spark: SparkSession, path: str, kind: str = "auto") -> DataFrame:
    """Features and label from ``path``.

    ``auto``: a folder holds captures; a name with ``unsw`` or ``nb15`` is
    UNSW-NB15; anything else is an ISCX table.
    """
    if kind == "auto":
        name = path.rstrip("/").split("/")[-1].lower()
        if files.is_directory(spark, path):
            kind = "pcap"
        elif "unsw" in name or "nb15" in name:
            kind = "unsw_nb15"
        else:
            kind = "iscx_vpn"
    if kind == "pcap":
        from flowlab.sources.pcap import flows_from_captures

        return flows_from_captures(spark, path)
    readers = {"unsw_nb15": read_unsw, "iscx_vpn": read_iscx, "cic_ids": read_cic}
    if kind not in readers:
        raise ValueError(f"unknown dataset kind: {kind}")
    return readers[kind](spark, path)
