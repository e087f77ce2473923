"""Packets to flows: keys, direction, splitting, gaps and the 33 statistics.

All ordered work happens in one window partitioning, the flow key. A key that
holds more rows than a task should sort is cut into time chunks, each of which
is its own window partition; what a chunk has to know about the past (last
packet, open flow, first source) comes from a table with one row per chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlab.functions import scalars as S
from flowlab.operators import scale
from flowlab.schema import FLOW_FEATURES, FLOW_KEY

MIN_DURATION = 1e-6
IDLE_GAP = 1.0


# ---------------------------------------------------------------------------
# row-local operators
# ---------------------------------------------------------------------------

def packet_fields(raw: DataFrame) -> DataFrame:
    """Decoded header fields to packets: ports only for TCP and UDP, header size."""
    has_ports = F.col("protocol").isin(6, 17)
    return raw.select(
        *[c for c in raw.columns if c not in ("src_port", "dst_port", "tcp_data_offset",
                                              "tcp_flags", "header_size")],
        F.when(has_ports, F.col("src_port")).otherwise(0).cast("int").alias("src_port"),
        F.when(has_ports, F.col("dst_port")).otherwise(0).cast("int").alias("dst_port"),
        S.header_bytes().alias("header_size"),
        F.when(F.col("protocol") == 6, F.col("tcp_flags")).otherwise(0).cast("int").alias("tcp_flags"),
    )


def ipv4_only(df: DataFrame, version: str = "ip_version") -> DataFrame:
    return df.where(F.col(version) == 4)


def with_flow_key(packets: DataFrame) -> DataFrame:
    """The undirected 5-tuple as plain columns ``a_ip, b_ip, a_port, b_port``."""
    swap = S.swapped()
    return packets.withColumns(
        {
            "a_ip": F.when(swap, F.col("dst_ip")).otherwise(F.col("src_ip")),
            "b_ip": F.when(swap, F.col("src_ip")).otherwise(F.col("dst_ip")),
            "a_port": F.when(swap, F.col("dst_port")).otherwise(F.col("src_port")),
            "b_port": F.when(swap, F.col("src_port")).otherwise(F.col("dst_port")),
        }
    )


def min_packets(flows: DataFrame, n: int = 5, count: str = "n_packets") -> DataFrame:
    return flows.where(F.col(count) >= n)


def protocol_name(df: DataFrame) -> DataFrame:
    return df.withColumn("protocol_name", S.protocol_text())


# ---------------------------------------------------------------------------
# the ordered pass
# ---------------------------------------------------------------------------

def split_flows(
    packets: DataFrame,
    timeout: float | None = None,
    split_on_fin: bool = False,
    *,
    scope: Sequence[str] = (),
    chunk_seconds: float = 60.0,
    hot_rows: int | None = scale.TASK_ROWS,
) -> DataFrame:
    """Number the flows of each key and describe each packet within its flow.

    Adds ``flow_seq`` (0, 1, ... per key; a new flow starts after a gap longer
    than ``timeout`` and, with ``split_on_fin``, after a FIN/RST packet),
    ``first_src``, ``is_fwd`` (the source is the flow's first source), ``iat``
    and ``dir_iat`` (seconds since the previous packet of the flow, and of the
    same direction; NULL for the first).

    Packets are ordered by ``(ts, packet_id)``. ``scope`` are further key
    columns, such as the source file. Keys with more than ``hot_rows`` packets
    are cut into chunks of ``chunk_seconds``; None skips the detection.
    """
    keyed = with_flow_key(packets)
    keys = [*scope, *FLOW_KEY]
    hot = scale.hot_groups(keyed, keys, hot_rows) if hot_rows is not None else []
    if not hot:
        return _describe(_local_pass(keyed, keys, timeout, split_on_fin), keys, carried=False)
    chunk = F.when(F.col("_hot"), F.floor(F.col("ts") / F.lit(float(chunk_seconds))))
    chunked = scale.mark_hot(keyed, keys, hot, "_hot").withColumn("_chunk", F.struct(chunk.alias("c")))
    group = [*keys, "_chunk"]
    rows = _local_pass(chunked.drop("_hot"), group, timeout, split_on_fin)
    hot_rows_only = _local_pass(chunked.where("_hot").drop("_hot"), group, timeout, split_on_fin)
    carry = _carries(hot_rows_only, keys, timeout)
    joined = rows.join(carry, group, "left")
    return _describe(joined, group, carried=True).drop("_chunk")


def _in_order(group: Sequence[str]):
    return Window.partitionBy(*group).orderBy("ts", "packet_id")


def _local_pass(keyed: DataFrame, group: Sequence[str], timeout, split_on_fin) -> DataFrame:
    """Previous packet and number of flow starts so far, inside one partition."""
    w = _in_order(group)
    closes = S.closes_flow() if split_on_fin else F.lit(False)
    df = keyed.withColumn("_closes", closes).withColumns(
        {"_prev_ts": F.lag("ts").over(w), "_prev_closes": F.lag("_closes").over(w)}
    )
    breaks = F.coalesce(F.col("_prev_closes"), F.lit(False))
    if timeout is not None:
        gap_breaks = (F.col("ts") - F.col("_prev_ts")) > F.lit(float(timeout))
        breaks = breaks | F.coalesce(gap_breaks, F.lit(False))
    return df.withColumn("_starts", breaks).withColumn(
        "_seq", F.sum(F.col("_starts").cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    )


def _carries(rows: DataFrame, keys: Sequence[str], timeout) -> DataFrame:
    """What each chunk of a hot key must know about earlier chunks.

    One row per chunk, so the windows over a key see as many rows as the
    capture has chunks, not packets.
    """
    group = [*keys, "_chunk"]
    pieces = rows.groupBy(*group, "_seq").agg(
        F.min(F.struct("ts", "packet_id", "src_ip")).alias("head"),
        F.max(F.struct("ts", "packet_id", "_closes")).alias("tail"),
        F.max(F.when(F.col("src_ip") == F.col("a_ip"), F.col("ts"))).alias("last_a"),
        F.max(F.when(F.col("src_ip") != F.col("a_ip"), F.col("ts"))).alias("last_b"),
    )
    chunks = pieces.groupBy(*group).agg(
        F.min_by("head", "_seq").alias("head"),
        F.max("_seq").alias("starts"),
        F.max_by(F.struct("head", "tail", "last_a", "last_b"), "_seq").alias("open"),
    )
    w = Window.partitionBy(*keys).orderBy("_chunk")
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    before = F.lag("open.tail").over(w)
    fresh = before.isNull() | before["_closes"]
    if timeout is not None:
        fresh = fresh | ((F.col("head.ts") - before["ts"]) > F.lit(float(timeout)))
    chunks = chunks.withColumns({"fresh": fresh, "before_ts": before["ts"]})
    opened = F.col("starts") + F.col("fresh").cast("long")
    chunks = chunks.withColumn(
        "base",
        F.coalesce(F.sum(opened).over(earlier), F.lit(0)) + F.col("fresh").cast("long") - 1,
    ).withColumn("open_seq", F.col("base") + F.col("starts"))

    def last_known(value: Column, known: Column) -> Column:
        tagged = F.when(known, F.struct(F.col("open_seq").alias("seq"), value.alias("v")))
        latest = F.last(tagged, ignorenulls=True).over(earlier)
        return F.when(latest["seq"] == F.col("base"), latest["v"])

    return chunks.select(
        *group,
        F.col("base").alias("_base"),
        F.when(~F.col("fresh"), F.col("before_ts")).alias("_carry_ts"),
        last_known(F.col("open.head.src_ip"), (F.col("starts") > 0) | F.col("fresh")).alias("_carry_src"),
        last_known(F.col("open.last_a"), F.col("open.last_a").isNotNull()).alias("_carry_a"),
        last_known(F.col("open.last_b"), F.col("open.last_b").isNotNull()).alias("_carry_b"),
    )


def _describe(rows: DataFrame, group: Sequence[str], carried: bool) -> DataFrame:
    """First source, direction and gaps; same partitioning and order as before."""
    w = _in_order(group)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    side_a = F.col("src_ip") == F.col("a_ip")

    def previous(side: Column) -> Column:
        seen = F.last(F.when(side, F.struct("_seq", "ts")), ignorenulls=True).over(earlier)
        return F.when(seen["_seq"] == F.col("_seq"), seen["ts"])

    opens = F.col("_starts") | F.col("_prev_ts").isNull()
    if carried:
        # the first row of a chunk that continues a flow opens nothing
        opens = F.col("_starts") | (F.col("_prev_ts").isNull() & F.col("_carry_ts").isNull())
    df = rows.withColumns(
        {
            "first_src": F.last(F.when(opens, F.col("src_ip")), ignorenulls=True).over(upto),
            "_last_same": F.when(side_a, previous(side_a)).otherwise(previous(~side_a)),
        }
    )
    gap_from = F.when(~F.col("_starts"), F.col("_prev_ts"))
    same_from = F.col("_last_same")
    seq = F.col("_seq")
    if carried:
        continued = (F.col("_seq") == 0) & F.col("_carry_ts").isNotNull()
        df = df.withColumn(
            "first_src", F.when(continued, F.col("_carry_src")).otherwise(F.col("first_src"))
        )
        gap_from = F.when(
            continued & F.col("_prev_ts").isNull(), F.col("_carry_ts")
        ).otherwise(gap_from)
        carry_same = F.when(side_a, F.col("_carry_a")).otherwise(F.col("_carry_b"))
        same_from = F.coalesce(same_from, F.when(continued, carry_same))
        seq = seq + F.coalesce(F.col("_base"), F.lit(0))
    df = df.withColumns(
        {
            "flow_seq": seq.cast("long"),
            "is_fwd": F.col("src_ip") == F.col("first_src"),
            "iat": F.col("ts") - gap_from,
            "dir_iat": F.col("ts") - same_from,
        }
    )
    return df.drop(*[c for c in df.columns if c.startswith("_") and c != "_chunk"])


def with_first_source(packets: DataFrame, **kw) -> DataFrame:
    return split_flows(packets, **kw).drop("iat", "dir_iat", "is_fwd")


def with_direction(packets: DataFrame, how: str = "first", **kw) -> DataFrame:
    """``direction`` is ``fwd`` or ``bwd``.

    ``first``: relative to the first source of the flow. ``key``: relative to
    the key's smaller endpoint, which needs no order and hence no shuffle.
    """
    if how == "key":
        keyed = with_flow_key(packets)
        forward = F.col("src_ip") == F.col("a_ip")
    elif how == "first":
        keyed = split_flows(packets, **kw).drop("iat", "dir_iat")
        forward = F.col("is_fwd")
    else:
        raise ValueError(f"unknown direction rule: {how}")
    return keyed.withColumn("direction", F.when(forward, "fwd").otherwise("bwd")).drop("is_fwd")


def with_iat(packets: DataFrame, **kw) -> DataFrame:
    return split_flows(packets, **kw).drop("dir_iat", "is_fwd", "first_src")


def with_directional_iat(packets: DataFrame, **kw) -> DataFrame:
    return split_flows(packets, **kw).drop("iat", "first_src")


# ---------------------------------------------------------------------------
# flow statistics
# ---------------------------------------------------------------------------

def flow_features(
    packets: DataFrame,
    timeout: float | None = None,
    split_on_fin: bool = False,
    min_packets: int = 5,
    profile: str = "exact",
    *,
    scope: Sequence[str] = (),
    label: str | None = None,
    **kw,
) -> DataFrame:
    """One row per flow with the canonical features.

    ``profile="exact"`` measures every feature; ``"estimated"`` derives the
    spread features from means the way the light-weight live scorers do (with
    direction by key order). The grouping reuses the partitioning of the
    ordered pass; for chunked hot keys Spark's partial aggregation merges the
    chunks.
    """
    if profile not in ("exact", "estimated"):
        raise ValueError(f"unknown profile: {profile}")
    rows = split_flows(packets, timeout, split_on_fin, scope=scope, **kw)
    forward = F.col("is_fwd") if profile == "exact" else F.col("src_ip") == F.col("a_ip")
    rows = rows.withColumn("_fwd", forward)
    measures = {
        "start_ts": F.min("ts"),
        "end_ts": F.max("ts"),
        "n_packets": F.count(F.lit(1)),
        **_base_measures(),
        **(_exact_measures() if profile == "exact" else {}),
    }
    if label:
        # of the earliest packet; ids of different files may be equal
        place = [c for c in ("source_file", "packet_id") if c in rows.columns]
        measures["label"] = F.min_by(label, F.struct("ts", *place))
    keys = [*scope, *FLOW_KEY, "flow_seq"]
    flows = rows.groupBy(*keys).agg(*[e.alias(n) for n, e in measures.items()])
    flows = flows.where(F.col("n_packets") >= min_packets)
    derived = _exact_features() if profile == "exact" else _estimated_features()
    return flows.select(
        *keys, "start_ts", "end_ts", "n_packets",
        *[derived[f].alias(f) for f in FLOW_FEATURES],
        *(["label"] if label else []),
    )


def _when_fwd(c):
    return F.when(F.col("_fwd"), c)


def _when_bwd(c):
    return F.when(~F.col("_fwd"), c)


def _zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def _base_measures() -> dict[str, Column]:
    one, size = F.lit(1), F.col("size")
    return {
        "_nf": F.count(_when_fwd(one)),
        "_nb": F.count(_when_bwd(one)),
        "_bf": F.coalesce(F.sum(_when_fwd(size)), F.lit(0)),
        "_bb": F.coalesce(F.sum(_when_bwd(size)), F.lit(0)),
        "_iat_mean": _zero(F.avg("iat")),
        "_iat_std": _zero(F.stddev_pop("iat")),
        "_fiat_mean": _zero(F.avg(_when_fwd(F.col("dir_iat")))),
        "_biat_mean": _zero(F.avg(_when_bwd(F.col("dir_iat")))),
        "_biat_std": _zero(F.stddev_pop(_when_bwd(F.col("dir_iat")))),
    }


def _exact_measures() -> dict[str, Column]:
    iat = F.col("iat")
    found = {
        "_header": F.sum("header_size"),
        "_iat_min": _zero(F.min(iat)),
        "_iat_max": _zero(F.max(iat)),
        "_fiat_std": _zero(F.stddev_pop(_when_fwd(F.col("dir_iat")))),
        "active_mean": _zero(F.avg(F.when(iat < IDLE_GAP, iat))),
        "idle_mean": _zero(F.avg(F.when(iat >= IDLE_GAP, iat))),
    }
    for side, pick in (("f", _when_fwd), ("b", _when_bwd)):
        found |= {
            f"_{side}len_std": _zero(F.stddev_pop(pick(F.col("size")))),
            f"_{side}len_min": _zero(F.min(pick(F.col("size"))).cast("double")),
            f"_{side}len_max": _zero(F.max(pick(F.col("size"))).cast("double")),
            f"_{side}iat_min": _zero(F.min(pick(F.col("dir_iat")))),
            f"_{side}iat_max": _zero(F.max(pick(F.col("dir_iat")))),
        }
    return found


def _common_features() -> dict[str, Column]:
    duration = F.greatest(F.col("end_ts") - F.col("start_ts"), F.lit(MIN_DURATION))
    total = F.col("_bf") + F.col("_bb")
    return {
        "fwd_packet_count": F.col("_nf"),
        "bwd_packet_count": F.col("_nb"),
        "total_fwd_bytes": F.col("_bf"),
        "total_bwd_bytes": F.col("_bb"),
        "fwd_pkt_len_mean": F.col("_bf") / F.greatest(F.col("_nf"), F.lit(1)),
        "bwd_pkt_len_mean": F.col("_bb") / F.greatest(F.col("_nb"), F.lit(1)),
        "flow_duration": duration,
        "flow_bytes_per_sec": total / duration,
        "flow_pkts_per_sec": F.col("n_packets") / duration,
        "iat_mean": F.col("_iat_mean"),
        "iat_std": F.col("_iat_std"),
        "fwd_iat_mean": F.col("_fiat_mean"),
        "bwd_iat_mean": F.col("_biat_mean"),
        "bwd_iat_std": F.col("_biat_std"),
        "fwd_bwd_byte_ratio": F.col("_bf") / F.greatest(F.col("_bb"), F.lit(1)),
        "fwd_bwd_pkt_ratio": F.col("_nf") / F.greatest(F.col("_nb"), F.lit(1)),
    }


def _exact_features() -> dict[str, Column]:
    total = F.greatest(F.col("_bf") + F.col("_bb"), F.lit(1))
    features = _common_features()
    for side, short in (("fwd", "f"), ("bwd", "b")):
        features |= {f"{side}_pkt_len_{s}": F.col(f"_{short}len_{s}") for s in ("std", "min", "max")}
        features |= {f"{side}_iat_{s}": F.col(f"_{short}iat_{s}") for s in ("std", "min", "max")}
    features |= {
        "iat_min": F.col("_iat_min"),
        "iat_max": F.col("_iat_max"),
        "header_ratio": F.col("_header") / total,
        "payload_ratio": (F.col("_bf") + F.col("_bb") - F.col("_header")) / total,
        "active_mean": F.col("active_mean"),
        "idle_mean": F.col("idle_mean"),
    }
    return features


def _estimated_features() -> dict[str, Column]:
    features = _common_features()
    spread = features["iat_std"]
    for side, jitter in (("fwd", spread), ("bwd", F.col("_biat_std"))):
        size, gap = features[f"{side}_pkt_len_mean"], features[f"{side}_iat_mean"]
        features |= {
            f"{side}_pkt_len_std": size * 0.2,
            f"{side}_pkt_len_min": F.greatest(size * 0.5, F.lit(40.0)),
            f"{side}_pkt_len_max": F.least(size * 1.5, F.lit(1500.0)),
            f"{side}_iat_std": jitter,
            f"{side}_iat_min": gap,
            f"{side}_iat_max": gap + jitter * 2,
        }
    duration = features["flow_duration"]
    header = estimated_header_ratio(F.col("n_packets"), F.col("_bf") + F.col("_bb"))
    features |= {
        "iat_min": features["iat_mean"],
        "iat_max": features["iat_mean"] + spread * 2,
        "header_ratio": header,
        "payload_ratio": F.lit(1.0) - header,
        "active_mean": duration * 0.7,
        "idle_mean": duration * 0.3,
    }
    return features


def as_estimated(flows: DataFrame) -> DataFrame:
    """Measured flows under the estimated profile, stream or batch.

    All that profile needs are counts, bytes and gaps per direction, so the
    other measurements are replaced. Columns and their order stay. Flows must
    have been measured with the direction by key order.
    """
    given = {
        "_nf": "fwd_packet_count", "_nb": "bwd_packet_count", "_bf": "total_fwd_bytes", "_bb": "total_bwd_bytes",
        "_iat_mean": "iat_mean", "_iat_std": "iat_std",
        "_fiat_mean": "fwd_iat_mean", "_biat_mean": "bwd_iat_mean", "_biat_std": "bwd_iat_std",
    }
    measured = flows.withColumns({m: F.col(c) for m, c in given.items()})
    estimated = _estimated_features()
    return measured.select(*[estimated[c].alias(c) if c in estimated else c for c in flows.columns])


def estimated_header_ratio(n_packets: Column, total_bytes: Column) -> Column:
    """40 header bytes per packet, as a share of all bytes, within [0, 1]."""
    share = n_packets * 40 / F.greatest(total_bytes.cast("double"), F.lit(1.0))
    return F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0))
