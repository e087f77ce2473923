"""Flows from a stream of packets, with the semantics of the batch operator."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from flowlab.functions import scalars as S
from flowlab.operators.flows import IDLE_GAP, MIN_DURATION, as_estimated, with_flow_key
from flowlab.schema import FLOW_FEATURES, FLOW_KEY, PACKET_SCHEMA

_COUNTS = {"fwd_packet_count", "bwd_packet_count", "total_fwd_bytes", "total_bwd_bytes"}
FLOW_SCHEMA = (
    "a_ip string, b_ip string, a_port int, b_port int, protocol int, "
    "start_ts double, end_ts double, n_packets long, closed_by string, "
    + ", ".join(f"{f} {'long' if f in _COUNTS else 'double'}" for f in FLOW_FEATURES)
)

# Moments (n, mean, m2, min, max) per measure, in this order, then scalars.
_MEASURES = ["size_f", "size_b", "iat", "iat_f", "iat_b", "active", "idle"]
_SCALARS = ["header", "start", "last", "last_f", "last_b", "first_is_a"]
_WIDTH = 5 * len(_MEASURES) + len(_SCALARS)
_PENDING = ["ts", "packet_id", "size", "header_size", "closes", "is_a"]
_KINDS = {"ts": float, "packet_id": np.int64, "size": np.int64, "header_size": np.int64, "closes": bool, "is_a": bool, "key": np.int64}
_KEY_KINDS = {"a_ip": "string", "b_ip": "string", "a_port": "int", "b_port": "int", "protocol": "int"}
STATE_SCHEMA = (
    ", ".join(f"{c} array<{_KEY_KINDS[c]}>" for c in FLOW_KEY)
    + ", pending_ts array<double>, pending_packet_id array<long>, pending_size array<long>, "
    "pending_header_size array<long>, pending_closes array<boolean>, pending_is_a array<boolean>, "
    "pending_key array<int>, open array<double>"
)
#: groups of flow keys that share a call and a state
KEY_GROUPS = 1024


def packet_stream(spark: SparkSession, path: str, max_files: int | None = None, fmt: str = "parquet") -> DataFrame:
    """A folder to which packet files are added, as a stream."""
    reader = spark.readStream.schema(PACKET_SCHEMA).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def split_rejects(packets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable packets and the rows that cannot belong to a flow."""
    required = ["packet_id", "ts", "src_ip", "dst_ip", "src_port", "dst_port", "protocol", "size", "header_size"]
    usable = ~F.isnan("ts") & (F.col("size") >= 0)
    for c in required:
        usable = usable & F.col(c).isNotNull()
    usable = F.coalesce(usable, F.lit(False))
    return packets.where(usable), packets.where(~usable)


def with_event_time(packets: DataFrame, delay: str) -> DataFrame:
    event_time = F.timestamp_micros((F.col("ts") * 1e6).cast("long"))
    return packets.withColumn("event_time", event_time).withWatermark("event_time", delay)


def stream_flows(
    packets: DataFrame,
    timeout: float = 30.0,
    split_on_fin: bool = True,
    min_packets: int = 5,
    delay: str | None = None,
    profile: str = "exact",
    at_once: bool = False,
    groups: int = KEY_GROUPS,
) -> DataFrame:
    """Closed flows: on FIN/RST, otherwise after ``timeout`` of silence.

    Packets wait until the watermark has passed them and are then taken in
    order, so disorder within ``delay`` (at least the timeout by default) does
    not change the result; later packets are dropped. The state of a key is
    those waiting packets plus a fixed-size summary of the open flow, however
    many packets it has seen. Shorter flows are dropped when they close.

    ``at_once=True`` takes packets in the batch they arrive in, for sources in
    time order: FIN/RST or a packet after the timeout closes a flow in that
    batch, and no packets are kept. Packets of one batch may come in any order;
    one that is older than its flow's latest of an earlier batch counts as
    seen at the time of that one.

    ``profile="estimated"``: features and direction as the batch operator has
    them under that profile.

    Keys are dealt to ``groups`` by hash; the keys of a group are handled in one
    call, as arrays, and share a state with one summary per open flow.
    """
    if profile not in ("exact", "estimated"):
        raise ValueError(f"unknown profile: {profile}")
    by_key = profile == "estimated"
    delay = delay or f"{int(np.ceil(timeout))} seconds"
    usable, _ = split_rejects(packets)
    closes = S.closes_flow() if split_on_fin else F.lit(False)
    keyed = with_flow_key(with_event_time(usable, delay)).select(
        *FLOW_KEY, "event_time", "ts", "packet_id", "size", "header_size",
        closes.alias("closes"), (F.col("src_ip") == F.col("a_ip")).alias("is_a"),
        F.pmod(F.xxhash64(*FLOW_KEY), F.lit(groups)).cast("int").alias("key_group"),
    )

    def update(_, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        mark_ms = state.getCurrentWatermarkMs()
        keys, pending, flows = _load(state)
        for batch in batches:
            if not len(batch):
                continue
            every = pd.concat([keys, batch[FLOW_KEY]], ignore_index=True) if len(keys) else batch[FLOW_KEY].reset_index(drop=True)
            number = every.groupby(FLOW_KEY, sort=False).ngroup().to_numpy()  # known keys keep theirs
            fresh = {c: batch[c].to_numpy() for c in _PENDING} | {"key": number[len(keys) :]}
            keys = every.drop_duplicates(ignore_index=True)
            pending = {c: np.concatenate([pending[c], fresh[c]]) for c in _KINDS}
            flows = np.concatenate([flows, np.tile(_EMPTY, (len(keys) - len(flows), 1))])
        order = np.lexsort((pending["packet_id"], pending["ts"], pending["key"]))
        pending = {c: v[order] for c, v in pending.items()}
        if at_once:
            ready = np.ones(len(order), dtype=bool)
        else:
            ready = (pending["ts"] * 1000.0 <= mark_ms) & (mark_ms > 0)
        due = {c: v[ready] for c, v in pending.items()}
        pending = {c: v[~ready] for c, v in pending.items()}
        # changes nothing in packets that have waited
        due["ts"] = np.fmax(due["ts"], flows[due["key"], _LAST])
        flows, closed, owner, fin = _advance_all(flows, due, timeout, by_key)
        silent = mark_ms / 1000.0 > flows[:, _LAST] + timeout
        closed = np.concatenate([closed, flows[silent]])
        owner = np.concatenate([owner, np.flatnonzero(silent)])
        fin = np.concatenate([fin, np.zeros(silent.sum(), dtype=bool)])
        flows[silent] = _EMPTY
        _store(state, keys, pending, flows, mark_ms, timeout)
        kept = _sizes(closed) >= min_packets
        if kept.any():
            out = pd.DataFrame(_features(closed[kept], fin[kept]))
            for name in FLOW_KEY:
                out[name] = keys[name].to_numpy()[owner[kept]]
            yield out[[c.split()[0] for c in FLOW_SCHEMA.split(", ")]]

    flows = keyed.groupBy("key_group").applyInPandasWithState(
        update, FLOW_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.EventTimeTimeout
    )
    return as_estimated(flows) if by_key else flows


# --- state -----------------------------------------------------------------------------

def _load(state):
    """Keys of the group, their waiting packets, and their summaries by row."""
    if not state.exists:
        nothing = pd.DataFrame({c: [] for c in FLOW_KEY})
        return nothing, {c: np.array([], dtype=k) for c, k in _KINDS.items()}, np.zeros((0, _WIDTH))
    columns = list(state.get)
    keys = pd.DataFrame(dict(zip(FLOW_KEY, columns)))
    pending = {c: np.array(v, dtype=_KINDS[c]) for c, v in zip([*_PENDING, "key"], columns[len(FLOW_KEY) :])}
    return keys, pending, np.array(columns[-1], dtype=float).reshape(-1, _WIDTH)


def _store(state, keys, pending, flows, mark_ms, timeout) -> None:
    is_open = ~np.isnan(flows[:, _LAST])
    used = is_open.copy()
    used[pending["key"]] = True
    if not used.any():
        if state.exists:
            state.remove()
        return
    own = (np.cumsum(used) - 1)[pending["key"]]
    state.update((
        *[keys[c].to_numpy()[used].tolist() for c in FLOW_KEY],
        *[pending[c].tolist() for c in _PENDING], own.tolist(), flows[used].ravel().tolist(),
    ))
    wakes = [*pending["ts"], *(flows[is_open, _LAST] + timeout)]
    state.setTimeoutTimestamp(max(int(np.floor(min(wakes) * 1000.0)), mark_ms + 1, 1))


def _pack(flow) -> list[float]:
    numbers = [float(x) for m in _MEASURES for x in flow[m]]
    return numbers + [float(flow[s]) for s in _SCALARS]


def _unpack(packed) -> dict:
    flow = {m: tuple(packed[5 * i : 5 * i + 5]) for i, m in enumerate(_MEASURES)}
    return flow | dict(zip(_SCALARS, packed[5 * len(_MEASURES) :]))


# --- flow summary --------------------------------------------------------------------------

_NONE = (0.0, 0.0, 0.0, np.inf, -np.inf)
_AT = {m: slice(5 * i, 5 * i + 5) for i, m in enumerate(_MEASURES)} | {c: 5 * len(_MEASURES) + i for i, c in enumerate(_SCALARS)}
_LAST = _AT["last"]
#: the row of a key without an open flow
_EMPTY = np.array([*_NONE * len(_MEASURES), 0.0, *[np.nan] * 4, 0.0])


def _moments(owner: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
    """A row of moments for each of ``n`` owners, which come in order."""
    out = np.tile(_NONE, (n, 1))
    if len(x):
        count = np.bincount(owner, minlength=n)
        some = count > 0
        mean = np.bincount(owner, weights=x, minlength=n) / np.maximum(count, 1)
        square = np.bincount(owner, weights=(x - mean[owner]) ** 2, minlength=n)
        starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        low, high = np.minimum.reduceat(x, starts), np.maximum.reduceat(x, starts)
        out[some] = np.stack([count[some], mean[some], square[some], low, high], axis=1)
    return out


def _merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Moments of two disjoint sets of numbers, row by row."""
    n = a[:, 0] + b[:, 0]
    share = np.divide(b[:, 0], n, out=np.zeros_like(n), where=n > 0)
    delta = b[:, 1] - a[:, 1]
    return np.stack([
        n, a[:, 1] + delta * share, a[:, 2] + b[:, 2] + delta * delta * a[:, 0] * share,
        np.minimum(a[:, 3], b[:, 3]), np.maximum(a[:, 4], b[:, 4]),
    ], axis=1)


def _size(flow) -> int:
    return int(flow["size_f"][0] + flow["size_b"][0])


def _sizes(flows: np.ndarray) -> np.ndarray:
    return flows[:, _AT["size_f"]][:, 0] + flows[:, _AT["size_b"]][:, 0]


def _advance(flow, due, timeout, closed, by_key=False):
    """Feed packets of one key in order; finished flows are appended to ``closed``."""
    rows = np.array([_EMPTY if flow is None else _pack(flow)])
    due = due | {"key": np.zeros(len(due["ts"]), dtype=np.int64)}
    rows, done, _, fin = _advance_all(rows, due, timeout, by_key)
    closed += [(_unpack(f), "fin" if b else "timeout") for f, b in zip(done.tolist(), fin.tolist())]
    return None if np.isnan(rows[0, _LAST]) else _unpack(rows[0].tolist())


def _advance_all(flows, due, timeout, by_key=False):
    """Feed packets, in order of key and time, to the open flows of their keys.

    Returns the open flows, the closed ones, their keys, and whether a FIN or
    RST closed them.
    """
    key, ts, closes = due["key"], due["ts"], due["closes"]
    if not len(ts):
        return flows.copy(), np.zeros((0, _WIDTH)), np.zeros(0, np.int64), np.zeros(0, bool)
    breaks = np.append(True, key[1:] != key[:-1])
    first = breaks.copy()  # of a key
    breaks[1:] |= (np.diff(ts) > timeout) | closes[:-1]
    starts = np.flatnonzero(breaks)
    part, own, first = np.cumsum(breaks) - 1, key[starts], first[starts]
    before = flows[own]
    was_open = first & ~np.isnan(before[:, _LAST])
    goes_on = was_open & ~(ts[starts] - before[:, _LAST] > timeout)
    base = np.where(goes_on[:, None], before, _EMPTY)
    new = ~goes_on
    base[new, _AT["start"]] = ts[starts][new]
    base[new, _AT["first_is_a"]] = 1.0 if by_key else due["is_a"][starts][new]
    found = _extend(base, part, due)
    fin = closes[np.append(starts[1:], len(ts)) - 1]
    final = np.append(own[1:] != own[:-1], True)  # of its key
    still = final & ~fin
    flows = flows.copy()
    flows[own[final]] = _EMPTY
    flows[own[still]] = found[still]
    silent = was_open & new
    return (
        flows,
        np.concatenate([before[silent], found[~still]]),
        np.concatenate([own[silent], own[~still]]),
        np.concatenate([np.zeros(silent.sum(), dtype=bool), fin[~still]]),
    )


def _extend(base, part, due):
    """Add consecutive packets to the summaries ``base`` of their flows. Forward
    is the way of the first packet or, ``by_key``, from the lower end of the key."""
    ts, size, n = due["ts"], due["size"].astype(float), len(base)
    fwd = due["is_a"] == (base[part, _AT["first_is_a"]] == 1.0)

    def gaps(some, before):
        """Gaps between these packets, and the flows they belong to."""
        at, owner = ts[some], part[some]
        head = np.append(True, owner[1:] != owner[:-1])[: len(owner)]
        previous = np.append(np.nan, at[:-1])[: len(at)]
        previous[head] = base[owner[head], _AT[before]]
        known = ~np.isnan(previous)
        return owner[known], (at - previous)[known]

    owner, gap = gaps(np.ones(len(ts), dtype=bool), "last")
    active = gap < IDLE_GAP
    found = {
        "size_f": (part[fwd], size[fwd]), "size_b": (part[~fwd], size[~fwd]), "iat": (owner, gap),
        "iat_f": gaps(fwd, "last_f"), "iat_b": gaps(~fwd, "last_b"),
        "active": (owner[active], gap[active]), "idle": (owner[~active], gap[~active]),
    }
    out = base.copy()
    for m, (of, x) in found.items():
        out[:, _AT[m]] = _merge(base[:, _AT[m]], _moments(of, x, n))
    out[:, _AT["header"]] += np.bincount(part, weights=due["header_size"], minlength=n)
    for name, some in (("last", slice(None)), ("last_f", fwd), ("last_b", ~fwd)):
        out[part[some], _AT[name]] = ts[some]  # the last one stays
    return out


def _features(flows: np.ndarray, fin: np.ndarray) -> dict:
    def stats(prefix, m):
        n, mean, m2, low, high = flows[:, _AT[m]].T
        some = n > 0
        return {f"{prefix}_mean": np.where(some, mean, 0.0), f"{prefix}_std": np.sqrt(np.where(some, m2, 0.0) / np.maximum(n, 1)),
                f"{prefix}_min": np.where(some, low, 0.0), f"{prefix}_max": np.where(some, high, 0.0)}

    column = lambda m, i=0: flows[:, _AT[m]][:, i]
    nf, nb, header = column("size_f"), column("size_b"), flows[:, _AT["header"]]
    bf, bb = np.rint(nf * column("size_f", 1)), np.rint(nb * column("size_b", 1))
    total = bf + bb
    start, last = flows[:, _AT["start"]], flows[:, _LAST]
    duration = np.maximum(last - start, MIN_DURATION)
    return {
        "start_ts": start, "end_ts": last, "n_packets": (nf + nb).astype(np.int64),
        "closed_by": np.where(fin, "fin", "timeout").astype(object),
        "fwd_packet_count": nf.astype(np.int64), "bwd_packet_count": nb.astype(np.int64),
        "total_fwd_bytes": bf.astype(np.int64), "total_bwd_bytes": bb.astype(np.int64),
        **stats("fwd_pkt_len", "size_f"), **stats("bwd_pkt_len", "size_b"),
        "flow_duration": duration, "flow_bytes_per_sec": total / duration,
        "flow_pkts_per_sec": (nf + nb) / duration,
        **stats("iat", "iat"), **stats("fwd_iat", "iat_f"), **stats("bwd_iat", "iat_b"),
        "fwd_bwd_byte_ratio": bf / np.maximum(bb, 1), "fwd_bwd_pkt_ratio": nf / np.maximum(nb, 1),
        "header_ratio": header / np.maximum(total, 1),
        "payload_ratio": (total - header) / np.maximum(total, 1),
        "active_mean": column("active", 1), "idle_mean": column("idle", 1),
    }
