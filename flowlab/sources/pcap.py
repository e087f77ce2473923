"""Packet captures as a source: pcap and pcapng, split by byte ranges.

A capture has no index, and one file may hold a large part of all packets. So
each file is cut into byte ranges that are read by different tasks. A range
starts at the first record found in it: a position from which a chain of
plausible records runs for longer than any single record can be (or to the end
of the file), so packet contents that look like records cannot pass. A range
ends where the next one starts. Where its records do not follow each other up
to there, its reader keeps the whole ones, reports the damaged bytes as a row
with an error and goes on at the next chain of records.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowlab.operators import flows as fl
from flowlab.sources import files
from flowlab.sources.labels import label_from_path

RANGE_BYTES = 64 << 20
RANGE_SCHEMA = "path string, lo long, hi long, start long, head string, links string, error string"
PACKET_FIELDS = [
    ("packet_id", "long"), ("ts", "double"), ("src_ip", "string"), ("dst_ip", "string"),
    ("src_port", "int"), ("dst_port", "int"), ("protocol", "int"), ("size", "long"),
    ("tcp_data_offset", "int"), ("tcp_flags", "int"), ("source_file", "string"), ("error", "string"),
]

# File magics -> (byte order, ticks per second).
PCAP_MAGIC = {
    b"\xd4\xc3\xb2\xa1": ("<", 1_000_000),
    b"\xa1\xb2\xc3\xd4": (">", 1_000_000),
    b"\x4d\x3c\xb2\xa1": ("<", 1_000_000_000),
    b"\xa1\xb2\x3c\x4d": (">", 1_000_000_000),
}
SECTION, INTERFACE, ENHANCED, SIMPLE, OLD_PACKET = 0x0A0D0D0A, 1, 6, 3, 2
# Bytes before the IP header and, if any, where its type is.
LINK_LAYERS = {
    0: (4, None),      # loopback
    1: (14, 12),       # Ethernet
    12: (0, None),     # raw IP
    14: (0, None),
    101: (0, None),
    108: (4, None),
    113: (16, 14),     # Linux cooked
    228: (0, None),    # raw IPv4
}
MAX_RECORD = 262_144


# --- file heads and record chains ------------------------------------------------

def _head(data: bytes) -> dict:
    """Format, byte order and, for pcap, clock and link type."""
    magic = data[:4]
    if magic in PCAP_MAGIC and len(data) >= 24:
        order, ticks = PCAP_MAGIC[magic]
        snaplen, link = struct.unpack_from(order + "II", data, 16)
        limit = min(max(snaplen or MAX_RECORD, 65_535), 4 * MAX_RECORD)
        return {"kind": "pcap", "order": order, "ticks": ticks, "link": link & 0x0FFFFFFF,
                "limit": limit, "body": 24}
    if magic == b"\x0a\x0d\x0d\x0a" and len(data) >= 12:
        order = {b"\x4d\x3c\x2b\x1a": "<", b"\x1a\x2b\x3c\x4d": ">"}.get(data[8:12])
        if order:
            return {"kind": "pcapng", "order": order, "limit": 2 * MAX_RECORD, "body": 0}
    raise ValueError("not a capture file")


def _next(head: dict, data: bytes, at: int, size_left: int) -> int | None:
    """Length of the plausible record at ``at``; None if there is none."""
    order = head["order"]
    if head["kind"] == "pcap":
        if at + 16 > len(data):
            return None
        _, frac, caught, wire = struct.unpack_from(order + "IIII", data, at)
        if frac >= head["ticks"] or caught > head["limit"] or caught > wire or not caught:
            return None
        if wire > 1 << 24:
            return None
        return 16 + caught
    if at + 12 > len(data):
        return None
    kind, length = struct.unpack_from(order + "II", data, at)
    if length < 12 or length % 4 or length > head["limit"]:
        return None
    if kind > 0xC and kind not in (SECTION, 0xBAD, 0x40000BAD):
        return None
    end = at + length
    if end <= len(data):
        if struct.unpack_from(order + "I", data, end - 4)[0] != length:
            return None
    elif end > at + size_left:
        return None
    return length


def _find_start(head: dict, data: bytes, lo: int, size: int, hi: int, before: bytes = b"") -> int | None:
    """First offset in [lo, hi) from which records chain on far enough.

    ``before``: the bytes that precede ``lo``; with them a header in the contents
    of a record that began earlier is told from the record's own.
    """
    if lo <= head["body"]:
        return head["body"]
    needed = head["limit"] + 64
    cut = None  # (records, offset) of the best chain that the end of the file cuts
    for at in range(0, min(hi - lo, len(data))):
        position, records = at, 0
        while position - at <= needed and lo + position < size:
            step = _next(head, data, position, size - lo - position)
            if step is None or lo + position + step > size:
                break
            position += step
            records += 1
        else:
            return _inside(lo + _likeliest(head, data, at, before), hi)
        # a truncated last record is not an error, but few records before it may
        # be packet contents that look like them
        left = size - (lo + position)
        if records and left < head["limit"] and lo + len(data) >= size and (left < 16 or _cut_record(head, data, position)):
            if records >= 16:
                return _inside(lo + _likeliest(head, data, at, before), hi)
            if cut is None or records > cut[0]:
                cut = (records, at)
    return None if cut is None else _inside(lo + _likeliest(head, data, cut[1], before), hi)


def _inside(start: int, hi: int) -> int | None:
    """A record that begins behind the range is found by a later one."""
    return start if start < hi else None


def _likeliest(head: dict, data: bytes, at: int, before: bytes = b"") -> int:
    """Of all records that end where the one at ``at`` ends, the likeliest.

    Small numbers beside a header can look like one that is shifted by some
    bytes. A header that tells the same length twice is preferred, then one
    whose time is nearest to that of the next record. If the likeliest begins in
    the bytes ``before``, the first record of ``data`` is the one after it.
    """
    if head["kind"] != "pcap":
        return at
    if before:
        found = _likeliest_of(head, before + data, 0, len(before) + at) - len(before)
        return found if found >= 0 else at + _next(head, data, at, len(data) - at)
    return _likeliest_of(head, data, at, at)


def _likeliest_of(head: dict, data: bytes, lo: int, at: int) -> int:
    end = at + (_next(head, data, at, len(data) - at) or 0)
    order = head["order"]
    if end + 16 > len(data):
        after = None
    else:
        after = struct.unpack_from(order + "I", data, end)[0]

    def key(q):
        sec, _, caught, wire = struct.unpack_from(order + "IIII", data, q)
        return caught == wire, 0 if after is None else -abs(sec - after)

    near = [q for q in _candidates(head, data, lo, end) if q + (_next(head, data, q, len(data) - q) or 0) == end]
    return max(near, key=key, default=at)


def _cut_record(head: dict, data: bytes, at: int) -> bool:
    """A record header at the end of the file whose bytes are missing."""
    if head["kind"] == "pcap" and at + 16 <= len(data):
        _, frac, caught, wire = struct.unpack_from(head["order"] + "IIII", data, at)
        return frac < head["ticks"] and 0 < caught <= min(wire, head["limit"]) and at + 16 + caught > len(data)
    if head["kind"] == "pcapng" and at + 8 <= len(data):
        _, length = struct.unpack_from(head["order"] + "II", data, at)
        return at + length > len(data)
    return True


def _interfaces(data: bytes, head: dict, start: int, stop: int) -> list:
    """Interface descriptions between two offsets; a section resets the list."""
    found, at = [], start
    order = head["order"]
    while at + 12 <= min(stop, len(data)):
        kind, length = struct.unpack_from(order + "II", data, at)
        if length < 12:
            break
        if kind == SECTION:
            found.append("section")
        elif kind == INTERFACE:
            found.append(_interface(data[at : at + length], order))
        at += length
    return found


def _interface(block: bytes, order: str) -> list:
    link = struct.unpack_from(order + "H", block, 8)[0]
    ticks, at = 1_000_000, 16
    while at + 4 <= len(block) - 4:
        code, length = struct.unpack_from(order + "HH", block, at)
        if code == 0:
            break
        if code == 9 and length >= 1:
            r = block[at + 4]
            ticks = 2 ** (r & 0x7F) if r & 0x80 else 10**r
        at += 4 + (length + 3) // 4 * 4
    return [link, ticks]


def _locate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for path, size, lo, hi in batch[["path", "length", "lo", "hi"]].itertuples(index=False):
            start, head, links, error = None, None, None, None
            try:
                with files.open_input(path) as f:
                    head = _head(f.read(64))
                    # a record that covers the first byte began at most this far before it
                    back = min(max(lo - head["body"], 0), head["limit"] + 16) if head["kind"] == "pcap" else 0
                    f.seek(lo - back)
                    before = f.read(back)
                    # enough to see a full chain even if it begins at the last byte
                    want = min(size - lo, 4 * head["limit"] + 4096)
                    if head["kind"] == "pcapng":
                        want = min(size - lo, hi - lo + 2 * head["limit"])
                    data = f.read(want)
                    start = _find_start(head, data, lo, size, hi, before)
                    if start is not None and head["kind"] == "pcapng":
                        links = _interfaces(data, head, start - lo, hi - lo) or None
            except Exception as e:  # noqa: BLE001 - an unreadable file is reported, not fatal
                error = f"{type(e).__name__}: {e}"[:500]
            rows.append((path, lo, hi, start, json.dumps(head) if head else None,
                         json.dumps(links) if links else None, error))
        yield pd.DataFrame(rows, columns=["path", "lo", "hi", "start", "head", "links", "error"]).astype(
            {"start": "Int64"}
        )


# --- decoding --------------------------------------------------------------------------

def _run(head: dict, data: bytes, at: int, most: int | None = None) -> int:
    """End of the whole, plausible records that follow each other from ``at``."""
    start = at
    while at < len(data) and (most is None or at - start < most):
        step = _next(head, data, at, len(data) - at)
        if step is None or at + step > len(data):
            break
        at += step
    return at


def _candidates(head: dict, data: bytes, lo: int, hi: int) -> list[int]:
    """Offsets in [lo, hi) where a record header could be, found vectorised."""
    width = 16 if head["kind"] == "pcap" else 12
    hi = min(hi, len(data) - width + 1)
    if hi <= lo:
        return []
    raw = np.frombuffer(data, np.uint8, hi - lo + width - 1, lo).astype(np.int64)

    def number(shift):
        parts = [raw[shift + k : shift + k + hi - lo] for k in range(4)]
        if head["order"] == ">":
            parts.reverse()
        return parts[0] | parts[1] << 8 | parts[2] << 16 | parts[3] << 24

    if head["kind"] == "pcap":
        caught = number(8)
        good = (caught > 0) & (caught <= head["limit"]) & (number(4) < head["ticks"]) & (number(12) >= caught)
    else:
        length, kind = number(4), number(0)
        good = (length >= 12) & (length <= head["limit"]) & (length % 4 == 0) & ((kind <= 0xC) | (kind == SECTION))
    return (np.flatnonzero(good) + lo).tolist()


def _resume(head: dict, data: bytes, at: int) -> int | None:
    """Next record after damage at ``at``: the first from which a chain runs
    for longer than any record, or exactly to the end of the data. Where more
    damage is near, the first from which three records follow each other."""
    needed, window = head["limit"] + 64, 1 << 20
    for lo in range(at + 1, len(data), window):
        weak = None
        for c in _candidates(head, data, lo, lo + window):
            end = _run(head, data, c, needed)
            if end - c >= needed or (end == len(data) and end > c):
                return _likeliest(head, data, c)
            if weak is None and _records(head, data, c, end) >= 3:
                weak = c
        if weak is not None:
            return weak
    return None


def _records(head: dict, data: bytes, at: int, end: int) -> int:
    n = 0
    while at < end:
        at += _next(head, data, at, len(data) - at)
        n += 1
    return n


def _intact(head: dict, data: bytes, last: bool) -> tuple[list, list]:
    """Stretches of whole records, and the damaged ones between them.

    A record that the end of the file cuts off is neither: the capture just
    stopped there.
    """
    whole, damaged, at = [], [], 0
    while at < len(data):
        end = _run(head, data, at)
        if end > at:
            whole.append((at, end))
        if end >= len(data):
            break
        at = _resume(head, data, end)
        if at is None:
            if not (last and _cut_record(head, data, end)):
                damaged.append((end, len(data)))
            break
        damaged.append((end, at))
    return whole, damaged


def _walk_pcap(data: bytes, head: dict, at: int, end: int):
    rows = []
    order, ticks = struct.Struct(head["order"] + "IIII"), head["ticks"]
    while at < end:
        sec, frac, caught, _ = order.unpack_from(data, at)
        rows.append((at, at + 16, caught, sec + frac / ticks, head["link"]))
        at += 16 + caught
    return rows


def _walk_pcapng(data: bytes, head: dict, at: int, end: int, links: list):
    """Packets between two offsets; ``links``, the interfaces, is kept up."""
    rows, order = [], head["order"]
    while at < end:
        kind, length = struct.unpack_from(order + "II", data, at)
        if kind == SECTION:
            links.clear()
        elif kind == INTERFACE:
            links.append(_interface(data[at : at + length], order))
        elif kind in (ENHANCED, OLD_PACKET):
            if kind == ENHANCED:
                number, high, low, caught = struct.unpack_from(order + "IIII", data, at + 8)
            else:
                number = struct.unpack_from(order + "H", data, at + 8)[0]
                high, low, caught = struct.unpack_from(order + "III", data, at + 12)
            link, ticks = links[number] if number < len(links) else (1, 1_000_000)
            rows.append((at, at + 28, caught, ((high << 32) | low) / ticks, link))
        elif kind == SIMPLE:
            wire = struct.unpack_from(order + "I", data, at + 8)[0]
            rows.append((at, at + 12, min(wire, length - 16), 0.0, links[0][0] if links else 1))
        at += length
    return rows


def _apply(links: list, events: list) -> list:
    for e in events:
        links = [] if e == "section" else [*links, e]
    return links


def _decode(data: bytes, rows: list, base: int) -> pd.DataFrame:
    """Header fields of all IPv4 packets, gathered column by column."""
    if not rows:
        return _reject(0, "").iloc[:0].copy()
    table = np.array([r[:3] for r in rows], dtype=np.int64)
    record, at, caught = table.T
    ts = np.array([r[3] for r in rows])
    link = np.array([r[4] for r in rows])
    raw = np.frombuffer(data + b"\0" * 64, dtype=np.uint8)
    end = at + caught

    def byte(pos):
        return raw[np.minimum(pos, len(raw) - 1)].astype(np.int64)

    def word(pos):
        return byte(pos) << 8 | byte(pos + 1)

    ip = np.full(len(rows), -1, dtype=np.int64)
    for code, (skip, type_at) in LINK_LAYERS.items():
        mine = link == code
        if not mine.any():
            continue
        start = at[mine] + skip
        good = np.ones(mine.sum(), dtype=bool)
        if type_at is not None:
            kind = word(at[mine] + type_at)
            for _ in range(2):  # up to two VLAN tags
                tagged = np.isin(kind, (0x8100, 0x88A8)) & (code == 1)
                kind = np.where(tagged, word(start + 2), kind)
                start = np.where(tagged, start + 4, start)
            good = kind == 0x0800
        ip[mine] = np.where(good, start, -1)
    safe = np.maximum(ip, 0)
    is_ip = (ip >= 0) & (safe + 20 <= end) & (byte(safe) >> 4 == 4)
    record, ts, caught, end, ip = record[is_ip], ts[is_ip], caught[is_ip], end[is_ip], safe[is_ip]
    protocol = byte(ip + 9)
    transport = ip + (byte(ip) & 15) * 4
    first_part = (word(ip + 6) & 0x1FFF) == 0  # later fragments have no ports
    tcp = (protocol == 6) & first_part & (transport + 20 <= end)
    udp = (protocol == 17) & first_part & (transport + 8 <= end)

    def address(pos):
        octets = np.stack([byte(pos + i) for i in range(4)], axis=1)
        return [".".join(map(str, o)) for o in octets.tolist()]

    ports = tcp | udp
    return pd.DataFrame(
        {
            "packet_id": base + record,
            "ts": ts,
            "src_ip": address(ip + 12),
            "dst_ip": address(ip + 16),
            "src_port": np.where(ports, word(transport), 0).astype(np.int32),
            "dst_port": np.where(ports, word(transport + 2), 0).astype(np.int32),
            "protocol": protocol.astype(np.int32),
            "size": caught,
            "tcp_data_offset": np.where(tcp, byte(transport + 12) >> 4, 0).astype(np.int32),
            "tcp_flags": np.where(tcp, byte(transport + 13), 0).astype(np.int32),
        }
    )


_FRAME_KINDS = {n: {"long": "Int64", "int": "Int32", "double": "float64", "string": "object"}[k] for n, k in PACKET_FIELDS}


def _reject(at: int, error: str) -> pd.DataFrame:
    row = {n: pd.Series([None], dtype=k) for n, k in _FRAME_KINDS.items()}
    return pd.DataFrame(row | {"packet_id": [at], "error": [error]})


def _read_ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = [n for n, _ in PACKET_FIELDS]
    for batch in batches:
        for row in batch.itertuples(index=False):
            try:
                if row.error:
                    raise ValueError(row.error)
                head = json.loads(row.head)
                with files.open_input(row.path) as f:
                    f.seek(int(row.start))
                    data = f.read(int(row.stop - row.start))
                whole, damaged = _intact(head, data, bool(row.is_last))
                links = _apply([], [e for part in row.before for e in json.loads(part)])
                rows = []
                for a, b in whole:
                    rows += _walk_pcap(data, head, a, b) if head["kind"] == "pcap" else _walk_pcapng(data, head, a, b, links)
                out = _decode(data, rows, int(row.start))
                out["error"] = None
                if damaged:
                    start = int(row.start)
                    lost = [_reject(start + a, f"damaged bytes {start + a} to {start + b}") for a, b in damaged]
                    out = pd.concat([*([out] if len(out) else []), *lost], ignore_index=True)
            except Exception as e:  # noqa: BLE001 - reported as a row
                out = _reject(int(row.lo), f"{type(e).__name__}: {e}"[:500])
            out["source_file"] = row.path
            yield out[columns].astype(_FRAME_KINDS)


# --- the source -----------------------------------------------------------------------------

def read_captures(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """All IPv4 packets below ``path`` and, as rows with ``error``, unreadable files."""
    listed = files.list_files(spark, path, "*.{pcap,pcapng}")
    ranges = listed.select(
        "path", "length",
        F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(range_bytes).cast("long"))).alias("lo"),
    ).withColumn("hi", F.least(F.col("lo") + range_bytes, F.col("length")))
    tasks = max(spark.sparkContext.defaultParallelism, 1)
    located = ranges.repartition(4 * tasks, "path", "lo").mapInPandas(_locate, RANGE_SCHEMA)
    # a range without a record start belongs to the record before it
    order = Window.partitionBy("path").orderBy("lo")  # one row per range
    sized = located.where(F.col("start").isNotNull() | F.col("error").isNotNull())
    bounded = sized.join(listed, "path").withColumns(
        {
            "next": F.lead("start").over(order),
            "before": F.collect_list("links").over(order.rowsBetween(Window.unboundedPreceding, -1)),
        }
    ).select(
        "path", "lo", "start", "head", "error", "before",
        F.coalesce("next", "length").alias("stop"), F.col("next").isNull().alias("is_last"),
    )
    unreadable = F.row_number().over(order)
    once = bounded.withColumn("_n", unreadable).where(F.col("error").isNull() | (F.col("_n") == 1)).drop("_n")
    schema = ", ".join(f"{n} {t}" for n, t in PACKET_FIELDS)
    return once.repartition(4 * tasks, "path", "lo").mapInPandas(_read_ranges, schema)


def read_pcap(
    spark: SparkSession,
    path: str,
    label_map: Mapping[str, str] | None = None,
    range_bytes: int = RANGE_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """Packets on the canonical schema with a label by file name, and rejects:
    path, offset and error of every unreadable file and damaged stretch."""
    decoded = read_captures(spark, path, range_bytes)
    good = decoded.where(F.col("error").isNull()).drop("error")
    packets = label_from_path(fl.packet_fields(good), label_map)
    rejects = decoded.where(F.col("error").isNotNull()).select(
        F.col("source_file").alias("path"), F.col("packet_id").alias("offset"), "error"
    )
    return packets, rejects


def flows_from_captures(
    spark: SparkSession,
    path: str,
    label_map: Mapping[str, str] | None = None,
    timeout: float | None = None,
    min_packets: int = 5,
    merge_files: bool = False,
    **kw,
) -> DataFrame:
    """Labelled flows of all captures; a flow does not continue in another file

    unless ``merge_files``.
    """
    packets, _ = read_pcap(spark, path, label_map)
    scope = [] if merge_files else ["source_file"]
    return fl.flow_features(
        packets, timeout, min_packets=min_packets, scope=scope, label="label", **kw
    )
