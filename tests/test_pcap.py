"""Captures: formats, byte orders, splitting, damage."""

import random
import struct

import duckdb
import pytest

from flowlab.plans import catalog
from flowlab.sources import datasets, pcap
from flowlab.streaming import flows  # noqa: F401  (imports cleanly beside the source)


def ethernet(ip, vlan=0):
    tags = b"\x81\x00\x00\x05" * vlan
    return b"\x02" * 12 + tags + b"\x08\x00" + ip


def ipv4(proto, layer, src=(10, 0, 0, 1), dst=(10, 0, 0, 2), fragment=0, options=0):
    head = struct.pack(">BBHHHBBH", 0x45 + options, 0, 20 + 4 * options + len(layer), 0, fragment, 64, proto, 0)
    return head + bytes(src) + bytes(dst) + b"\0" * (4 * options) + layer


def tcp(sport, dport, flags=16, offset=5):
    return struct.pack(">HHIIBBHHH", sport, dport, 0, 0, offset << 4, flags, 0, 0, 0) + b"\0" * (4 * offset - 20)


def udp(sport, dport):
    return struct.pack(">HHHH", sport, dport, 8, 0)


FRAMES = [
    ethernet(ipv4(6, tcp(1000, 80, 2, 8) + b"x" * 30)),
    ethernet(ipv4(17, udp(53, 5353) + b"y" * 9), vlan=1),
    ethernet(ipv4(1, b"\x08\0\0\0")),
    b"\x02" * 12 + b"\x86\xdd" + b"\x60" + b"\0" * 60,                       # IPv6: dropped
    ethernet(ipv4(6, tcp(1000, 80)[:8], fragment=100)),                       # later fragment
    ethernet(ipv4(6, tcp(7, 8, 17), src=(200, 1, 2, 3), options=2), vlan=2),
]
EXPECTED = [
    ("10.0.0.1", "10.0.0.2", 1000, 80, 6, 52, 2),
    ("10.0.0.1", "10.0.0.2", 53, 5353, 17, 28, 0),
    ("10.0.0.1", "10.0.0.2", 0, 0, 1, 20, 0),
    ("10.0.0.1", "10.0.0.2", 0, 0, 6, None, None),
    ("200.1.2.3", "10.0.0.2", 7, 8, 6, 40, 17),
]


def pcap_bytes(frames, order="<", nano=False, start=1_700_000_000):
    ticks = 10**9 if nano else 10**6
    magic = 0xA1B23C4D if nano else 0xA1B2C3D4
    out = struct.pack(order + "IHHiIII", magic, 2, 4, 0, 0, 65_535, 1)
    for i, f in enumerate(frames):
        out += struct.pack(order + "IIII", start + i, ticks // 4, len(f), len(f)) + f
    return out


def block(order, kind, body):
    body += b"\0" * (-len(body) % 4)
    size = len(body) + 12
    return struct.pack(order + "II", kind, size) + body + struct.pack(order + "I", size)


def pcapng_bytes(frames, order="<", resolution=None, start=1_700_000_000):
    out = block(order, 0x0A0D0D0A, struct.pack(order + "IHHq", 0x1A2B3C4D, 1, 0, -1))
    options = struct.pack(order + "HHB3x", 9, 1, resolution) + struct.pack(order + "HH", 0, 0) if resolution else b""
    out += block(order, 1, struct.pack(order + "HHI", 1, 0, 0) + options)
    ticks = 10 ** (resolution or 6)
    for i, f in enumerate(frames):
        t = (start + i) * ticks + ticks // 4
        out += block(order, 6, struct.pack(order + "IIIII", 0, t >> 32, t & 0xFFFFFFFF, len(f), len(f)) + f)
    return out


def read(spark, folder, **kw):
    packets, rejects = pcap.read_pcap(spark, str(folder), **kw)
    return packets.orderBy("source_file", "packet_id").collect(), rejects.collect()


@pytest.mark.parametrize("order", ["<", ">"])
@pytest.mark.parametrize("kind", ["micro", "nano", "ng", "ng-nano"])
def test_formats(spark, tmp_path, order, kind):
    data = {
        "micro": lambda: pcap_bytes(FRAMES, order), "nano": lambda: pcap_bytes(FRAMES, order, True),
        "ng": lambda: pcapng_bytes(FRAMES, order), "ng-nano": lambda: pcapng_bytes(FRAMES, order, 9),
    }[kind]()
    (tmp_path / ("a.pcapng" if "ng" in kind else "a.pcap")).write_bytes(data)
    rows, rejects = read(spark, tmp_path)
    assert not rejects and len(rows) == len(EXPECTED)
    for r, want in zip(rows, EXPECTED):
        got = (r.src_ip, r.dst_ip, r.src_port, r.dst_port, r.protocol)
        assert got == want[:5]
        if want[5] is not None:
            assert (r.header_size, r.tcp_flags) == want[5:]
    assert [r["size"] for r in rows] == [len(f) for i, f in enumerate(FRAMES) if i != 3]
    assert rows[0].ts == pytest.approx(1_700_000_000.25, abs=1e-6)


def many(n, seed=0):
    rng = random.Random(seed)
    inner = pcap_bytes([FRAMES[0]] * 5)  # a capture inside packet contents
    return [
        ethernet(ipv4(17, udp(i % 60000, 9) + (inner if i % 50 == 0 else rng.randbytes(rng.randrange(0, 1400)))))
        for i in range(n)
    ]


@pytest.mark.parametrize("name", ["a.pcap", "a.pcapng"])
def test_ranges_do_not_change_the_result(spark, tmp_path, name):
    frames = many(1500)
    data = pcap_bytes(frames) if name.endswith("pcap") else pcapng_bytes(frames)
    (tmp_path / name).write_bytes(data)
    whole, _ = read(spark, tmp_path)
    split, rejects = read(spark, tmp_path, range_bytes=50_000)
    assert not rejects
    assert whole == split and len(whole) == 1500


def test_truncated_capture_keeps_the_complete_packets(spark, tmp_path):
    (tmp_path / "cut.pcap").write_bytes(pcap_bytes(many(300))[:-100])
    rows, rejects = read(spark, tmp_path, range_bytes=20_000)
    assert not rejects and len(rows) == 299


def test_broken_file_is_reported_and_skipped(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "good.pcap").write_bytes(pcap_bytes(FRAMES))
    (tmp_path / "bad.pcap").write_bytes(b"this is not a capture" * 10)
    (tmp_path / "notes.txt").write_bytes(b"ignored")
    rows, rejects = read(spark, tmp_path)
    assert len(rows) == len(EXPECTED)
    assert [r.path.rsplit("/", 1)[1] for r in rejects] == ["bad.pcap"]


def test_labels_and_flows_per_file(spark, tmp_path):
    conversation = [
        ethernet(ipv4(6, tcp(1000, 80) + b"a" * 10)) if i % 2 else
        ethernet(ipv4(6, tcp(80, 1000) + b"b" * 20, src=(10, 0, 0, 2), dst=(10, 0, 0, 1)))
        for i in range(6)
    ]
    for name in ("YouTube_1.pcap", "voip-2.pcap", "other.pcap"):
        (tmp_path / name).write_bytes(pcap_bytes(conversation))
    df = pcap.flows_from_captures(spark, str(tmp_path), {"youtube": "streaming", "voip": "voip"})
    assert sorted(r.label for r in df.collect()) == ["streaming", "unknown", "voip"]
    assert {(r.fwd_packet_count, r.bwd_packet_count) for r in df.collect()} == {(3, 3)}
    merged = pcap.flows_from_captures(spark, str(tmp_path), merge_files=True)
    assert [r.n_packets for r in merged.collect()] == [18]
    auto = datasets.load_dataset(spark, str(tmp_path))
    assert auto.count() == 3


def plain(n):
    """Frames without a capture inside: one that ends with its packet cannot be
    told from the records that follow it."""
    return [f for i, f in enumerate(many(n + n // 49 + 1)) if i % 50][:n]


def damaged(data, frames, n):
    """``data`` with the lengths in the header of packet ``n`` overwritten."""
    at = 24 + sum(16 + len(f) for f in frames[:n])
    return data[: at + 8] + b"\xff" * 8 + data[at + 16 :]


@pytest.mark.parametrize("n, at, range_bytes", [(100, 60, 64 << 20), (100, 99, 64 << 20), (100, 1, 64 << 20), (3000, 1234, 50_000), (3000, 2998, 50_000)])
def test_one_damaged_record_loses_one_packet(spark, tmp_path, n, at, range_bytes):
    frames = plain(n)
    (tmp_path / "a.pcap").write_bytes(damaged(pcap_bytes(frames), frames, at))
    rows, rejects = read(spark, tmp_path, range_bytes=range_bytes)
    offsets = [24]
    for f in frames:
        offsets.append(offsets[-1] + 16 + len(f))
    assert [r.packet_id for r in rows] == offsets[:at] + offsets[at + 1 : -1]
    assert [(r.path.rsplit("/", 1)[1], r.offset) for r in rejects] == [("a.pcap", offsets[at])]


def test_damage_in_several_places(spark, tmp_path):
    frames = plain(2000)
    data = pcap_bytes(frames)
    for at in (10, 700, 701, 1500):
        data = damaged(data, frames, at)
    (tmp_path / "a.pcap").write_bytes(data)
    rows, rejects = read(spark, tmp_path, range_bytes=80_000)
    assert len(rows) == 1996 and len(rejects) == 3


def test_damaged_blocks_of_pcapng(spark, tmp_path):
    frames = plain(600)
    data = pcapng_bytes(frames)
    at = data.index(struct.pack("<I", 6), len(data) // 2)  # somewhere in the middle
    (tmp_path / "a.pcapng").write_bytes(data[:at] + b"\xee" * 40 + data[at + 40 :])
    rows, rejects = read(spark, tmp_path, range_bytes=60_000)
    assert 598 <= len(rows) <= 599 and len(rejects) == 1


def test_a_clock_that_was_not_set(spark, tmp_path):
    frames = plain(1500)
    data = pcap_bytes(frames)
    (tmp_path / "a.pcap").write_bytes(data[:24] + b"\0\0\0\0" + data[28:])
    rows, rejects = read(spark, tmp_path, range_bytes=50_000)
    assert not rejects and len(rows) == 1500


def test_range_that_begins_in_a_header_with_a_look_alike(spark, tmp_path):
    # the total length of the IP header reads as a record of 52 bytes that ends
    # where the packet ends
    frame = ethernet(ipv4(6, tcp(1000, 80, 16, 8)))
    frame += b"\0" * (77 - len(frame))
    (tmp_path / "a.pcap").write_bytes(pcap_bytes([frame] * 120, start=85_000))
    for width in (97, 211):
        packets, rejects = read(spark, tmp_path, range_bytes=width)
        assert (len(packets), rejects) == (120, [])


def test_users_beyond_the_fields_of_a_packet(spark, tmp_path):
    from tests.compare import difference

    users = [0, 7, 63_999, 64_000, 64_003, 64_511, 64_512, 70_001, 89_999, 150_000, 1_000_003, 9_000_012]
    rows = [(i, f"2024-01-01 00:{i // 60:02d}:{i % 60:02d}", users[i % 12] + i % 5, (i % 9) * 20.5) for i in range(1_200)]
    events = spark.createDataFrame(rows, "event_id long, ts string, user_id long, value double")
    events.withColumn("ts", events.ts.cast("timestamp_ntz")).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    con = duckdb.connect()
    con.execute("set TimeZone='UTC'")
    con.execute(f"create view events as select * from '{tmp_path}/events.parquet/*.parquet'")
    assert difference(spark, con, str(tmp_path), catalog.queries()["pcap_packets"], catalog.oracle_sql()["pcap_packets"]) is None
