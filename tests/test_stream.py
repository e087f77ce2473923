"""Streams: several batches, disorder, equality with the batch operator."""

import math
import time

import pytest
from pyspark.sql import functions as F

from flowlab.operators import flows as fl
from flowlab.schema import FLOW_FEATURES, FLOW_KEY, PACKET_SCHEMA
from flowlab.sources import tables as t
from flowlab.streaming import flows as st
from flowlab.streaming import scoring


def arrive(spark, packets, folder, parts, mix):
    """Files in time order, each row up to ``mix`` seconds late."""
    late = packets.withColumn("_t", F.col("ts") + F.pmod(F.hash("packet_id"), 1000) / 1000.0 * mix)
    low, high = late.agg(F.min("_t"), F.max("_t")).first()
    step = (high - low) / parts
    for i in range(parts):
        part = late.where((F.col("_t") >= low + i * step) & ((F.col("_t") < low + (i + 1) * step) | (i == parts - 1)))
        part.select(*PACKET_SCHEMA.fieldNames()).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.05)


def run(spark, folder, state, **kw):
    df = st.stream_flows(st.packet_stream(spark, folder, max_files=1), **kw)
    scoring.write_stream(df, f"{state}/out", f"{state}/check", available_now=True).awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{state}/out")


@pytest.mark.parametrize("fin", [True, False])
def test_stream_equals_batch_on_closed_flows(spark, sf_dir, tmp_path, fin):
    packets = t.packets(spark, sf_dir)
    arrive(spark, packets, str(tmp_path / "in"), 6, 3.0)
    got = run(spark, str(tmp_path / "in"), str(tmp_path), timeout=5.0, split_on_fin=fin, min_packets=3, delay="8 seconds")
    batch = fl.flow_features(packets, 5.0, fin, 3)
    # the watermark counts whole milliseconds
    horizon = math.floor(packets.agg(F.max("ts")).first()[0] * 1000) / 1000 - 8.0 - 5.0
    want = {tuple(r[k] for k in (*FLOW_KEY, "start_ts")): r for r in batch.collect()}
    seen = {tuple(r[k] for k in (*FLOW_KEY, "start_ts")): r for r in got.collect()}
    assert len(seen) == got.count() and set(seen) <= set(want)
    assert {k for k, r in want.items() if r.end_ts < horizon} <= set(seen)
    for k, r in seen.items():
        for f in FLOW_FEATURES:
            assert r[f] == pytest.approx(want[k][f], rel=1e-9, abs=1e-9), f
    assert {r.closed_by for r in seen.values()} <= {"fin", "timeout"}


def test_rejects(spark):
    rows = [(1, 0.0, "a", "b", 1, 2, 6, 10, 20, 0), (2, None, "a", "b", 1, 2, 6, 10, 20, 0),
            (3, 0.0, None, "b", 1, 2, 6, 10, 20, 0), (4, 0.0, "a", "b", 1, 2, 6, -1, 20, 0),
            (5, float("nan"), "a", "b", 1, 2, 6, 5, 20, 0)]
    good, bad = st.split_rejects(spark.createDataFrame(rows, PACKET_SCHEMA))
    assert [r.packet_id for r in good.collect()] == [1]
    assert sorted(r.packet_id for r in bad.collect()) == [2, 3, 4, 5]


def test_state_is_bounded():
    """However many packets a flow has, its summary keeps its size."""
    import numpy as np

    flow = None
    for start in (0, 1000, 2000):
        ts = np.arange(start, start + 1000) * 0.01
        due = {"ts": ts, "packet_id": np.arange(start, start + 1000), "size": np.full(1000, 100),
               "header_size": np.full(1000, 40), "closes": np.zeros(1000, bool), "is_a": np.arange(1000) % 3 == 0}
        closed = []
        flow = st._advance(flow, due, 5.0, closed)
        assert not closed and len(st._pack(flow)) == st._WIDTH
    assert st._unpack(st._pack(flow)) == flow
    assert st._size(flow) == 3000
    assert flow["iat"][0] == 2999 and flow["iat"][1] == pytest.approx(0.01)


def test_sessions_need_no_python_and_keep_a_gap_of_the_timeout(spark):
    from flowlab.schema import PACKET_SCHEMA
    from flowlab.streaming.sessions import stream_sessions

    def packet(i, ts, back=False):
        ends = ("10.0.0.2", "10.0.0.1", 80, 9) if back else ("10.0.0.1", "10.0.0.2", 9, 80)
        own = {"packet_id": i, "ts": ts, "src_ip": ends[0], "dst_ip": ends[1], "src_port": ends[2], "dst_port": ends[3]}
        own |= {"protocol": 17, "size": 100 + i, "header_size": 28, "tcp_flags": 0}
        return tuple(own.get(c) for c in PACKET_SCHEMA.fieldNames())

    rows = [packet(3, 6.0, True), packet(1, 0.0), packet(2, 1.0, True), packet(4, 11.5), packet(5, None)]
    flows = stream_sessions(spark.createDataFrame(rows, PACKET_SCHEMA), 5.0, 1)
    assert "Python" not in flows._jdf.queryExecution().executedPlan().toString()
    first, second = flows.orderBy("start_ts").collect()
    assert (first.n_packets, first.fwd_packet_count, first.bwd_packet_count) == (3, 1, 2)
    assert (first.iat_mean, first.bwd_iat_mean, first.fwd_iat_mean) == (3.0, 5.0, 0.0)
    assert (second.n_packets, second.fwd_packet_count, second.total_fwd_bytes, second.iat_mean) == (1, 1, 104, 0.0)


def test_a_batch_that_is_run_again_replaces_itself(spark, tmp_path, monkeypatch):
    from flowlab.schema import PACKET_SCHEMA
    from flowlab.streaming import fanout

    caught = []
    monkeypatch.setattr(fanout.scoring, "start", lambda packets, write, *rest: caught.append(write))
    fanout.fan_out(None, str(tmp_path), "unused")
    names = PACKET_SCHEMA.fieldNames()
    own = {"packet_id": 1, "ts": 0.5, "src_ip": "a", "dst_ip": "b", "src_port": 1, "dst_port": 2, "protocol": 6}
    own |= {"size": 10, "header_size": 40, "tcp_flags": 0}
    good = tuple(own.get(c) for c in names)
    bad = tuple((own | {"src_ip": None}).get(c) for c in names)
    for number, rows in ((0, [good, bad]), (1, [bad]), (0, [good, bad])):
        caught[0](spark.createDataFrame(rows, PACKET_SCHEMA), number)
    found = {r.kind: (r.n, r.bytes) for r in fanout.totals(fanout.read_sink(spark, str(tmp_path), "counts")).collect()}
    assert found == {"packets": (1, 10), "rejects": (2, 0)}
    assert fanout.read_sink(spark, str(tmp_path), "rejects").count() == 2
    assert fanout.read_sink(spark, str(tmp_path), "packets").count() == 1


@pytest.mark.parametrize("fin", [True, False])
def test_estimated_stream_equals_estimated_batch(spark, sf_dir, tmp_path, fin):
    packets = t.packets(spark, sf_dir)
    arrive(spark, packets, str(tmp_path / "in"), 4, 3.0)
    got = run(spark, str(tmp_path / "in"), str(tmp_path), timeout=5.0, split_on_fin=fin, min_packets=3, delay="8 seconds", profile="estimated")
    want = {tuple(r[k] for k in (*FLOW_KEY, "start_ts")): r for r in fl.flow_features(packets, 5.0, fin, 3, "estimated").collect()}
    rows = got.collect()
    assert rows
    for r in rows:
        for f in FLOW_FEATURES:
            assert r[f] == pytest.approx(want[tuple(r[k] for k in (*FLOW_KEY, "start_ts"))][f], rel=1e-9, abs=1e-9), f


def test_at_once_closes_in_the_batch_of_the_fin(spark, tmp_path):
    names = PACKET_SCHEMA.fieldNames()

    def packet(i, ts, flags):
        own = {"packet_id": i, "ts": 1000.0 + ts, "src_ip": "a", "dst_ip": "b", "src_port": 1, "dst_port": 2, "protocol": 6}
        own |= {"size": 100, "header_size": 40, "tcp_flags": flags}
        return tuple(own.get(c) for c in names)

    # the last packet is older than one of the batch before it
    batches = [[packet(2, 1.0, 0), packet(1, 0.0, 0)], [packet(3, 1.5, 1), packet(4, 2.0, 0)], [packet(5, 1.9, 1)]]
    seen = {}
    for rows in batches:
        spark.createDataFrame(rows, PACKET_SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(0.05)
    df = st.stream_flows(st.packet_stream(spark, str(tmp_path / "in"), 1), 100.0, True, 1, at_once=True)

    def keep(batch, number):
        seen[number] = [(r.n_packets, r.start_ts, r.end_ts, r.closed_by) for r in batch.collect()]

    scoring.start(df, keep, str(tmp_path / "state"), available_now=True).awaitTermination()
    assert seen[0] == [] and seen[1] == [(3, 1000.0, 1001.5, "fin")] and seen[2] == [(2, 1002.0, 1002.0, "fin")]


def test_many_keys_share_a_call(spark, tmp_path):
    """The calls of a batch are bounded, however many keys it has."""
    packets = spark.range(6_000).selectExpr(
        "id as packet_id", "cast(id div 3000 as double) as ts", "concat('a', id % 3000) as src_ip", "'b' as dst_ip", "1 as src_port",
        "2 as dst_port", "17 as protocol", "id % 100 as size", "28L as header_size", "0 as tcp_flags")
    packets.select([F.col(f.name).cast(f.dataType) for f in PACKET_SCHEMA]).coalesce(1).write.parquet(str(tmp_path / "in"))
    df = st.stream_flows(st.packet_stream(spark, str(tmp_path / "in"), 1), 5.0, False, 1, delay="1 seconds", at_once=True)
    query = scoring.write_stream(df, str(tmp_path / "out"), str(tmp_path / "state"), available_now=True)
    query.awaitTermination()
    assert max(p.stateOperators[0].numRowsTotal for p in query.recentProgress) <= 1024
