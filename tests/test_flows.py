"""Flow building: hand-computed cases, hot keys, plans."""

import pytest
from pyspark.sql import functions as F

from flowlab.operators import flows as fl
from flowlab.schema import FLOW_FEATURES
from flowlab.sources import tables as t

SCHEMA = (
    "packet_id long, ts double, src_ip string, dst_ip string, src_port int, dst_port int, "
    "protocol int, size long, header_size long, tcp_flags int"
)
A, B = "10.0.0.1", "10.0.0.2"


def packet(i, ts, size, forward=True, flags=16, src=A, dst=B, header=40):
    ends = (src, dst, 1000, 80) if forward else (dst, src, 80, 1000)
    return (i, ts, *ends, 6, size, header, flags)


def five():
    return [
        packet(0, 0.0, 1000), packet(1, 0.02, 500, False), packet(2, 0.05, 800),
        packet(3, 0.08, 600, False), packet(4, 0.1, 1200),
    ]


def test_five_packets(spark):
    row = fl.flow_features(spark.createDataFrame(five(), SCHEMA)).first()
    assert (row.fwd_packet_count, row.bwd_packet_count) == (3, 2)
    assert (row.total_fwd_bytes, row.total_bwd_bytes) == (3000, 1100)
    expected = {
        "flow_duration": 0.1, "flow_bytes_per_sec": 41000.0, "flow_pkts_per_sec": 50.0,
        "header_ratio": 200 / 4100, "payload_ratio": 3900 / 4100, "iat_min": 0.02,
        "iat_max": 0.03, "iat_mean": 0.025, "fwd_iat_mean": 0.05, "bwd_iat_mean": 0.06,
        "active_mean": 0.025, "idle_mean": 0.0, "fwd_pkt_len_mean": 1000.0,
        "fwd_pkt_len_std": (80000 / 3) ** 0.5, "bwd_pkt_len_std": 50.0,
        "fwd_bwd_byte_ratio": 3000 / 1100, "fwd_bwd_pkt_ratio": 1.5,
    }
    for name, value in expected.items():
        assert row[name] == pytest.approx(value, abs=1e-9), name


def test_arrival_order_does_not_matter(spark):
    shuffled = spark.createDataFrame(list(reversed(five())), SCHEMA)
    ordered = spark.createDataFrame(five(), SCHEMA)
    assert fl.flow_features(shuffled).collect() == fl.flow_features(ordered).collect()


def test_min_packets_drops_short_flows(spark):
    assert fl.flow_features(spark.createDataFrame(five()[:4], SCHEMA)).count() == 0


def test_single_packet_flow(spark):
    row = fl.flow_features(spark.createDataFrame(five()[:1], SCHEMA), min_packets=1).first()
    assert row.flow_duration == pytest.approx(1e-6)
    assert row.iat_mean == 0.0 and row.bwd_pkt_len_max == 0.0


def test_gap_equal_to_timeout_does_not_split(spark):
    rows = [packet(i, ts, 100) for i, ts in enumerate([0.0, 5.0, 10.1])]
    seqs = fl.split_flows(spark.createDataFrame(rows, SCHEMA), 5.0).orderBy("packet_id")
    assert [r.flow_seq for r in seqs.collect()] == [0, 0, 1]


def test_fin_closes_and_next_packet_opens_with_its_own_source(spark):
    rows = [packet(0, 0.0, 100), packet(1, 0.1, 100, flags=17), packet(2, 0.2, 100, forward=False)]
    got = fl.split_flows(spark.createDataFrame(rows, SCHEMA), None, True).orderBy("packet_id").collect()
    assert [r.flow_seq for r in got] == [0, 0, 1]
    assert [r.first_src for r in got] == [A, A, B]
    assert got[2].is_fwd and got[2].iat is None


def test_fin_bits_of_other_protocols_are_ignored(spark):
    rows = [(0, 0.0, A, B, 1, 2, 17, 100, 28, 1), (1, 0.1, A, B, 1, 2, 17, 100, 28, 1)]
    got = fl.split_flows(spark.createDataFrame(rows, SCHEMA), None, True)
    assert got.agg(F.max("flow_seq")).first()[0] == 0


def test_same_address_on_both_ends_is_all_forward(spark):
    rows = [packet(i, i * 0.1, 100, forward=i % 2 == 0, src=A, dst=A) for i in range(6)]
    row = fl.flow_features(spark.createDataFrame(rows, SCHEMA)).first()
    assert (row.fwd_packet_count, row.bwd_packet_count) == (6, 0)


@pytest.mark.parametrize("chunk", [0.5, 3.0, 60.0, 1e6])
@pytest.mark.parametrize("timeout,fin", [(None, False), (None, True), (1.0, False), (5.0, True)])
def test_hot_keys_in_chunks_equal_the_plain_pass(spark, sf_dir, chunk, timeout, fin):
    packets = t.packets(spark, sf_dir)
    plain = fl.split_flows(packets, timeout, fin, hot_rows=None)
    chunked = fl.split_flows(packets, timeout, fin, hot_rows=30, chunk_seconds=chunk)
    columns = plain.columns
    assert plain.exceptAll(chunked.select(*columns)).count() == 0
    assert chunked.select(*columns).exceptAll(plain).count() == 0


def test_one_key_with_most_rows(spark):
    """A key with two thirds of the rows is split; the others are not."""
    hot = spark.range(4000).selectExpr(
        "id as packet_id", "id * 0.01 + (id div 500) * 3 as ts",
        f"case when id % 3 = 0 then '{B}' else '{A}' end as src_ip",
        f"case when id % 3 = 0 then '{A}' else '{B}' end as dst_ip",
        "5 as src_port", "5 as dst_port", "6 as protocol", "60 + id % 7 as size", "40L as header_size",
        "case when id % 401 = 0 then 1 else 16 end as tcp_flags",
    )
    cold = spark.range(4000, 6000).selectExpr(
        "id as packet_id", "id * 0.01 as ts", "concat('10.1.0.', id % 200) as src_ip", f"'{A}' as dst_ip",
        "6 as src_port", "7 as dst_port", "6 as protocol", "100L as size", "40L as header_size", "16 as tcp_flags",
    )
    packets = hot.unionByName(cold)
    plain = fl.flow_features(packets, 2.0, True, 1, hot_rows=None)
    split = fl.flow_features(packets, 2.0, True, 1, hot_rows=1000, chunk_seconds=1.0)
    view = lambda df: sorted(
        [tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()], key=repr
    )
    assert view(plain) == view(split)


def test_one_exchange_and_no_python(spark, sf_dir):
    df = fl.flow_features(t.packets(spark, sf_dir), 5.0, True)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Python" not in plan and "Pandas" not in plan
    assert "props" not in plan  # unused columns are not read


def test_unknown_profile(spark, sf_dir):
    with pytest.raises(ValueError):
        fl.flow_features(t.packets(spark, sf_dir), profile="other")


def test_all_features_present(spark, sf_dir):
    df = fl.flow_features(t.packets(spark, sf_dir))
    assert [c for c in df.columns if c in FLOW_FEATURES] == FLOW_FEATURES
