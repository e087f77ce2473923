"""Packet and flow relations derived from the generic benchmark tables.

The expressions below are shared text for Spark and for the SQL the results
are compared with; only the epoch and array functions differ by engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PACKET_COLUMNS = {
    "packet_id": "event_id",
    "ts": "cast({EPOCH} as double)/1e6/20000.0",
    "src_ip": "case when event_id % 3 = 0 then concat('10.1.0.', cast(user_id % 7 as string)) "
    "else concat('10.0.0.', cast(user_id as string)) end",
    "dst_ip": "case when event_id % 3 = 0 then concat('10.0.0.', cast(user_id as string)) "
    "else concat('10.1.0.', cast(user_id % 7 as string)) end",
    "src_port": "cast(case when user_id % 5 = 4 then 0 when event_id % 3 = 0 then 443 "
    "else 1024 + user_id end as int)",
    "dst_port": "cast(case when user_id % 5 = 4 then 0 when event_id % 3 = 0 then 1024 + user_id "
    "else 443 end as int)",
    "protocol": "cast(case when user_id % 5 = 4 then 1 when user_id % 5 = 3 then 17 else 6 end as int)",
    "size": "cast(60 + floor(value * 3) as bigint)",
    "header_size": "cast(20 + case when user_id % 5 = 4 then 0 when user_id % 5 = 3 then 8 "
    "else 4 * (5 + event_id % 4) end as bigint)",
    "tcp_flags": "cast(case when user_id % 5 < 3 and event_id % 31 = 0 then 4 "
    "when user_id % 5 < 3 and event_id % 17 = 0 then 1 else 16 end as int)",
}

CIC_COLUMNS = {
    "row_id": "o_orderkey",
    "fwd_packet_count": "cast(1 + o_custkey % 50 as bigint)",
    "bwd_packet_count": "cast(o_orderkey % 8 as bigint)",
    "total_fwd_bytes": "cast(floor(o_totalprice) as double)",
    "total_bwd_bytes": "cast(case when o_orderkey % 8 = 0 then 0 "
    "else floor(o_totalprice * (o_custkey % 5) / 10) end as double)",
    "flow_duration": "cast((o_orderkey % 1000) * 150000 as double)",
    "flow_bytes_per_sec": "case when o_orderkey % 1000 = 0 then cast('Infinity' as double) "
    "else o_totalprice / ((o_orderkey % 1000) * 0.15) end",
    "label": "case o_custkey % 23 when 0 then 'DoS Hulk' when 1 then 'DDoS' when 2 then 'PortScan' "
    "when 3 then 'FTP-Patator' when 4 then 'Web Attack - XSS' when 5 then 'Bot' "
    "when 6 then 'Infiltration' when 7 then '' when 8 then null when 9 then ' BENIGN ' "
    "else 'BENIGN' end",
}

PREDICTION_COLUMNS = {
    "row_id": "o_orderkey",
    "y_true": "cast(o_custkey % 4 as int)",
    "y_pred": "cast(case when o_orderkey % 10 < 7 then o_custkey % 4 else o_orderkey % 3 end as int)",
    "score": "cast((o_orderkey * 7 + (o_custkey % 4) * 13) % 101 as double) / 100.0",
}


def _select(columns: dict[str, str], epoch: str = "") -> list[str]:
    return [f"{e.replace('{EPOCH}', epoch)} as {c}" for c, e in columns.items()]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    # UTC conversion whatever the zone of the session
    epoch = "unix_micros(to_utc_timestamp(cast(ts as timestamp), 'UTC'))"
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        epoch = (
            "unix_micros(to_utc_timestamp(cast(ts as timestamp), current_timezone()))"
        )
    return table(spark, sf_dir, "events").selectExpr(*_select(PACKET_COLUMNS, epoch))


def cic_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*_select(CIC_COLUMNS))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*_select(PREDICTION_COLUMNS))


def vec2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").selectExpr(
        "vec_id",
        "label",
        "cast(element_at(embedding, 1) as double) as x1",
        "cast(element_at(embedding, 2) as double) as x2",
    )


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings")


def _cte(columns: dict[str, str], source: str, epoch: str = "") -> str:
    return "select " + ",\n ".join(_select(columns, epoch)) + f"\n from {source}"


SQL_VIEWS = {
    "packets": _cte(PACKET_COLUMNS, "events", "epoch_us(ts)"),
    "cic_raw": _cte(CIC_COLUMNS, "orders"),
    "predictions": _cte(PREDICTION_COLUMNS, "orders"),
    "vec2": "select vec_id, label, cast(embedding[1] as double) as x1, "
    "cast(embedding[2] as double) as x2 from embeddings",
}
