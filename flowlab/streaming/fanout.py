"""One stream of packets into several sinks: packets, rejects and counts.

A micro-batch is read once and written to folders that carry its number, so a
batch that is run again after a failure replaces what it wrote before, and no
row is counted twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowlab.streaming import scoring
from flowlab.streaming.flows import split_rejects

_BATCH = "batch"


def fan_out(
    packets: DataFrame, folder: str, checkpoint: str, available_now: bool = False, interval: str = "5 seconds"
) -> StreamingQuery:
    """Usable packets to ``folder/packets``, rows that cannot belong to a flow
    to ``folder/rejects``, the numbers of both to ``folder/counts``."""

    def write(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            usable, rejects = split_rejects(batch)
            sums = usable.agg(
                F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")
            ).withColumn("kind", F.lit("packets"))
            bad = rejects.agg(F.count(F.lit(1)).alias("n")).withColumns({"bytes": F.lit(0).cast("long"), "kind": F.lit("rejects")})
            counts = sums.unionByName(bad).coalesce(1)
            for name, rows in (("packets", usable), ("rejects", rejects), ("counts", counts)):
                rows.write.mode("overwrite").parquet(f"{folder}/{name}/{_BATCH}={number}")
        finally:
            batch.unpersist()

    return scoring.start(packets, write, checkpoint, available_now, interval)


def read_sink(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """What ``fan_out`` wrote so far: packets, rejects or counts per batch."""
    return spark.read.parquet(f"{folder}/{name}")


def totals(counts: DataFrame) -> DataFrame:
    """Packets, rejects and bytes of all batches; takes ``counts``."""
    return counts.groupBy("kind").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
