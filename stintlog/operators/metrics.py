"""Benchmark runs: latency, completion, throughput."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stintlog.functions.times import int_div

KIB = 1024


def match_runs(packets: DataFrame, runs: DataFrame) -> DataFrame:
    """Packets whose session key is the number of a known run; others are skipped."""
    return (
        packets.withColumn("run_id", F.col("run_key").try_cast("bigint"))
        .where(F.col("run_id").isNotNull())
        .join(runs, "run_id")
    )


def message_latency(packets: DataFrame) -> DataFrame:
    """Latency of each response: arrival minus the creation time of its first item."""
    first = packets.groupBy("response_id").agg(
        F.min_by("created_ns", "position").alias("created_ns"),
        F.max("received_ns").alias("received_ns"),
    )
    return first.select(
        "response_id",
        ((F.col("received_ns") - F.col("created_ns")) / 1e6).alias("latency_ms"),
    )


def latency_stats(latencies: DataFrame) -> DataFrame:
    """Largest, mean and smallest latency per run and kind, without the first record.

    The first record is removed by an anti join on run, kind and offset, which spreads a busy
    run over all tasks; a window would put it into one.
    """
    keys = ["run_id", "kind"]
    first = latencies.groupBy(*keys).agg(F.min("pkt_offset").alias("pkt_offset"))
    return (
        latencies.join(first, [*keys, "pkt_offset"], "left_anti")
        .groupBy(*keys)
        .agg(
            F.max("latency_ms").alias("max_ms"),
            F.avg("latency_ms").alias("avg_ms"),
            F.min("latency_ms").alias("min_ms"),
        )
    )


def run_completion(runs: DataFrame, messages: DataFrame) -> DataFrame:
    """Published and received messages of each run, elapsed time, and whether all arrived.

    ``messages`` has ``run_id, kind`` (publish or receive), ``ts_ns`` and ``n_messages``.
    Elapsed is last receive minus first publish, null while either is missing.
    """
    published, received = F.col("kind") == "publish", F.col("kind") == "receive"
    totals = messages.groupBy("run_id").agg(
        F.sum(F.when(published, F.col("n_messages"))).alias("published"),
        F.sum(F.when(received, F.col("n_messages"))).alias("received"),
        F.min(F.when(published, F.col("ts_ns"))).alias("_from"),
        F.max(F.when(received, F.col("ts_ns"))).alias("_to"),
    )
    return runs.join(totals, "run_id", "left").select(
        *runs.columns,
        F.coalesce("published", F.lit(0)).alias("published"),
        F.coalesce("received", F.lit(0)).alias("received"),
        ((F.col("_to") - F.col("_from")) / 1e6).alias("elapsed_ms"),
        (F.coalesce("received", F.lit(0)) == F.col("expected_messages")).alias("completed"),
    )


def run_throughput(runs: DataFrame) -> DataFrame:
    """Megabytes per second, exact and with the number of MiB rounded down."""
    total = F.col("expected_messages").cast("bigint") * F.col("message_size").cast("bigint")
    seconds = F.col("elapsed_ms") / 1000
    floor_mib = int_div(int_div(total, KIB), KIB)
    return (
        runs.withColumn("floor_mib", floor_mib)
        .withColumn("floor_mib_per_s", F.try_divide(F.col("floor_mib").cast("double"), seconds))
        .withColumn("mib_per_s", F.try_divide(total.cast("double") / (KIB * KIB), seconds))
    )
