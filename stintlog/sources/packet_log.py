"""The packet log: reading it as a table or a stream, and writing to it."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from stintlog.operators.packets import (
    ESSENTIALS, LATEST, MAIN_STREAM, ReadSpec, match_session, select_packets,
)
from stintlog.schemas import BOOL, LOG, TEXT, record

# Reading one kind, stream or source then reads only its folders.
PARTITIONS = ["data_source", "stream", "type"]

# Files of a micro-batch unless the reader says otherwise, so that a backlog is never one batch.
FILES_PER_TRIGGER = 1_000


def read_packets(
    spark: SparkSession,
    path: str,
    spec: ReadSpec = ReadSpec(),
    streaming: bool = False,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Packets of a log written by ``write_packets``, filtered by ``spec``.

    ``partition`` and ``submit_time`` are null where what was written had none.

    ``files_per_trigger`` limits a micro-batch of the streaming form. There ``LATEST`` means what
    is appended from now on: the offsets that the log has reached are looked up first.
    """
    reader = (spark.readStream if streaming else spark.read).schema(LOG)
    if streaming:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger or FILES_PER_TRIGGER)
        spec = _from_now_on(spark, path, spec)
    # A folder name cannot be empty, so the main stream comes back as null.
    packets = reader.parquet(path).withColumn(
        "stream", F.coalesce("stream", F.lit(MAIN_STREAM))
    )
    return select_packets(packets, spec)


def _from_now_on(spark: SparkSession, path: str, spec: ReadSpec) -> ReadSpec:
    """The spec with the next offset of its log in place of each ``LATEST``."""
    if LATEST not in (*spec.offsets, spec.main_offset):
        return spec
    log = select_packets(
        spark.read.schema(LOG).parquet(path).withColumn("stream", F.coalesce("stream", F.lit(MAIN_STREAM))),
        ReadSpec(spec.data_source, spec.session_key),
    )
    reached = {r["stream"]: r["last"] + 1 for r in log.groupBy("stream").agg(F.max("pkt_offset").alias("last")).collect()}
    offsets = [reached.get(s, 0) if o == LATEST else o for s, o in spec.starts().items()]
    main = reached.get(MAIN_STREAM, 0) if spec.main_offset == LATEST else spec.main_offset
    return replace(spec, offsets=offsets, main_offset=main)


def kafka_options(
    spec: ReadSpec, servers: str, strategy: str, partitions: Mapping[str, int] | None = None
) -> dict[str, str]:
    """Options of Spark's Kafka source for a spec of one data source.

    By topic, each stream is a topic and new streams are found by pattern when none is named.
    """
    if spec.data_source is None:
        raise ValueError("a Kafka read needs a data source")
    source = spec.data_source
    options = {"kafka.bootstrap.servers": servers}
    if not spec.streams:
        if spec.main_offset == LATEST:
            raise ValueError("name the streams of a Kafka read whose main stream starts at LATEST")
        pattern = source.replace(".", "\\.")
        if strategy == "topic":
            other = f"\\.(?!{ESSENTIALS}$).*"
            pattern += other if spec.exclude_main_stream else f"({other})?"
        options["subscribePattern"] = pattern
        # A pattern takes no offsets by topic: ``read_kafka`` filters the main stream's.
        options["startingOffsets"] = "earliest"
        return options
    starts = spec.starts()
    if not spec.exclude_main_stream:
        starts = {MAIN_STREAM: spec.main_offset, **starts}
    offsets: dict[str, dict[str, int]] = {}
    for stream, offset in starts.items():
        if strategy == "topic":
            offsets[f"{source}.{stream}" if stream else source] = {"0": offset}
        else:
            offsets.setdefault(source, {})[str((partitions or {}).get(stream, 0))] = offset
    options["assign"] = json.dumps({t: sorted(map(int, p)) for t, p in offsets.items()})
    options["startingOffsets"] = json.dumps(offsets)
    return options


def essentials_options(spec: ReadSpec, servers: str) -> dict[str, str]:
    """Options of Spark's Kafka source for the essentials topic of a spec's data source."""
    only = ReadSpec(
        spec.data_source,
        streams=(ESSENTIALS,),
        offsets=(spec.essentials_offset,),
        exclude_main_stream=True,
    )
    return kafka_options(only, servers, "topic")


# The value of a Kafka record: the packet's envelope with its content.
KAFKA_VALUE = record(type=TEXT, session_key=TEXT, is_essential=BOOL, content=TEXT)


def kafka_packets(
    records: DataFrame, data_source: str, partitions: Mapping[str, int] | None = None
) -> DataFrame:
    """Packets from the records of Spark's Kafka source, batch or stream.

    The stream is the part of the topic after the data source, or with ``partitions`` the one
    mapped to the record's partition. Offsets count per topic and partition.
    """
    if partitions is None:
        stream = F.col("topic").substr(F.lit(len(data_source) + 2), F.length("topic"))
    else:
        stream = F.lit(MAIN_STREAM)
        for name, number in partitions.items():
            stream = F.when(F.col("partition") == number, name).otherwise(stream)
    value = F.from_json(F.col("value").cast("string"), KAFKA_VALUE)
    return records.select(
        F.col("offset").alias("pkt_offset"),
        F.col("partition").cast("int").alias("partition"),
        F.lit(data_source).alias("data_source"),
        stream.alias("stream"),
        F.col("timestamp").alias("submit_time"),
        value.alias("v"),
    ).select("pkt_offset", "partition", "data_source", "stream", "submit_time", "v.*")


def read_kafka(
    spark: SparkSession,
    spec: ReadSpec,
    servers: str,
    strategy: str,
    partitions: Mapping[str, int] | None = None,
    streaming: bool = True,
    packets_per_trigger: int | None = None,
) -> DataFrame:
    """Packets of a spec from Kafka; needs Spark's Kafka package on the class path.

    The main stream's topic or partition is read unless the spec excludes it.
    """
    reader = (spark.readStream if streaming else spark.read).format("kafka")
    if packets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", packets_per_trigger)
    records = reader.options(**kafka_options(spec, servers, strategy, partitions)).load()
    packets = kafka_packets(
        records, spec.data_source, partitions or {} if strategy == "partition" else None
    )
    return select_packets(packets, replace(spec, offsets=())) if not spec.streams else (
        match_session(packets, spec.session_key) if spec.session_key else packets
    )


def write_packets(packets: DataFrame, path: str, mode: str = "append") -> None:
    """Append packets to a log, partitioned so that reads prune. Partition and submit time are kept.

    The rebalance makes few large files per folder and splits an oversized one over tasks.
    """
    packets.hint("rebalance", *PARTITIONS).write.mode(mode).partitionBy(*PARTITIONS).parquet(path)


def write_info_packets(packets: DataFrame, info_type: str, path: str) -> None:
    """Append status packets with their info type; they belong to the essentials."""
    tagged = packets.withColumn("info_type", F.lit(info_type)).withColumn(
        "is_essential", F.lit(True)
    )
    tagged.hint("rebalance", "info_type").write.mode("append").partitionBy("info_type").parquet(path)


def stream_packets_to(packets: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream of packets to a log until the source is drained."""
    return (
        packets.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*PARTITIONS)
        .trigger(availableNow=True)
        .start()
    )
