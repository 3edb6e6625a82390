"""Streams: the batch operators on micro-batches, and waiting for what is announced later; see ``stateful``."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from stintlog.functions.names import full_identifier
from stintlog.functions.times import NS_PER_SECOND, int_div, to_timestamp
from stintlog.operators.packets import ReadSpec
from stintlog.plans.recording import LISTS, closing_tables, record_session_tables, rejects_of, samples_of
from stintlog.schemas import LONG, TEXT, record
from stintlog.sources.packet_log import read_packets
from stintlog.sources.registry import register_channels
from stintlog.sources.session_tables import load_session, write_batch, write_session_tables
from stintlog.streaming.stateful import GIVEN_UP, REVISION, hold_rows

# Keys of a stream join that one (session, parameter) is spread over.
SALTS = 16

# Definitions that a task remembers, to send each once.
REMEMBERED = 200_000

# Where a recording keeps the ids of its channels, below its tables.
CHANNEL_REGISTRY = "_channel_registry"

# A stopped session closes after this long without a packet.
IDLE_NS = 10 * NS_PER_SECOND


def _trigger(every: str | None) -> dict:
    """Drain the source and stop, or run a micro-batch every so often."""
    return {"processingTime": every} if every else {"availableNow": True}


def stream_tables(
    packets: DataFrame,
    tables: Callable[[DataFrame], Mapping[str, DataFrame]],
    path: str,
    checkpoint: str,
    every: str | None = None,
    output_mode: str = "append",
) -> StreamingQuery:
    """Write the tables of each micro-batch below ``path``; a repeated batch replaces itself.

    The batch is stored once and read per table, so the source is not read again for each.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            write_batch(tables(batch), path, batch_id)
        finally:
            batch.unpersist()

    return (
        packets.writeStream.foreachBatch(write)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .start()
    )


def stream_samples(
    packets: DataFrame,
    formats: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = None,
    definitions: DataFrame | None = None,
    **waiting: str | int,
) -> StreamingQuery:
    """Continuous packets to the samples table. Batch size is limited at the source.

    With ``formats`` as a stream, blocks wait for their format (and for ``definitions``, where
    given; see ``live_blocks``), and a table ``rejects`` has what no sample was made of.
    """
    if formats.isStreaming:
        return stream_tables(live_blocks(packets, formats, definitions, **waiting), block_tables, path, checkpoint, every)
    return stream_tables(
        packets, lambda batch: {"samples": samples_of(batch, formats)}, path, checkpoint, every
    )


def replay_history(
    spark: SparkSession,
    log: str,
    session_key: str,
    formats: DataFrame,
    path: str,
    checkpoint: str,
    files_per_trigger: int = 1000,
) -> None:
    """Record a complete session once, all its tables, in batches of so many files; then stop.

    The batches share one registry of channels. Once all are recorded, the tables of
    ``plans.recording.closing_tables`` are written beside the others.
    """
    packets = read_packets(
        spark, log, ReadSpec(session_key=session_key), streaming=True, files_per_trigger=files_per_trigger
    )
    channels = partial(register_channels, spark, f"{path}/{CHANNEL_REGISTRY}")
    query = stream_tables(
        packets, lambda batch: record_session_tables(batch, formats, channels=channels), path, checkpoint
    )
    query.awaitTermination()
    write_session_tables(closing_tables(partial(load_session, spark, path, session_key=session_key)), path)


def hold_and_replay(
    samples: DataFrame,
    definitions: DataFrame,
    ttl: str | None = None,
    how: str = "inner",
    salts: int = SALTS,
    name: str = "parameter",
) -> DataFrame:
    """Samples whose parameter is defined; in a stream, a sample waits for its definition.

    ``samples`` has ``session_key, parameter, pkt_offset, ts_ns``; ``definitions`` has
    ``session_key, parameter, defined_ns``, repeats allowed. For events or errors, ``name`` is
    the column that must be defined. Streams hold each side in join
    state. With ``ttl`` a sample waits no longer than that in event time, and ``how="left"``
    returns it with ``defined`` null once given up. Both sides are salted, so that samples of
    one busy parameter spread over ``salts`` keys; definitions are repeated for each.
    """
    keys = ["session_key", name]
    known = definitions.select(*keys, to_timestamp("defined_ns").alias("defined_at"))
    held = samples.withColumn("salt", F.pmod("pkt_offset", F.lit(salts)).cast("int"))
    if ttl:
        known = known.withWatermark("defined_at", ttl)
        held = held.withColumn("taken_at", to_timestamp("ts_ns")).withWatermark("taken_at", ttl)
    known = (
        known.dropDuplicates(keys)
        if known.isStreaming
        else known.groupBy(*keys).agg(F.min("defined_at").alias("defined_at"))
    )
    known = (
        known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        .withColumn("defined", F.lit(True))
    )
    s, d = held.alias("s"), known.alias("d")
    condition = F.lit(True)
    for key in [*keys, "salt"]:
        condition = condition & (F.col(f"s.{key}") == F.col(f"d.{key}"))
    if ttl:
        condition = condition & (
            F.col("d.defined_at") <= F.col("s.taken_at") + F.expr(f"interval {ttl}")
        )
    return s.join(d, condition, how).select(*[f"s.{c}" for c in samples.columns], "d.defined")


def _named_list(blocks: DataFrame) -> Column:
    """Full names of a block's parameters."""
    return F.transform("params", full_identifier)


def _above_watermark(df: DataFrame, condition: Column) -> DataFrame:
    """A filter that stays above the watermark, so that time passes with every row of the stream.

    A filter that does not mention the time would be pushed below it, and a branch in which nothing
    passes would hold up all the others.
    """
    return df.where(F.when(F.col("submit_time").isNotNull(), condition).otherwise(F.lit(False)))


def _once(definitions: DataFrame) -> DataFrame:
    """``session_key, name, submit_time`` of definitions: of those that a task reads again, the last to arrive.

    Repeats say nothing new, but each would go to every salt's state. A task remembers up to
    ``REMEMBERED`` names; past that it starts anew, and more repeats pass.
    """
    most = REMEMBERED

    def latest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told() -> pa.RecordBatch:
            rows = [(*key, at) for key, at in held.items()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

        held: dict[tuple, int | None] = {}
        for batch in batches:
            for session, name, at in zip(*(column.to_pylist() for column in batch.columns)):
                before = held.get((session, name))
                held[session, name] = before if before is not None and (at is None or at <= before) else at
            if len(held) >= most:
                yield told()
                held.clear()
        if held:
            yield told()

    names, kinds = ["session_key", "name", "at"], [pa.string(), pa.string(), pa.int64()]
    rows = definitions.select("session_key", full_identifier(F.col("parameter")).alias("name"), F.unix_micros("submit_time").alias("at"))
    once = rows.mapInArrow(latest, "session_key string, name string, at long")
    return once.select("session_key", "name", F.timestamp_micros("at").alias("submit_time"))


def live_blocks(
    packets: DataFrame,
    formats: DataFrame,
    definitions: DataFrame | None = None,
    wait: str = "1 hour",
    lateness: str = "1 minute",
    idle: str = "1 day",
    salts: int = SALTS,
) -> DataFrame:
    """Sample blocks of a stream that wait as a whole for their format, then for their definitions.

    ``packets`` as ``read_packets`` streams them, with ``submit_time``. ``formats`` is a stream of
    ``data_source, format_id, kind, params, submit_time`` and ``definitions`` one of ``session_key,
    parameter, submit_time`` (none: blocks need no definition). A block comes out once, undecoded,
    with ``known_params`` and ``reason``: null, or why it was given up after ``wait`` (``item`` says
    what was missing). Blocks with an inline list wait for no format, and unreadable ones for nothing.
    """
    head = F.from_json("content", record(format_id=LONG, params=T.ArrayType(TEXT)))
    timed = packets.withWatermark("submit_time", lateness).withColumn("_head", head)
    is_block = F.col("type").isin(*LISTS)
    by_id = is_block & F.coalesce(F.col("_head.format_id") != 0, F.lit(False))
    envelope = ["session_key", "data_source", "pkt_offset", "type", "content"]
    rows = _above_watermark(timed, by_id).select(
        *envelope, "submit_time", F.col("_head.format_id").alias("format_id"), F.array(F.col("_head.format_id").cast("string")).alias("needs")
    )
    lists = formats.withWatermark("submit_time", lateness)
    lists = _above_watermark(lists, (F.col("kind") == "parameter") & (F.col("format_id") != 0)).select(
        "data_source", "format_id", "submit_time", F.col("format_id").cast("string").alias("name"), F.to_json("params").alias("fact")
    )
    found = hold_rows(rows, lists, ["data_source", "format_id"], wait, idle, salts)
    given_up = F.col("status") == GIVEN_UP
    found = found.select(
        *envelope,
        F.col("settled_at").alias("submit_time"),
        F.from_json(F.get("facts", F.lit(0)), T.ArrayType(TEXT)).alias("params"),
        F.when(given_up, "no parameter list").alias("reason"),
        F.when(given_up, F.col("format_id").cast("string")).alias("item"),
    )
    nothing = F.lit(None).cast("string")
    # Inline lists wait for no format, so they pass by its state.
    inline = _above_watermark(timed, is_block & ~by_id).select(
        *envelope, "submit_time", F.col("_head.params").alias("params"), nothing.alias("reason"), nothing.alias("item")
    )
    resolved = found.unionByName(inline)
    if definitions is not None:
        names = F.coalesce(F.when(F.col("reason").isNull(), _named_list(resolved)), F.array().cast("array<string>"))
        defined = _once(definitions).withWatermark("submit_time", lateness).withColumn("fact", F.lit("defined"))
        settled = hold_rows(
            resolved.withColumn("needs", names), defined, ["session_key"], wait, idle, salts
        )
        undefined = F.filter(_named_list(settled), lambda _, i: F.get("facts", i).isNull())
        resolved = settled.withColumn("reason", F.when(given_up, "parameter not defined").otherwise(F.col("reason")))
        resolved = resolved.withColumn("item", F.when(given_up, F.array_join(undefined, ",")).otherwise(F.col("item")))
    return resolved.select("session_key", "pkt_offset", "type", "content", F.col("params").alias("known_params"), "reason", "item")


def block_tables(blocks: DataFrame) -> dict[str, DataFrame]:
    """``samples`` and ``rejects`` of ``live_blocks``: together they account for every list of every block."""
    known = blocks.where(F.col("reason").isNull()).drop("reason", "item")
    given_up = blocks.where(F.col("reason").isNotNull()).select("session_key", "pkt_offset", "type", "item", "reason")
    return {"samples": samples_of(known, None), "rejects": rejects_of(known, None).unionByName(given_up)}


def latest_laps(revisions: DataFrame) -> DataFrame:
    """The last revision of each lap."""
    rest = [c for c in REVISION.names if c not in ("session_key", "pkt_offset")]
    return (
        revisions.groupBy("session_key", "pkt_offset")
        .agg(F.max_by(F.struct(*rest), "revision").alias("r"))
        .select("session_key", "pkt_offset", "r.*")
    )


def session_idle_close(packets: DataFrame, gap: str = "10 seconds") -> DataFrame:
    """Bursts of a session's packets: a burst ends when nothing arrived for more than ``gap``.

    For streams with ``type`` and ``submit_time``, such as a stored log; a burst comes out once the
    watermark passed its end. ``stop_ns`` is the first EndOfSession in it: the session closes with
    that burst (``close_times``). Bursts are merged per task before the shuffle (see
    ``SQL_SETTINGS``).
    """
    submit_ns = F.unix_micros("submit_time") * 1000
    # A window's end is not in it: a packet exactly ``gap`` later still belongs to the burst.
    return (
        packets.withWatermark("submit_time", gap)
        .groupBy("session_key", F.session_window("submit_time", f"{gap} 1 microsecond").alias("burst"))
        .agg(
            F.count(F.lit(1)).alias("n_packets"),
            F.min(submit_ns).alias("first_ns"),
            F.max(submit_ns).alias("last_ns"),
            F.min(F.when(F.col("type") == "EndOfSession", submit_ns)).alias("stop_ns"),
        )
        .select("session_key", "first_ns", "last_ns", "n_packets", "stop_ns")
    )


def close_times(bursts: DataFrame, gap_ns: int = IDLE_NS) -> DataFrame:
    """When each stopped session closes, from its stored bursts: ``gap_ns`` after the one with its first stop."""
    return (
        bursts.where(F.col("stop_ns").isNotNull())
        .groupBy("session_key")
        .agg(F.min("stop_ns").alias("stop_ns"), (F.min("last_ns") + gap_ns).alias("close_ns"))
    )


def dedupe_marker_stream(markers: DataFrame, lateness: str) -> DataFrame:
    """A marker of the same time and label passes once per session, as the first that arrives.

    ``markers`` is a stream with ``submit_time``. A marker is remembered until the watermark is
    ``lateness`` past it, so repeats within that time are dropped, across micro-batches and
    restarts, and the state does not grow with the stream.
    """
    return markers.withWatermark("submit_time", lateness).dropDuplicatesWithinWatermark(["session_key", "day_ns", "label"])


def idle_bursts(packets: DataFrame, gap_ns: int) -> DataFrame:
    """The same bursts for a finished log, and whether a burst is the session's last.

    Packets of one slot of length ``gap_ns`` always belong together, so they are reduced to a
    row per slot before the sessions are put in order.
    """
    slots = (
        packets.groupBy("session_key", int_div("submit_ns", gap_ns).alias("slot"))
        .agg(
            F.min("submit_ns").alias("first_ns"),
            F.max("submit_ns").alias("last_ns"),
            F.count(F.lit(1)).alias("n_packets"),
        )
    )
    in_order = Window.partitionBy("session_key").orderBy("slot")
    starts = F.col("first_ns") - F.lag("last_ns").over(in_order) > gap_ns
    bursts = (
        slots.withColumn("_starts", F.coalesce(starts, F.lit(False)).cast("int"))
        .withColumn("_burst", F.sum("_starts").over(in_order))
        .groupBy("session_key", "_burst")
        .agg(
            F.min("first_ns").alias("first_ns"),
            F.max("last_ns").alias("last_ns"),
            F.sum("n_packets").alias("n_packets"),
        )
    )
    last = Window.partitionBy("session_key").orderBy("_burst")
    return bursts.withColumn("is_last", F.lead("_burst").over(last).isNull()).drop("_burst")


def session_close_times(packets: DataFrame, gap_ns: int = IDLE_NS) -> DataFrame:
    """When each stopped session closes: the first time after its stop that it is idle.

    Packets (with ``type`` and ``submit_ns``) that still arrive after the stop keep the session
    open until nothing came for ``gap_ns``.
    """
    stops = (
        packets.where(F.col("type") == "EndOfSession")
        .groupBy("session_key")
        .agg(F.min("submit_ns").alias("stop_ns"))
    )
    return (
        idle_bursts(packets, gap_ns)
        .join(stops, "session_key")
        .where(F.col("last_ns") >= F.col("stop_ns"))
        .groupBy("session_key", "stop_ns")
        .agg((F.min("last_ns") + gap_ns).alias("close_ns"))
    )
