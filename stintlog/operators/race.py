"""Markers, events, errors, metadata and coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stintlog.functions.times import day_time

# Fixed value.
LAP_TRIGGER = "Lap Trigger"


def lap_triggers(markers: DataFrame) -> DataFrame:
    """Markers that start a lap: trigger source as a number, and the value as a lap number.

    A lap number has 16 bits; a larger value wraps around. A trigger whose source is no number
    starts no lap; ``unreadable_triggers`` has it.
    """
    carried = [c for c in markers.columns if c not in ("type", "source", "value")]
    wrapped = F.pmod(F.col("value") + 32768, F.lit(65536)) - 32768
    return markers.where((F.col("type") == LAP_TRIGGER) & _trigger_source().isNotNull()).select(
        *carried,
        wrapped.cast("smallint").alias("lap_number"),
        _trigger_source().alias("trigger_source"),
    )


def _trigger_source() -> Column:
    """The source as an unsigned 8-bit number, else null."""
    source = F.col("source").try_cast("smallint")
    return F.when(source.between(0, 255), source)


def unreadable_triggers(markers: DataFrame) -> DataFrame:
    """Lap triggers whose source is not an unsigned 8-bit number."""
    return markers.where((F.col("type") == LAP_TRIGGER) & _trigger_source().isNull())


def point_markers(markers: DataFrame) -> DataFrame:
    """Markers that only label a moment."""
    return markers.where(F.col("type") != LAP_TRIGGER)


def split_markers(markers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lap triggers, point markers)."""
    return lap_triggers(markers), point_markers(markers)


def dedupe_markers(markers: DataFrame) -> DataFrame:
    """A marker of the same time and label is stored once per session, at its first offset.

    Offsets count per stream, so several markers may share the first one; the rest of the row then
    decides. Combined before the shuffle, without a join.
    """
    key = ["session_key", "day_ns", "label"]
    rest = [c for c in markers.columns if c not in (*key, "pkt_offset")]
    first = F.min(F.struct("pkt_offset", *rest)).alias("_first")
    return markers.groupBy(*key).agg(first).select(*key, "_first.*").select(*markers.columns)


def events(packets: DataFrame, definitions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Events with the id and application of their definition; undefined ones are not stored.

    Of repeated definitions of an identifier (and ``by`` columns, such as the session) the latest
    counts.
    """
    at = ["pkt_offset"] if "pkt_offset" in definitions.columns else []
    latest = F.max(F.struct(*at, "definition_id", "application_name")).alias("d")
    known = definitions.groupBy(*by, F.col("identifier").alias("event_identifier")).agg(latest).select(
        *by, "event_identifier", "d.definition_id", "d.application_name"
    )
    return packets.join(known, [*by, "event_identifier"]).select(
        "pkt_offset",
        "session_key",
        "definition_id",
        "application_name",
        day_time("ts_ns").alias("day_ns"),
        "raw_values",
    )


def _writes(*pairs: tuple[str, float]) -> Column:
    return F.array(
        *[F.struct(F.lit(k).alias("error_kind"), F.lit(v).alias("value")) for k, v in pairs]
    )


def _error_writes() -> Column:
    status, kind = F.col("status"), F.col("error_type")
    return (
        F.when((status == "SET") & (kind == "CURRENT"), _writes(("Logged", 1.0), ("Current", 1.0)))
        .when((status == "CLEARED") & (kind == "CURRENT"), _writes(("Logged", 1.0), ("Current", 0.0)))
        .when((status == "SET") & (kind == "LOGGED"), _writes(("Logged", 1.0)))
        .when((status == "CLEARED") & (kind == "LOGGED"), _writes(("Current", 0.0), ("Logged", 0.0)))
    )


def error_samples(errors: DataFrame, definitions: DataFrame, channels: DataFrame) -> DataFrame:
    """0/1 samples on an error's current and logged channels, by its status and type.

    Other combinations of status and type write nothing; ``reject_errors`` has them.
    """
    written = errors.withColumn("w", F.explode(_error_writes())).select(
        "pkt_offset",
        "session_key",
        "name",
        day_time("ts_ns").alias("day_ns"),
        "w.error_kind",
        "w.value",
    )
    known = definitions.select("session_key", "name", "error_kind", "parameter").join(
        channels.where(F.col("space") == "Row").select("session_key", "parameter", "channel_id"),
        ["session_key", "parameter"],
    )
    return written.join(known, ["session_key", "name", "error_kind"])


def reject_errors(errors: DataFrame) -> DataFrame:
    """Errors whose status and type say nothing about a channel."""
    return errors.where(_error_writes().isNull())


def metadata_items(packets: DataFrame) -> DataFrame:
    """One row per metadata item that has a text or a number."""
    carried = [c for c in packets.columns if c != "metadata"]
    items = packets.select(*carried, F.explode("metadata").alias("item_key", "item"))
    return items.where(
        F.col("item.str_value").isNotNull() | F.col("item.dbl_value").isNotNull()
    ).select(*carried, "item_key", "item.str_value", "item.dbl_value")


def coverage_cursor(packets: DataFrame) -> DataFrame:
    """Latest coverage cursor of each session."""
    return packets.groupBy("session_key").agg(
        F.max_by(day_time("ts_ns"), "pkt_offset").alias("covered_ns")
    )
