"""Sessions: the catalogue folded from the log, its queries, time ranges and summaries.

A session log has ``pkt_offset, type, session_key, data_source, identifier, assoc_key``. Offsets
count per stream, so the columns of ``ARRIVAL`` that a log has decide which packet is later.
Folding uses aggregates that combine before the shuffle, so a busy session is no hot key.
Sets and maps come out as rows: one row per element, however many a session has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stintlog.functions.names import title_or_untitled
from stintlog.functions.times import int_div
from stintlog.operators.ordering import BUCKET_SPAN, number_rows

# Record kinds that stretch a session's time range.
RANGE_KINDS = ("Periodic", "Row", "Synchro", "CAN", "Coverage")

INFO_COLUMNS = ("session_type", "version", "utc_offset", "streams", "offsets", "main_offset", "essentials_offset")


# What orders the packets of several streams, the first that differs deciding.
ARRIVAL = ("submit_time", "pkt_offset", "stream", "partition")


def arrival(log: DataFrame) -> Column:
    """The place of a packet in the order of arrival."""
    known = [c for c in ARRIVAL if c in log.columns]
    return F.struct(*known) if len(known) > 1 else F.col(known[0])


def session_catalog(log: DataFrame) -> DataFrame:
    """One row per session: source, identifier, whether complete, first and last offset.

    An empty identifier is an update only in a SessionInfo packet, where it means untitled. Of
    ``INFO_COLUMNS``, those the log has are included with their latest value.
    """
    is_update = (F.col("type") == "SessionInfo") | (F.col("identifier") != "")
    at = arrival(log)
    info = [
        F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c)
        for c in INFO_COLUMNS
        if c in log.columns
    ]
    return log.groupBy("session_key").agg(
        F.min_by("data_source", at).alias("data_source"),
        title_or_untitled(
            F.max_by("identifier", F.when(is_update, at))
        ).alias("identifier"),
        F.bool_or(F.col("type") == "EndOfSession").alias("is_complete"),
        F.min("pkt_offset").alias("first_offset"),
        F.max("pkt_offset").alias("last_offset"),
        *info,
    )


def sessions_of_source(catalog: DataFrame, data_source: str) -> DataFrame:
    return catalog.where(F.col("data_source") == data_source)


def live_sessions(catalog: DataFrame, data_source: str) -> DataFrame:
    """Sessions of a source that are not complete, newest first."""
    return (
        sessions_of_source(catalog, data_source)
        .where(~F.col("is_complete"))
        .orderBy(F.col("first_offset").desc())
    )


def latest_live_session(catalog: DataFrame, data_source: str) -> DataFrame:
    """The newest session of a source that is not complete."""
    return live_sessions(catalog, data_source).limit(1)


def historical_sessions(catalog: DataFrame, data_source: str | None = None) -> DataFrame:
    """Complete sessions, numbered from 0 per source in order of creation."""
    complete = catalog.where("is_complete")
    if data_source is not None:
        complete = sessions_of_source(complete, data_source)
    return number_rows(
        complete,
        ["data_source"],
        int_div("first_offset", BUCKET_SPAN),
        ["first_offset"],
        "_position",
    ).select("*", (F.col("_position") - 1).alias("session_no")).drop("_position")


def load_first_historical(catalog: DataFrame) -> DataFrame:
    """The first complete session of a store, and whether the store holds others."""
    return (
        catalog.where("is_complete")
        .agg(
            F.min_by(F.struct(*catalog.columns), "first_offset").alias("s"),
            (F.count(F.lit(1)) > 1).alias("has_more"),
        )
        .where(F.col("s").isNotNull())
        .select("s.*", "has_more")
    )


def session_identifier(updates: DataFrame) -> DataFrame:
    """Last identifier of each session; an empty one shows as untitled."""
    return updates.groupBy("session_key").agg(
        title_or_untitled(F.max_by("identifier", arrival(updates))).alias("identifier")
    )


def session_details(updates: DataFrame) -> DataFrame:
    """Current details of each session, a row per key: a later update of a key wins.

    Takes ``session_key, pkt_offset, details`` with ``details`` a map.
    """
    return (
        updates.select("session_key", arrival(updates).alias("_at"), F.explode("details").alias("detail", "value"))
        .groupBy("session_key", "detail")
        .agg(F.max_by("value", "_at").alias("value"))
    )


def associated_sessions(updates: DataFrame) -> DataFrame:
    """Sessions associated with each session, a row per pair.

    Takes ``session_key`` and the array ``assoc_keys``, as in ``plans.recording.session_log_of``.
    """
    pairs = updates.select("session_key", F.explode("assoc_keys").alias("assoc_key"))
    return pairs.where(F.col("assoc_key").isNotNull()).distinct()


def _notifications(packets: DataFrame, kind: str, data_source: str | None) -> DataFrame:
    packets = packets.where(F.col("type") == kind)
    if data_source is not None:
        packets = packets.where(F.col("data_source") == data_source)
    return packets.select("pkt_offset", "data_source", "session_key")


def session_start_notifications(packets: DataFrame, data_source: str | None = None) -> DataFrame:
    """A row per new session of a source; batch or stream."""
    return _notifications(packets, "NewSession", data_source)


def session_stop_notifications(packets: DataFrame, data_source: str | None = None) -> DataFrame:
    """A row per ended session of a source; batch or stream."""
    return _notifications(packets, "EndOfSession", data_source)


def session_time_range(records: DataFrame, time_col: str = "day_ns") -> DataFrame:
    """First and last time of each session, over sample, CAN and coverage records only.

    Laps, markers, events and errors do not count. A periodic block counts with its start, so
    feed blocks, not samples. Batch or stream (update mode).
    """
    return (
        records.where(F.col("kind").isin(*RANGE_KINDS))
        .groupBy("session_key")
        .agg(F.min(time_col).alias("start_ns"), F.max(time_col).alias("end_ns"))
    )


def session_summary(catalog: DataFrame, ranges: DataFrame, laps: DataFrame) -> DataFrame:
    """Closing record of each session. Every side has one row per session when joined.

    ``laps`` are classified ones; a session without any has the default lap, hence one.
    """
    lap_totals = laps.groupBy("session_key").agg(
        F.count(F.lit(1)).alias("n_laps"), F.count_if("counts").alias("n_counting")
    )
    return (
        catalog.select("session_key", "data_source", "identifier", "is_complete")
        .join(ranges, "session_key", "left")
        .join(lap_totals, "session_key", "left")
        .withColumn("n_laps", F.coalesce("n_laps", F.lit(1)))
        .withColumn("n_counting", F.coalesce("n_counting", F.lit(0)))
    )


def session_json(catalog: DataFrame) -> DataFrame:
    """Each session's catalogue row as JSON text."""
    return catalog.select("session_key", F.to_json(F.struct("*")).alias("json"))
