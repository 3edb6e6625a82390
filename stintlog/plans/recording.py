"""Whole plans: from packets to the session tables, and the report over them."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from stintlog.functions.lists import sample_kind
from stintlog.functions.times import day_time
from stintlog.operators import laps, packets as pk, race, samples as sm, sessions
from stintlog.operators.definitions import (
    assign_channels, block_parameters, dedupe_config, error_definitions, event_definitions, group_definitions,
    parameter_definitions, undefinable_events,
)
from stintlog.operators.formats import check_arity, resolve_event, resolve_parameter_list

SAMPLE_COLUMNS = [
    "session_key", "parameter", "ts_ns", "day_ns", "value", "status", "kind", "interval_ns", "pkt_offset",
]


# Sample lists of each kind of block.
LISTS = {"PeriodicData": "columns", "RowData": "rows", "SynchroData": "columns"}

# Resolved names of a block, where it brings them.
_KNOWN = "known_params"

Decoder = Callable[[Column, T.StructType], Column]


def _decoded(packets: DataFrame, kind: str, decoder: Decoder | None = None) -> DataFrame:
    carried = [c for c in ("pkt_offset", "session_key", "type", "content", _KNOWN) if c in packets.columns]
    return pk.decode_content(packets.select(carried), kind, decoder=decoder).drop("type")


def _sized(decoded: DataFrame, formats: DataFrame | None, kind: str) -> DataFrame:
    """Decoded blocks of one kind with resolved names and wide lists, and their size error.

    Without formats the blocks bring their resolved names in ``known_params``.
    """
    if formats is None:
        resolved = decoded.withColumn("params", F.col(_KNOWN)).drop(_KNOWN)
    else:
        resolved = resolve_parameter_list(decoded, formats)
    return check_arity(sm.widen_samples(resolved, LISTS[kind]))


# Decoded blocks of a kind, and the same ones with their names, wide lists and size error.
Sized = dict[str, tuple[DataFrame, DataFrame]]


def _sized_blocks(packets: DataFrame, formats: DataFrame | None, decoder: Decoder | None) -> Sized:
    """All kinds of blocks, made once for the plans that read them."""
    decoded = {kind: _decoded(packets, kind, decoder) for kind in LISTS}
    return {kind: (blocks, _sized(blocks, formats, kind)) for kind, blocks in decoded.items()}


def _fitting(sized: DataFrame) -> DataFrame:
    """The blocks whose sizes agree; ``rejects_of`` has the others."""
    return sized.where(F.col("arity_error").isNull()).drop("arity_error", "format_id")


def samples_of(packets: DataFrame, formats: DataFrame | None, decoder: Decoder | None = None) -> DataFrame:
    """All samples of a log: fixed-rate, row and variable-rate blocks in one long table.

    Without formats the packets bring their resolved names as a column ``known_params``.
    """
    return _samples_of(_sized_blocks(packets, formats, decoder))


def _samples_of(blocks: Sized) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    periodic, rows, synchro = (_fitting(blocks[kind][1]) for kind in LISTS)
    parts = [
        sm.explode_periodic(sm.drop_zero_interval(periodic)),
        sm.explode_rows(rows).withColumn("interval_ns", zero),
        sm.explode_synchro(synchro).withColumn("interval_ns", zero),
    ]
    return reduce(DataFrame.unionByName, [part.select(*SAMPLE_COLUMNS) for part in parts])


def rejects_of(packets: DataFrame, formats: DataFrame | None, decoder: Decoder | None = None) -> DataFrame:
    """Everything of a log that no table holds: ``session_key, pkt_offset, type, item, reason``.

    Packets of unknown type or undecodable content, blocks whose sizes disagree or that have no
    time axis, lists that are no numbers (``item`` is their place), variable-rate columns that do
    not fit (``item`` is the parameter), triggers, events and errors that say nothing usable. With
    the samples these account for every list of every block. Without formats see ``samples_of``; events
    are then not looked at.
    """
    return _rejects_of(packets, formats, decoder, _sized_blocks(packets, formats, decoder))


def _rejects_of(packets: DataFrame, formats: DataFrame | None, decoder: Decoder | None, blocks: Sized) -> DataFrame:
    carried = [c for c in ("pkt_offset", "session_key", "type", "content", _KNOWN) if c in packets.columns]
    packets = packets.select(carried)

    def rows(df: DataFrame, kind: Column, reason: Column | str, item: Column = F.lit(None)) -> DataFrame:
        reason = F.lit(reason) if isinstance(reason, str) else reason
        return df.select(
            "session_key", "pkt_offset", kind.alias("type"), item.cast("string").alias("item"), reason.alias("reason")
        )

    parts = [rows(pk.reject_packets(packets, decoder=decoder), F.col("type"), F.col("reason"))]
    for kind, lists in LISTS.items():
        decoded, sized = blocks[kind]
        name = F.lit(kind)
        parts.append(rows(sized.where(F.col("arity_error").isNotNull()), name, F.col("arity_error")))
        fitting = _fitting(sized)
        typed = decoded
        if kind == "PeriodicData":
            idle = ~F.coalesce(F.col("interval_ns") > 0, F.lit(False))
            parts.append(rows(fitting.where(idle), name, "no interval"))
            typed = decoded.where(~idle)
        # Of blocks whose sizes agree: the others are rejected as a whole.
        unread = sm.unreadable_lists(typed.select("session_key", "pkt_offset", lists), lists)
        unread = unread.join(fitting.select("session_key", "pkt_offset"), ["session_key", "pkt_offset"], "left_semi")
        parts.append(rows(unread, name, "no list of numbers", F.col("list_no")))
        if kind == "SynchroData":
            misfits = sm.misfit_synchro(fitting).where(F.col("n_samples") >= 0)
            parts.append(rows(misfits, name, "samples do not fit intervals", F.col("parameter")))
    markers = _decoded(packets, "Marker", decoder).withColumnRenamed("content_type", "type")
    parts.append(rows(race.unreadable_triggers(markers), F.lit("Marker"), "unreadable trigger source"))
    if formats is not None:
        events = resolve_event(_decoded(packets, "Event", decoder), formats)
        parts.append(rows(events.where(F.col("event_identifier").isNull()), F.lit("Event"), "unknown event format"))
        # A name that stands for no id needs a definition; those of the log itself count.
        defined = event_definitions(_decoded(packets, "Configuration", decoder)).select(F.col("identifier").alias("event_identifier"))
        unnumbered = undefinable_events(events.where(F.col("event_identifier").isNotNull()).withColumn("identifier", F.col("event_identifier")))
        unnumbered = unnumbered.join(defined.distinct(), "event_identifier", "left_anti")
        parts.append(rows(unnumbered, F.lit("Event"), "event without a definition or id", F.col("event_identifier")))
    errors = race.reject_errors(_decoded(packets, "Error", decoder))
    parts.append(rows(errors, F.lit("Error"), "no channel for status and type"))
    return reduce(DataFrame.unionByName, parts)


def lap_triggers_of(packets: DataFrame, decoder: Decoder | None = None) -> DataFrame:
    """Lap triggers of a log, with their day time."""
    markers = _decoded(packets, "Marker", decoder).withColumnRenamed("content_type", "type")
    return race.lap_triggers(markers).withColumn("day_ns", day_time("ts_ns"))


def laps_of(triggers: DataFrame, starts: DataFrame | None = None) -> DataFrame:
    """Named laps from lap triggers, in the order the rules apply."""
    in_time = laps.reject_early_laps(triggers, starts) if starts is not None else triggers
    return laps.classify_laps(laps.lap_guard(in_time))


def sample_report(samples: DataFrame) -> DataFrame:
    """Per session and parameter: samples, valid ones, and their smallest, largest and mean."""
    valid = F.when(F.col("status") == "VALID", F.col("value"))
    return samples.groupBy("session_key", "parameter").agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.count(valid).alias("n_valid"),
        F.min(valid).alias("min_value"),
        F.max(valid).alias("max_value"),
        F.avg(valid).alias("mean_value"),
    )


# Packet types that stretch a session's range, and the kinds they are recorded as.
_RANGE_KINDS = {
    "PeriodicData": "Periodic", "RowData": "Row", "SynchroData": "Synchro", "RawCANData": "CAN",
    "CoverageCursorInfo": "Coverage",
}


def _range_times(kind: str, block: Column) -> Column:
    """Times of a decoded packet that count for its session's range; null or empty if none does."""

    def numeric(samples: Column) -> Column:
        return sample_kind(samples).isin("double", "int", "bool")

    if kind == "RowData":
        rows = F.filter(F.arrays_zip(block["timestamps"].alias("at"), block["rows"].alias("row")), lambda r: numeric(r["row"]))
        return F.when(F.exists(block["rows"], numeric), F.array(F.array_min(rows["at"]), F.array_max(rows["at"])))
    if kind in ("RawCANData", "CoverageCursorInfo"):
        return F.array(block["ts_ns"])
    counts = F.exists(block["columns"], numeric)
    if kind == "PeriodicData":
        counts = counts & (block["interval_ns"] != 0)
    return F.when(counts, F.array(block["start_ns"]))


def time_records_of(packets: DataFrame, decoder: Decoder | None = None) -> DataFrame:
    """Times that stretch a session's range: ``session_key, kind, day_ns``.

    Only what is recorded counts: a fixed-rate or variable-rate block with its start, unless its
    interval is 0 or it has no list of numbers, and a row block with its rows of numbers. The log is
    scanned once and each content parsed once, by the schema of its own type.
    """
    kind = F.col("type")
    times, name = F.lit(None).cast("array<bigint>"), F.lit(None).cast("string")
    for packet_type, recorded in _RANGE_KINDS.items():
        found = pk.decoded_value(F.col("content"), packet_type, partial(_range_times, packet_type), decoder)
        times = F.when(kind == packet_type, found).otherwise(times)
        name = F.when(kind == packet_type, recorded).otherwise(name)
    return (
        packets.where(kind.isin(*_RANGE_KINDS))
        .select("session_key", name.alias("kind"), F.explode(times).alias("ts_ns"))
        .select("session_key", "kind", day_time("ts_ns").alias("day_ns"))
    )


def session_log_of(packets: DataFrame, decoder: Decoder | None = None) -> DataFrame:
    """The session packets of a log in one shape; see ``operators.sessions``."""
    place = [c for c in sessions.ARRIVAL if c in packets.columns and c != "pkt_offset"]
    envelope = packets.select("pkt_offset", "data_source", "session_key", "type", "content", *place)
    opened, updated, ended = (
        pk.decode_content(envelope, kind, decoder=decoder) for kind in ("NewSession", "SessionInfo", "EndOfSession")
    )
    opened = opened.withColumn(
        "utc_offset", F.make_dt_interval(secs=F.col("utc_offset_seconds").cast("decimal(18,6)"))
    )
    rows = opened.unionByName(updated, allowMissingColumns=True).unionByName(
        ended, allowMissingColumns=True
    )
    return rows.select(
        "pkt_offset",
        *place,
        "type",
        "session_key",
        F.coalesce("content_data_source", "data_source").alias("data_source"),
        F.coalesce("identifier", F.lit("")).alias("identifier"),
        F.col("content_type").alias("session_type"),
        "version",
        "utc_offset",
        "details",
        "assoc_keys",
        "streams",
        "offsets",
        "main_offset",
        "essentials_offset",
    )


def recorded_parameters(packets: DataFrame, formats: DataFrame | None, decoder: Decoder | None = None) -> DataFrame:
    """``session_key, kind, parameter, interval_ns`` of all a log has samples of, errors included.

    Taken from the lists of the blocks, before any sample is exploded; see ``assign_channels``.
    """
    return _parameters_of(_sized_blocks(packets, formats, decoder), error_definitions(_decoded(packets, "Error", decoder)))


def _parameters_of(blocks: Sized, defined_errors: DataFrame) -> DataFrame:
    periodic, rows, synchro = (_fitting(blocks[kind][1]) for kind in LISTS)
    errors = defined_errors.select(
        "session_key", F.lit("Error").alias("kind"), "parameter", F.lit(0).cast("bigint").alias("interval_ns")
    )
    parts = [
        block_parameters(sm.drop_zero_interval(periodic), "Periodic"),
        block_parameters(rows, "Row"),
        block_parameters(synchro, "Synchro"),
        errors,
    ]
    return reduce(DataFrame.unionByName, parts)


def record_session_tables(
    packets: DataFrame,
    formats: DataFrame,
    decoder: Decoder | None = None,
    channels: Callable[[DataFrame], DataFrame] = assign_channels,
) -> dict[str, DataFrame]:
    """The tables of a log, or of a micro-batch of it, by name; rejects included.

    Rows of different batches only ever add up; ``closing_tables`` folds them. Definitions are
    those that the packets bring; names and ids are resolved, and what cannot be is in ``rejects``.
    ``channels`` numbers the recorded parameters: by themselves, or, for micro-batches, in a registry
    that all batches share (``sources.registry.register_channels``).
    """
    def decoded(kind: str) -> DataFrame:
        return _decoded(packets, kind, decoder)

    blocks = _sized_blocks(packets, formats, decoder)
    markers = decoded("Marker").withColumnRenamed("content_type", "type")
    errors = decoded("Error")
    config = dedupe_config(decoded("Configuration"), by=["session_key"])
    sessions_log = session_log_of(packets, decoder)
    defined_errors = error_definitions(errors)
    numbered = channels(_parameters_of(blocks, defined_errors))
    return {
        "samples": _samples_of(blocks),
        "channels": numbered,
        "error_samples": race.error_samples(errors, defined_errors, numbered),
        "lap_triggers": race.lap_triggers(markers).withColumn("day_ns", day_time("ts_ns")),
        "markers": race.point_markers(markers),
        "events": resolve_event(decoded("Event"), formats).where(F.col("event_identifier").isNotNull()),
        "errors": errors,
        "error_definitions": defined_errors,
        "can_frames": sm.can_frames(decoded("RawCANData")),
        "coverage": decoded("CoverageCursorInfo"),
        "metadata": race.metadata_items(decoded("Metadata")),
        "parameter_definitions": parameter_definitions(config),
        "event_definitions": event_definitions(config),
        "group_definitions": group_definitions(config),
        "session_log": sessions_log,
        "details": sessions.session_details(sessions_log),
        "ranges": sessions.session_time_range(time_records_of(packets, decoder)),
        "rejects": _rejects_of(packets, formats, decoder, blocks),
    }


def close_sessions(
    catalog: DataFrame, ranges: DataFrame, lap_triggers: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """(closing records, laps) of recorded sessions, from their stored tables.

    A session without laps gets the default lap at its start.
    """
    folded = ranges.groupBy("session_key").agg(
        F.min("start_ns").alias("start_ns"), F.max("end_ns").alias("end_ns")
    )
    named = laps_of(lap_triggers, folded).select(
        "session_key", "day_ns", "lap_number", "lap_name", "counts"
    )
    summary = sessions.session_summary(catalog, folded, named)
    return summary, named.unionByName(laps.default_lap(folded, lap_triggers))


def closing_tables(stored: Callable[[str], DataFrame]) -> dict[str, DataFrame]:
    """What is known of recorded sessions as a whole, by name, from their stored tables.

    ``stored`` reads a table of ``record_session_tables`` by its name. The catalogue, the current
    details, the ranges, the closing records and the laps have one state each, so they are made when
    a session is complete, from the rows of all batches.
    """
    log = stored("session_log")
    catalog = sessions.session_catalog(log)
    summary, named = close_sessions(catalog, stored("ranges"), stored("lap_triggers"))
    return {
        "catalog": catalog,
        "current_details": sessions.session_details(log),
        "associated": sessions.associated_sessions(log),
        "closing_records": summary,
        "laps": named,
        "channel_list": stored("channels").distinct(),
    }
