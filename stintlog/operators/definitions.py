"""Configuration: parameter, event, group and error definitions, channels, conversions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stintlog.functions.names import event_priority, full_identifier, hex_id, parse_identifier
from stintlog.operators.ordering import number_rows
from stintlog.operators.samples import fits_intervals

# Fixed values.
DEFAULT_CONVERSION = "DefaultConversion"
DEFAULT_CONVERSION_FORMAT = "%5.2f"
CONVERSION_SLOTS = 3


def dedupe_config(config: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Keep the first packet of each config id: a stored configuration is not reprocessed.

    With ``by=["session_key"]`` each session has its own.

    Only ids and places are aggregated; the wide packets are then picked by a semi join whose
    key includes the place, so repeats of one id spread over all tasks. A place is the offset, and
    the stream (and partition) where the packets have them, since streams count for themselves.
    """
    place = [c for c in ("pkt_offset", "stream", "partition") if c in config.columns]
    keys = [*by, "config_id"]
    first = config.groupBy(*keys).agg(F.min(F.struct(*place)).alias("first"))
    return config.join(first.select(*keys, "first.*"), [*keys, *place], "left_semi")


def _carried(config: DataFrame) -> list[str]:
    """Where a definition comes from; the session only where the packets say it."""
    return [*(["session_key"] if "session_key" in config.columns else []), "config_id", "pkt_offset"]


def _conversion_name(conversion: Column) -> Column:
    name = conversion["conversion_identifier"]
    return F.coalesce(F.nullif(name, F.lit("")), F.lit(DEFAULT_CONVERSION))


def parameter_definitions(config: DataFrame) -> DataFrame:
    """One row per parameter of the configuration packets."""
    return config.select(
        *_carried(config), F.explode("parameter_definitions").alias("d")
    ).select(
        *_carried(config),
        "d.identifier",
        "d.name",
        "d.application_name",
        "d.description",
        "d.units",
        "d.format_string",
        "d.min_value",
        "d.max_value",
        "d.warning_min_value",
        "d.warning_max_value",
        _conversion_name(F.col("d.conversion")).alias("conversion"),
    )


def event_definitions(config: DataFrame) -> DataFrame:
    """One row per event of the configuration packets, with its stored priority.

    Each event has three conversion slots; a blank or missing one takes the default.
    """
    slots = F.transform(
        F.sequence(F.lit(0), F.lit(CONVERSION_SLOTS - 1)),
        lambda i: _conversion_name(F.get(F.col("d.conversions"), i)),
    )
    return config.select(
        *_carried(config), F.explode("event_definitions").alias("d")
    ).select(
        *_carried(config),
        "d.identifier",
        "d.definition_id",
        "d.application_name",
        "d.description",
        event_priority("d.priority").alias("priority"),
        slots.alias("conversions"),
    )


def group_definitions(config: DataFrame) -> DataFrame:
    """One row per group of the configuration packets."""
    return config.select(
        *_carried(config), F.explode("group_definitions").alias("d")
    ).select(*_carried(config), "d.identifier", "d.name", "d.application_name")


def application_groups(config: DataFrame) -> DataFrame:
    """Distinct applications of a configuration, over its parameters and events."""
    def names(definitions: str) -> Column:
        return F.coalesce(
            F.transform(definitions, lambda d: d["application_name"]),
            F.array().cast("array<string>"),
        )

    every = F.array_union(names("parameter_definitions"), names("event_definitions"))
    return config.select("config_id", F.explode(every).alias("application")).distinct()


def current_definitions(definitions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One definition per identifier: the one of the latest packet."""
    keys = [*by, "identifier"]
    rest = [c for c in definitions.columns if c not in keys]
    return (
        definitions.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), "pkt_offset").alias("d"))
        .select(*keys, "d.*")
        .select(*definitions.columns)
    )


def missing_parameters(
    samples: DataFrame, definitions: DataFrame, by: Sequence[str] = ()
) -> DataFrame:
    """Parameters (full identifiers) that occur in data but have no definition.

    With ``by=["session_key"]`` a definition holds for its own session only.
    """
    seen = samples.select(*by, full_identifier("parameter").alias("identifier")).distinct()
    known = definitions.select(*by, full_identifier("identifier").alias("identifier")).distinct()
    return seen.join(known, [*by, "identifier"], "left_anti")


def missing_events(
    events: DataFrame, definitions: DataFrame, by: Sequence[str] = ()
) -> DataFrame:
    """Events that occur in data but have no definition."""
    seen = events.select(*by, F.col("event_identifier").alias("identifier")).distinct()
    known = definitions.select(*by, "identifier").distinct()
    return seen.join(known, [*by, "identifier"], "left_anti")


def default_parameter_definitions(missing: DataFrame) -> DataFrame:
    """Definitions for parameters that came without one."""
    parsed = parse_identifier("identifier")
    return missing.select(
        # An identifier of more than two parts stays as it is, or it would still be undefined.
        F.when(F.size(F.split("identifier", ":")) > 2, F.col("identifier"))
        .otherwise(F.concat_ws(":", parsed["name"], parsed["application"]))
        .alias("identifier"),
        parsed["name"].alias("name"),
        parsed["application"].alias("application_name"),
        F.lit("").alias("description"),
        F.lit("").alias("units"),
        F.lit("FLOAT64").alias("data_type"),
        F.lit("6.3f").alias("format_string"),
        F.lit(0.0).alias("min_value"),
        F.lit(100.0).alias("max_value"),
        F.lit(0.0).alias("warning_min_value"),
        F.lit(100.0).alias("warning_max_value"),
        F.lit(DEFAULT_CONVERSION).alias("conversion"),
    )


def default_event_definitions(missing: DataFrame) -> DataFrame:
    """Definitions for events that came without one.

    The id is the hexadecimal name part. ``undefinable_events`` lists the events whose name is not
    hexadecimal, or has more than 32 bits: they cannot be defined.
    """
    parsed = parse_identifier("identifier")
    return missing.where(hex_id(parsed["name"]).isNotNull()).select(
        "identifier",
        hex_id(parsed["name"]).alias("definition_id"),
        parsed["application"].alias("application_name"),
        F.col("identifier").alias("description"),
        F.lit("Low").alias("priority"),
        F.array_repeat(F.lit(DEFAULT_CONVERSION), CONVERSION_SLOTS).alias("conversions"),
    )


def undefinable_events(missing: DataFrame) -> DataFrame:
    """Events without a definition for which none can be made."""
    return missing.where(hex_id(parse_identifier("identifier")["name"]).isNull())


def error_definitions(errors: DataFrame) -> DataFrame:
    """Two parameters, current and logged, per error name of a session.

    The first packet of a name decides its identifier, application and description.
    """
    details = ["error_identifier", "application"]
    if "description" in errors.columns:
        details.append("description")
    # Distinct details first: a repeated error is combined before the shuffle, by hash.
    distinct = errors.groupBy("session_key", "name", *details).agg(
        F.min("pkt_offset").alias("pkt_offset")
    )
    first = distinct.groupBy("session_key", "name").agg(
        F.min_by(F.struct(*details), "pkt_offset").alias("d")
    )
    return first.select(
        "session_key",
        "name",
        F.explode(F.array(F.lit("Current"), F.lit("Logged"))).alias("error_kind"),
        "d.*",
    ).select(
        "session_key",
        "name",
        F.col("application").alias("application_name"),
        "error_kind",
        F.concat("error_kind", "error_identifier").alias("parameter"),
        F.get(F.split(F.concat("error_kind", "error_identifier"), ":"), F.lit(0)).alias("short_name"),
        F.lit("UNSIGNED16").alias("data_type"),
        F.lit(0.0).alias("min_value"),
        F.lit(100.0).alias("max_value"),
        *([F.col("description")] if "description" in details else []),
    )


def _channel_space(kind: Column) -> Column:
    """Row and error parameters share their channels; other kinds have their own."""
    return F.when(kind == "Error", "Row").otherwise(kind)


def _channel_interval(kind: Column) -> Column:
    """Only a periodic channel depends on the interval."""
    return F.when(kind == "Periodic", F.col("interval_ns")).otherwise(F.lit(0)).cast("bigint")


# What a channel belongs to.
CHANNEL_KEYS = ("session_key", "space", "parameter", "channel_interval")


def channel_keys(parameters: DataFrame) -> DataFrame:
    """The distinct keys that need a channel; see ``assign_channels``."""
    return parameters.select(
        "session_key",
        _channel_space(F.col("kind")).alias("space"),
        "parameter",
        _channel_interval(F.col("kind")).alias("channel_interval"),
    ).distinct()


def block_parameters(blocks: DataFrame, kind: str) -> DataFrame:
    """``session_key, kind, parameter, interval_ns`` of what blocks of a kind have samples of.

    Takes blocks with wide lists. Lists of names are made distinct before any name is exploded,
    and samples never are: a block adds a row for its list, however many samples it has.
    """
    if kind == "Row":
        names = F.when(F.exists("rows", lambda row: row.isNotNull()), F.col("params"))
    else:
        sampled = F.filter(F.arrays_zip("params", "columns"), lambda c: _has_samples(kind, c["columns"]))
        names = F.transform(sampled, lambda c: c["params"])
    interval = F.col("interval_ns") if kind == "Periodic" else F.lit(0).cast("bigint")
    lists = blocks.select("session_key", names.alias("names"), interval.alias("interval_ns")).distinct()
    return lists.select("session_key", F.lit(kind).alias("kind"), F.explode("names").alias("parameter"), "interval_ns").distinct()


def _has_samples(kind: str, column: Column) -> Column:
    return column.isNotNull() & fits_intervals(F.size(column), F.size("intervals")) if kind == "Synchro" else column.isNotNull()


def new_channels(parameters: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Channels of parameters that have none yet, numbered after the last one of their session."""
    keys = list(CHANNEL_KEYS)
    text = F.concat_ws("|", "space", "parameter", F.col("channel_interval").cast("string"))
    channels = channel_keys(parameters)
    if known is not None:
        channels = channels.join(known, keys, "left_anti")
    numbered = number_rows(
        channels.withColumn("_md5", F.md5(text.cast("binary"))),
        ["session_key"],
        F.substring("_md5", 1, 2),
        ["_md5"],
        "number",
    )
    if known is None:
        return numbered.select(*keys, F.col("number").alias("channel_id"))
    last = known.groupBy("session_key").agg(F.max("channel_id").alias("_last"))
    following = F.coalesce("_last", F.lit(0)) + F.col("number")
    return numbered.join(last, "session_key", "left").select(*keys, following.alias("channel_id"))


def assign_channels(parameters: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """A channel id, unique in its session, per parameter (and interval, if periodic).

    Takes ``session_key, kind, parameter, interval_ns``, repeats allowed. Channels in ``known``
    (an earlier result) keep their ids, and new ones follow. Ids number the keys by their MD5,
    so they do not depend on arrival, and a large session is numbered in parts. Ids have 64 bits
    and never wrap.
    """
    new = new_channels(parameters, known)
    return new if known is None else known.unionByName(new)


def attach_channels(samples: DataFrame, channels: DataFrame) -> DataFrame:
    """Samples with the channel of their kind's key; samples without a channel are left out."""
    keyed = samples.withColumn("space", _channel_space(F.col("kind"))).withColumn(
        "channel_interval", _channel_interval(F.col("kind"))
    )
    return keyed.join(
        channels, ["session_key", "space", "parameter", "channel_interval"]
    ).select(*samples.columns, "channel_id")


def text_conversion(samples: DataFrame, conversions: DataFrame) -> DataFrame:
    """Add ``text``: the string of the sample's value in its conversion, else its default.

    ``conversions`` has one row per ``conversion_identifier``, with its parallel arrays. A
    sample without such a conversion keeps a null text.
    """
    found = F.get(
        F.col("string_values"),
        (F.array_position("input_values", F.col("value")) - 1).cast("int"),
    )
    return (
        samples.join(conversions, "conversion_identifier", "left")
        .withColumn("text", F.coalesce(found, F.col("default_value")))
        .select(*samples.columns, "text")
    )


def default_conversion(samples: DataFrame) -> DataFrame:
    """Add ``converted`` (1:1) and its display text."""
    return samples.withColumn("converted", F.col("value")).withColumn(
        "text", F.format_string(DEFAULT_CONVERSION_FORMAT, "value")
    )
