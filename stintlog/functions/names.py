"""Names: packet types, identifiers, priorities, run titles."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from stintlog.functions.times import as_column

# Fixed values.
DEFAULT_APPLICATION = "StreamAPI"
UNTITLED = "Untitled"


def packet_type_name(class_name: Column | str) -> Column:
    """Packet type of a message class: the class name without a trailing ``Packet``."""
    return F.regexp_replace(as_column(class_name), "Packet$", "")


def parse_identifier(identifier: Column | str) -> Column:
    """``name:application`` as a struct.

    Only a two-part identifier names its application; any other gets the default one.
    """
    parts = F.split(as_column(identifier), ":")
    application = F.when(F.size(parts) == 2, F.get(parts, F.lit(1))).otherwise(DEFAULT_APPLICATION)
    return F.struct(F.get(parts, F.lit(0)).alias("name"), application.alias("application"))


def full_identifier(identifier: Column | str) -> Column:
    """The identifier with the default application added when it has none."""
    identifier = as_column(identifier)
    return F.when(
        F.contains(identifier, F.lit(":")), identifier
    ).otherwise(F.concat(identifier, F.lit(f":{DEFAULT_APPLICATION}")))


def event_priority(priority: Column | str) -> Column:
    """Stored priority: there is no critical level and no unspecified one."""
    priority = as_column(priority)
    return (
        F.when(priority.isin("CRITICAL", "HIGH"), "High")
        .when(priority == "MEDIUM", "Medium")
        .when(priority == "DEBUG", "Debug")
        .when(priority.isin("LOW", "UNSPECIFIED"), "Low")
    )


def hex_id(name: Column | str) -> Column:
    """The number a hexadecimal name stands for; null when it is not one of at most 32 bits."""
    name = as_column(name)
    return F.when(name.rlike("^[0-9A-Fa-f]{1,8}$"), F.conv(name, 16, 10).cast("bigint"))


def title_or_untitled(identifier: Column | str) -> Column:
    return F.coalesce(F.nullif(as_column(identifier), F.lit("")), F.lit(UNTITLED))


def run_title(run_id: str, data_source: str, stream: str, session_key: str, completed: str) -> Column:
    """One-line title of a benchmark run, from the names of its columns."""
    state = F.when(F.col(completed), "completed").otherwise("running")
    return F.format_string(
        "Id:%s-(%s:%s[%s])->%s",
        F.col(run_id).cast("string"),
        F.col(data_source),
        F.col(stream),
        F.col(session_key),
        state,
    )
