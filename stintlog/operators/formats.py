"""Data formats: an id stands for an ordered parameter list or for an event name; 0 is unset.

Lookups carry no broadcast hint: Spark broadcasts a side whose size it knows to be under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise sort-merges, splitting hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stintlog.operators.ordering import BUCKET_SPAN, number_rows
from stintlog.functions.times import int_div

# Join keys that packets without a format id are spread over.
INLINE_KEYS = 4096


def list_formats(packets: DataFrame) -> DataFrame:
    """Format definitions of the essentials log (decoded ``DataFormatDefinition`` packets).

    An event name wins over a list; ``text`` joins the names with commas.
    """
    names = F.when(F.col("event_identifier").isNotNull(), F.array("event_identifier")).otherwise(
        F.coalesce(F.col("params"), F.array().cast("array<string>"))
    )
    return (
        packets.where(F.col("type") == "DataFormatDefinition")
        .select("format_id", "kind", names.alias("names"))
        .withColumn("text", F.array_join("names", ","))
    )


def _resolve(
    packets: DataFrame, formats: DataFrame, kind: str, column: str, by: Sequence[str]
) -> DataFrame:
    dimension = formats.where((F.col("kind") == kind) & (F.col("format_id") != 0)).select(
        *by, F.col("format_id").alias("_id"), F.col(column).alias("_found")
    )
    # A format may be announced more than once; an id never changes its meaning.
    dimension = dimension.dropDuplicates([*by, "_id"])
    # Packets with an inline name match no format. Ids are not negative, so negative keys keep
    # such packets apart instead of gathering them all under id 0.
    spread = -1 - F.pmod("pkt_offset", F.lit(INLINE_KEYS))
    keyed = packets.withColumn(
        "_id", F.when(F.col("format_id") != 0, F.col("format_id")).otherwise(spread)
    )
    resolved = F.when(F.col("format_id") != 0, F.col("_found")).otherwise(F.col(column))
    return (
        keyed.join(dimension, [*by, "_id"], "left")
        .withColumn(column, resolved)
        .select(*packets.columns)
    )


def resolve_parameter_list(
    packets: DataFrame, formats: DataFrame, by: Sequence[str] = ()
) -> DataFrame:
    """Replace ``params`` by the list of a non-zero format id; null when the id is unknown.

    Where ids are only unique per data source, pass ``by=["data_source"]``.
    """
    return _resolve(packets, formats, "parameter", "params", by)


def resolve_event(packets: DataFrame, formats: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Replace ``event_identifier`` by the name of a non-zero format id; null when unknown."""
    return _resolve(packets, formats, "event", "event_identifier", by)


def _register(
    seen: DataFrame, formats: DataFrame, kind: str, key: str, by: Sequence[str]
) -> DataFrame:
    by = list(by)
    known = formats.where(F.col("kind") == kind).select(*by, "format_id", key)
    new = (
        seen.groupBy(*by, key)
        .agg(F.min("pkt_offset").alias("first_offset"))
        .join(known, [*by, key], "left_anti")
    )
    numbered = number_rows(new, by, int_div("first_offset", BUCKET_SPAN), ["first_offset", key])
    if by:
        last = formats.groupBy(*by).agg(F.max("format_id").alias("_last"))
        numbered = numbered.join(last, by, "left")
    else:
        numbered = numbered.withColumn("_last", formats.agg(F.max("format_id")).scalar())
    created = numbered.select(
        *by,
        (F.coalesce("_last", F.lit(0)) + F.col("position")).alias("format_id"),
        key,
        F.lit(True).alias("is_new"),
    )
    return known.withColumn("is_new", F.lit(False)).unionByName(created)


def register_parameter_format(
    lists: DataFrame, formats: DataFrame, by: Sequence[str] = ()
) -> DataFrame:
    """Get or create the id of each parameter list; the order of a list is part of its key.

    New ids are dense, after the largest known one (of the ``by`` columns, if given), in order
    of first appearance.
    """
    return _register(lists.where(F.size("params") > 0), formats, "parameter", "params", by)


def register_event_format(
    events: DataFrame, formats: DataFrame, by: Sequence[str] = ()
) -> DataFrame:
    """Get or create the id of each event name."""
    named = events.where(F.col("event_identifier") != "")
    return _register(named, formats, "event", "event_identifier", by)


def positional_name(params: Column, position: Column) -> Column:
    """Name of value ``position`` (from 0); ``Param{position}`` when the list is too short."""
    return F.coalesce(
        F.get(params, position), F.concat(F.lit("Param"), position.cast("string"))
    )


def positional_names(rows: DataFrame) -> DataFrame:
    """One row per value of a row block's ``row``, named by position."""
    carried = [c for c in rows.columns if c not in ("params", "row")]
    return rows.select(*carried, "params", F.posexplode("row").alias("position", "value")).select(
        *carried,
        "position",
        positional_name(F.col("params"), F.col("position")).alias("name"),
        "value",
    )


def check_arity(packets: DataFrame) -> DataFrame:
    """Add ``arity_error``: why a block's sizes disagree, or null when they agree.

    Column blocks need one column per parameter. Row blocks need one timestamp per row and
    one value per parameter in every row that carries values.
    """
    n_params = F.coalesce(F.size("params"), F.lit(-1))
    if "rows" in packets.columns:
        error = F.when(
            F.size("timestamps") != F.size("rows"), "timestamps do not match rows"
        ).when(
            F.exists("rows", lambda r: r.isNotNull() & (F.size(r) != n_params)),
            "parameters do not match row width",
        )
    else:
        error = F.when(F.size("columns") != n_params, "parameters do not match columns")
    return packets.withColumn(
        "arity_error", F.when(F.col("params").isNull(), "no parameter list").otherwise(error)
    )
