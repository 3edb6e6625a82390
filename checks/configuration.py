"""Definitions, channels and conversions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.blocks import _PERIODIC_SAMPLES, periodic_samples
from checks.fixtures import ROW_PARAMETERS, configuration, conversions, frame, sql, table
from checks.registry import query
from stintlog.functions.names import event_priority
from stintlog.operators import definitions as df

DEFS = sql("parameter_defs")
_CONVERSION = "case when conversion_identifier = '' then 'DefaultConversion' else conversion_identifier end"


@query(
    "parameter_definitions",
    f"""
    select config_id, pkt_offset, case when j = 0 then identifier else concat('Q', identifier) end as identifier,
      brand as application_name, units, '5.2f' as format_string, min_value, max_value + j as max_value,
      min_value as warning_min_value, max_value as warning_max_value, {_CONVERSION} as conversion
    from {DEFS}, unnest([0, 1]) as u(j)
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return df.parameter_definitions(configuration(spark, sf_dir)).drop("name", "description")


@query(
    "event_definitions",
    f"""
    select config_id, pkt_offset, concat('1F', size, ':', brand) as identifier,
      pkt_offset + 100 as definition_id, concat('Ev', brand) as application_name, name as description,
      case priority when 'CRITICAL' then 'High' when 'HIGH' then 'High' when 'MEDIUM' then 'Medium'
        when 'DEBUG' then 'Debug' else 'Low' end as priority,
      concat({_CONVERSION}, ',DefaultConversion,DefaultConversion') as conversions
    from {DEFS}
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return df.event_definitions(configuration(spark, sf_dir)).withColumn(
        "conversions", F.array_join("conversions", ",")
    )


@query(
    "event_priority",
    f"""
    select pkt_offset, priority, case priority when 'CRITICAL' then 'High' when 'HIGH' then 'High'
      when 'MEDIUM' then 'Medium' when 'DEBUG' then 'Debug' else 'Low' end as stored
    from {DEFS}
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, sf_dir, "parameter_defs").select(
        "pkt_offset", "priority", event_priority("priority").alias("stored")
    )


@query(
    "application_groups",
    f"select config_id, brand as application from {DEFS} union"
    f" select config_id, concat('Ev', brand) from {DEFS}",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return df.application_groups(configuration(spark, sf_dir))


@query(
    "group_definitions",
    f"""
    select config_id, pkt_offset, concat('G', size) as identifier, units as name, brand as application_name
    from {DEFS}
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return df.group_definitions(configuration(spark, sf_dir))


@query(
    "dedupe_config",
    f"""
    select config_id, pkt_offset, identifier as first_identifier from {DEFS}
    where (config_id, pkt_offset) in (select (config_id, min(pkt_offset)) from {DEFS} group by config_id)
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return df.dedupe_config(configuration(spark, sf_dir)).select(
        "config_id", "pkt_offset", F.col("parameter_definitions")[0]["identifier"].alias("first_identifier")
    )


_SEEN_SQL = "(select distinct concat('P', l_partkey % 500, ':Brand#11') as identifier from lineitem)"
_KNOWN_SQL = (
    f"(select case when contains(identifier, ':') then identifier else concat(identifier, ':StreamAPI') end from {DEFS})"
)


def _missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = table(spark, sf_dir, "lineitem").selectExpr(
        "concat('P', l_partkey % 500, ':Brand#11') as parameter"
    )
    return df.missing_parameters(seen, frame(spark, sf_dir, "parameter_defs"))


@query("missing_parameters", f"select identifier from {_SEEN_SQL} where identifier not in {_KNOWN_SQL}")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _missing(spark, sf_dir)


_EVENTS = sql("events_in")


def _event_definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Definitions of the events whose number is below 5."""
    known = frame(spark, sf_dir, "events_in").where("k % 7 < 5")
    named = known.select(F.col("event_identifier").alias("identifier")).distinct()
    return df.default_event_definitions(named)


@query("missing_events", f"select distinct event_identifier as identifier from {_EVENTS} where k % 7 >= 5")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return df.missing_events(
        frame(spark, sf_dir, "events_in"), _event_definitions(spark, sf_dir)
    )


@query(
    "default_parameter_definitions",
    f"""
    select identifier, string_split(identifier, ':')[1] as name, 'Brand#11' as application_name,
      '' as description, '' as units, 'FLOAT64' as data_type, '6.3f' as format_string,
      0.0::double as min_value, 100.0::double as max_value, 0.0::double as warning_min_value,
      100.0::double as warning_max_value, 'DefaultConversion' as conversion
    from {_SEEN_SQL} where identifier not in {_KNOWN_SQL}
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return df.default_parameter_definitions(_missing(spark, sf_dir))


@query(
    "default_event_definitions",
    f"""
    select distinct event_identifier as identifier, cast(496 + k % 7 as bigint) as definition_id,
      concat('App', k % 2) as application_name, event_identifier as description, 'Low' as priority,
      'DefaultConversion,DefaultConversion,DefaultConversion' as conversions
    from {_EVENTS} where k % 7 >= 5
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    missing = df.missing_events(
        frame(spark, sf_dir, "events_in"), _event_definitions(spark, sf_dir)
    )
    return df.default_event_definitions(missing).withColumn(
        "conversions", F.array_join("conversions", ",")
    )


_ERRORS = sql("errors")
ERROR_DEFS_SQL = f"""
    select session_key, name, 'Ecu' as application_name, error_kind,
      concat(error_kind, replace(name, 'Err', 'E'), ':Ecu') as parameter,
      concat(error_kind, replace(name, 'Err', 'E')) as short_name, 'UNSIGNED16' as data_type,
      0.0::double as min_value, 100.0::double as max_value
    from (select distinct session_key, name from {_ERRORS}), unnest(['Current', 'Logged']) as u(error_kind)
    """


@query("error_definitions", ERROR_DEFS_SQL)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return df.error_definitions(frame(spark, sf_dir, "errors"))


# Parameters of all kinds: fixed-rate, row, variable-rate and error ones.
PARAMETERS_SQL = f"""
    select session_key, 'Periodic' as space, case when j = 0 then 'vCar:Chassis' else 'nEngine' end as parameter,
      interval_ns as channel_interval from {sql("periodic")}, unnest([0, 1]) as v(j)
    union
    select concat('S', l_suppkey), 'Row', unnest(['qty:Sales', 'price:Sales', 'disc:Sales', 'tax']), 0 from lineitem
    union
    select session_key, 'Synchro', 'rWheel:Chassis', 0 from {sql("synchro")}
    union
    select session_key, 'Row', parameter, 0 from ({ERROR_DEFS_SQL})
    """
CHANNELS_SQL = f"""
    select session_key, space, parameter, channel_interval, row_number() over (partition by session_key
      order by md5(concat(space, '|', parameter, '|', channel_interval))) % 2147483647 as channel_id
    from ({PARAMETERS_SQL})
    """


def channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    parts = [
        periodic_samples(spark, sf_dir).withColumn("kind", F.lit("Periodic")),
        frame(spark, sf_dir, "rows").select(
            "session_key",
            F.explode(F.array(*map(F.lit, ROW_PARAMETERS))).alias("parameter"),
            F.lit("Row").alias("kind"),
            zero.alias("interval_ns"),
        ),
        frame(spark, sf_dir, "synchro").select(
            "session_key",
            F.lit("rWheel:Chassis").alias("parameter"),
            F.lit("Synchro").alias("kind"),
            zero.alias("interval_ns"),
        ),
        df.error_definitions(frame(spark, sf_dir, "errors")).select(
            "session_key", "parameter", F.lit("Error").alias("kind"), zero.alias("interval_ns")
        ),
    ]
    columns = ["session_key", "kind", "parameter", "interval_ns"]
    return df.assign_channels(reduce(DataFrame.unionByName, [p.select(columns) for p in parts]))


@query("assign_channels", CHANNELS_SQL)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return channels(spark, sf_dir)


@query(
    "attach_channels",
    f"""
    select s.*, c.channel_id from ({_PERIODIC_SAMPLES}) s join ({CHANNELS_SQL}) c
      on c.session_key = s.session_key and c.space = 'Periodic' and c.parameter = s.parameter
      and c.channel_interval = s.interval_ns
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = periodic_samples(spark, sf_dir).withColumn("kind", F.lit("Periodic"))
    return df.attach_channels(samples, channels(spark, sf_dir)).drop("kind")


@query(
    "text_conversion",
    """
    select pkt_offset, row_no, value, case when conversion_identifier <> '' then
      case value when 0 then 'Neutral' when 1 then 'First' when 2 then 'Second' else 'Unknown' end end as text
    from (select l_orderkey as pkt_offset, l_linenumber as row_no, cast(l_linenumber - 1 as double) as value,
      case when l_partkey % 5 = 0 then 'conv_gear' else '' end as conversion_identifier from lineitem)
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey as pkt_offset",
        "l_linenumber as row_no",
        "cast(l_linenumber - 1 as double) as value",
        "if(l_partkey % 5 = 0, 'conv_gear', '') as conversion_identifier",
    )
    return df.text_conversion(samples, conversions(spark)).drop("conversion_identifier")


@query(
    "default_conversion",
    f"select pkt_offset, value as converted, printf('%5.2f', value) as text from {sql('packets')}",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    converted = df.default_conversion(frame(spark, sf_dir, "packets"))
    return converted.select("pkt_offset", "converted", "text")
