"""Laps, markers, events, errors, metadata and coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.blocks import DAY
from checks.configuration import CHANNELS_SQL, _event_definitions, channels
from checks.fixtures import frame, sql, table
from checks.registry import query
from stintlog.operators import definitions, laps as lp, race

MARKERS = sql("markers")
GUARD = 10_000_000_000


def with_source(markers: DataFrame) -> DataFrame:
    return markers.withColumn("source", F.col("trigger_source").cast("string")).drop("trigger_source")


def triggers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return race.lap_triggers(with_source(frame(spark, sf_dir, "markers")))


@query(
    "split_markers",
    f"""
    select pkt_offset, session_key, day_ns, label, cast(trigger_source as smallint) as trigger_source,
      cast(value as smallint) as lap_number, type = 'Lap Trigger' as is_lap
    from (select pkt_offset, session_key, day_ns, label, type,
      case when type = 'Lap Trigger' then trigger_source end as trigger_source,
      case when type = 'Lap Trigger' then value end as value from {MARKERS})
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    laps, points = race.split_markers(with_source(frame(spark, sf_dir, "markers")))
    columns = ["pkt_offset", "session_key", "day_ns", "label", "trigger_source", "lap_number", "is_lap"]
    return (
        laps.withColumn("is_lap", F.lit(True))
        .unionByName(points.withColumn("is_lap", F.lit(False)), allowMissingColumns=True)
        .select(columns)
    )


@query(
    "dedupe_markers",
    f"""
    select session_key, day_ns, label, min(pkt_offset) as pkt_offset
    from (select pkt_offset, session_key, day_ns - day_ns % 60000000000 as day_ns,
      concat('M', value % 3) as label from {MARKERS})
    group by session_key, day_ns, label
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    markers = frame(spark, sf_dir, "markers").selectExpr(
        "pkt_offset",
        "session_key",
        "day_ns - day_ns % 60000000000 as day_ns",
        "concat('M', value % 3) as label",
    )
    return race.dedupe_markers(markers)


LAPS_SQL = (
    "(select pkt_offset, session_key, day_ns, label, cast(trigger_source as smallint) as trigger_source,"
    f" cast(value as smallint) as lap_number from {MARKERS} where type = 'Lap Trigger')"
)
STARTS_SQL = (
    "(select session_key, min(day_ns) + 3600000000000 as start_ns from"
    f" {MARKERS} group by session_key)"
)


def guarded_sql(laps: str) -> str:
    """The guard row by row: each row sees the time of the last kept one."""
    return f"""
    with recursive ordered as (
      select *, row_number() over (partition by session_key order by pkt_offset) as rn from {laps}),
    walked as (
      select session_key, rn, pkt_offset, day_ns as last_ns, true as kept from ordered where rn = 1
      union all
      select o.session_key, o.rn, o.pkt_offset,
        case when o.day_ns - w.last_ns >= {GUARD} then o.day_ns else w.last_ns end,
        o.day_ns - w.last_ns >= {GUARD}
      from walked w join ordered o on o.session_key = w.session_key and o.rn = w.rn + 1)
    select o.* exclude (rn) from ordered o join walked w on o.session_key = w.session_key and o.rn = w.rn
    where w.kept
    """


def named_sql(guarded: str) -> str:
    return f"""
    select * exclude (n0, nm, next_trigger),
      next_trigger is not null and lap_name not in ('Out Lap', 'In Lap', 'Pit Lane') as counts
    from (
      select *, case when next_trigger = 1 and trigger_source = 0 then 'In Lap'
        when next_trigger = 0 and nm = 'Pit Lane' then 'Out Lap' else nm end as lap_name
      from (
        select *, coalesce(n0, case when lag(n0) over w = 'Pit Lane' and trigger_source = 0 then 'Out Lap'
            else label end) as nm, lead(trigger_source) over w as next_trigger
        from (
          select *, case when row_number() over w = 1 then 'Out Lap'
            when trigger_source = 1 then 'Pit Lane' end as n0
          from ({guarded}) window w as (partition by session_key order by pkt_offset))
        window w as (partition by session_key order by pkt_offset)))
    """


GUARDED_SQL = guarded_sql(LAPS_SQL)
NAMED_SQL = named_sql(GUARDED_SQL)


@query("lap_guard", GUARDED_SQL)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lp.lap_guard(triggers(spark, sf_dir))


@query("classify_laps", NAMED_SQL)
def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lp.classify_laps(lp.lap_guard(triggers(spark, sf_dir)))


@query("lap_counts_for_fastest", f"select session_key, pkt_offset, lap_name from ({NAMED_SQL}) where counts")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    counting = lp.lap_counts_for_fastest(classified(spark, sf_dir))
    return counting.select("session_key", "pkt_offset", "lap_name")


def _starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        frame(spark, sf_dir, "markers")
        .groupBy("session_key")
        .agg((F.min("day_ns") + 3_600_000_000_000).alias("start_ns"))
    )


@query(
    "reject_early_laps",
    f"""
    select l.* exclude (rn) from (select *, row_number() over (partition by session_key order by pkt_offset) as rn
      from {LAPS_SQL}) l join {STARTS_SQL} s on s.session_key = l.session_key
    where l.rn = 1 or l.day_ns >= s.start_ns
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lp.reject_early_laps(triggers(spark, sf_dir), _starts(spark, sf_dir))


@query(
    "python_laps",
    f"""
    select session_key, day_ns, min(pkt_offset) as pkt_offset, arg_min(lap_number, pkt_offset) as lap_number,
      arg_min(label, pkt_offset) as lap_name, true as counts
    from (select * replace (day_ns - day_ns % 600000000000 as day_ns) from {LAPS_SQL})
    group by session_key, day_ns
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    coarse = triggers(spark, sf_dir).withColumn("day_ns", F.expr("day_ns - day_ns % 600000000000"))
    return lp.python_laps(coarse)


@query(
    "default_lap",
    f"""
    select concat('S', o_orderkey) as session_key, o_orderkey * 1000 as day_ns, cast(1 as smallint) as lap_number,
      'Out Lap' as lap_name, false as counts
    from orders where concat('S', o_orderkey) not in (select session_key from {LAPS_SQL})
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    sessions = table(spark, sf_dir, "orders").selectExpr(
        "concat('S', o_orderkey) as session_key", "o_orderkey * 1000 as start_ns"
    )
    return lp.default_lap(sessions, triggers(spark, sf_dir))


@query(
    "events",
    f"""
    select pkt_offset, session_key, cast(496 + k % 7 as bigint) as definition_id,
      concat('App', k % 2) as application_name, ts_ns % {DAY} as day_ns, value as first_value,
      cast(k as double) as second_value
    from {sql("events_in")} where k % 7 < 5
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    packets = frame(spark, sf_dir, "events_in").withColumn(
        "raw_values", F.array(F.col("value"), F.col("k").cast("double"))
    )
    stored = race.events(packets, _event_definitions(spark, sf_dir))
    return stored.select(
        "*", F.col("raw_values")[0].alias("first_value"), F.col("raw_values")[1].alias("second_value")
    ).drop("raw_values")


@query(
    "error_samples",
    f"""
    select e.pkt_offset, e.session_key, e.name, ts_ns % {DAY} as day_ns, w.error_kind, w.value,
      concat(w.error_kind, replace(e.name, 'Err', 'E'), ':Ecu') as parameter, c.channel_id
    from {sql("errors")} e
    join (values ('SET', 'CURRENT', 'Logged', 1.0::double), ('SET', 'CURRENT', 'Current', 1.0::double),
      ('CLEARED', 'CURRENT', 'Logged', 1.0::double), ('CLEARED', 'CURRENT', 'Current', 0.0::double),
      ('SET', 'LOGGED', 'Logged', 1.0::double), ('CLEARED', 'LOGGED', 'Current', 0.0::double),
      ('CLEARED', 'LOGGED', 'Logged', 0.0::double)) as w(status, error_type, error_kind, value)
      on w.status = e.status and w.error_type = e.error_type
    join ({CHANNELS_SQL}) c on c.session_key = e.session_key and c.space = 'Row'
      and c.parameter = concat(w.error_kind, replace(e.name, 'Err', 'E'), ':Ecu')
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    errors = frame(spark, sf_dir, "errors")
    return race.error_samples(
        errors, definitions.error_definitions(errors), channels(spark, sf_dir)
    )


@query("reject_errors", f"select pkt_offset, status from {sql('errors')} where status = 'UNSPECIFIED'")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return race.reject_errors(frame(spark, sf_dir, "errors")).select("pkt_offset", "status")


@query(
    "metadata_items",
    f"""
    select pkt_offset, session_key, meta_key as item_key, str_value, dbl_value from {sql("metadata")}
    where str_value is not null or dbl_value is not null
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    packets = frame(spark, sf_dir, "metadata").selectExpr(
        "pkt_offset",
        "session_key",
        "map(meta_key, named_struct('str_value', str_value, 'dbl_value', dbl_value)) as metadata",
    )
    return race.metadata_items(packets)


@query(
    "coverage_cursor",
    f"""
    select session_key, arg_max(ts_ns % {DAY}, pkt_offset) as covered_ns from {sql("coverage")}
    group by session_key
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return race.coverage_cursor(frame(spark, sf_dir, "coverage"))
