"""Data formats and samples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.fixtures import (
    FORMATS_SQL, ROW_PARAMETERS, faulty_log, formats, frame, on_disk, packet_log, periodic_blocks, row_blocks, sql,
    synchro_blocks, table, typed_row_blocks,
)
from checks.registry import query
from stintlog.functions.times import day_time
from stintlog.operators import formats as fm, samples as sm
from stintlog.plans import recording
from stintlog.session import shared_dir
from stintlog.sources.registry import register_channels

DAY = 86400000000000
PERIODIC, SYNCHRO, ROWS = sql("periodic"), sql("synchro"), sql("rows")
EVENTS_IN = sql("events_in")


@query(
    "resolve_parameter_list",
    f"""
    select b.pkt_offset, case when b.format_id = 0 then 'vCar:Chassis,nEngine' else f.parameters end as names
    from (select pkt_offset, pkt_offset % 4 as format_id from {PERIODIC}) b
    left join {FORMATS_SQL} f on f.format_id = b.format_id and f.kind = 'parameter'
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = periodic_blocks(frame(spark, sf_dir, "periodic")).withColumn(
        "format_id", F.col("pkt_offset") % 4
    )
    resolved = fm.resolve_parameter_list(blocks, formats(spark))
    return resolved.select("pkt_offset", F.array_join("params", ",").alias("names"))


@query(
    "resolve_event",
    f"""
    select e.pkt_offset, case when e.format_id = 0 then e.event_identifier else f.event_identifier end
      as event_identifier
    from {EVENTS_IN} e left join {FORMATS_SQL} f on f.format_id = e.format_id and f.kind = 'event'
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm.resolve_event(_hidden_events(spark, sf_dir), formats(spark)).select(
        "pkt_offset", "event_identifier"
    )


def _hidden_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose inline name is hidden when a format id is set."""
    return frame(spark, sf_dir, "events_in").withColumn(
        "event_identifier", F.when(F.col("format_id") == 0, F.col("event_identifier")).otherwise("")
    )


@query(
    "register_parameter_format",
    f"""
    with seen as (
      select case when l_partkey % 50 = 0 then ['nEngine', 'vCar:Chassis']
          else [concat('P', l_partkey % 40), concat('P', l_suppkey % 7)] end as params,
        min(l_orderkey * 8 + l_linenumber) as first_offset
      from lineitem group by 1),
    known as (select format_id, string_split(parameters, ',') as params from {FORMATS_SQL}
      where kind = 'parameter')
    select format_id, array_to_string(params, ',') as names, false as is_new from known
    union all
    select 16 + row_number() over (order by first_offset, params), array_to_string(params, ','), true
    from seen where params not in (select params from known)
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey * 8 + l_linenumber as pkt_offset",
        "if(l_partkey % 50 = 0, array('nEngine', 'vCar:Chassis'),"
        " array(concat('P', l_partkey % 40), concat('P', l_suppkey % 7))) as params",
    )
    registered = fm.register_parameter_format(lists, formats(spark))
    return registered.select("format_id", F.array_join("params", ",").alias("names"), "is_new")


@query(
    "register_event_format",
    f"""
    with seen as (select event_identifier, min(pkt_offset) as first_offset from {EVENTS_IN} group by 1),
    known as (select format_id, event_identifier from {FORMATS_SQL} where kind = 'event')
    select format_id, event_identifier, false as is_new from known
    union all
    select 16 + row_number() over (order by first_offset, event_identifier), event_identifier, true
    from seen where event_identifier not in (select event_identifier from known)
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm.register_event_format(frame(spark, sf_dir, "events_in"), formats(spark))


@query(
    "list_formats",
    """
    select p_partkey as format_id, case when p_size % 2 = 1 then 'event' else 'parameter' end as kind,
      case when p_size % 2 = 1 then concat(p_name, ':', p_brand) else concat(p_name, ',', p_brand) end as text
    from part where p_size % 10 <> 0
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    packets = table(spark, sf_dir, "part").selectExpr(
        "if(p_size % 10 = 0, 'Metadata', 'DataFormatDefinition') as type",
        "p_partkey as format_id",
        "if(p_size % 2 = 1, 'event', 'parameter') as kind",
        "array(p_name, p_brand) as params",
        "if(p_size % 2 = 1, concat(p_name, ':', p_brand), null) as event_identifier",
    )
    return fm.list_formats(packets).select("format_id", "kind", "text")


_NAMES_SQL = "['qty:Sales', 'price:Sales', 'disc:Sales', 'tax']"
_VALUES_SQL = "[l_quantity, l_extendedprice, l_discount, l_tax]"


@query(
    "positional_names",
    f"""
    select pkt_offset, row_no, cast(j as int) as position,
      case when j < row_no % 5 then {_NAMES_SQL}[j + 1] else concat('Param', j) end as name,
      {_VALUES_SQL}[j + 1] as value
    from {ROWS}, unnest(range(0, 4)) as u(j)
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frame(spark, sf_dir, "rows").selectExpr(
        "pkt_offset",
        "row_no",
        "slice(array(" + ", ".join(f"'{p}'" for p in ROW_PARAMETERS) + "), 1, row_no % 5) as params",
        "array(l_quantity, l_extendedprice, l_discount, l_tax) as row",
    )
    return fm.positional_names(rows)


@query(
    "check_arity",
    f"""
    select pkt_offset, case when pkt_offset % 28 = 0 then 'no parameter list'
      when pkt_offset % 4 = 0 then 'parameters do not match columns' end as arity_error
    from {PERIODIC}
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = periodic_blocks(frame(spark, sf_dir, "periodic")).withColumn(
        "params",
        F.expr("case when pkt_offset % 28 = 0 then null when pkt_offset % 4 = 0 then array('x') else params end"),
    )
    return fm.check_arity(blocks).select("pkt_offset", "arity_error")


@query(
    "check_arity_rows",
    f"""
    select pkt_offset, row_no, case when row_no % 4 = 0 then 'timestamps do not match rows'
      when row_no % 3 = 0 then 'parameters do not match row width' end as arity_error
    from {ROWS}
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = (
        row_blocks(frame(spark, sf_dir, "rows"))
        .withColumn("timestamps", F.expr("if(row_no % 4 = 0, array(1L, 2L), timestamps)"))
        .withColumn("params", F.expr("if(row_no % 3 = 0, slice(params, 1, 3), params)"))
    )
    return fm.check_arity(blocks).select("pkt_offset", "row_no", "arity_error")


_PERIODIC_SAMPLES = f"""
    select pkt_offset, session_key, interval_ns,
      case when j = 0 then 'vCar:Chassis' else 'nEngine' end as parameter,
      start_ns + interval_ns * i as ts_ns, (start_ns + interval_ns * i) % {DAY} as day_ns,
      case when j = 0 then value + 0.5::double * i else value - i end as value,
      case when (pkt_offset + i) % 7 = 0 then 'INVALID' else 'VALID' end as status
    from {PERIODIC}, unnest(range(0, n)) as u(i), unnest([0, 1]) as v(j)
    """
SAMPLE = ["pkt_offset", "session_key", "interval_ns", "parameter", "ts_ns", "day_ns", "value", "status"]


def periodic_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sm.explode_periodic(periodic_blocks(frame(spark, sf_dir, "periodic"))).select(*SAMPLE)


@query("explode_periodic", _PERIODIC_SAMPLES)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_samples(spark, sf_dir)


@query("drop_zero_interval", f"select pkt_offset, interval_ns from {PERIODIC} where interval_ns > 0")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = sm.drop_zero_interval(periodic_blocks(frame(spark, sf_dir, "periodic")))
    return blocks.select("pkt_offset", "interval_ns")


def _row_samples_sql(value: str, condition: str = "true") -> str:
    return f"""
    select pkt_offset, session_key, row_no, {_NAMES_SQL}[j + 1] as parameter,
      pkt_offset * 1000000000 + l_partkey as ts_ns,
      (pkt_offset * 1000000000 + l_partkey) % {DAY} as day_ns, {value} as value, status
    from {ROWS}, unnest(range(0, 4)) as u(j) where {condition}
    """


ROW_SAMPLE = ["pkt_offset", "session_key", "row_no", "parameter", "ts_ns", "day_ns", "value", "status"]


def row_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sm.explode_rows(row_blocks(frame(spark, sf_dir, "rows"))).select(*ROW_SAMPLE)


@query("explode_rows", _row_samples_sql(f"{_VALUES_SQL}[j + 1]"))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_samples(spark, sf_dir)


@query(
    "explode_synchro",
    f"""
    select pkt_offset, session_key, 'rWheel:Chassis' as parameter, start_ns + shift as ts_ns,
      (start_ns + shift) % {DAY} as day_ns, value
    from (
      select pkt_offset, session_key, start_ns, 0 as shift, value from {SYNCHRO}
      union all select pkt_offset, session_key, start_ns, i0, value + 1 from {SYNCHRO}
      union all select pkt_offset, session_key, start_ns, i0 + i1, value + 2 from {SYNCHRO}
      union all select pkt_offset, session_key, start_ns, i0 + i1 + i2, value + 3 from {SYNCHRO})
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = sm.explode_synchro(synchro_blocks(frame(spark, sf_dir, "synchro")))
    return samples.select("pkt_offset", "session_key", "parameter", "ts_ns", "day_ns", "value")


@query(
    "misfit_synchro",
    f"""
    select pkt_offset, 'rWheel:Chassis' as parameter, 4 as n_samples, cast(pkt_offset % 6 as int) as n_intervals
    from {SYNCHRO} where pkt_offset % 6 not in (3, 4)
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = synchro_blocks(frame(spark, sf_dir, "synchro")).withColumn(
        "intervals", F.expr("slice(array(1L, 2L, 3L, 4L, 5L), 1, cast(pkt_offset % 6 as int))")
    )
    return sm.misfit_synchro(blocks).select("pkt_offset", "parameter", "n_samples", "n_intervals")


@query(
    "synchro_delta_scale",
    f"""
    select pkt_offset, g as delta_scale, concat(i0 // g, ',', i1 // g, ',', i2 // g) as scaled
    from (select *, cast(gcd(gcd(i0, i1), i2) as bigint) as g from {SYNCHRO})
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = sm.synchro_delta_scale(synchro_blocks(frame(spark, sf_dir, "synchro")))
    return scaled.select(
        "pkt_offset",
        "delta_scale",
        F.array_join(F.col("scaled").cast("array<string>"), ",").alias("scaled"),
    )


@query(
    "widen_samples",
    _row_samples_sql(
        f"case list_kind when 'double' then {_VALUES_SQL}[j + 1] when 'int' then trunc({_VALUES_SQL}[j + 1])"
        f" else case when {_VALUES_SQL}[j + 1] > 0.04::double then 1.0::double else 0.0::double end end",
        "list_kind <> 'string'",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = sm.widen_samples(typed_row_blocks(frame(spark, sf_dir, "rows")), "rows")
    return sm.explode_rows(blocks).select(*ROW_SAMPLE)


@query(
    "unreadable_lists",
    f"select pkt_offset, row_no, 0 as list_no, 'string' as list_kind from {ROWS} where list_kind = 'string'",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = sm.unreadable_lists(typed_row_blocks(frame(spark, sf_dir, "rows")), "rows")
    return rejects.select("pkt_offset", "row_no", "list_no", "list_kind")


@query(
    "null_invalid_samples",
    f"""
    select pkt_offset, parameter, ts_ns, status <> 'VALID' as is_nan,
      case when status = 'VALID' then value end as valid_value
    from ({_PERIODIC_SAMPLES})
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = sm.null_invalid_samples(periodic_samples(spark, sf_dir))
    return samples.select(
        "pkt_offset",
        "parameter",
        "ts_ns",
        F.isnan("value").alias("is_nan"),
        F.when(~F.isnan("value"), F.col("value")).alias("valid_value"),
    )


@query("day_time", f"select pkt_offset, ts_ns, ts_ns % {DAY} as day_ns from {sql('packets')}")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, sf_dir, "packets").select(
        "pkt_offset", "ts_ns", day_time("ts_ns").alias("day_ns")
    )


@query(
    "can_frames",
    f"""
    select pkt_offset, session_key, can_id, ts_ns % {DAY} as day_ns, cast(bus % 65536 as int) as bus,
      cast(case when can_type = 'TRANSMIT' then 0 else 1 end as smallint) as direction,
      payload_hex, payload_hex = '' as empty_payload
    from {sql('can')}
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = sm.can_frames(
        frame(spark, sf_dir, "can").withColumn("payload", F.unhex("payload_hex")).drop("payload_hex")
    )
    return frames.select(
        "pkt_offset", "session_key", "can_id", "day_ns", "bus", "direction",
        F.hex("payload").alias("payload_hex"), "empty_payload",
    )


def samples_sql() -> str:
    """All samples of ``packet_log``, after decoding, formats and size checks."""
    packets = f"(select * from {sql('packets')} where k % 31 <> 0)"
    interval = "case when k % 10 = 0 then 0 when k % 10 < 6 then 1000000 else 10000000 end"
    status = "case when (pkt_offset + i) % 7 = 0 then 'INVALID' else 'VALID' end"
    first = ["vCar:Chassis", "nEngine", "qty:Sales"]
    second = ["nEngine", "vCar:Chassis", "price:Sales"]
    name = " ".join(
        f"when k % 3 = {f} and j = {j} then '{names[f]}'"
        for f in range(3)
        for j, names in enumerate([first, second])
    )
    return f"""
    select pkt_offset, session_key, case {name} end as parameter, ts_ns + {interval} * i as ts_ns,
      case when j = 0 then value + 0.5::double * i else value - i end as value, {status} as status,
      'Periodic' as kind, cast({interval} as bigint) as interval_ns
    from {packets}, unnest(range(0, pkt_offset % 5 + 1)) as u(i), unnest([0, 1]) as v(j)
    where type = 'PeriodicData' and {interval} > 0
    union all
    select pkt_offset, session_key, case when i = 0 then 'k:Row' else 'twice:Row' end, ts_ns + 1000 * r,
      cast(case when r = 0 then k * (i + 1) else k + i end as double), {status}, 'Row', 0
    from {packets}, unnest([0, 1]) as u(r), unnest([0, 1]) as v(i) where type = 'RowData'
    union all
    select pkt_offset, session_key, 'rWheel:Chassis', ts_ns
      + case when i > 0 then (k % 6 + 1) * 1000 else 0 end + case when i > 1 then (k % 4 + 1) * 3000 else 0 end
      + case when i > 2 then (pkt_offset % 7 + 1) * 500 else 0 end, value + i, {status}, 'Synchro', 0
    from {packets}, unnest(range(0, 4)) as u(i) where type = 'SynchroData'
    """


SAMPLES_SQL = f"select *, ts_ns % {DAY} as day_ns from ({samples_sql()})"


def log_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recording.samples_of(packet_log(frame(spark, sf_dir, "packets")), formats(spark))


@query("samples_of_log", SAMPLES_SQL)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_samples(spark, sf_dir)


@query(
    "sample_report",
    f"""
    select session_key, parameter, count(*) as n_samples, count(v) as n_valid, min(v) as min_value,
      max(v) as max_value, round(avg(v), 9) as mean_value
    from (select *, case when status = 'VALID' then value end as v from ({samples_sql()}))
    group by session_key, parameter
    """,
)
def sample_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Sums of doubles depend on their order, so the comparison rounds; the report does not.
    report = recording.sample_report(log_samples(spark, sf_dir))
    return report.withColumn("mean_value", F.round("mean_value", 9))


# Every rule stands for itself: a packet that cannot be read has no other fault.
REJECTS_SQL = f"""
    with p as (select *, pkt_offset % 47 = 0 or type = 'Mystery' as unknown,
        pkt_offset % 41 = 0 or pkt_offset % 43 = 0 or k % 31 = 0 as undecodable from {sql('packets')}),
      good as (select * from p where not unknown and not undecodable)
    select session_key, pkt_offset, case when pkt_offset % 47 <> 0 then type end as type, cast(null as varchar) as item,
      case when unknown then 'unknown type' else 'undecodable content' end as reason from p where unknown or undecodable
    union all
    select session_key, pkt_offset, type, null,
      case when pkt_offset % 13 = 0 and k % 3 = 1 then 'no parameter list' else 'no interval' end
    from good where type = 'PeriodicData' and ((pkt_offset % 13 = 0 and k % 3 = 1) or k % 10 = 0)
    union all
    select session_key, pkt_offset, type, cast(i as varchar), 'no list of numbers'
    from good, unnest([0, 1]) as u(i) where type = 'RowData' and pkt_offset % 11 = 0
    union all
    select session_key, pkt_offset, type, 'rWheel:Chassis', 'samples do not fit intervals'
    from good where type = 'SynchroData' and pkt_offset % 7 = 0
    union all
    select session_key, pkt_offset, type, null, 'unreadable trigger source'
    from good where type = 'Marker' and k % 5 <> 0 and k % 4 = 0 and pkt_offset % 3 = 0
    union all
    select session_key, pkt_offset, type, concat('Zz', k % 7, ':App'), 'event without a definition or id'
    from good where type = 'Event' and pkt_offset % 17 = 0
    union all
    select session_key, pkt_offset, type, null, 'no channel for status and type'
    from good where type = 'Error' and k % 2 = 0 and pkt_offset % 5 = 0
    """


@query("rejects_of_log", REJECTS_SQL)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recording.rejects_of(on_disk(faulty_log(frame(spark, sf_dir, "packets"))), formats(spark))


_GOOD = f"(select * from {sql('packets')} where k % 31 <> 0)"


def recorded_channels_sql() -> str:
    """Channels of all that ``packet_log`` has samples or errors of."""
    return f"""
    select *, row_number() over (partition by session_key
      order by md5(concat(space, '|', parameter, '|', channel_interval))) as channel_id
    from (select session_key, kind as space, parameter, interval_ns as channel_interval from ({samples_sql()})
      union select session_key, 'Row', concat(kind, 'E', k % 6, ':Ecu'), 0
      from {_GOOD}, unnest(['Current', 'Logged']) as u(kind) where type = 'Error')
    """


@query("recorded_channels", recorded_channels_sql())
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = on_disk(packet_log(frame(spark, sf_dir, "packets")))
    return register_channels(spark, shared_dir(spark, "channels"), recording.recorded_parameters(log, formats(spark)))


@query(
    "recorded_tables",
    f"""
    select 'can_frames' as record, session_key, pkt_offset, cast(pkt_offset as varchar) as detail
      from {_GOOD} where type = 'RawCANData'
    union all select 'coverage', session_key, pkt_offset, cast(ts_ns as varchar) from {_GOOD} where type = 'CoverageCursorInfo'
    union all select 'errors', session_key, pkt_offset, concat('Err', k % 6) from {_GOOD} where type = 'Error'
    union all select 'events', session_key, pkt_offset, concat('1F', k % 7, ':App') from {_GOOD} where type = 'Event'
    union all select 'lap_triggers', session_key, pkt_offset, concat('Lap ', k) from {_GOOD} where type = 'Marker' and k % 5 <> 0
    union all select 'markers', session_key, pkt_offset, concat('Lap ', k) from {_GOOD} where type = 'Marker' and k % 5 = 0
    union all select 'samples', session_key, pkt_offset, concat(parameter, ' ', ts_ns, ' ', status) from ({samples_sql()})
    union all select 'error_definitions', session_key, null, concat(kind, 'E', k % 6, ':Ecu')
      from (select distinct session_key, k % 6 as k from {_GOOD} where type = 'Error'), unnest(['Current', 'Logged']) as u(kind)
    union all select 'channels', session_key, null, concat(space, ' ', parameter, ' ', channel_interval, ' ', channel_id)
      from ({recorded_channels_sql()})
    union all select 'error_samples', e.session_key, e.pkt_offset,
        concat(parameter, ' ', channel_id, ' ', case when w.value then 1 else 0 end, ' ', ts_ns % {DAY})
      from {_GOOD} e join (values (0, 'Logged', true), (0, 'Current', true), (1, 'Logged', true), (1, 'Current', false),
        (2, 'Logged', true), (3, 'Current', false), (3, 'Logged', false)) as w(case_no, kind, value) on w.case_no = k % 4
      join ({recorded_channels_sql()}) c on c.session_key = e.session_key and c.space = 'Row'
        and c.parameter = concat(w.kind, 'E', k % 6, ':Ecu')
      where type = 'Error'
    union all select 'ranges', session_key, null, concat(min(day_ns), ' ', max(day_ns)) from (
      select session_key, ts_ns % {DAY} as day_ns from {_GOOD} where type in ('RowData', 'SynchroData', 'RawCANData',
        'CoverageCursorInfo') or (type = 'PeriodicData' and k % 10 <> 0)
      union all select session_key, (ts_ns + 1000) % {DAY} from {_GOOD} where type = 'RowData') group by session_key
    union all select 'rejects', session_key, pkt_offset, case when type = 'Mystery' then 'unknown type'
        when k % 31 = 0 then 'undecodable content' else 'no interval' end
      from {sql('packets')} where type = 'Mystery' or k % 31 = 0 or (type = 'PeriodicData' and k % 10 = 0)
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = recording.record_session_tables(on_disk(packet_log(frame(spark, sf_dir, "packets"))), formats(spark))
    text = {
        "can_frames": F.col("can_id").cast("string"), "coverage": F.col("ts_ns").cast("string"), "errors": F.col("name"),
        "events": F.col("event_identifier"), "lap_triggers": F.col("label"), "markers": F.col("label"),
        "samples": F.concat_ws(" ", "parameter", F.col("ts_ns").cast("string"), "status"), "error_definitions": F.col("parameter"),
        "channels": F.concat_ws(" ", "space", "parameter", F.col("channel_interval").cast("string"), F.col("channel_id").cast("string")),
        "error_samples": F.concat_ws(" ", "parameter", F.col("channel_id").cast("string"), F.col("value").cast("int").cast("string"), F.col("day_ns").cast("string")),
        "ranges": F.concat_ws(" ", F.col("start_ns").cast("string"), F.col("end_ns").cast("string")), "rejects": F.col("reason"),
    }
    rows = [
        tables[name].select(
            F.lit(name).alias("record"), "session_key",
            (F.col("pkt_offset") if "pkt_offset" in tables[name].columns else F.lit(None).cast("long")).alias("pkt_offset"),
            detail.alias("detail"),
        )
        for name, detail in text.items()
    ]
    return reduce(DataFrame.unionByName, rows)
