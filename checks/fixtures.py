"""Telemetry inputs derived from the given tables, as SQL both engines understand.

Each flat input is (source, expressions, condition). Nested blocks are built on the Spark
side only; the oracles state the same formulas over flat rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stintlog.session import shared_dir
from stintlog.sources.packet_log import read_packets, write_packets

TABLES = {"events", "orders", "lineitem", "part", "customer"}

_SPARK_US, _DUCK_US = "unix_micros(cast(ts as timestamp))", "epoch_us(ts)"

# Known formats, conversions, stream partitions.
FORMATS = (
    "values (0, 'parameter', 'vCar:Chassis,nEngine', null), (1, 'parameter', 'nEngine,vCar:Chassis', null),"
    " (2, 'parameter', 'qty:Sales,price:Sales', null), (10, 'event', null, '1F0:App0'),"
    " (11, 'event', null, '1F1:App1'), (12, 'event', null, '1F2:App0'), (13, 'event', null, '1F3:App1'),"
    " (14, 'event', null, '1F4:App0'), (15, 'event', null, '1F5:App1'), (16, 'event', null, '1F6:App0')"
)
CONVERSIONS = (
    "values ('conv_gear', 0, 'Neutral', 'Unknown'), ('conv_gear', 1, 'First', 'Unknown'),"
    " ('conv_gear', 2, 'Second', 'Unknown')"
)
PARTITIONS = {"Stream1": 1, "Stream2": 2}

FLAT: dict[str, tuple[str, list[str], str]] = {
    "packets": (
        "events",
        [
            "event_id as pkt_offset",
            "concat('DS', cast(user_id % 3 as string)) as data_source",
            "concat('S', cast(user_id as string)) as session_key",
            "case when event_id % 10 = 0 then ''"
            " else concat('Stream', cast(event_id % 2 + 1 as string)) end as stream",
            "case when event_id % 97 = 0 then 'Mystery'"
            " when event_type = 'view' and event_id % 2 = 0 then 'PeriodicData'"
            " when event_type = 'view' then 'SynchroData'"
            " when event_type = 'click' then 'RowData'"
            " when event_type = 'purchase' then 'Marker'"
            " when event_type = 'signup' then 'Event'"
            " when event_id % 3 = 0 then 'Error'"
            " when event_id % 3 = 1 then 'RawCANData'"
            " else 'CoverageCursorInfo' end as type",
            "event_id % 20 = 0 as is_essential",
            "{US} * 1000 as ts_ns",
            "value",
            "cast(regexp_extract(props, '([0-9]+)', 1) as int) as k",
        ],
        "true",
    ),
    "periodic": (
        "packets",
        [
            "pkt_offset",
            "session_key",
            "ts_ns as start_ns",
            "cast(case when k % 10 = 0 then 0 when k % 10 < 6 then 1000000 else 10000000 end as bigint)"
            " as interval_ns",
            "cast(pkt_offset % 5 + 1 as int) as n",
            "value",
            "cast(k % 3 as bigint) as format_id",
        ],
        "type = 'PeriodicData'",
    ),
    "synchro": (
        "packets",
        [
            "pkt_offset",
            "session_key",
            "ts_ns as start_ns",
            "cast((k % 6 + 1) * 1000 as bigint) as i0",
            "cast((k % 4 + 1) * 3000 as bigint) as i1",
            "(pkt_offset % 7 + 1) * 500 as i2",
            "value",
        ],
        "type = 'SynchroData'",
    ),
    "row_packets": (
        "packets",
        ["pkt_offset", "session_key", "ts_ns", "value", "k"],
        "type = 'RowData'",
    ),
    "rows": (
        "lineitem",
        [
            "l_orderkey as pkt_offset",
            "concat('S', cast(l_suppkey as string)) as session_key",
            "l_linenumber as row_no",
            "l_partkey",
            "l_quantity",
            "l_extendedprice",
            "l_discount",
            "l_tax",
            "case when l_partkey % 11 = 0 then 'INVALID' else 'VALID' end as status",
            "case l_linenumber % 4 when 0 then 'double' when 1 then 'int' when 2 then 'bool'"
            " else 'string' end as list_kind",
        ],
        "true",
    ),
    "can": (
        "packets",
        [
            "pkt_offset",
            "session_key",
            "ts_ns",
            "cast(65530 + k % 20 as bigint) as bus",
            "pkt_offset as can_id",
            "case k % 3 when 0 then 'TRANSMIT' when 1 then 'RECEIVE' else 'UNSPECIFIED' end as can_type",
            "case when k % 9 = 0 then '' else concat('0', cast(k % 10 as string)) end as payload_hex",
        ],
        "type = 'RawCANData'",
    ),
    "markers": (
        "packets",
        [
            "pkt_offset",
            "session_key",
            "cast((ts_ns - 1704067200000000000 - (ts_ns - 1704067200000000000) % 3600) / 3600 as bigint)"
            " as day_ns",
            "case when k % 5 = 0 then 'Note' else 'Lap Trigger' end as type",
            "case when k % 4 = 0 then 1 else 0 end as trigger_source",
            "concat('Lap ', cast(k as string)) as label",
            "k as value",
        ],
        "type = 'Marker'",
    ),
    "events_in": (
        "packets",
        [
            "pkt_offset",
            "session_key",
            "ts_ns",
            "cast(case when k % 2 = 0 then k % 7 + 10 else 0 end as bigint) as format_id",
            "concat('1F', cast(k % 7 as string), ':App', cast(k % 2 as string)) as event_identifier",
            "value",
            "k",
        ],
        "type = 'Event'",
    ),
    "errors": (
        "packets",
        [
            "pkt_offset",
            "session_key",
            "ts_ns",
            "concat('Err', cast(k % 6 as string)) as name",
            "concat('E', cast(k % 6 as string), ':Ecu') as error_identifier",
            "'Ecu' as application",
            "case when k % 4 < 2 then 'CURRENT' else 'LOGGED' end as error_type",
            "case when k % 23 = 0 then 'UNSPECIFIED' when k % 2 = 0 then 'SET' else 'CLEARED' end as status",
        ],
        "type = 'Error'",
    ),
    "coverage": (
        "packets",
        ["pkt_offset", "session_key", "ts_ns"],
        "type = 'CoverageCursorInfo'",
    ),
    "metadata": (
        "customer",
        [
            "c_custkey as pkt_offset",
            "concat('S', cast(c_custkey % 50 as string)) as session_key",
            "case c_custkey % 3 when 0 then 'Segment' when 1 then 'Balance' else 'Flag' end as meta_key",
            "case when c_custkey % 3 = 0 then c_mktsegment end as str_value",
            "case when c_custkey % 3 = 1 then c_acctbal end as dbl_value",
        ],
        "true",
    ),
    "parameter_defs": (
        "part",
        [
            "p_partkey as pkt_offset",
            "concat('C', cast(p_partkey % 50 as string)) as config_id",
            "case when p_size % 7 = 0 then concat('P', cast(p_partkey % 400 as string))"
            " else concat('P', cast(p_partkey % 400 as string), ':', p_brand) end as identifier",
            "p_type as units",
            "p_retailprice as max_value",
            "cast(0 as double) as min_value",
            "case p_size % 6 when 0 then 'CRITICAL' when 1 then 'HIGH' when 2 then 'MEDIUM'"
            " when 3 then 'LOW' when 4 then 'DEBUG' else 'UNSPECIFIED' end as priority",
            "case when p_size % 5 = 0 then 'conv_gear' else '' end as conversion_identifier",
            "p_brand as brand",
            "p_name as name",
            "p_size as size",
        ],
        "true",
    ),
    "new_sessions": (
        "orders",
        [
            "o_orderkey * 4 as pkt_offset",
            "'NewSession' as type",
            "concat('S', cast(o_orderkey as string)) as session_key",
            "concat('DS', cast(o_custkey % 10 as string)) as data_source",
            "'' as identifier",
            "cast(null as string) as assoc_key",
        ],
        "true",
    ),
    "info_updates": (
        "orders",
        [
            "o_orderkey * 4 + 1 as pkt_offset",
            "'SessionInfo' as type",
            "concat('S', cast(o_orderkey as string)) as session_key",
            "concat('DS', cast(o_custkey % 10 as string)) as data_source",
            "case when o_orderkey % 6 = 0 then '' else concat('Run ', o_orderpriority) end as identifier",
            "case when o_orderkey % 4 = 0 then concat('S', cast(o_custkey as string)) end as assoc_key",
        ],
        "o_orderkey % 3 <> 0",
    ),
    "ends": (
        "orders",
        [
            "o_orderkey * 4 + 2 as pkt_offset",
            "'EndOfSession' as type",
            "concat('S', cast(o_orderkey as string)) as session_key",
            "concat('DS', cast(o_custkey % 10 as string)) as data_source",
            "'' as identifier",
            "cast(null as string) as assoc_key",
        ],
        "o_orderstatus = 'F'",
    ),
    "latencies": (
        "events",
        [
            "event_id as pkt_offset",
            "case when cast(regexp_extract(props, '([0-9]+)', 1) as int) % 11 = 0"
            " then concat('x', cast(user_id as string)) else cast(user_id as string) end as run_key",
            "case when event_id % 2 = 0 then 'publish' else 'receive' end as kind",
            "value as latency_ms",
            "{US} * 1000 as ts_ns",
        ],
        "true",
    ),
}
UNIONS = {"session_log": ["new_sessions", "info_updates", "ends"]}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derive(source: DataFrame, name: str) -> DataFrame:
    """Apply a flat input's expressions to its source; works on streams too."""
    _, expressions, condition = FLAT[name]
    return source.where(condition).selectExpr(*[e.replace("{US}", _SPARK_US) for e in expressions])


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name in TABLES:
        return table(spark, sf_dir, name)
    if name in UNIONS:
        first, *rest = [frame(spark, sf_dir, part) for part in UNIONS[name]]
        for part in rest:
            first = first.unionByName(part)
        return first
    return derive(frame(spark, sf_dir, FLAT[name][0]), name)


def sql(name: str) -> str:
    """The same input as a DuckDB sub-select."""
    if name in TABLES:
        return name
    if name in UNIONS:
        return "(" + " union all ".join(f"select * from {sql(part)}" for part in UNIONS[name]) + ")"
    source, expressions, condition = FLAT[name]
    columns = ", ".join(expressions).replace("{US}", _DUCK_US)
    return f"(select {columns} from {sql(source)} as {name}_source where {condition})"


FORMATS_SQL = (
    "(select cast(format_id as bigint) as format_id, kind, parameters, event_identifier"
    f" from ({FORMATS}) as t(format_id, kind, parameters, event_identifier))"
)
CONVERSIONS_SQL = (
    "(select conversion_identifier, cast(input_value as double) as input_value, string_value, default_value"
    f" from ({CONVERSIONS}) as t(conversion_identifier, input_value, string_value, default_value))"
)


def formats(spark: SparkSession) -> DataFrame:
    return spark.sql(f"select * from {FORMATS_SQL}").select(
        "format_id", "kind", F.split("parameters", ",").alias("params"), "event_identifier"
    )


def conversions(spark: SparkSession) -> DataFrame:
    return (
        spark.sql(f"select * from {CONVERSIONS_SQL}")
        .groupBy("conversion_identifier")
        .agg(
            F.array_sort(F.collect_list(F.struct("input_value", "string_value"))).alias("c"),
            F.min("default_value").alias("default_value"),
        )
        .select(
            "conversion_identifier",
            F.col("c.input_value").alias("input_values"),
            F.col("c.string_value").alias("string_values"),
            "default_value",
        )
    )


# Nested blocks. Sample lists are built as text-free expressions over the flat inputs.

_STATUS = "if((pkt_offset + i) % 7 = 0, 'INVALID', 'VALID')"


def _samples(value: str, count: str = "n") -> str:
    return (
        f"transform(sequence(0, {count} - 1), i -> named_struct('value', cast({value} as double),"
        f" 'status', {_STATUS}))"
    )


def _typed(kind: str, expression: str) -> str:
    """A typed list with one kind filled in."""
    element = {"double": "double", "int32": "int", "bool": "boolean", "string": "string"}
    fields = ", ".join(
        f"'{k}_samples', "
        + (expression if k == kind else f"cast(null as array<struct<value: {t}, status: string>>)")
        for k, t in element.items()
    )
    return f"named_struct({fields})"


def periodic_blocks(flat: DataFrame) -> DataFrame:
    """Wide fixed-rate blocks with the inline list."""
    return flat.selectExpr(
        "pkt_offset",
        "session_key",
        "start_ns",
        "interval_ns",
        "format_id",
        "array('vCar:Chassis', 'nEngine') as params",
        f"array({_samples('value + 0.5D * i')}, {_samples('value - i')}) as columns",
    )


def synchro_blocks(flat: DataFrame) -> DataFrame:
    return flat.selectExpr(
        "pkt_offset",
        "session_key",
        "start_ns",
        "array('rWheel:Chassis') as params",
        "array(i0, i1, i2) as intervals",
        "array(transform(sequence(0, 3), i -> named_struct('value', value + i, 'status', 'VALID'))) as columns",
    )


ROW_PARAMETERS = ["qty:Sales", "price:Sales", "disc:Sales", "tax"]
_ROW_VALUES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def row_blocks(flat: DataFrame) -> DataFrame:
    """One wide row per block, all values as doubles."""
    values = ", ".join(f"named_struct('value', {v}, 'status', status)" for v in _ROW_VALUES)
    names = ", ".join(f"'{p}'" for p in ROW_PARAMETERS)
    return flat.selectExpr(
        "pkt_offset",
        "session_key",
        "row_no",
        "cast(0 as bigint) as format_id",
        f"array({names}) as params",
        "array(pkt_offset * 1000000000 + l_partkey) as timestamps",
        f"array(array({values})) as rows",
    )


def typed_row_blocks(flat: DataFrame) -> DataFrame:
    """The same rows with typed lists: double, int, bool or text by line number."""

    def row(kind: str, convert: str) -> str:
        values = ", ".join(
            f"named_struct('value', {convert.format(v)}, 'status', status)" for v in _ROW_VALUES
        )
        return _typed(kind, f"array({values})")

    by_kind = (
        f"case list_kind when 'double' then {row('double', '{}')}"
        f" when 'int' then {row('int32', 'cast({} as int)')}"
        f" when 'bool' then {row('bool', '{} > 0.04D')}"
        f" else {row('string', 'cast({} as string)')} end"
    )
    return flat.withColumn("rows", F.array(F.expr(by_kind))).selectExpr(
        "pkt_offset",
        "session_key",
        "row_no",
        "array(" + ", ".join(f"'{p}'" for p in ROW_PARAMETERS) + ") as params",
        "array(pkt_offset * 1000000000 + l_partkey) as timestamps",
        "rows",
    )


def configuration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configuration packets: one per part, with two parameters, one event and one group."""
    return frame(spark, sf_dir, "parameter_defs").selectExpr(
        "config_id",
        "pkt_offset",
        "transform(sequence(0, 1), j -> named_struct('identifier', if(j = 0, identifier,"
        " concat('Q', identifier)), 'name', name, 'application_name', brand, 'description', '',"
        " 'units', units, 'data_type', 'FLOAT64', 'format_string', '5.2f', 'min_value', min_value,"
        " 'max_value', max_value + j, 'warning_min_value', min_value, 'warning_max_value', max_value,"
        " 'conversion', named_struct('conversion_identifier', conversion_identifier, 'input_values',"
        " array(0.0D), 'string_values', array('Neutral'), 'default_value', 'Unknown')))"
        " as parameter_definitions",
        "array(named_struct('identifier', concat('1F', cast(size as string), ':', brand), 'definition_id',"
        " pkt_offset + 100, 'name', name, 'application_name', concat('Ev', brand), 'description', name,"
        " 'priority', priority, 'conversions', array(named_struct('conversion_identifier',"
        " conversion_identifier, 'input_values', array(0.0D), 'string_values', array('Neutral'),"
        " 'default_value', 'Unknown')))) as event_definitions",
        "array(named_struct('identifier', concat('G', cast(size as string)), 'name', units,"
        " 'application_name', brand)) as group_definitions",
    )


def packet_log(packets: DataFrame) -> DataFrame:
    """The packet log with JSON content; every 31st ``k`` is broken. Works on streams."""
    start = "ts_ns"
    interval = "cast(case when k % 10 = 0 then 0 when k % 10 < 6 then 1000000 else 10000000 end as bigint)"
    status = "if((pkt_offset + i) % 7 = 0, 'INVALID', 'VALID')"

    def listed(kind: str, value: str, count: str) -> str:
        return (
            f"named_struct('{kind}_samples', transform(sequence(0, cast({count} as int) - 1), i ->"
            f" named_struct('value', {value}, 'status', {status})))"
        )

    count = "(pkt_offset % 5 + 1)"
    contents = {
        "PeriodicData": "named_struct('format_id', k % 3, 'params', array('vCar:Chassis', 'nEngine'),"
        f" 'start_ns', {start}, 'interval_ns', {interval}, 'columns',"
        f" array({listed('double', 'value + 0.5D * i', count)}, {listed('double', 'value - i', count)}))",
        "RowData": "named_struct('format_id', 0, 'params', array('k:Row', 'twice:Row'), 'timestamps',"
        f" array({start}, {start} + 1000), 'rows', array({listed('int32', 'k * (i + 1)', '2')},"
        f" {listed('int32', 'k + i', '2')}))",
        "SynchroData": "named_struct('format_id', 0, 'params', array('rWheel:Chassis'), 'start_ns',"
        f" {start}, 'intervals', array((k % 6 + 1) * 1000, (k % 4 + 1) * 3000, (pkt_offset % 7 + 1) * 500),"
        f" 'columns', array({listed('double', 'value + i', '4')}))",
        "Marker": f"named_struct('ts_ns', {start}, 'end_ns', 0, 'type', if(k % 5 = 0, 'Note', 'Lap Trigger'),"
        " 'label', concat('Lap ', cast(k as string)), 'source', if(k % 4 = 0, '1', '0'), 'value', k)",
        "Event": "named_struct('format_id', 0, 'event_identifier', concat('1F', cast(k % 7 as string), ':App'),"
        f" 'ts_ns', {start}, 'raw_values', array(value, cast(k as double)))",
        "Error": f"named_struct('ts_ns', {start}, 'name', concat('Err', cast(k % 6 as string)),"
        " 'error_identifier', concat('E', cast(k % 6 as string), ':Ecu'), 'application', 'Ecu',"
        " 'error_type', if(k % 4 < 2, 'CURRENT', 'LOGGED'), 'status', if(k % 2 = 0, 'SET', 'CLEARED'))",
        "RawCANData": f"named_struct('ts_ns', {start}, 'bus', 65530 + k % 20, 'can_id', pkt_offset,"
        " 'can_type', if(k % 3 = 0, 'TRANSMIT', 'RECEIVE'))",
        "CoverageCursorInfo": f"named_struct('ts_ns', {start})",
    }
    cases = " ".join(f"when '{kind}' then to_json({body})" for kind, body in contents.items())
    return packets.selectExpr(
        "pkt_offset",
        "data_source",
        "session_key",
        "stream",
        "type",
        "is_essential",
        f"if(k % 31 = 0, '{{broken', case type {cases} else '{{}}' end) as content",
    )


def on_disk(packets: DataFrame) -> DataFrame:
    """The log as it is used: written and read back."""
    path = shared_dir(packets.sparkSession, "log")
    write_packets(packets, path)
    return read_packets(packets.sparkSession, path)


def faulty_log(packets: DataFrame) -> DataFrame:
    """``packet_log`` with more faults: see ``REJECTS_SQL`` for which."""
    changes = [
        ("type = 'PeriodicData' and pkt_offset % 13 = 0", '"format_id":1,', '"format_id":99,'),
        ("type = 'RowData' and pkt_offset % 11 = 0", "int32_samples", "string_samples"),
        ("type = 'SynchroData' and pkt_offset % 7 = 0", '"intervals":[', '"intervals":[5,5,'),
        ("type = 'Marker' and pkt_offset % 3 = 0", '"source":"1"', '"source":"x"'),
        ("type = 'Event' and pkt_offset % 17 = 0", '"event_identifier":"1F', '"event_identifier":"Zz'),
        ("type = 'Error' and pkt_offset % 5 = 0", '"status":"SET"', '"status":"NONE"'),
    ]
    content = "content"
    for condition, old, new in changes:
        # A text that no content has where the condition does not hold.
        content = f"replace({content}, if({condition}, '{old}', '?none?'), '{new}')"
    return packet_log(packets).selectExpr(
        "pkt_offset", "data_source", "session_key", "stream", "if(pkt_offset % 47 = 0, null, type) as type", "is_essential",
        f"case when pkt_offset % 41 = 0 then null when pkt_offset % 43 = 0 then ' ' else {content} end as content",
    )
