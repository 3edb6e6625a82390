"""Sources, sinks, routing and the packet envelope."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.fixtures import PARTITIONS, frame, packet_log, sql, table
from checks.registry import query
from stintlog.functions.names import packet_type_name, parse_identifier
from stintlog.operators import packets as pk, sessions
from stintlog.functions.times import to_timestamp
from stintlog.session import shared_dir
from stintlog.sources import packet_log as log, session_tables

PACKETS = sql("packets")
ENVELOPE = ["pkt_offset", "data_source", "session_key", "stream", "type", "is_essential"]
ENVELOPE_SQL = ", ".join(ENVELOPE)
SPEC = pk.ReadSpec(
    data_source="DS1", streams=("Stream1", "Stream2"), offsets=(0, 100), main_offset=50
)


@query(
    "read_packets",
    f"select {ENVELOPE_SQL} from {PACKETS} where data_source = 'DS1' and (stream = 'Stream1'"
    " or (stream = 'Stream2' and pkt_offset >= 100) or (stream = '' and pkt_offset >= 50))",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pk.select_packets(frame(spark, sf_dir, "packets").select(ENVELOPE), SPEC)


@query("read_essentials", f"select {ENVELOPE_SQL} from {PACKETS} where pkt_offset % 20 = 0")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pk.read_essentials(frame(spark, sf_dir, "packets").select(ENVELOPE))


@query(
    "read_data_packets",
    f"""
    select pkt_offset, type,
      case when type in ('PeriodicData', 'RowData', 'SynchroData') then concat_ws(',',
        case when k % 10 <= 4 then concat('P', k % 10, ':A') end,
        case when k % 7 > 3 then concat('Q', k % 7, ':Debug') end) end as names
    from {PACKETS}
    where (type in ('PeriodicData', 'RowData', 'SynchroData') and (k % 10 <= 4 or k % 7 > 3))
      or (type = 'Event' and k % 7 in (0, 1, 3)) or type = 'Marker'
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    packets = frame(spark, sf_dir, "packets").selectExpr(
        "pkt_offset",
        "type",
        "array(concat('P', k % 10, ':A'), concat('Q', k % 7, ':Debug')) as params",
        "concat('1F', k % 7, ':App') as event_identifier",
    )
    selected = pk.read_data_packets(
        packets,
        include_parameters=["P[0-4]:.*", "Q.*"],
        exclude_parameters=["Q[0-3]:.*"],
        include_events=["1F[0-3]:.*"],
        exclude_events=["1F2.*"],
        include_markers=True,
    )
    return selected.select("pkt_offset", "type", F.array_join("selected", ",").alias("names"))


@query("exclude_main_stream", f"select {ENVELOPE_SQL} from {PACKETS} where pkt_offset % 10 <> 0")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pk.exclude_main_stream(frame(spark, sf_dir, "packets").select(ENVELOPE))


def _sessions_with_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "concat('S', o_orderkey) as session_key",
        "concat('DS', o_custkey % 10) as data_source",
        "slice(array('Stream1', 'Stream2', 'Stream3'), 1, cast(o_orderkey % 3 + 1 as int)) as streams",
        "map_filter(map(concat('DS', o_custkey % 10, '.Stream1:0'), if(o_orderkey % 2 = 0, o_orderkey * 10, null),"
        " concat('DS', o_custkey % 10, '.Stream2:0'), if(o_orderkey % 5 = 0, -1, null)),"
        " (k, v) -> v is not null) as offsets",
    )


OFFSETS_SQL = """
    select concat('S', o_orderkey) as session_key, concat('Stream', i) as stream,
      cast(case when i = 1 and o_orderkey % 2 = 0 then o_orderkey * 10
        when i = 2 and o_orderkey % 5 = 0 then -1 else 0 end as bigint) as start_offset
    from orders, unnest(range(1, o_orderkey % 3 + 2)) as u(i)
    """


@query("resolve_offsets", OFFSETS_SQL)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pk.resolve_offsets(_sessions_with_streams(spark, sf_dir))


@query(
    "discover_streams",
    OFFSETS_SQL + " where not (i = 1 or (i = 2 and o_orderkey % 4 = 0))",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    sessions_now = _sessions_with_streams(spark, sf_dir)
    known = sessions_now.selectExpr(
        "session_key",
        "explode(if(o_orderkey % 4 = 0, array('Stream1', 'Stream2'), array('Stream1'))) as stream",
    )
    return pk.discover_streams(sessions_now, known)


def _routes_sql(own_topic: str, own_partition: str) -> str:
    return f"""
    select pkt_offset, {own_topic} as topic, {own_partition} as topic_partition from {PACKETS}
    union all
    select pkt_offset, data_source, 0 from {PACKETS} where pkt_offset % 20 = 0 and stream <> ''
    union all
    select pkt_offset, concat(data_source, '.essentials'), 0 from {PACKETS} where pkt_offset % 20 = 0
    """


@query(
    "route_packets",
    _routes_sql("data_source", "case stream when 'Stream1' then 1 when 'Stream2' then 2 else 0 end"),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = pk.route_packets(frame(spark, sf_dir, "packets").select(ENVELOPE), "partition", PARTITIONS)
    return routed.select("pkt_offset", "topic", "topic_partition")


@query(
    "route_packets_by_topic",
    _routes_sql("case stream when '' then data_source else concat(data_source, '.', stream) end", "0"),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = pk.route_packets(frame(spark, sf_dir, "packets").select(ENVELOPE), "topic")
    return routed.select("pkt_offset", "topic", "topic_partition")


@query(
    "write_packets",
    f"select {ENVELOPE_SQL}, cast(k as varchar) as content, cast(k % 4 as integer) as partition, ts_ns as submit_ns from {PACKETS}",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "log")
    packets = frame(spark, sf_dir, "packets").select(
        *ENVELOPE,
        F.col("k").cast("string").alias("content"),
        F.expr("cast(k % 4 as int) as partition"),
        to_timestamp("ts_ns").alias("submit_time"),
    )
    log.write_packets(packets, path)
    stored = log.read_packets(spark, path)
    return stored.withColumn("submit_ns", F.unix_micros("submit_time") * 1000).drop("submit_time")


@query(
    "write_info_packets",
    f"select pkt_offset, session_key, type, true as is_essential, 'SYSTEM_STATUS' as info_type from {PACKETS}",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "info")
    packets = frame(spark, sf_dir, "packets").select("pkt_offset", "session_key", "type", "is_essential")
    log.write_info_packets(packets, "SYSTEM_STATUS", path)
    return spark.read.parquet(path)


@query(
    "compact_table",
    f"select session_key, pkt_offset, name, status from {sql('errors')} where session_key in ('S3', 'S7')"
    f" union all select session_key, pkt_offset, 'all', null from {sql('errors')}",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Micro-batches merged twice on the way; the last ones are read beside the clustered part."""
    path = shared_dir(spark, "tables")
    errors = frame(spark, sf_dir, "errors").select("session_key", "pkt_offset", "name", "status")
    for batch in range(6):
        session_tables.write_batch({"errors": errors.where(F.col("pkt_offset") % 6 == batch)}, path, batch)
        if batch in (2, 4):
            session_tables.compact_table(spark, path, "errors")
    every = session_tables.load_table(spark, path, "errors").select(
        "session_key", "pkt_offset", F.lit("all").alias("name"), F.lit(None).cast("string").alias("status")
    )
    parts = [session_tables.load_session(spark, path, "errors", s) for s in ("S3", "S7")]
    return reduce(DataFrame.unionByName, [every, *parts])


@query(
    "write_session_tables",
    f"select 'coverage' as record, session_key, pkt_offset from {sql('coverage')}"
    f" union all select 'errors', session_key, pkt_offset from {sql('errors')}"
    f" union all select 'markers', session_key, pkt_offset from {sql('markers')}",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "tables")
    names = ["coverage", "errors", "markers"]
    session_tables.write_session_tables({n: frame(spark, sf_dir, n) for n in names}, path)
    stored = [
        session_tables.load_table(spark, path, n).select(
            F.lit(n).alias("record"), "session_key", "pkt_offset"
        )
        for n in names
    ]
    return reduce(DataFrame.unionByName, stored)


@query(
    "load_session",
    f"select pkt_offset, session_key, day_ns, label from {sql('markers')} where session_key = 'S7'",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "tables")
    session_tables.write_session_tables({"markers": frame(spark, sf_dir, "markers")}, path)
    stored = session_tables.load_session(spark, path, "markers", "S7")
    return stored.select("pkt_offset", "session_key", "day_ns", "label")


@query(
    "load_first_historical",
    "select concat('S', o_orderkey) as session_key, true as is_complete, o_orderkey * 4 as first_offset,"
    " (select count(*) from orders where o_orderstatus = 'F') > 1 as has_more"
    " from orders where o_orderstatus = 'F' order by o_orderkey limit 1",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = sessions.session_catalog(frame(spark, sf_dir, "session_log"))
    first = sessions.load_first_historical(catalog)
    return first.select("session_key", "is_complete", "first_offset", "has_more")


@query("match_session", f"select {ENVELOPE_SQL} from {PACKETS} where session_key = 'S7'")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pk.match_session(frame(spark, sf_dir, "packets").select(ENVELOPE), "S7")


@query(
    "demux_packets",
    f"select type as record, pkt_offset, session_key from {PACKETS} where type <> 'Mystery'",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = pk.demux_packets(frame(spark, sf_dir, "packets").select(ENVELOPE))
    return reduce(
        DataFrame.unionByName,
        [df.select(F.lit(kind).alias("record"), "pkt_offset", "session_key") for kind, df in kinds.items()],
    )


@query(
    "decode_content",
    f"""
    select pkt_offset, session_key, cast(k % 3 as bigint) as format_id, ts_ns as start_ns,
      cast(case when k % 10 = 0 then 0 when k % 10 < 6 then 1000000 else 10000000 end as bigint) as interval_ns,
      2 as n_columns, cast(pkt_offset % 5 + 1 as int) as n_samples, value as first_value
    from {PACKETS} where type = 'PeriodicData' and k % 31 <> 0
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = pk.decode_content(packet_log(frame(spark, sf_dir, "packets")), "PeriodicData")
    first = F.col("columns")[0]["double_samples"]
    return blocks.select(
        "pkt_offset",
        "session_key",
        "format_id",
        "start_ns",
        "interval_ns",
        F.size("columns").alias("n_columns"),
        F.size(first).alias("n_samples"),
        first[0]["value"].alias("first_value"),
    )


@query(
    "reject_packets",
    f"""
    select pkt_offset, type, case when type = 'Mystery' then 'unknown type' else 'undecodable content' end as reason
    from {PACKETS} where type = 'Mystery' or k % 31 = 0
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = pk.reject_packets(packet_log(frame(spark, sf_dir, "packets")))
    return rejects.select("pkt_offset", "type", "reason")


@query("packet_type_name", f"select pkt_offset, type as type_name from {PACKETS}")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    class_name = F.concat("type", F.lit("Packet"))
    return frame(spark, sf_dir, "packets").select(
        "pkt_offset", packet_type_name(class_name).alias("type_name")
    )


@query(
    "parse_identifier",
    f"""
    select pkt_offset, identifier, string_split(identifier, ':')[1] as name,
      case when len(string_split(identifier, ':')) = 2 then string_split(identifier, ':')[2]
        else 'StreamAPI' end as application
    from (select pkt_offset, case when pkt_offset % 3 = 0 then concat(identifier, ':x') else identifier end
      as identifier from {sql('parameter_defs')})
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = frame(spark, sf_dir, "parameter_defs").selectExpr(
        "pkt_offset", "if(pkt_offset % 3 = 0, concat(identifier, ':x'), identifier) as identifier"
    )
    return names.withColumn("p", parse_identifier("identifier")).select(
        "pkt_offset", "identifier", "p.name", "p.application"
    )


@query(
    "payload_shape",
    "select l_orderkey as pkt_offset, l_linenumber as n_samples, l_linenumber % 5 as n_parameters from lineitem",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey as pkt_offset",
        "sequence(1L, cast(l_linenumber as bigint)) as timestamps",
        "slice(array('a', 'b', 'c', 'd'), 1, l_linenumber % 5) as params",
    )
    return pk.payload_shape(blocks)
