"""Sessions and benchmark runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.blocks import DAY
from checks.fixtures import frame, packet_log, sql, table
from checks.racing import NAMED_SQL, classified
from checks.registry import query
from stintlog.functions.names import run_title
from stintlog.operators import metrics, sessions as ss
from stintlog.plans.recording import time_records_of

LOG = sql("session_log")
CATALOG_SQL = f"""
    select session_key, arg_min(data_source, pkt_offset) as data_source,
      coalesce(nullif(arg_max(identifier, case when type = 'SessionInfo' or identifier <> '' then pkt_offset end),
        ''), 'Untitled') as identifier,
      bool_or(type = 'EndOfSession') as is_complete, min(pkt_offset) as first_offset,
      max(pkt_offset) as last_offset
    from {LOG} group by session_key
    """


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ss.session_catalog(frame(spark, sf_dir, "session_log"))


@query("session_catalog", CATALOG_SQL)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog(spark, sf_dir)


@query("sessions_of_source", f"select * from ({CATALOG_SQL}) where data_source = 'DS3'")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ss.sessions_of_source(catalog(spark, sf_dir), "DS3")


@query(
    "live_sessions",
    f"select * from ({CATALOG_SQL}) where data_source = 'DS3' and not is_complete order by first_offset desc",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ss.live_sessions(catalog(spark, sf_dir), "DS3")


@query(
    "latest_live_session",
    f"select * from ({CATALOG_SQL}) where data_source = 'DS3' and not is_complete"
    " order by first_offset desc limit 1",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ss.latest_live_session(catalog(spark, sf_dir), "DS3")


@query(
    "historical_sessions",
    f"""
    select *, row_number() over (partition by data_source order by first_offset) - 1 as session_no
    from ({CATALOG_SQL}) where is_complete
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ss.historical_sessions(catalog(spark, sf_dir))


@query(
    "session_identifier",
    f"""
    select session_key, coalesce(nullif(arg_max(identifier, pkt_offset), ''), 'Untitled') as identifier
    from {sql("info_updates")} group by session_key
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ss.session_identifier(frame(spark, sf_dir, "info_updates"))


_PRICE = "cast(cast(o_totalprice as decimal(18, 2)) as string)"


@query(
    "session_details",
    f"""
    select concat('S', o_orderkey) as session_key, 'Priority' as detail,
      case when o_orderstatus = 'F' then 'late' else o_orderpriority end as value from orders
    union all
    select concat('S', o_orderkey), 'Total', {_PRICE} from orders
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    updates = [
        ("true", 0, "map('Priority', o_orderpriority)"),
        ("true", 1, f"map('Total', {_PRICE})"),
        ("o_orderstatus = 'F'", 2, "map('Priority', 'late')"),
    ]
    first, *rest = [
        orders.where(condition).selectExpr(
            "concat('S', o_orderkey) as session_key", f"o_orderkey * 4 + {step} as pkt_offset", f"{details} as details"
        )
        for condition, step, details in updates
    ]
    for update in rest:
        first = first.unionByName(update)
    return ss.session_details(first)


@query(
    "associated_sessions",
    f"select distinct session_key, assoc_key from {sql('info_updates')} where assoc_key is not null",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = frame(spark, sf_dir, "session_log").withColumn("assoc_keys", F.array("assoc_key"))
    return ss.associated_sessions(log)


@query(
    "session_start_notifications",
    "select o_orderkey * 4 as pkt_offset, 'DS3' as data_source, concat('S', o_orderkey) as session_key"
    " from orders where o_custkey % 10 = 3",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ss.session_start_notifications(frame(spark, sf_dir, "session_log"), "DS3")


@query(
    "session_stop_notifications",
    "select o_orderkey * 4 + 2 as pkt_offset, concat('DS', o_custkey % 10) as data_source,"
    " concat('S', o_orderkey) as session_key from orders where o_orderstatus = 'F'",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ss.session_stop_notifications(frame(spark, sf_dir, "session_log"))


# Only what is recorded: readable content, and no fixed-rate block without an interval. A row
# block has a second row a microsecond after its first.
RANGE_SQL = f"""
    select session_key, min(t % {DAY}) as start_ns, max(t % {DAY}) as end_ns
    from (select session_key, type, k, unnest(case when type = 'RowData' then [ts_ns, ts_ns + 1000] else [ts_ns] end) as t
      from {sql("packets")})
    where k % 31 <> 0 and type in ('PeriodicData', 'RowData', 'SynchroData', 'RawCANData', 'CoverageCursorInfo')
      and not (type = 'PeriodicData' and k % 10 = 0)
    group by session_key
    """


@query("session_time_range", RANGE_SQL)
def ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ss.session_time_range(time_records_of(packet_log(frame(spark, sf_dir, "packets"))))


@query(
    "session_summary",
    f"""
    select c.session_key, c.data_source, c.identifier, c.is_complete, r.start_ns, r.end_ns,
      coalesce(l.n_laps, 1) as n_laps, coalesce(l.n_counting, 0) as n_counting
    from ({CATALOG_SQL}) c left join ({RANGE_SQL}) r using (session_key)
    left join (select session_key, count(*) as n_laps, cast(count(*) filter (counts) as bigint) as n_counting
      from ({NAMED_SQL}) group by session_key) l using (session_key)
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ss.session_summary(
        catalog(spark, sf_dir), ranges(spark, sf_dir), classified(spark, sf_dir)
    )


@query(
    "session_json",
    f"""
    select session_key, concat('{{"session_key":"', session_key, '","data_source":"', data_source,
      '","identifier":"', identifier, '","is_complete":', case when is_complete then 'true' else 'false' end,
      ',"first_offset":', first_offset, ',"last_offset":', last_offset, '}}') as json
    from ({CATALOG_SQL})
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ss.session_json(catalog(spark, sf_dir))


LATENCIES = sql("latencies")
RUNS_SQL = "(select distinct user_id as run_id from events where user_id % 5 <> 0)"
MATCHED_SQL = f"""
    select run_id, run_key, pkt_offset, kind, latency_ms, ts_ns
    from (select *, try_cast(run_key as bigint) as run_id from {LATENCIES})
    where run_id in (select run_id from {RUNS_SQL})
    """


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "events").where("user_id % 5 <> 0")
    return known.select(F.col("user_id").alias("run_id")).distinct()


def matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.match_runs(frame(spark, sf_dir, "latencies"), runs(spark, sf_dir))


@query("match_runs", MATCHED_SQL)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matched(spark, sf_dir)


@query(
    "message_latency",
    """
    select response_id, (max(received_ns) - arg_min(created_ns, position)) / 1e6 as latency_ms
    from (select cast((event_id - event_id % 10) / 10 as bigint) as response_id, 9 - event_id % 10 as position,
      epoch_us(ts) * 1000 as created_ns, epoch_us(ts) * 1000 + user_id * 1000000 as received_ns from events)
    group by response_id
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    created = "unix_micros(cast(ts as timestamp)) * 1000"
    packets = table(spark, sf_dir, "events").selectExpr(
        "event_id div 10 as response_id",
        "9 - event_id % 10 as position",
        f"{created} as created_ns",
        f"{created} + user_id * 1000000 as received_ns",
    )
    return metrics.message_latency(packets)


@query(
    "latency_stats",
    f"""
    select run_id, kind, max(latency_ms) as max_ms,
      round(avg(latency_ms), 9) as avg_ms, min(latency_ms) as min_ms
    from (select *, row_number() over (partition by run_id, kind order by pkt_offset) as rn from ({MATCHED_SQL}))
    where rn > 1 group by run_id, kind
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.latency_stats(matched(spark, sf_dir)).withColumn("avg_ms", F.round("avg_ms", 9))


@query(
    "run_completion",
    f"""
    select run_id, expected_messages, published, received, (to_ns - from_ns) / 1e6 as elapsed_ms,
      received = expected_messages as completed
    from (
      select r.run_id, 40 as expected_messages, count(*) filter (kind = 'publish') as published,
        count(*) filter (kind = 'receive') as received, min(case when kind = 'publish' then ts_ns end) as from_ns,
        max(case when kind = 'receive' then ts_ns end) as to_ns
      from {RUNS_SQL} r left join ({MATCHED_SQL}) m on m.run_id = r.run_id group by r.run_id)
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = runs(spark, sf_dir).withColumn("expected_messages", F.lit(40))
    messages = matched(spark, sf_dir).withColumn("n_messages", F.lit(1))
    return metrics.run_completion(expected, messages)


_THROUGHPUT = ["run_id", "floor_mib", "floor_mib_per_s", "mib_per_s"]


@query(
    "run_throughput",
    """
    select run_id, total // 1024 // 1024 as floor_mib,
      cast(total // 1024 // 1024 as double) / (elapsed_ms / 1000) as floor_mib_per_s,
      cast(total as double) / 1048576 / (elapsed_ms / 1000) as mib_per_s
    from (select o_orderkey as run_id, (o_orderkey * 1000 + 1) * (130 + o_custkey % 100) as total,
      o_totalprice as elapsed_ms from orders)
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    finished = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as run_id",
        "o_orderkey * 1000 + 1 as expected_messages",
        "130 + o_custkey % 100 as message_size",
        "o_totalprice as elapsed_ms",
    )
    return metrics.run_throughput(finished).select(*_THROUGHPUT)


@query(
    "run_title",
    """
    select o_orderkey as run_id, concat('Id:', o_orderkey, '-(DS', o_custkey % 10, ':Stream1[S', o_custkey, '])->',
      case when o_orderstatus = 'F' then 'completed' else 'running' end) as title
    from orders
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    all_runs = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as run_id",
        "concat('DS', o_custkey % 10) as data_source",
        "'Stream1' as stream",
        "concat('S', o_custkey) as session_key",
        "o_orderstatus = 'F' as completed",
    )
    return all_runs.select(
        "run_id", run_title("run_id", "data_source", "stream", "session_key", "completed").alias("title")
    )
