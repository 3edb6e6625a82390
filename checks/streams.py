"""Streaming queries: each drains a stream over the given tables and reads back its sink."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from checks.blocks import SAMPLES_SQL, samples_sql
from checks.catalogue import RANGE_SQL
from checks.fixtures import derive, formats, frame, packet_log, sql, table
from checks.racing import NAMED_SQL, with_source
from checks.registry import query
from stintlog.functions.times import to_timestamp
from stintlog.operators import race, sessions as ss
from stintlog.plans.recording import time_records_of
from stintlog.schemas import LOG
from stintlog.session import shared_dir
from stintlog.sources import packet_log as log, registry, session_tables
from stintlog.streaming import recorder, stateful


def stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packets of the events table as a stream."""
    schema = table(spark, sf_dir, "events").schema
    # A stream reads folders or globs; this glob fits a single file and a folder of files.
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/{{events}}.parquet")
    return derive(events, "packets")


def submitted() -> Column:
    """A packet arrives each second."""
    return F.timestamp_seconds(F.lit(1_700_000_000) + F.col("pkt_offset"))


def arriving(packets: DataFrame) -> DataFrame:
    return packets.withColumn("submit_time", submitted())


def later(packets: DataFrame) -> DataFrame:
    """The first packets again, long after the others and of a session that is none of theirs."""
    clock = packets.where("pkt_offset < 10").withColumn("session_key", F.lit("~"))
    clock = clock.withColumn("pkt_offset", F.col("pkt_offset") + 10**8)
    return clock.withColumn("submit_time", submitted()) if "submit_time" in packets.columns else clock


def drained(
    spark: SparkSession, source: DataFrame, name: str, shape: Callable[[DataFrame], DataFrame] | None = None,
    output_mode: str = "append",
) -> DataFrame:
    """Run a stream into a session table until its source is empty, and read the table."""
    path, checkpoint = shared_dir(spark, name), shared_dir(spark, f"{name}-checkpoint")
    recorder.stream_tables(
        source, lambda batch: {name: shape(batch) if shape else batch}, path, checkpoint, output_mode=output_mode
    ).awaitTermination()
    return session_tables.load_table(spark, path, name).drop(*session_tables.LAYOUT)


@query("stream_samples", SAMPLES_SQL)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, checkpoint = shared_dir(spark, "samples"), shared_dir(spark, "samples-checkpoint")
    recorder.stream_samples(
        packet_log(stream(spark, sf_dir)), formats(spark), path, checkpoint
    ).awaitTermination()
    return session_tables.load_table(spark, path, "samples").drop(*session_tables.LAYOUT)


@query(
    "hold_and_replay",
    f"""
    select pkt_offset, session_key, concat('P', k % 10) as parameter, ts_ns, value from {sql("packets")}
    where (session_key, concat('P', k % 10)) in (
      select (session_key, concat('P', k % 10)) from {sql("packets")} where type = 'Event')
      and type = 'PeriodicData'
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    packets = stream(spark, sf_dir)
    samples = packets.where("type = 'PeriodicData'").selectExpr(
        "pkt_offset", "session_key", "concat('P', k % 10) as parameter", "ts_ns", "value"
    )
    definitions = stream(spark, sf_dir).where("type = 'Event'").selectExpr(
        "session_key", "concat('P', k % 10) as parameter", "ts_ns as defined_ns"
    )
    return drained(spark, recorder.hold_and_replay(samples, definitions), "defined_samples").drop("defined")


@query(
    "stream_laps",
    f"""
    select pkt_offset, session_key, day_ns, label, cast(trigger_source as integer) as trigger_source,
      cast(lap_number as integer) as lap_number, lap_name, counts,
      cast(case when pkt_offset = max(pkt_offset) over (partition by session_key) then 0 else 1 end as integer)
        as revision
    from ({NAMED_SQL})
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    packets = arriving(stream(spark, sf_dir))
    markers = derive(packets, "markers").withColumn("submit_time", submitted())
    triggers = race.lap_triggers(with_source(markers))
    # Some sessions end on the way; a packet of another one, much later, lets time pass for all.
    ends = packets.where("pkt_offset % 50 = 0").select("session_key", "submit_time")
    named = stateful.session_laps(triggers, ends.unionByName(later(packets).select("session_key", "submit_time")))
    return recorder.latest_laps(drained(spark, named, "laps"))


@query(
    "stream_dedupe_markers",
    f"""
    select distinct session_key, day_ns - day_ns % 60000000000 as day_ns, concat('M', value % 3) as label
    from {sql("markers")}
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    markers = derive(stream(spark, sf_dir), "markers").selectExpr(
        "pkt_offset", "session_key", "day_ns - day_ns % 60000000000 as day_ns", "concat('M', value % 3) as label"
    )
    # A packet a second: the whole table lies within the lateness.
    once = recorder.dedupe_marker_stream(markers.withColumn("submit_time", submitted()), "60 days")
    return drained(spark, once, "markers_once").select("session_key", "day_ns", "label")


@query(
    "stream_discover_streams",
    f"""
    select distinct session_key, concat('Stream', i) as stream,
      case when i = 2 then cast(length(session_key) as bigint) else 0 end as start_offset
    from {sql("packets")}, unnest([1, 2]) as u(i) where pkt_offset % 20 = 0 and (i = 1 or k % 2 = 1)
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every essential packet tells its session's streams again; some tell one more."""
    packets = arriving(stream(spark, sf_dir))
    infos = packets.where("is_essential").selectExpr(
        "session_key", "data_source", "submit_time",
        "if(k % 2 = 1, array('Stream1', 'Stream2'), array('Stream1')) as streams",
        "map(concat(data_source, '.Stream2:0'), cast(length(session_key) as bigint)) as offsets",
    )
    found = stateful.discovered_streams(infos, later(packets).select("session_key", "submit_time"), lateness="60 days")
    return drained(spark, found, "streams").select("session_key", "stream", "start_offset")


_DEFINED = ["vCar:Chassis", "nEngine:StreamAPI", "k:Row", "twice:Row", "rWheel:Chassis"]
_BLOCKS = "('PeriodicData', 'RowData', 'SynchroData')"


@query(
    "live_blocks",
    f"""
    with p as (select *, session_key in (select session_key from {sql("packets")} where type = 'Event') as defined
      from {sql("packets")} where type in {_BLOCKS}),
    d as (select distinct session_key from p where defined)
    select session_key, pkt_offset, parameter as item, cast(null as varchar) as reason, count(*) as n_samples
    from ({samples_sql()}) where parameter not in ('qty:Sales', 'price:Sales') and session_key in (select session_key from d)
    group by session_key, pkt_offset, parameter
    union all
    select session_key, pkt_offset, case when type = 'RowData' then 'k:Row,twice:Row' when type = 'SynchroData'
      then 'rWheel:Chassis' when k % 3 = 2 then 'qty:Sales,price:Sales' when k % 3 = 1
      then 'nEngine:StreamAPI,vCar:Chassis' else 'vCar:Chassis,nEngine:StreamAPI' end, 'parameter not defined', 0
    from p where k % 31 <> 0 and (not defined or type = 'PeriodicData' and k % 3 = 2)
    union all
    select session_key, pkt_offset, null, 'no interval', 0
    from p where k % 31 <> 0 and defined and type = 'PeriodicData' and k % 3 <> 2 and k % 10 = 0
    union all
    select session_key, pkt_offset, null, 'undecodable content', 0 from p where k % 31 = 0
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks whose formats and definitions arrive as streams: samples and rejects account for all."""
    flat = stream(spark, sf_dir)
    packets = packet_log(flat.unionByName(later(flat))).withColumn("submit_time", submitted())
    lists = F.when(F.col("format_id") == 1, F.array(F.lit("nEngine"), F.lit("vCar:Chassis"))).otherwise(
        F.array(F.lit("qty:Sales"), F.lit("price:Sales"))
    )
    # Time passes on all three streams.
    announced = (
        flat.unionByName(later(flat))
        .where("pkt_offset < 6 or session_key = '~'")
        .selectExpr("pkt_offset", "concat('DS', pkt_offset % 3) as data_source", "if(pkt_offset < 6, 1 + pkt_offset div 3, 99) as format_id")
        .withColumn("kind", F.lit("parameter"))
        .withColumn("params", lists)
        .withColumn("submit_time", submitted())
    )
    # Sessions with an event define these parameters, some with every event again.
    told = flat.where("type = 'Event'").select("session_key", "pkt_offset")
    defined = arriving(told.unionByName(later(flat).select("session_key", "pkt_offset")))
    defined = defined.withColumn("parameter", F.explode(F.array(*map(F.lit, _DEFINED))))
    path, checkpoint = shared_dir(spark, "live"), shared_dir(spark, "live-checkpoint")
    recorder.stream_samples(
        packets, announced, path, checkpoint, definitions=defined, wait="1 day", lateness="60 days", salts=2
    ).awaitTermination()
    samples, rejects = (session_tables.load_table(spark, path, t).drop(*session_tables.LAYOUT) for t in ("samples", "rejects"))
    counted = samples.where("session_key <> '~'").groupBy("session_key", "pkt_offset", F.col("parameter").alias("item")).agg(F.count(F.lit(1)).alias("n_samples"))
    lost = rejects.where("session_key <> '~'").select("session_key", "pkt_offset", "item", "reason", F.lit(0).cast("bigint").alias("n_samples"))
    return counted.withColumn("reason", F.lit(None).cast("string")).unionByName(lost)


@query("stream_time_range", RANGE_SQL)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    running = ss.session_time_range(time_records_of(packet_log(stream(spark, sf_dir))))
    updates = drained(spark, running, "ranges", output_mode="update")
    return updates.groupBy("session_key").agg(
        F.min("start_ns").alias("start_ns"), F.max("end_ns").alias("end_ns")
    )


_GAP = 6 * 3600 * 10**9
BURSTS_SQL = f"""
    select session_key, min(ts_ns) as first_ns, max(ts_ns) as last_ns, count(*) as n_packets,
      burst = max(burst) over (partition by session_key) as is_last
    from (
      select session_key, ts_ns, sum(starts) over (partition by session_key order by ts_ns
        rows unbounded preceding) as burst
      from (
        select session_key, ts_ns, case when ts_ns - lag(ts_ns) over (partition by session_key order by ts_ns)
          > {_GAP} then 1 else 0 end as starts
        from {sql("packets")}))
    group by session_key, burst
    """


@query("session_idle_close", BURSTS_SQL)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored log streamed; a packet of another session, much later, ends the last bursts."""
    packets = frame(spark, sf_dir, "packets").withColumn("submit_time", to_timestamp("ts_ns"))
    clock = packets.orderBy("pkt_offset").limit(1).withColumn("session_key", F.lit("~"))
    clock = clock.withColumn("submit_time", F.col("submit_time") + F.expr("interval 10000 days"))
    archive = shared_dir(spark, "log")
    stored = packets.unionByName(clock).withColumn("content", F.lit("{}"))
    log.write_packets(stored.select(*[f.name for f in LOG if f.name in stored.columns]), archive)
    bursts = drained(spark, recorder.session_idle_close(log.read_packets(spark, archive, streaming=True), "6 hours"), "bursts")
    last = bursts.groupBy("session_key").agg(F.max("first_ns").alias("_last"))
    return bursts.join(last, "session_key").select(
        "session_key", "first_ns", "last_ns", "n_packets", (F.col("first_ns") == F.col("_last")).alias("is_last")
    )


@query(
    "session_close_times",
    f"""
    with stops as (select session_key, min(ts_ns) as stop_ns from {sql("packets")}
      where pkt_offset % 50 = 0 group by session_key)
    select b.session_key, s.stop_ns, min(b.last_ns) + {_GAP} as close_ns
    from ({BURSTS_SQL}) b join stops s on s.session_key = b.session_key and b.last_ns >= s.stop_ns
    group by b.session_key, s.stop_ns
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    packets = frame(spark, sf_dir, "packets").selectExpr(
        "session_key",
        "if(pkt_offset % 50 = 0, 'EndOfSession', type) as type",
        "ts_ns as submit_ns",
    )
    return recorder.session_close_times(packets, _GAP)


@query(
    "replay_history",
    f"select pkt_offset, parameter, ts_ns, value, status from ({SAMPLES_SQL}) where session_key = 'S7'",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive, path = shared_dir(spark, "log"), shared_dir(spark, "replayed")
    log.write_packets(packet_log(frame(spark, sf_dir, "packets")), archive)
    recorder.replay_history(spark, archive, "S7", formats(spark), path, shared_dir(spark, "replay-checkpoint"))
    samples = session_tables.load_session(spark, path, "samples", "S7")
    return samples.select("pkt_offset", "parameter", "ts_ns", "value", "status")


@query(
    "register_formats_live",
    """
    select row_number() over (order by min(l_orderkey * 8 + l_linenumber), params) as format_id, params as names
    from (select *, concat('P', l_partkey % 40, ',P', l_suppkey % 7) as params from lineitem) group by params
    """,
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of parameter lists that a stream brings in four parts, and that come once more in another stream."""
    lists = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey * 8 + l_linenumber as pkt_offset", "array(concat('P', l_partkey % 40), concat('P', l_suppkey % 7)) as params"
    )
    arrived, path = shared_dir(spark, "lists"), shared_dir(spark, "formats")
    quarter = F.lit(lists.agg(F.max("pkt_offset").alias("top")).first().top // 4 + 1)

    def read(checkpoint: str, **limit: int) -> None:
        source = spark.readStream.schema(lists.schema).options(**limit).parquet(arrived)
        query = source.writeStream.foreachBatch(
            lambda batch, _: registry.register_formats(spark, path, batch, "parameter") and None
        )
        query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()

    # A part has as many files as tasks wrote it; the stream takes each part, all its files, as one batch.
    first = shared_dir(spark, "lists-checkpoint")
    for number in range(4):
        part = lists.where((F.col("pkt_offset") >= quarter * number) & (F.col("pkt_offset") < quarter * (number + 1)))
        part.write.mode("append").parquet(arrived)
        read(first)
    files = len(spark.read.schema(lists.schema).parquet(arrived).inputFiles())
    read(shared_dir(spark, "lists-checkpoint"), maxFilesPerTrigger=max(1, 3 * files // 4))
    return registry.known_formats(spark, path).select("format_id", F.array_join("params", ",").alias("names"))
