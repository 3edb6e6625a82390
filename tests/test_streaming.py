"""Streams over several files give what the batch operators give."""

from __future__ import annotations

import os
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import Window, functions as F, types as T

from checks.fixtures import formats, frame, packet_log
from stintlog.operators import sessions as ss
from stintlog.plans import recording
from stintlog.session import shared_dir
from stintlog.sources import packet_log as log, session_tables
from stintlog.streaming import recorder

SF = "/root/testdata/sf0.001"


class Feed:
    """A folder of Parquet files, streamed one file per micro-batch in the order written."""

    def __init__(self, spark, folder, schema):
        self.spark, self.folder, self.schema, self.count = spark, folder, schema, 0

    def add(self, df):
        path = self.folder / f"part-{self.count:03}.parquet"
        pq.write_table(df.toArrow(), path)
        os.utime(path, (1_700_000_000 + self.count, 1_700_000_000 + self.count))
        self.count += 1

    def stream(self):
        return (
            self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(str(self.folder))
        )


def feed(spark, folder, df, parts, shuffled=False):
    folder.mkdir(exist_ok=True)
    cut = df.withColumn("_part", F.ntile(parts).over(Window.orderBy("pkt_offset")))
    cut = cut.persist()
    order = list(range(1, parts + 1))
    if shuffled:
        random.Random(4).shuffle(order)
    source = Feed(spark, folder, df.schema)
    for part in order:
        source.add(cut.where(F.col("_part") == part).drop("_part"))
    cut.unpersist()
    return source


def run(stream, spark, name, mode="append", checkpoint=None, path=None):
    path, checkpoint = path or shared_dir(spark, name), checkpoint or shared_dir(spark, "checkpoint")
    recorder.stream_tables(stream, lambda b: {name: b}, path, checkpoint, output_mode=mode).awaitTermination()
    return session_tables.load_table(spark, path, name).drop(*session_tables.LAYOUT)


def same(a, b):
    """The same rows; maps compare by their entries."""
    maps = {f.name for f in a.schema if isinstance(f.dataType, T.MapType)}
    columns = [F.array_sort(F.map_entries(c)).alias(c) if c in maps else F.col(c) for c in a.columns]
    a, b = a.select(columns), b.select(columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_samples_in_any_file_order(spark, tmp_path):
    packets = packet_log(frame(spark, SF, "packets"))
    source = feed(spark, tmp_path / "in", packets, 5, shuffled=True)
    path, checkpoint = shared_dir(spark, "samples"), shared_dir(spark, "checkpoint")
    want = recording.samples_of(packets, formats(spark))
    for _ in range(2):  # the second run finds nothing new
        recorder.stream_samples(source.stream(), formats(spark), path, checkpoint).awaitTermination()
        assert same(want, session_tables.load_table(spark, path, "samples"))


SAMPLE = "pkt_offset bigint, session_key string, parameter string, ts_ns bigint"
DEFINITION = "session_key string, parameter string, defined_ns bigint"
SECOND = 10**9


def test_held_samples_are_replayed_once(spark, tmp_path):
    samples = [(i, "A", f"p{i % 3}", i * SECOND) for i in range(60)]
    for name in ("samples", "definitions"):
        (tmp_path / name).mkdir()
    data = Feed(spark, tmp_path / "samples", spark.createDataFrame([], SAMPLE).schema)
    defs = Feed(spark, tmp_path / "definitions", spark.createDataFrame([], DEFINITION).schema)
    data.add(spark.createDataFrame(samples[:30], SAMPLE))
    data.add(spark.createDataFrame(samples[30:50], SAMPLE))
    defs.add(spark.createDataFrame([("B", "p0", 0)], DEFINITION))
    path, checkpoint = shared_dir(spark, "held"), shared_dir(spark, "checkpoint")

    def go():
        held = recorder.hold_and_replay(data.stream(), defs.stream())
        return sorted(r.pkt_offset for r in run(held, spark, "held", checkpoint=checkpoint, path=path).collect())

    recorder.stream_tables(
        recorder.hold_and_replay(data.stream(), defs.stream()), lambda b: {"held": b}, path, checkpoint
    ).awaitTermination()
    defs.add(spark.createDataFrame([("A", "p0", 0), ("A", "p0", 5)], DEFINITION))
    data.add(spark.createDataFrame(samples[50:], SAMPLE))
    assert go() == [i for i in range(60) if i % 3 == 0]
    defs.add(spark.createDataFrame([("A", "p1", 9), ("A", "p0", 9)], DEFINITION))
    assert go() == [i for i in range(60) if i % 3 != 2]
    batch = recorder.hold_and_replay(
        spark.createDataFrame(samples, SAMPLE),
        spark.createDataFrame([("A", "p0", 0), ("A", "p0", 5), ("A", "p1", 9)], DEFINITION),
    )
    assert sorted(r.pkt_offset for r in batch.collect()) == [i for i in range(60) if i % 3 != 2]


def test_samples_given_up_after_the_time_limit(spark, tmp_path):
    for name in ("samples", "definitions"):
        (tmp_path / name).mkdir()
    data = Feed(spark, tmp_path / "samples", spark.createDataFrame([], SAMPLE).schema)
    defs = Feed(spark, tmp_path / "definitions", spark.createDataFrame([], DEFINITION).schema)
    start = 1_700_000_000 * SECOND
    data.add(spark.createDataFrame([(0, "A", "p", start), (1, "A", "q", start)], SAMPLE))
    defs.add(spark.createDataFrame([("A", "p", start + 5 * SECOND)], DEFINITION))
    for step in range(1, 4):  # time passes on both sides
        later = start + step * 1000 * SECOND
        data.add(spark.createDataFrame([(10 + step, "A", "p", later)], SAMPLE))
        defs.add(spark.createDataFrame([("B", f"x{step}", later)], DEFINITION))
    held = recorder.hold_and_replay(data.stream(), defs.stream(), ttl="10 seconds", how="left")
    rows = {r.pkt_offset: r.defined for r in run(held, spark, "held").collect()}
    assert rows[0] is True and rows[1] is None and rows[11] is True


def test_running_time_range(spark, tmp_path):
    packets = packet_log(frame(spark, SF, "packets"))
    source = feed(spark, tmp_path / "in", packets, 4, shuffled=True)
    updates = run(ss.session_time_range(recording.time_records_of(source.stream())), spark, "ranges", mode="update")
    folded = updates.groupBy("session_key").agg(F.min("start_ns").alias("start_ns"), F.max("end_ns").alias("end_ns"))
    assert same(ss.session_time_range(recording.time_records_of(packets)), folded)


def test_idle_bursts(spark, tmp_path):
    hour = 3600 * SECOND
    packets = frame(spark, SF, "packets").select(
        "pkt_offset", "session_key", F.expr("if(pkt_offset % 50 = 0, 'EndOfSession', type)").alias("type"),
        F.col("ts_ns").alias("submit_ns"), F.timestamp_micros(F.expr("ts_ns div 1000")).alias("submit_time"),
    )
    end = packets.agg(F.max("submit_ns")).first()[0] + 1000 * hour
    source = feed(spark, tmp_path / "in", packets, 4)
    for step in range(2):  # packets of a later session let the last bursts close
        late = spark.createDataFrame(
            [(10**9 + step, "later", "RowData", end + step * 100 * hour)], "pkt_offset bigint, session_key string, type string, submit_ns bigint"
        )
        source.add(late.withColumn("submit_time", F.timestamp_micros(F.expr("submit_ns div 1000"))))
    closed = run(recorder.session_idle_close(source.stream(), "6 hours"), spark, "bursts").where("session_key <> 'later'")
    want = recorder.idle_bursts(packets, 6 * hour)
    assert same(want.drop("is_last"), closed)
    assert same(recorder.session_close_times(packets, 6 * hour), recorder.close_times(closed, 6 * hour))
    assert want.where("is_last").count() == packets.select("session_key").distinct().count()


@pytest.mark.parametrize("notify", [ss.session_start_notifications, ss.session_stop_notifications])
def test_notifications(spark, tmp_path, notify):
    packets = frame(spark, SF, "session_log")
    source = feed(spark, tmp_path / "in", packets, 3, shuffled=True)
    assert same(notify(packets, "DS3"), run(notify(source.stream(), "DS3"), spark, "notes"))


def test_replay_records_a_session_once(spark):
    archive, path, checkpoint = (shared_dir(spark, n) for n in ("log", "tables", "checkpoint"))
    packets = packet_log(frame(spark, SF, "packets"))
    log.write_packets(packets, archive)
    for _ in range(2):
        recorder.replay_history(spark, archive, "S3", formats(spark), path, checkpoint)
    one = packets.where("session_key = 'S3'")
    for name, want in recording.record_session_tables(one, formats(spark)).items():
        got = session_tables.load_session(spark, path, name, "S3")
        assert same(want, got), name


def test_log_stream(spark, tmp_path):
    packets = packet_log(frame(spark, SF, "packets"))
    source = feed(spark, tmp_path / "in", packets, 3)
    path = shared_dir(spark, "log")
    log.stream_packets_to(source.stream(), path, shared_dir(spark, "checkpoint")).awaitTermination()
    assert same(packets, log.read_packets(spark, path))
