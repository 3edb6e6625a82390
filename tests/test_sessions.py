from __future__ import annotations

from pyspark.sql import functions as F

from stintlog import session
from stintlog.operators import metrics, sessions as ss
from stintlog.streaming import recorder

LOG = "pkt_offset bigint, type string, session_key string, data_source string, identifier string, assoc_key string"


def log(spark):
    return spark.createDataFrame(
        [(0, "NewSession", "A", "D", "", None), (1, "SessionInfo", "A", "D", "first", "P"), (2, "SessionInfo", "A", "D", "", "P"),
         (3, "NewSession", "B", "D", "named", None), (4, "EndOfSession", "B", "D", "", None), (5, "NewSession", "C", "D", "", None),
         (6, "NewSession", "Z", "E", "", None), (7, "EndOfSession", "Z", "E", "", None)],
        LOG,
    )


def test_catalog(spark):
    rows = ss.session_catalog(log(spark)).orderBy("session_key").collect()
    assert [(r.session_key, r.identifier, r.is_complete, r.first_offset, r.last_offset) for r in rows] == [
        ("A", "Untitled", False, 0, 2), ("B", "named", True, 3, 4), ("C", "Untitled", False, 5, 5), ("Z", "Untitled", True, 6, 7),
    ]


def test_live_and_historical(spark):
    catalog = ss.session_catalog(log(spark))
    assert [r.session_key for r in ss.live_sessions(catalog, "D").collect()] == ["C", "A"]
    assert ss.latest_live_session(catalog, "D").first().session_key == "C"
    numbered = ss.historical_sessions(catalog).collect()
    assert sorted((r.session_key, r.session_no) for r in numbered) == [("B", 0), ("Z", 0)]
    first = ss.load_first_historical(catalog).first()
    assert (first.session_key, first.has_more) == ("B", True)
    assert ss.load_first_historical(catalog.where("not is_complete")).isEmpty()


def test_details_and_associations(spark):
    updates = spark.createDataFrame(
        [("A", 1, {"x": "1", "y": "2"}), ("A", 2, {"x": "3"})], "session_key string, pkt_offset bigint, details map<string, string>"
    )
    assert sorted(tuple(r) for r in ss.session_details(updates).collect()) == [("A", "x", "3"), ("A", "y", "2")]
    assert [tuple(r) for r in ss.associated_sessions(log(spark).withColumn("assoc_keys", F.array("assoc_key"))).collect()] == [("A", "P")]


def test_range_ignores_other_kinds(spark):
    records = spark.createDataFrame([("A", "Row", 5), ("A", "Lap", 1), ("A", "CAN", 9), ("B", "Event", 3)], "session_key string, kind string, day_ns bigint")
    assert [tuple(r) for r in ss.session_time_range(records).collect()] == [("A", 5, 9)]


def test_latency_skips_the_first_record(spark):
    latencies = spark.createDataFrame(
        [(1, "publish", 0, 100.0), (1, "publish", 2, 1.0), (1, "publish", 1, 3.0), (2, "publish", 0, 5.0)],
        "run_id bigint, kind string, pkt_offset bigint, latency_ms double",
    )
    rows = metrics.latency_stats(latencies).collect()
    assert [tuple(r) for r in rows] == [(1, "publish", 3.0, 2.0, 1.0)]


def test_completion(spark):
    runs = spark.createDataFrame([(1, 2), (2, 1)], "run_id bigint, expected_messages int")
    messages = spark.createDataFrame(
        [(1, "publish", 10**6, 2), (1, "receive", 3 * 10**6, 1), (1, "receive", 4 * 10**6, 1)],
        "run_id bigint, kind string, ts_ns bigint, n_messages int",
    )
    rows = metrics.run_completion(runs, messages).orderBy("run_id").collect()
    assert [tuple(r) for r in rows] == [(1, 2, 2, 2, 3.0, True), (2, 1, 0, 0, None, False)]


def test_throughput_does_not_wrap(spark):
    runs = spark.createDataFrame([(100_000_000, 65_535, 2000.0), (1, 1, 0.0)], "expected_messages int, message_size int, elapsed_ms double")
    rows = metrics.run_throughput(runs).orderBy("message_size", ascending=False).collect()
    assert rows[0].floor_mib == 6_553_500_000_000 // 2**20 and rows[0].floor_mib_per_s == rows[0].floor_mib / 2
    assert rows[1].mib_per_s is None


def test_close_after_stop_and_silence(spark):
    second = 10**9
    packets = spark.createDataFrame(
        [("A", "x", 0), ("A", "EndOfSession", 15), ("A", "x", 20), ("A", "x", 30), ("A", "x", 41), ("B", "x", 3)],
        "session_key string, type string, at bigint",
    ).selectExpr("session_key", "type", f"at * {second} as submit_ns")
    closed = recorder.session_close_times(packets).collect()
    assert [(r.session_key, r.stop_ns // second, r.close_ns // second) for r in closed] == [("A", 15, 40)]


def test_shared_folder_never_depends_on_the_master():
    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Session:
        def __init__(self, **conf):
            self.conf = Conf({k.replace("_", "."): v for k, v in conf.items()})

    assert session.shared_dir(Session(spark_checkpoint_dir="s3://bucket/"), "p").startswith("s3://bucket/p-")
    assert session.shared_dir(Session(spark_sql_warehouse_dir="file:/w"), "p").startswith("file:/w/work/p-")


def test_streams_that_share_offsets(spark):
    rows = [
        ("S", 7, "NewSession", "DS", "first", {"a": "1", "b": "1"}, "main", 0, 1),
        ("S", 7, "SessionInfo", "DS", "second", {"a": "2"}, "info", 0, 2),
        ("S", 1, "SessionInfo", "DS", "third", {"b": "3"}, "info", 1, 3),
        ("S", 3, "EndOfSession", "Other", "", None, "main", 1, 4),
    ]
    log = spark.createDataFrame(
        rows, "session_key string, pkt_offset bigint, type string, data_source string, identifier string,"
        " details map<string, string>, stream string, partition int, second bigint",
    )
    log = log.withColumn("submit_time", F.timestamp_seconds("second")).drop("second")
    (found,) = ss.session_catalog(log).collect()
    assert (found.data_source, found.identifier, found.is_complete) == ("DS", "third", True)
    assert (found.first_offset, found.last_offset) == (1, 7)
    assert sorted(tuple(r) for r in ss.session_details(log).collect()) == [("S", "a", "2"), ("S", "b", "3")]
    assert ss.session_identifier(log.where("type <> 'EndOfSession'")).first().identifier == "third"
