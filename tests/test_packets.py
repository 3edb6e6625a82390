from __future__ import annotations

import json

import pytest

from checks.fixtures import frame, packet_log
from stintlog.operators import packets as pk
from stintlog.session import shared_dir
from stintlog.sources import packet_log as log, session_tables

SF = "/root/testdata/sf0.001"


def offsets(df):
    return sorted(r.pkt_offset for r in df.collect())


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame(
        [(0, "D", "A", "", True), (1, "D", "A", "s1", False), (2, "D", "A", "s2", False), (3, "D", "B", "s1", True),
         (4, "E", "A", "s1", False), (5, "D", "A", "", False)],
        "pkt_offset bigint, data_source string, session_key string, stream string, is_essential boolean",
    )


@pytest.mark.parametrize(
    ("spec", "expected"),
    [
        (pk.ReadSpec(), [0, 1, 2, 3, 4, 5]),
        (pk.ReadSpec("D", "A"), [0, 1, 2, 5]),
        (pk.ReadSpec("D", "A", exclude_main_stream=True), [1, 2]),
        (pk.ReadSpec("D", "A", main_offset=1), [1, 2, 5]),
        (pk.ReadSpec("D", streams=("s1",), offsets=(2,)), [0, 3, 5]),
        (pk.ReadSpec("D", streams=("s1", "s2"), offsets=(0, pk.LATEST), main_offset=pk.LATEST), [1, 3]),
        (pk.ReadSpec("D", streams=("s2", "s1"), offsets=(3,), exclude_main_stream=True), [1, 3]),
    ],
)
def test_read_spec(small, spec, expected):
    assert offsets(pk.select_packets(small, spec)) == expected


def test_essentials(small):
    assert offsets(pk.read_essentials(small, pk.ReadSpec("D", essentials_offset=1))) == [3]


def test_routes_by_partition(small):
    routed = pk.route_packets(small, "partition", {"s1": 4}).where("data_source = 'D'")
    assert sorted((r.pkt_offset, r.topic, r.topic_partition) for r in routed.collect()) == [
        (0, "D", 0), (0, "D.essentials", 0), (1, "D", 4), (2, "D", 0), (3, "D", 0), (3, "D", 4),
        (3, "D.essentials", 0), (5, "D", 0),
    ]


def test_kafka_options():
    spec = pk.ReadSpec("D", streams=("s1", "s2"), offsets=(5, pk.LATEST))
    by_topic = log.kafka_options(spec, "b:9092", "topic")
    assert json.loads(by_topic["startingOffsets"]) == {"D": {"0": 0}, "D.s1": {"0": 5}, "D.s2": {"0": -1}}
    by_partition = log.kafka_options(spec, "b:9092", "partition", {"s1": 1, "s2": 2})
    assert json.loads(by_partition["assign"]) == {"D": [0, 1, 2]}
    assert json.loads(by_partition["startingOffsets"]) == {"D": {"0": 0, "1": 5, "2": -1}}
    essentials = log.essentials_options(pk.ReadSpec("D", essentials_offset=8), "b:9092")
    assert json.loads(essentials["startingOffsets"]) == {"D.essentials": {"0": 8}}
    with pytest.raises(ValueError):
        log.kafka_options(pk.ReadSpec(), "b:9092", "topic")


def test_kafka_records(spark):
    value = '{"type": "RowData", "session_key": "A", "is_essential": false, "content": "{}"}'
    records = spark.createDataFrame(
        [("D", 0, 4, bytearray(value.encode())), ("D.s1", 1, 5, bytearray(value.encode())), ("D", 7, 6, bytearray(b"?"))],
        "topic string, partition int, offset bigint, value binary",
    ).selectExpr("*", "timestamp '2024-01-01' as timestamp")
    by_topic = log.kafka_packets(records, "D").orderBy("pkt_offset").collect()
    assert [(r.pkt_offset, r.stream, r.type, r.session_key) for r in by_topic] == [
        (4, "", "RowData", "A"), (5, "s1", "RowData", "A"), (6, "", None, None),
    ]
    by_partition = log.kafka_packets(records, "D", {"s1": 1, "s7": 7}).orderBy("pkt_offset").collect()
    assert [r.stream for r in by_partition] == ["", "s1", "s7"]


def test_decoded_plus_rejected_is_everything(spark):
    packets = packet_log(frame(spark, SF, "packets"))
    decoded = sum(pk.decode_content(packets, kind).count() for kind in pk.DATA_KINDS)
    assert decoded + pk.reject_packets(packets).count() == packets.count()


def test_demux_covers_known_kinds_once(spark):
    packets = frame(spark, SF, "packets")
    found = [r.pkt_offset for df in pk.demux_packets(packets).values() for r in df.select("pkt_offset").collect()]
    assert sorted(found) == offsets(packets.where("type <> 'Mystery'"))


def test_log_round_trip_prunes(spark):
    path = shared_dir(spark, "log")
    packets = packet_log(frame(spark, SF, "packets"))
    log.write_packets(packets, path)
    back = log.read_packets(spark, path)
    columns = packets.columns
    assert back.select(columns).exceptAll(packets).isEmpty() and packets.exceptAll(back.select(columns)).isEmpty()
    one = pk.demux_packets(log.read_packets(spark, path, pk.ReadSpec("DS1")))["Marker"]
    plan = one._jdf.queryExecution().executedPlan().toString()
    partition_filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "data_source" in partition_filters and "type" in partition_filters


def test_load_session_prunes(spark):
    path = shared_dir(spark, "tables")
    markers = frame(spark, SF, "markers")
    session_tables.write_session_tables({"markers": markers}, path)
    one = session_tables.load_session(spark, path, "markers", "S3")
    assert offsets(one) == offsets(markers.where("session_key = 'S3'"))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "session_bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "EqualTo(session_key,S3)" in plan


def test_repeated_batch_replaces_itself(spark):
    path = shared_dir(spark, "tables")
    markers = frame(spark, SF, "markers")
    for _ in range(2):
        session_tables.write_batch({"markers": markers}, path, 3)
    assert session_tables.load_table(spark, path, "markers").count() == markers.count()


def test_info_packets(spark, small):
    path = shared_dir(spark, "info")
    log.write_info_packets(small, "SYSTEM_STATUS", path)
    log.write_info_packets(small, "SESSION_INFO", path)
    back = spark.read.parquet(path)
    assert back.where("info_type = 'SYSTEM_STATUS' and is_essential").count() == small.count()


def test_filter_by_regular_expression(spark):
    packets = spark.createDataFrame(
        [(0, "RowData", ["Sin:A", "Debug:A"], None), (1, "RowData", ["Debug:A"], None), (2, "Event", None, "Lap:T"),
         (3, "Event", None, "Heartbeat:T"), (4, "Marker", None, None), (5, "Error", None, None), (6, "RowData", ["XSin:A"], None)],
        "pkt_offset bigint, type string, params array<string>, event_identifier string",
    )
    chosen = pk.read_data_packets(packets, ["Sin:.*", "Debug:.*"], ["Debug:.*"], [], ["Heartbeat:.*"], True)
    assert sorted((r.pkt_offset, r.selected) for r in chosen.collect()) == [(0, ["Sin:A"]), (2, None), (4, None)]
    assert offsets(pk.read_data_packets(packets)) == [0, 1, 2, 3, 6]


def test_streams_and_offsets(spark):
    sessions = spark.createDataFrame(
        [("A", "D", ["s1", "s2"], {"D.s1:0": 9})],
        "session_key string, data_source string, streams array<string>, offsets map<string, bigint>",
    )
    assert sorted(tuple(r) for r in pk.resolve_offsets(sessions).collect()) == [("A", "s1", 9), ("A", "s2", 0)]
    known = spark.createDataFrame([("A", "s1")], "session_key string, stream string")
    assert [tuple(r) for r in pk.discover_streams(sessions, known).collect()] == [("A", "s2", 0)]
