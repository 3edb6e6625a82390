"""From a log of session packets and data to the closing records."""

from __future__ import annotations

import datetime
import json

from pyspark.sql import functions as F

from checks.blocks import DAY
from checks.fixtures import faulty_log, formats, frame, on_disk, packet_log
from stintlog.operators import packets as pk, race, sessions as ss
from stintlog.plans import recording
from stintlog.schemas import PACKETS

SF = "/root/testdata/sf0.001"
S = 10**9


def packets(spark, *rows):
    """Packets of (session, type, content), in arrival order."""
    return spark.createDataFrame(
        [(i, "D", session, "", kind, False, json.dumps(content)) for i, (session, kind, content) in enumerate(rows)],
        PACKETS,
    )


def lap(t, source="0", number=1):
    return {"ts_ns": t * S, "type": "Lap Trigger", "label": f"Lap {number}", "source": source, "value": number}


def values(*numbers, kind="double_samples"):
    return {kind: [{"value": n, "status": "VALID"} for n in numbers]}


def test_whole_session(spark):
    log = packets(
        spark,
        ("A", "NewSession", {"identifier": "run", "type": "Race", "version": 2, "utc_offset_seconds": -18000,
                             "details": {"Driver": "T"}, "assoc_keys": ["P"]}),
        ("A", "PeriodicData", {"format_id": 0, "params": ["a:X", "b"], "start_ns": 5 * S, "interval_ns": S,
                               "columns": [values(1.0, 2.0, 3.0), values(True, kind="bool_samples")]}),
        ("A", "RowData", {"format_id": 2, "params": None, "timestamps": [9 * S, 7 * S],
                          "rows": [values(1, 2, kind="int32_samples"), values("x", "y", kind="string_samples")]}),
        ("A", "SynchroData", {"format_id": 0, "params": ["s"], "start_ns": 6 * S, "intervals": [S, 2 * S],
                              "columns": [values(1.0, 2.0, 3.0)]}),
        ("A", "Marker", lap(6)), ("A", "Marker", lap(9, number=2)), ("A", "Marker", lap(70, number=3)),
        ("A", "Marker", lap(140, "1", 4)), ("A", "CoverageCursorInfo", {"ts_ns": 200 * S}),
        ("A", "Metadata", {"metadata": {"k": {"str_value": "v"}, "n": {"dbl_value": 1.5}, "none": {}}}),
        ("A", "SessionInfo", {"identifier": "", "details": {"Driver": "U", "Track": "V"}}),
        ("B", "NewSession", {}), ("B", "CoverageCursorInfo", {"ts_ns": 3 * S}), ("A", "EndOfSession", {}),
        ("B", "Mystery", {}),
    )
    session_log = recording.session_log_of(log)
    catalog = ss.session_catalog(session_log)
    a = catalog.where("session_key = 'A'").first()
    assert (a.identifier, a.is_complete, a.session_type, a.version) == ("Untitled", True, "Race", 2)
    assert a.utc_offset == datetime.timedelta(hours=-5)
    assert sorted(tuple(r) for r in ss.session_details(session_log).collect()) == [("A", "Driver", "U"), ("A", "Track", "V")]

    tables = recording.record_session_tables(log, formats(spark))
    samples = sorted((r.parameter, r.ts_ns // S, r.value) for r in tables["samples"].collect())
    assert samples == [
        ("a:X", 5, 1.0), ("a:X", 6, 2.0), ("a:X", 7, 3.0), ("b", 5, 1.0), ("price:Sales", 9, 2.0),
        ("qty:Sales", 9, 1.0), ("s", 6, 1.0), ("s", 7, 2.0), ("s", 9, 3.0),
    ]
    assert sorted((r.item_key, r.str_value, r.dbl_value) for r in tables["metadata"].collect()) == [("k", "v", None), ("n", None, 1.5)]
    assert sorted(r.reason for r in tables["rejects"].collect()) == ["no list of numbers", "unknown type"]

    numbered = sorted((r.session_key, r.space, r.parameter, r.channel_interval // S) for r in tables["channels"].collect())
    assert numbered == [
        ("A", "Periodic", "a:X", 1), ("A", "Periodic", "b", 1), ("A", "Row", "price:Sales", 0), ("A", "Row", "qty:Sales", 0),
        ("A", "Synchro", "s", 0),
    ]
    closed = recording.closing_tables(tables.get)
    assert {r.session_key: r.is_complete for r in closed["catalog"].collect()} == {"A": True, "B": False}
    assert closed["laps"].count() == 4 and closed["channel_list"].count() == 5 and closed["closing_records"].count() == 2
    assert sorted(tuple(r) for r in closed["current_details"].collect()) == [("A", "Driver", "U"), ("A", "Track", "V")]
    assert [tuple(r) for r in closed["associated"].collect()] == [("A", "P")]

    summary, laps = recording.close_sessions(catalog, tables["ranges"], tables["lap_triggers"])
    assert sorted((r.session_key, r.start_ns // S, r.end_ns // S, r.n_laps, r.n_counting) for r in summary.collect()) == [
        ("A", 5, 200, 3, 0), ("B", 3, 3, 1, 0),
    ]
    assert sorted((r.session_key, r.day_ns // S, r.lap_name, r.lap_number) for r in laps.collect()) == [
        ("A", 6, "Out Lap", 1), ("A", 70, "In Lap", 3), ("A", 140, "Pit Lane", 4), ("B", 3, "Out Lap", 1),
    ]


def test_range_leaves_out_ignored_blocks(spark):
    block = {"format_id": 0, "params": ["a:X"], "interval_ns": 1}
    numbers, text = [{"double_samples": [{"value": 1.0, "status": "VALID"}]}], [{"string_samples": [{"value": "t", "status": "VALID"}]}]
    bodies = [
        {**block, "start_ns": 5, "interval_ns": 0, "columns": numbers},
        {**block, "start_ns": 7, "columns": text},
        {**block, "start_ns": 50, "columns": numbers},
    ]
    log = one_session(spark, [("PeriodicData", body) for body in bodies])
    got = ss.session_time_range(recording.time_records_of(log)).collect()
    assert [(r.start_ns, r.end_ns) for r in got] == [(50, 50)]


def one_session(spark, rows):
    """A log of session A from (type, content); content that is no dict is taken as it is."""
    data = [(i, "DS", "A", "", kind, False, json.dumps(body) if isinstance(body, dict) else body) for i, (kind, body) in enumerate(rows)]
    return spark.createDataFrame(data, PACKETS)


def test_samples_and_rejects_account_for_every_list(spark):
    log = on_disk(faulty_log(frame(spark, SF, "packets")))
    samples = recording.samples_of(log, formats(spark)).select("session_key", "pkt_offset", "kind").distinct()
    rejects = recording.rejects_of(log, formats(spark)).select("session_key", "pkt_offset").distinct()
    blocks = log.where(F.col("type").isin("PeriodicData", "RowData", "SynchroData")).select("session_key", "pkt_offset")
    seen = samples.select("session_key", "pkt_offset").union(rejects).distinct()
    assert blocks.exceptAll(blocks.intersect(seen)).isEmpty()
    assert samples.join(rejects, ["session_key", "pkt_offset"], "left_semi").isEmpty()


def test_content_that_cannot_be_read_is_rejected(spark):
    log = one_session(spark, [("Event", None), ("Event", ""), ("Event", " "), ("Event", "{broken"), (None, "{}"), ("Odd", "{}"), ("Event", {"ts_ns": 1})])
    assert [r.pkt_offset for r in pk.decode_content(log, "Event").collect()] == [6]
    reasons = {r.pkt_offset: r.reason for r in pk.reject_packets(log).collect()}
    assert reasons == dict.fromkeys(range(4), "undecodable content") | dict.fromkeys((4, 5), "unknown type")


def test_content_is_parsed_once(spark):
    plan = pk.decode_content(packet_log(frame(spark, SF, "packets")), "PeriodicData")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json") == 1


def test_another_decoder_reaches_every_table(spark):
    def reversed_json(content, schema):
        return F.from_json(F.reverse(content), schema)

    log = one_session(spark, [("CoverageCursorInfo", json.dumps({"ts_ns": 7})[::-1]), ("Error", json.dumps({"ts_ns": 1, "name": "E", "status": "SET", "error_type": "CURRENT"})[::-1])])
    tables = recording.record_session_tables(log, formats(spark), reversed_json)
    assert [r.ts_ns for r in tables["coverage"].collect()] == [7] and tables["errors"].count() == 1


def test_unreadable_trigger_starts_no_lap(spark):
    rows = [("Marker", {"ts_ns": t * S, "type": "Lap Trigger", "label": f"L{t}", "source": s, "value": t}) for t, s in ((0, "0"), (100, "1"), (200, "x"), (300, "0"), (400, "0"))]
    log = one_session(spark, rows)
    named = recording.laps_of(recording.lap_triggers_of(log)).orderBy("pkt_offset").collect()
    assert [(r.label, r.lap_name, r.counts) for r in named] == [
        ("L0", "In Lap", False), ("L100", "Out Lap", False), ("L300", "Out Lap", False), ("L400", "L400", False),
    ]
    assert [r.pkt_offset for r in recording.rejects_of(log, formats(spark)).collect()] == [2]


def test_session_info_fits_the_offset_functions(spark):
    opened = {"data_source": "DS", "identifier": "Run", "streams": ["A", "B"], "offsets": {"DS.A:0": 5}, "assoc_keys": ["P"]}
    log = recording.session_log_of(one_session(spark, [("NewSession", opened)]))
    offsets = pk.resolve_offsets(ss.session_catalog(log)).collect()
    assert sorted((r.stream, r.start_offset) for r in offsets) == [("A", 5), ("B", 0)]
    assert [tuple(r) for r in ss.associated_sessions(log).collect()] == [("A", "P")]


def test_range_of_decoded_log_equals_range_of_blocks(spark):
    flat = frame(spark, SF, "packets").where("k % 31 <> 0 and not (type = 'PeriodicData' and k % 10 = 0)")
    got = ss.session_time_range(recording.time_records_of(packet_log(flat)))
    kinds = ["PeriodicData", "RowData", "SynchroData", "RawCANData", "CoverageCursorInfo"]
    # A row block holds a second row one microsecond after the first.
    ends = F.when(F.col("type") == "RowData", F.array("ts_ns", F.col("ts_ns") + 1000)).otherwise(F.array("ts_ns"))
    want = (
        flat.where(F.col("type").isin(kinds))
        .select("session_key", (F.explode(ends)).alias("t"))
        .groupBy("session_key")
        .agg(F.min(F.col("t") % DAY).alias("start_ns"), F.max(F.col("t") % DAY).alias("end_ns"))
    )
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_events_that_stand_for_no_id(spark):
    event = {"format_id": 0, "ts_ns": S, "raw_values": [1.0]}
    defined = {"config_id": "c", "event_definitions": [{"identifier": "Pit:App", "definition_id": 7, "application_name": "App"}]}
    log = packets(
        spark, ("A", "Configuration", defined), *[("A", "Event", event | {"event_identifier": e}) for e in ("1F:App", "Lap:App", "Pit:App")]
    )
    assert [(r.pkt_offset, r.item, r.reason) for r in recording.rejects_of(log, formats(spark)).collect()] == [
        (2, "Lap:App", "event without a definition or id")
    ]


def test_streams_that_share_offsets(spark):
    """Offsets count per stream: equal ones of two streams double no marker and no event."""
    markers = spark.createDataFrame(
        [(1, "A", 5, "x", "s1"), (1, "A", 5, "x", "s2"), (2, "A", 5, "x", "s1"), (1, "A", 5, None, "s1"), (1, "B", 5, "x", "s2")],
        "pkt_offset bigint, session_key string, day_ns bigint, label string, stream string",
    )
    kept = race.dedupe_markers(markers)
    assert kept.columns == markers.columns
    assert sorted(map(tuple, kept.collect()), key=str) == [(1, "A", 5, "x", "s1"), (1, "A", 5, None, "s1"), (1, "B", 5, "x", "s2")]
    happened = spark.createDataFrame([(1, "A", S, "1F:App", [1.0])], "pkt_offset bigint, session_key string, ts_ns bigint, event_identifier string, raw_values array<double>")
    definitions = spark.createDataFrame([(1, "1F:App", 31, "App"), (1, "1F:App", 31, "App"), (0, "1F:App", 30, "Old")], "pkt_offset bigint, identifier string, definition_id bigint, application_name string")
    assert [(r.definition_id, r.application_name) for r in race.events(happened, definitions).collect()] == [(31, "App")]
