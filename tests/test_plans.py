"""Plan shapes that matter at scale."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from checks.fixtures import formats, frame, on_disk, packet_log, periodic_blocks, row_blocks, synchro_blocks, typed_row_blocks
from stintlog.operators import formats as fm, samples as sm, sessions
from stintlog.plans import recording

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


SAMPLE_OPERATORS = {
    "periodic": lambda s: sm.explode_periodic(sm.drop_zero_interval(periodic_blocks(frame(s, SF, "periodic")))),
    "rows": lambda s: sm.explode_rows(row_blocks(frame(s, SF, "rows"))),
    "widened rows": lambda s: sm.explode_rows(sm.widen_samples(typed_row_blocks(frame(s, SF, "rows")), "rows")),
    "synchro": lambda s: sm.explode_synchro(synchro_blocks(frame(s, SF, "synchro"))),
    "whole log": lambda s: recording.samples_of(packet_log(frame(s, SF, "packets")), formats(s)),
}


@pytest.mark.parametrize("name", SAMPLE_OPERATORS)
def test_no_shuffle_and_no_python_on_the_sample_path(spark, name):
    text = plan(SAMPLE_OPERATORS[name](spark))
    assert "Python" not in text and "Pandas" not in text
    # Only the formats, a dimension, are made distinct by their id before they are broadcast.
    text = re.sub(r"\bExchange hashpartitioning\(_id#", "", text)
    assert not re.search(r"\bExchange (hash|range|single|round)", text)


def test_small_lookups_are_broadcast_by_measured_size(spark):
    blocks = periodic_blocks(frame(spark, SF, "periodic"))
    resolved = fm.resolve_parameter_list(blocks, formats(spark))
    assert "BroadcastHashJoin" in plan(resolved)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = fm.resolve_parameter_list(blocks, formats(spark))
        assert "SortMergeJoin" in plan(large) and "BroadcastHashJoin" not in plan(large)
        assert large.exceptAll(resolved).isEmpty()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def scans(text):
    return re.findall(r"ReadSchema: struct<([^>]*)>", text)


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(entry.queries()["match_runs"](spark, SF))
    assert "PushedFilters: [" in text
    text = plan(entry.queries()["day_time"](spark, SF))
    assert "value" not in scans(text)[0] and "props" not in scans(text)[0]


def test_ranges_scan_the_log_once_and_parse_once(spark):
    """The query makes its content from all columns of ``events``; of a stored log few are read."""
    log = on_disk(packet_log(frame(spark, SF, "packets")))
    text = plan(sessions.session_time_range(recording.time_records_of(log)))
    assert len(scans(text)) == 1
    # The type is a folder: it prunes, and is not read. Offsets are, since a read starts at one.
    assert re.findall(r"(\w+):", scans(text)[0]) == ["pkt_offset", "session_key", "content"]
    assert re.search(r"PartitionFilters: \[[^\]]*type#\d+ IN", text)
    kinds = re.findall(r"from_json\(", text)
    assert len(kinds) == 5, "one parse for each type, of which a row takes one"
    text = plan(entry.queries()["session_time_range"](spark, SF))
    assert len(scans(text)) == 1
