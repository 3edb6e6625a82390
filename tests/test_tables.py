"""Compaction of session tables: whatever happens between its steps, no record is lost or doubled."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from stintlog.session import shared_dir
from stintlog.sources import manifest, session_tables as st

SCHEMA = "session_key string, pkt_offset bigint"


def batch(spark, path, number, *offsets):
    rows = spark.createDataFrame([(f"S{o % 5}", o) for o in offsets], SCHEMA)
    st.write_batch({"t": rows}, path, number)


def stored(spark, path):
    return sorted(r.pkt_offset for r in st.load_table(spark, path, "t").collect())


@pytest.fixture
def path(spark):
    path = shared_dir(spark, "tables")
    for number in range(3):
        batch(spark, path, number, *range(10 * number, 10 * number + 10))
    return path


def test_merged_while_batches_arrive(spark, path):
    assert not st.compact_table(spark, shared_dir(spark, "none"), "t")
    assert st.compact_table(spark, path, "t") and stored(spark, path) == [*range(30)]
    assert not st.compact_table(spark, path, "t")  # the newest batch stays
    batch(spark, path, 2, *range(20, 30))  # as a stream writes it once more
    batch(spark, path, 3, *range(30, 35))
    assert stored(spark, path) == [*range(35)]
    assert st.compact_table(spark, path, "t") and st.compact_table(spark, path, "t", final=True)
    assert stored(spark, path) == [*range(35)]
    one = st.load_session(spark, path, "t", "S3")
    assert sorted(r.pkt_offset for r in one.collect()) == [*range(3, 35, 5)] and one.columns == ["session_key", "pkt_offset"]


def test_one_session_reads_one_folder_of_the_merged_part(spark, path):
    st.compact_table(spark, path, "t", final=True)
    files = st.load_session(spark, path, "t", "S3").inputFiles()
    assert st.load_session(spark, path, "t", "S3").count() == 6
    plan = st.load_session(spark, path, "t", "S3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(session_bucket" in plan and files


def test_crash_before_the_swap(spark, path, monkeypatch):
    def crash(*_):
        raise OSError("lost")

    monkeypatch.setattr(manifest, "publish", crash)
    with pytest.raises(OSError):
        st.compact_table(spark, path, "t")
    assert stored(spark, path) == [*range(30)]
    monkeypatch.undo()
    assert st.compact_table(spark, path, "t") and stored(spark, path) == [*range(30)]


def test_another_call_was_quicker(spark, path, monkeypatch):
    publish = manifest.publish

    def late(spark, folder, then):
        monkeypatch.setattr(manifest, "publish", publish)
        assert st.compact_table(spark, path, "t")
        return publish(spark, folder, then)

    monkeypatch.setattr(manifest, "publish", late)
    assert not st.compact_table(spark, path, "t")
    assert stored(spark, path) == [*range(30)]


def test_readers_of_the_old_state_finish(spark, path):
    st.compact_table(spark, path, "t")
    before = st.load_table(spark, path, "t")
    batch(spark, path, 3, 30)
    batch(spark, path, 4, 31)
    assert st.compact_table(spark, path, "t")  # replaces what ``before`` reads, and leaves it
    assert sorted(r.pkt_offset for r in before.collect()) == [*range(30)]
    assert stored(spark, path) == [*range(32)]


def test_columns_that_come_later(spark, path):
    st.compact_table(spark, path, "t", final=True)
    more = spark.createDataFrame([("S1", 99, "x")], SCHEMA + ", note string")
    st.write_batch({"t": more}, path, 3)
    st.compact_table(spark, path, "t", final=True)
    assert st.load_table(spark, path, "t").where(F.col("note") == "x").count() == 1 and len(stored(spark, path)) == 31
