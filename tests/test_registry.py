"""Ids that last: over repeated batches, quicker writers, crashes and merges."""

from __future__ import annotations

from pathlib import Path

import pytest

import checks.streams  # noqa: F401  (registers the query)
from checks.registry import QUERIES
from stintlog.session import shared_dir
from stintlog.sources import manifest, registry

LISTS = "pkt_offset bigint, params array<string>"
PARAMETERS = "session_key string, kind string, parameter string, interval_ns bigint"


def register(spark, path, *names):
    seen = spark.createDataFrame([(i, list(n)) for i, n in enumerate(names)], LISTS)
    return ids(registry.register_formats(spark, path, seen, "parameter"))


def ids(formats):
    rows = formats.where("kind = 'parameter'").collect()
    found = {"".join(r.params): r.format_id for r in rows}
    assert len(found) == len(rows) == len({*found.values()})
    return found


def test_ids_last(spark):
    path = shared_dir(spark, "formats")
    assert register(spark, path) == {} and registry.known_formats(spark, path).isEmpty()
    assert register(spark, path, "ab", "ba", "ab") == {"ab": 1, "ba": 2}
    assert register(spark, path, "c", "ba") == {"ab": 1, "ba": 2, "c": 3}
    version = manifest.current(spark, path)["version"]
    assert register(spark, path, "ab", "ba", "ab") == {"ab": 1, "ba": 2, "c": 3}  # a batch once more
    assert manifest.current(spark, path)["version"] == version
    events = spark.createDataFrame([(0, "1F:X"), (1, "")], "pkt_offset bigint, event_identifier string")
    made = registry.register_formats(spark, path, events, "event").where("kind = 'event'").collect()
    assert [(r.format_id, r.event_identifier, r.params) for r in made] == [(4, "1F:X", None)]


def test_a_quicker_writer(spark, monkeypatch):
    path, publish, others = shared_dir(spark, "formats"), manifest.publish, iter(["xc", "c"])

    def late(*args):
        monkeypatch.setattr(manifest, "publish", publish)
        register(spark, path, *next(others))
        return publish(*args)

    monkeypatch.setattr(manifest, "publish", late)
    assert register(spark, path, "a", "c") == {"x": 1, "c": 2, "a": 3}
    parts = [n for n in manifest.names(spark, path) if n.startswith("_part")]
    assert len(parts) == 2  # what lost the race is gone


def test_crash_before_the_swap(spark, monkeypatch):
    path = shared_dir(spark, "formats")
    register(spark, path, "a")

    def crash(*_):
        raise OSError("lost")

    monkeypatch.setattr(manifest, "publish", crash)
    with pytest.raises(OSError):
        register(spark, path, "b")
    monkeypatch.undo()
    assert ids(registry.known_formats(spark, path)) == {"a": 1}
    assert register(spark, path, "c", "b") == {"a": 1, "c": 2, "b": 3}


def test_parts_are_merged(spark, monkeypatch):
    monkeypatch.setattr(registry, "MAX_PARTS", 2)
    path = shared_dir(spark, "formats")
    for i, name in enumerate("abcdefg"):
        assert register(spark, path, name)[name] == i + 1
    assert ids(registry.known_formats(spark, path)) == {n: i + 1 for i, n in enumerate("abcdefg")}
    assert len(manifest.current(spark, path)["parts"]) <= 2


def test_ids_per_source(spark):
    path, schema = shared_dir(spark, "formats"), f"data_source string, {LISTS}"
    for rows in ([("D", 0, ["a"]), ("E", 1, ["a"])], [("E", 0, ["b"]), ("D", 5, ["c"]), ("D", 6, ["d"])]):
        seen = spark.createDataFrame(rows, schema)
        made = registry.register_formats(spark, path, seen, "parameter", by=["data_source"])
    assert sorted((r.data_source, r.format_id, *r.params) for r in made.collect()) == [
        ("D", 1, "a"), ("D", 2, "c"), ("D", 3, "d"), ("E", 1, "a"), ("E", 2, "b"),
    ]


def test_channels_over_batches(spark):
    path = shared_dir(spark, "channels")

    def channels(*rows):
        made = registry.register_channels(spark, path, spark.createDataFrame(rows, PARAMETERS)).collect()
        return {(r.session_key, r.space, r.parameter, r.channel_interval): r.channel_id for r in made}

    first = channels(("S", "Periodic", "a", 5), ("S", "Periodic", "a", 7), ("S", "Error", "e", 0), ("T", "Row", "a", 0))
    then = channels(("S", "Row", "e", 9), ("S", "Row", "b", 0), ("S", "Row", "b", 0), ("S", "Periodic", "a", 7))
    key = ("S", "Periodic", "a", 7)
    assert sorted(v for k, v in first.items() if k[0] == "S") == [1, 2, 3] and first["T", "Row", "a", 0] == 1
    assert then == {("S", "Row", "e", 0): first["S", "Row", "e", 0], ("S", "Row", "b", 0): 4, key: first[key]}


def test_parts_of_a_stream_are_written_by_many_tasks(spark, tmp_path):
    """Each part arrives in several files, and still counts as one batch: ids follow the first offsets."""
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").limit(300)
    lines.repartition(6).write.parquet(str(tmp_path / "lineitem.parquet"))
    base = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before, cost = {*base.glob("lists-*")}, spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")
    try:
        made = {r.names: r.format_id for r in QUERIES["register_formats_live"](spark, str(tmp_path)).collect()}
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    first: dict = {}
    for r in lines.collect():
        names, at = f"P{r.l_partkey % 40},P{r.l_suppkey % 7}", r.l_orderkey * 8 + r.l_linenumber
        first[names] = min(at, first.get(names, at))
    assert made == {names: i for i, names in enumerate(sorted(first, key=lambda n: (first[n], n)), start=1)}
    written = [f for folder in {*base.glob("lists-*")} - before for f in folder.glob("part-*.parquet")]
    assert len(written) > 4
