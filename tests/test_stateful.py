"""Keyed state: shuffled files and restarts give what the batch rules give, and state goes."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from checks.fixtures import frame, packet_log
from checks.racing import triggers
from stintlog.operators import laps as lp
from stintlog.plans import recording
from stintlog.session import shared_dir
from stintlog.sources import session_tables
from stintlog.streaming import recorder, stateful
from tests.test_streaming import Feed, same

S = 10**9
LAP = "pkt_offset bigint, session_key string, day_ns bigint, label string, trigger_source smallint, lap_number smallint"
NAMED = ["session_key", "pkt_offset", "day_ns", "trigger_source", "label", "lap_name", "counts"]


def arriving(df):
    """One packet a second, in the order of the offsets."""
    return df.withColumn("submit_time", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("pkt_offset")))


def mixed_parts(spark, df, files, jitter, seed=4):
    """Parts in which a row lies up to ``jitter`` places from its own."""
    rows = [r.asDict() for r in df.collect()]
    rng = random.Random(seed)
    rows.sort(key=lambda r: r["pkt_offset"] + rng.uniform(0, jitter))
    size = -(-len(rows) // files)
    parts = [rows[i : i + size] for i in range(0, len(rows), size)]
    for part in parts:
        rng.shuffle(part)
    return [spark.createDataFrame(part, df.schema) for part in parts]


def feed_of(spark, folder, parts):
    folder.mkdir()
    source = Feed(spark, folder, parts[0].schema)
    for part in parts:
        source.add(part)
    return source


def drain(stream, spark, name, path, checkpoint):
    query = recorder.stream_tables(stream, lambda b: {name: b}, path, checkpoint)
    query.awaitTermination()
    return query


def with_ends(spark, laps):
    """Packets: the triggers, an end behind the last of each session, and two later ones that let time pass."""
    rows = arriving(laps.withColumn("type", F.lit("Lap Trigger")))
    last = laps.agg(F.max("pkt_offset")).first()[0]
    ends = laps.groupBy("session_key").agg((F.max("pkt_offset") + 1).alias("pkt_offset"))
    clock = spark.createDataFrame([(last + 10**6, "~"), (last + 2 * 10**6, "~")], "pkt_offset bigint, session_key string")
    more = arriving(ends.unionByName(clock).withColumn("type", F.lit("EndOfSession")))
    return rows.unionByName(more, allowMissingColumns=True)


def laps_of(stream, **options):
    ends = stream.where("type = 'EndOfSession'")
    return stateful.session_laps(stream.where("type = 'Lap Trigger'"), ends, **options)


def held_sessions(spark, checkpoint):
    state = spark.read.format("statestore").option("stateVarName", "session").load(checkpoint)
    return {r.key.session_key for r in state.collect()}


def test_laps_over_shuffled_files_and_a_restart(spark, tmp_path):
    laps = triggers(spark, "/root/testdata/sf0.01")
    parts = mixed_parts(spark, with_ends(spark, laps), 4, jitter=1500)
    source = feed_of(spark, tmp_path / "in", parts[:2])
    path, checkpoint = shared_dir(spark, "laps"), shared_dir(spark, "checkpoint")
    held = []
    for more in ([], parts[2:], []):  # half of the files, the rest, nothing new
        for part in more:
            source.add(part)
        drain(laps_of(source.stream(), lateness="1600 seconds"), spark, "laps", path, checkpoint)
        held.append(held_sessions(spark, checkpoint))
    assert len(held[0]) > 10 and held[1] == held[2] == {"~"}
    want = lp.classify_laps(lp.lap_guard(laps)).select(*NAMED)
    revisions = session_tables.load_table(spark, path, "laps").drop(*session_tables.LAYOUT)
    got = recorder.latest_laps(revisions).select(*[F.col(c).cast(want.schema[c].dataType) for c in NAMED])
    assert same(want, got)
    assert revisions.groupBy("session_key", "pkt_offset", "revision").count().where("count > 1").isEmpty()


def test_early_laps_and_silent_sessions(spark, tmp_path):
    def lap(offset, session, seconds, trigger=0):
        return (offset, session, seconds * S, f"L{offset}", trigger, offset)

    laps = spark.createDataFrame(
        [lap(1, "A", 5), lap(2, "A", 20), lap(3, "A", 40), lap(4, "A", 60, 1), lap(5, "A", 80), lap(6, "B", 3), lap(7, "B", 50)], LAP
    )
    starts = spark.createDataFrame([("A", 30 * S), ("B", 10 * S)], "session_key string, start_ns bigint")
    want = recording.laps_of(laps, starts).select(*NAMED)
    rows = arriving(laps.withColumn("type", F.lit("Lap Trigger"))).withColumn("start_ns", F.lit(None).cast("bigint"))
    began = arriving(starts.withColumn("pkt_offset", F.lit(0).cast("bigint")).withColumn("type", F.lit("Start")))
    clock = arriving(spark.createDataFrame([(10_000, "~"), (20_000, "~")], "pkt_offset bigint, session_key string").withColumn("type", F.lit("EndOfSession")))
    both = rows.unionByName(began, allowMissingColumns=True).unionByName(clock, allowMissingColumns=True)
    stream = feed_of(spark, tmp_path / "in", mixed_parts(spark, both, 3, jitter=1)).stream()
    path, checkpoint = shared_dir(spark, "laps"), shared_dir(spark, "checkpoint")
    # No session ends: both are forgotten after a silent hour.
    named = laps_of(stream, starts=stream.where("type = 'Start'"), lateness="10 seconds", idle_ns=3600 * S)
    drain(named, spark, "laps", path, checkpoint)
    revisions = session_tables.load_table(spark, path, "laps").drop(*session_tables.LAYOUT)
    got = recorder.latest_laps(revisions).select(*[F.col(c).cast(want.schema[c].dataType) for c in NAMED])
    assert same(want, got) and got.count() == 6
    assert held_sessions(spark, checkpoint) == {"~"}


ROWS = "pkt_offset bigint, session_key string, note string, needs array<string>"
FACTS = "pkt_offset bigint, session_key string, name string, fact string"


def test_rows_wait_for_facts(spark, tmp_path):
    rng = random.Random(3)
    names = [f"p{i}" for i in range(6)]
    rows = [(i, rng.choice("AB"), f"n{i}", rng.sample(names, rng.randrange(4))) for i in range(200)]
    facts = [(rng.randrange(150, 260), s, n, f"{s}{n}") for s in "AB" for n in names if (s, n) != ("B", "p5")]
    facts += [(400, "A", "p0", "Ap0")]  # a repeat
    clock = [(at, "~", "clock", []) for at in (20_000, 50_000, 60_000)]
    left = feed_of(spark, tmp_path / "rows", mixed_parts(spark, arriving(spark.createDataFrame(rows, ROWS)), 4, jitter=30))
    for c in clock:
        left.add(arriving(spark.createDataFrame([c], ROWS)))
    right = feed_of(spark, tmp_path / "facts", mixed_parts(spark, arriving(spark.createDataFrame(facts, FACTS)), 3, jitter=30))
    for at in (20_000, 50_000, 60_000):  # time passes on both streams
        right.add(arriving(spark.createDataFrame([(at, "~", "x", "x")], FACTS)))
    path, checkpoint = shared_dir(spark, "held"), shared_dir(spark, "checkpoint")
    for _ in range(2):
        rows_in, facts_in = (source.stream().withWatermark("submit_time", "500 seconds") for source in (left, right))
        held = stateful.hold_rows(rows_in, facts_in, ["session_key"], "3000 seconds", "20000 seconds", salts=3)
        drain(held, spark, "held", path, checkpoint)
    got = session_tables.load_table(spark, path, "held").where("session_key <> '~'").collect()
    assert sorted(r.pkt_offset for r in got) == list(range(200))  # each once
    for r in got:
        _, session, note, needs = rows[r.pkt_offset]
        want = [None if (session, n) == ("B", "p5") else f"{session}{n}" for n in needs]
        assert (r.session_key, r.note, r.status) == (session, note, "given up" if None in want else "known")
        assert r.facts == want
    assert any(r.status == "given up" for r in got)
    clock = spark.read.format("statestore").option("stateVarName", "clock").load(checkpoint)
    assert {r.key.session_key for r in clock.collect()} <= {"~"}


def test_markers_stay_single_over_batches_and_a_restart(spark, tmp_path):
    """Repeats in the same file, in later files and after a restart are dropped; the state shrinks again."""
    rng = random.Random(2)
    rows = [(i, "AB"[i % 2], (i // 40) * S, rng.choice(["x", "y", None])) for i in range(200)]
    markers = arriving(spark.createDataFrame(rows, "pkt_offset bigint, session_key string, day_ns bigint, label string"))
    parts = mixed_parts(spark, markers, 4, jitter=20)
    clock = [arriving(spark.createDataFrame([(10_000 * (k + 1), "~", k, "")], markers.drop("submit_time").schema)) for k in range(2)]
    source = feed_of(spark, tmp_path / "in", parts[:2])
    path, checkpoint = shared_dir(spark, "markers"), shared_dir(spark, "checkpoint")
    for more in ([], parts[2:] + clock, []):
        for part in more:
            source.add(part)
        query = drain(recorder.dedupe_marker_stream(source.stream(), "100 seconds"), spark, "markers", path, checkpoint)
        progress = [p for p in query.recentProgress if p["stateOperators"]] or progress
    got = session_tables.load_table(spark, path, "markers").where("session_key <> '~'").collect()
    keys = [(r.session_key, r.day_ns, r.label) for r in got]
    assert len(keys) == len({*keys}) and {*keys} == {row[1:] for row in rows}
    assert progress[-1]["stateOperators"][0]["numRowsTotal"] <= 2


def test_formats_and_definitions_in_later_files_lose_no_sample(spark, tmp_path):
    packets = arriving(packet_log(frame(spark, "/root/testdata/sf0.001", "packets")))
    data = feed_of(spark, tmp_path / "in", mixed_parts(spark, packets, 2, jitter=50))
    schema = "pkt_offset bigint, data_source string, format_id bigint, kind string, params array<string>"
    lists = {1: ["nEngine", "vCar:Chassis"], 2: ["qty:Sales", "price:Sales"]}
    # Format 2 of DS2 never comes.
    told = [(900 + i, f"DS{s}", f, "parameter", lists[f]) for i, (s, f) in enumerate((s, f) for s in range(3) for f in lists if (s, f) != (2, 2))]
    names = ["vCar:Chassis", "nEngine", "qty:Sales", "price:Sales", "k:Row", "twice:Row", "rWheel:Chassis"]
    # Session S3 never gets a definition of rWheel.
    defined = [(950 + i, f"S{s}", n) for i, (s, n) in enumerate((s, n) for s in range(15) for n in names if (s, n) != (3, "rWheel:Chassis"))]
    formats = feed_of(spark, tmp_path / "formats", mixed_parts(spark, arriving(spark.createDataFrame(told, schema)), 2, jitter=3))
    definitions = feed_of(
        spark, tmp_path / "definitions",
        mixed_parts(spark, arriving(spark.createDataFrame(defined, "pkt_offset bigint, session_key string, parameter string")), 2, jitter=3),
    )
    for at in (10_000, 20_000):  # time passes on every stream
        row = packets.limit(1).withColumn("pkt_offset", F.lit(at).cast("bigint")).withColumn("session_key", F.lit("~"))
        data.add(arriving(row.withColumn("type", F.lit("RowData"))))
        formats.add(arriving(spark.createDataFrame([(at, "~", 5, "parameter", ["x"])], schema)))
        definitions.add(arriving(spark.createDataFrame([(at, "~", "x")], "pkt_offset bigint, session_key string, parameter string")))
    path, checkpoint = shared_dir(spark, "live"), shared_dir(spark, "checkpoint")
    recorder.stream_samples(
        data.stream(), formats.stream(), path, checkpoint, definitions=definitions.stream(), wait="2000 seconds",
        lateness="1100 seconds", idle="5000 seconds", salts=2,
    ).awaitTermination()
    samples, rejects = (session_tables.load_table(spark, path, t).where("session_key <> '~'").drop(*session_tables.LAYOUT) for t in ("samples", "rejects"))
    known = spark.createDataFrame([(f, "parameter", p, None) for f, p in lists.items()], "format_id bigint, kind string, params array<string>, event_identifier string")
    whole = recording.samples_of(packets, known)
    lost = rejects.where("reason in ('no parameter list', 'parameter not defined')").select("pkt_offset")
    assert same(whole.join(lost, "pkt_offset", "left_anti"), samples)
    blocks = packets.where("type in ('PeriodicData', 'RowData', 'SynchroData')")
    seen = samples.select("pkt_offset").union(rejects.select("pkt_offset")).distinct()
    assert same(blocks.select("pkt_offset"), seen)
    why = {(r.reason, r.item) for r in rejects.collect()}
    assert {("no parameter list", "2"), ("parameter not defined", "rWheel:Chassis")} <= why
    given_up = rejects.where("reason = 'no parameter list'").join(packets, "pkt_offset").select("data_source").distinct().collect()
    assert [r.data_source for r in given_up] == ["DS2"]


def test_streams_are_discovered_once(spark, tmp_path):
    schema = "pkt_offset bigint, session_key string, data_source string, streams array<string>, offsets map<string, bigint>, type string"
    rows = [
        (1, "A", "D", ["s1"], {}, "SessionInfo"), (2, "A", "D", ["s1", "s2"], {"D.s2:0": 9}, "SessionInfo"), (3, "B", "D", ["s1"], {"D.s1:0": 4}, "SessionInfo"),
        (4, "A", "D", ["s2", "s3"], {"D.s2:0": 11}, "SessionInfo"), (5, "A", "D", None, None, "EndOfSession"), (6, "B", "D", ["s1", "s1"], None, "SessionInfo"),
        (10_000, "~", "D", [], None, "EndOfSession"), (20_000, "~", "D", [], None, "EndOfSession"),
    ]
    parts = mixed_parts(spark, arriving(spark.createDataFrame(rows, schema)), 4, jitter=0)
    source = feed_of(spark, tmp_path / "in", parts[:2])
    path, checkpoint = shared_dir(spark, "streams"), shared_dir(spark, "checkpoint")
    for more in ([], parts[2:]):
        for part in more:
            source.add(part)
        stream = source.stream()
        infos, ends = stream.where("type = 'SessionInfo'"), stream.where("type = 'EndOfSession'").select("session_key", "submit_time")
        drain(stateful.discovered_streams(infos, ends, "10 seconds", idle_ns=3600 * S), spark, "streams", path, checkpoint)
    got = sorted((r.session_key, r.stream, r.start_offset) for r in session_tables.load_table(spark, path, "streams").collect())
    assert got == [("A", "s1", 0), ("A", "s2", 9), ("A", "s3", 0), ("B", "s1", 4)]
    assert held_sessions(spark, checkpoint) == {"~"}


def test_a_task_sends_a_definition_once(spark, monkeypatch):
    told = [("S1", "a:x", i) for i in range(50)] + [("S1", "b:x", 7), (None, "a:x", 3), ("S2", "a:x", 9), ("S2", "a:x", None)]
    table = spark.createDataFrame(told, "session_key string, parameter string, s long").coalesce(1)
    table = table.selectExpr("session_key", "parameter", "timestamp_seconds(s) as submit_time")

    def sent():
        return sorted((str(r.session_key), r.name, r.s) for r in recorder._once(table).selectExpr("*", "unix_seconds(submit_time) as s").collect())

    assert sent() == [("None", "a:x", 3), ("S1", "a:x", 49), ("S1", "b:x", 7), ("S2", "a:x", 9)]
    monkeypatch.setattr(recorder, "REMEMBERED", 1)  # past what it remembers nothing is lost
    assert {row[:2] for row in sent()} == {("None", "a:x"), ("S1", "a:x"), ("S1", "b:x"), ("S2", "a:x")}
