from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from stintlog.operators import laps as lp
from stintlog.streaming.stateful import LapFold

S = 10**9
LAP_SCHEMA = (
    "pkt_offset bigint, session_key string, day_ns bigint, label string,"
    " trigger_source smallint, lap_number smallint"
)


def frame(spark, rows):
    """Rows of (session, seconds, trigger, label), in arrival order."""
    return spark.createDataFrame(
        [(i, s, int(t * S), label, trigger, i) for i, (s, t, trigger, label) in enumerate(rows)],
        LAP_SCHEMA,
    )


def kept(spark, rows, **options):
    guarded = lp.lap_guard(frame(spark, rows), **options)
    return sorted((r.session_key, r.day_ns / S) for r in guarded.collect())


def brute_guard(times, guard):
    last, out = None, []
    for t in times:
        if last is None or t - last >= guard:
            out.append(t)
            last = t
    return out


@pytest.mark.parametrize(
    ("seconds", "expected"),
    [([0, 6, 12, 13, 30], [0, 12, 30]), ([0, 20, 15], [0, 20]), ([50, 3, 60], [50, 60]), ([7], [7])],
)
def test_guard_by_hand(spark, seconds, expected):
    rows = [("A", t, 0, "L") for t in seconds]
    assert kept(spark, rows) == [("A", t) for t in expected]


def test_guard_of_a_single_late_chunk_keeps_its_first_lap(spark):
    """The first lap of a session counts even where its step was merged with later ones."""
    assert kept(spark, [("A", 5, 0, "L"), ("A", 6, 0, "L"), ("A", 100, 0, "L")]) == [("A", 5), ("A", 100)]


def test_guard_equals_brute_force(spark):
    """Dense, sparse, late and repeated triggers; small chunks and buckets force every path."""
    rng = random.Random(7)
    triggers = {}
    for session, (count, span) in {
        "dense": (900, 400),
        "regular": (600, 0),
        "sparse": (60, 4000),
        "mixed": (400, 3000),
        "hot": (3000, 20000),
    }.items():
        times = [i * 0.5 for i in range(count)] if not span else sorted(rng.uniform(0, span) for _ in range(count))
        for _ in range(count // 20):
            a, b = rng.randrange(count), rng.randrange(count)
            times[a], times[b] = times[b], times[a]
        triggers[session] = [round(t, 3) for t in times]
    order = [s for s, times in triggers.items() for _ in times]
    rng.shuffle(order)
    queues = {s: iter(times) for s, times in triggers.items()}
    rows = [(s, next(queues[s]), 0, "L") for s in order]
    expected = sorted(
        (s, t / S) for s, times in triggers.items() for t in brute_guard([int(x * S) for x in times], 10 * S)
    )
    for chunk_guards, bucket_span in ((1, 17), (3, 100), (360, 1 << 20)):
        assert kept(spark, rows, chunk_guards=chunk_guards, bucket_span=bucket_span) == expected


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.integers(0, 400), min_size=1, max_size=80, unique=True),
    st.integers(1, 30),
    st.integers(1, 6),
)
def test_steps_entries_and_walk(times, guard, chunk_guards):
    """The three Python steps alone, on every chunk, keep what a sequential guard keeps."""
    laps = pd.DataFrame({"session_key": "A", "_time": np.array(sorted(times), dtype="int64")})
    laps["_chunk"] = laps["_time"] // (guard * chunk_guards)
    steps = lp._chunk_steps(guard, chunk_guards)(laps)
    entries = lp._chunk_entries(guard)(steps)
    kept_rows = lp._walk(guard, "_time")(laps.merge(entries, on=["session_key", "_chunk"]))
    assert kept_rows["_time"].tolist() == brute_guard(sorted(times), guard)


def test_no_laps(spark):
    empty = frame(spark, [("A", 1, 0, "L")]).where("false")
    assert lp.classify_laps(lp.lap_guard(empty)).isEmpty()


def named(spark, triggers):
    """Names and counting flags for (trigger, label), one lap a minute."""
    rows = [("A", 60 * i, trigger, label) for i, (trigger, label) in enumerate(triggers)]
    result = lp.classify_laps(frame(spark, rows)).orderBy("pkt_offset").collect()
    return [(r.lap_name, r.counts) for r in result]


OUT, IN, PIT = "Out Lap", "In Lap", "Pit Lane"


@pytest.mark.parametrize(
    ("triggers", "expected"),
    [
        (
            [(0, "L1"), (0, "L2"), (1, "L3"), (0, "L4"), (0, "L5")],
            [(OUT, False), (IN, False), (OUT, False), (OUT, False), ("L5", False)],
        ),
        ([(0, "L1"), (0, "L2"), (0, "L3")], [(OUT, False), ("L2", True), ("L3", False)]),
        ([(1, "L1"), (0, "L2")], [(OUT, False), ("L2", False)]),
        (
            [(0, "L1"), (0, PIT), (0, PIT), (0, PIT), (0, "L5"), (0, "L6")],
            [(OUT, False), (OUT, False), (OUT, False), (OUT, False), (OUT, False), ("L6", False)],
        ),
        ([(0, "L1"), (2, "L2"), (2, PIT), (0, "L4")], [(OUT, False), ("L2", True), (OUT, False), (OUT, False)]),
    ],
)
def test_classify_by_hand(spark, triggers, expected):
    assert named(spark, triggers) == expected


def sequential(triggers):
    """The naming rules one lap at a time."""
    laps = []
    for trigger, label in triggers:
        previous = laps[-1] if laps else None
        if previous is None:
            name = OUT
        elif trigger == 1:
            name = PIT
            if previous["trigger"] == 0:
                previous["name"] = IN
        elif previous["name"] == PIT and trigger == 0:
            previous["name"] = name = OUT
        else:
            name = label
        if previous:
            previous["counts"] = previous["name"] not in (OUT, IN, PIT)
        laps.append({"name": name, "trigger": trigger, "counts": False})
    return [(lap["name"], lap["counts"]) for lap in laps]


def test_classify_equals_sequential_rules(spark):
    rng = random.Random(3)
    labels = [PIT, "A", "B", PIT, OUT]
    for _ in range(6):
        triggers = [(rng.choice([0, 0, 1, 2]), rng.choice(labels)) for _ in range(60)]
        assert named(spark, triggers) == sequential(triggers)


def test_stream_fold_equals_sequential_rules():
    """The fold names laps as the rules do, however the laps are cut into batches."""
    rng = random.Random(5)
    triggers = [(rng.choice([0, 0, 1, 2]), rng.choice([PIT, "A", "B"])) for _ in range(80)]
    laps = [(i, i * 60 * S, t, label, i) for i, (t, label) in enumerate(triggers)]
    previous, settled, last = None, 0, {}
    for start in range(0, 80, 7):
        fold = LapFold(10 * S, previous, settled, None)
        for lap in laps[start : start + 7]:
            fold.add(lap)
        previous, settled = fold.previous, fold.settled
        last.update({row[0]: (row[5], row[6]) for row in fold.rows})
    assert [last[i] for i in range(80)] == sequential(triggers)


def test_early_laps(spark):
    laps = frame(spark, [("A", 5, 0, "L"), ("A", 20, 0, "L"), ("A", 40, 0, "L"), ("B", 1, 0, "L"), ("C", 1, 0, "L")])
    starts = spark.createDataFrame([("A", 30 * S), ("B", 0)], "session_key string, start_ns bigint")
    result = lp.reject_early_laps(laps, starts)
    assert sorted((r.session_key, r.day_ns // S) for r in result.collect()) == [("A", 5), ("A", 40), ("B", 1), ("C", 1)]


def test_default_lap(spark):
    laps = frame(spark, [("A", 5, 0, "L")])
    sessions = spark.createDataFrame([("A", 1), ("B", 2)], "session_key string, start_ns bigint")
    assert [tuple(r) for r in lp.default_lap(sessions, laps).collect()] == [("B", 2, 1, OUT, False)]


def test_simple_laps(spark):
    laps = frame(spark, [("A", 5, 0, "L0"), ("A", 5, 0, "L1"), ("A", 1, 0, "L2")])
    result = lp.python_laps(laps).orderBy("day_ns").select("lap_name", "counts").collect()
    assert [tuple(r) for r in result] == [("L2", True), ("L0", True)]


def test_counting_laps(spark):
    rows = [("A", 60 * i, 0, f"L{i}") for i in range(4)]
    counting = lp.lap_counts_for_fastest(lp.classify_laps(frame(spark, rows)))
    assert sorted(r.label for r in counting.select(F.col("label")).collect()) == ["L1", "L2"]
