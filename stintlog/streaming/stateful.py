"""Stream operators with keyed state: laps of a session, and rows that wait for what they need.

State lies in RocksDB, so it may outgrow an executor's memory. Time is the time of arrival
(``submit_time``): Spark's watermark says up to when everything has arrived, and rows are put in
order only then, however the files or partitions of a stream are mixed. Timers settle what waits,
and drop the state of ended and of silent keys. A row that comes later than the watermark is
dropped by Spark, which counts it in the progress of the query.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from stintlog.functions.times import NS_PER_SECOND
from stintlog.operators.laps import GUARD_NS, IN_LAP, MAIN_TRIGGER, OUT_LAP, PIT_LANE, PIT_TRIGGER
from stintlog.operators.packets import start_offset
from stintlog.schemas import BOOL, INT, LONG, TEXT, record

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"

TRIGGER, START, END = "Lap Trigger", "Start", "EndOfSession"

_LAP = record(pkt_offset=LONG, day_ns=LONG, trigger_source=INT, label=TEXT, lap_number=INT)
_KEPT = T.StructType([*_LAP, *record(lap_name=TEXT)])
_WAITING = T.StructType([*_LAP, *record(arrived_ms=LONG)])
_SESSION = record(start_ns=LONG, ended_ms=LONG, newest_ms=LONG, settled=LONG, alarm_ms=LONG)
REVISION = T.StructType([T.StructField("session_key", TEXT), *_KEPT, *record(counts=BOOL, revision=INT)])


def use_rocksdb(df: DataFrame) -> None:
    """Keep the state of streams in RocksDB, which keyed state needs."""
    df.sparkSession.conf.set(_PROVIDER_KEY, PROVIDER)


def first_name(previous: tuple | None, trigger: int, label: str) -> str:
    """Name of a lap when it is accepted; ``previous`` is the lap kept before it."""
    if previous is None:
        return OUT_LAP
    if trigger == PIT_TRIGGER:
        return PIT_LANE
    return OUT_LAP if trigger == MAIN_TRIGGER and previous[5] == PIT_LANE else label


def final_name(previous: tuple, next_trigger: int) -> str:
    """Name of a lap once its successor is known."""
    if next_trigger == PIT_TRIGGER and previous[2] == MAIN_TRIGGER:
        return IN_LAP
    if next_trigger == MAIN_TRIGGER and previous[5] == PIT_LANE:
        return OUT_LAP
    return previous[5]


class LapFold:
    """Laps of one session in order of arrival: early ones go, then the guard, then names."""

    def __init__(self, guard_ns: int, previous: tuple | None, settled: int, start_ns: int | None):
        self.guard_ns, self.previous, self.settled, self.start_ns = guard_ns, previous, settled, start_ns
        self.rows: list[tuple] = []

    def add(self, lap: tuple) -> None:
        first = self.settled == 0
        self.settled += 1
        if not first and self.start_ns is not None and lap[1] < self.start_ns:
            return
        before = self.previous
        if before is not None:
            if lap[1] - before[1] < self.guard_ns:
                return
            name = final_name(before, lap[2])
            self.rows.append((*before[:5], name, name not in (OUT_LAP, IN_LAP, PIT_LANE), 1))
        self.previous = (*lap, first_name(before, lap[2], lap[3]))
        self.rows.append((*self.previous, False, 0))


def _frames(rows: list[tuple], names: list[str]) -> Iterator[pd.DataFrame]:
    """One frame of plain objects, which Arrow takes as they are; none without rows."""
    if rows:
        yield pd.DataFrame(rows, columns=names, dtype=object)


def _lap(text: str) -> tuple:
    """A lap from its JSON. As columns of pandas, whole numbers beside nulls would turn to floats."""
    read = json.loads(text)
    return tuple(read.get(name) for name in _LAP.names)


class _Alarm:
    """The one timer of a key: a call for each batch of it would cost more than the state itself."""

    def __init__(self, handle: StatefulProcessorHandle, at: int | None):
        self.handle, self.at = handle, at

    def by(self, due: int) -> None:
        """Ring at ``due`` at the latest."""
        if self.at is None or due < self.at:
            if self.at is not None:
                self.handle.deleteTimer(self.at)
            self.handle.registerTimer(due)
            self.at = due


class SessionLaps(StatefulProcessor):
    """State of a session: triggers that wait for their order, the lap kept last, start and end."""

    def __init__(self, guard_ns: int, idle_ms: int):
        self.guard_ns, self.idle_ms = guard_ns, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", _WAITING)
        self.kept = handle.getValueState("kept", _KEPT)
        self.session = handle.getValueState("session", _SESSION)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        start, ended, newest, settled, alarm_ms = self.session.get() or (None, None, None, 0, None)
        triggers, due = [], []
        for batch in rows:
            for kind, arrived, lap in zip(batch["kind"].tolist(), batch["arrived_ms"].tolist(), batch["lap"]):
                newest = arrived if newest is None else max(newest, arrived)
                if kind == TRIGGER:
                    triggers.append((*_lap(lap), arrived))
                elif kind == START and (began := _lap(lap)[1]) is not None:
                    start = began if start is None else min(start, began)
                elif kind == END:
                    ended = arrived if ended is None else max(ended, arrived)
                    due.append(arrived)
        if triggers:
            self.waiting.appendList(triggers)
            due.append(max(t[-1] for t in triggers))
        alarm = _Alarm(self.handle, alarm_ms)
        alarm.by(min([*due, newest + self.idle_ms]))
        self.session.update((start, ended, newest, settled, alarm.at))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self.session.get()
        if held is None:
            return
        start, ended, newest, settled, _ = held
        now = timerValues.getCurrentWatermarkInMs()
        waiting = [tuple(w) for w in self.waiting.get()] if self.waiting.exists() else []
        ready = sorted((w for w in waiting if w[-1] <= now), key=lambda w: w[0])
        rest = [w for w in waiting if w[-1] > now]
        if ready:
            fold = LapFold(self.guard_ns, self.kept.get(), settled, start)
            for lap in ready:
                fold.add(lap[:-1])
            self.waiting.put(rest) if rest else self.waiting.clear()
            if fold.previous is not None:
                self.kept.update(fold.previous)
            settled = fold.settled
            yield from _frames([(key[0], *row) for row in fold.rows], REVISION.names)
        if not rest and (newest + self.idle_ms <= now or ended is not None and ended <= now):
            for state in (self.waiting, self.kept, self.session):
                state.clear()
            return
        due = [newest + self.idle_ms, *([max(w[-1] for w in rest)] if rest else [])]
        if ended is not None and ended > now:
            due.append(ended)
        alarm = _Alarm(self.handle, None)
        alarm.by(min(at for at in due if at > now) if any(at > now for at in due) else now + 1)
        self.session.update((start, ended, newest, settled, alarm.at))

    def close(self) -> None:
        pass


def session_laps(
    triggers: DataFrame,
    ends: DataFrame,
    starts: DataFrame | None = None,
    guard_ns: int = GUARD_NS,
    lateness: str = "1 minute",
    idle_ns: int = 24 * 3600 * NS_PER_SECOND,
) -> DataFrame:
    """Named laps of a stream of lap triggers, as revisions; equal to the batch rules.

    ``triggers`` as ``race.lap_triggers`` gives them, with ``submit_time``; ``ends`` has
    ``session_key, submit_time`` of ended sessions and ``starts`` ``session_key, submit_time,
    start_ns``. Triggers wait until nothing older than ``lateness`` can arrive, then are taken in
    the order of their offsets: a lap before its session's start goes (not the first), then laps
    within the guard time. A lap comes out when it is accepted (revision 0) and again with its
    final name when its successor is (revision 1).

    The state of a session is its triggers that wait and one lap. It goes when the session has
    ended and its last triggers are settled, or after ``idle_ns`` without anything of it. The
    start of a session counts as far as it is known when a lap is settled.
    """
    use_rocksdb(triggers)

    def rows(df: DataFrame, kind: str, **columns) -> DataFrame:
        have = {c: F.col(c) for c in _LAP.names if c in df.columns} | columns
        laps = [have.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in _LAP]
        return df.select("session_key", "submit_time", F.lit(kind).alias("kind"), F.to_json(F.struct(*laps)).alias("lap"))

    # Only what a kind has; an end has no lap's columns.
    parts = rows(triggers, TRIGGER).unionByName(rows(ends.select("session_key", "submit_time"), END))
    if starts is not None:
        parts = parts.unionByName(rows(starts.select("session_key", "submit_time", "start_ns"), START, day_ns=F.col("start_ns")))
    parts = parts.withColumn("arrived_ms", F.unix_millis("submit_time")).withWatermark("submit_time", lateness)
    return parts.groupBy("session_key").transformWithStateInPandas(
        SessionLaps(guard_ns, idle_ns // 1_000_000), REVISION, "append", "eventTime"
    )


_FACT, _ROW = "fact", "row"
HELD, GIVEN_UP = "known", "given up"
_HELD = record(row=TEXT, facts=T.ArrayType(TEXT), status=TEXT, settled_at=T.TimestampType())


class Held(StatefulProcessor):
    """State of a key: the facts known, and the rows that need others. A row is a text nobody reads here."""

    def __init__(self, wait_ms: int, idle_ms: int):
        self.wait_ms, self.idle_ms = wait_ms, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", record(row=TEXT, needs=T.ArrayType(TEXT), arrived_ms=LONG))
        self.known = handle.getListState("known", record(name=TEXT, fact=TEXT))
        self.clock = handle.getValueState("clock", record(newest_ms=LONG, alarm_ms=LONG))

    def _out(self, rows: list[tuple], status: str, watermark_ms: int) -> Iterator[pd.DataFrame]:
        """Rows as they came, with the facts that each needs (None for those unknown).

        What has waited settles now: for the operators that follow it is not late.
        """
        out = [(row, facts, status, pd.Timestamp(max(at, watermark_ms + 1), unit="ms")) for (row, _, at), facts in rows]
        return _frames(out, _HELD.names)

    def _known(self) -> dict[str, str]:
        return dict(tuple(pair) for pair in self.known.get()) if self.known.exists() else {}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        clock = self.clock.get()  # a key without it has no state at all, and each look costs a call
        newest, alarm_ms = clock or (None, None)
        fresh, told = [], {}
        for batch in rows:
            latest = int(batch["arrived_ms"].max())
            newest = latest if newest is None else max(newest, latest)
            # Lists: to cut frames of few rows costs more than all else.
            columns = (batch[c].tolist() for c in ("role", "fact_name", "fact", "row", "needs", "arrived_ms"))
            for role, name, fact, row, needs, arrived in zip(*columns):
                if role == _FACT:
                    told[name] = fact
                else:
                    fresh.append((row, list(needs), arrived))
        known = self._known() if clock and (told or any(needs for _, needs, _ in fresh)) else {}
        changed = [(name, fact) for name, fact in told.items() if known.get(name) != fact]
        if changed:
            # An id hardly ever changes its meaning; where it does, the list is written anew.
            again = any(name in known for name, _ in changed)
            known.update(changed)
            self.known.put([*known.items()]) if again else self.known.appendList(changed)
        held = [tuple(w) for w in self.waiting.get()] if clock and changed and self.waiting.exists() else []
        ready: list[tuple] = []
        wait: list[list[tuple]] = []
        for part in (held, fresh):
            wait.append([])
            for row in part:
                facts = [known.get(name) for name in row[1]]
                wait[-1].append(row) if None in facts else ready.append((row, facts))
        if len(wait[0]) < len(held):
            self.waiting.put([*wait[0], *wait[1]]) if wait[0] or wait[1] else self.waiting.clear()
        elif wait[1]:
            self.waiting.appendList(wait[1])
        alarm = _Alarm(self.handle, alarm_ms)
        alarm.by(min([row[-1] + self.wait_ms for row in wait[1]] + [newest + self.idle_ms]))
        self.clock.update((newest, alarm.at))
        yield from self._out(ready, HELD, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self.clock.get()
        if held is None:
            return
        newest, now = held[0], timerValues.getCurrentWatermarkInMs()
        waiting = [tuple(w) for w in self.waiting.get()] if self.waiting.exists() else []
        late = [row for row in waiting if row[-1] + self.wait_ms <= now]
        rest = [row for row in waiting if row[-1] + self.wait_ms > now]
        if late:
            self.waiting.put(rest) if rest else self.waiting.clear()
            known = self._known()
            yield from self._out([(row, [known.get(name) for name in row[1]]) for row in late], GIVEN_UP, now)
        if not rest and newest + self.idle_ms <= now:
            for state in (self.waiting, self.known, self.clock):
                state.clear()
            return
        alarm = _Alarm(self.handle, None)
        alarm.by(min([row[-1] + self.wait_ms for row in rest] + [max(newest + self.idle_ms, now + 1)]))
        self.clock.update((newest, alarm.at))

    def close(self) -> None:
        pass


def hold_rows(
    rows: DataFrame,
    facts: DataFrame,
    keys: Sequence[str],
    wait: str,
    idle: str,
    salts: int = 16,
) -> DataFrame:
    """Rows that have what they need; a row waits in the state of its key until all of it is known.

    Both streams have a watermark on ``submit_time``. ``rows`` has ``keys``, ``pkt_offset``,
    ``submit_time`` and ``needs``, an array of names; any other columns pass through. ``facts`` has
    ``keys``, ``name``, ``fact`` (text) and ``submit_time``; repeats are allowed, the latest counts.
    Comes out with ``facts`` in the order of ``needs``, ``status`` and ``settled_at``: ``known`` as
    soon as all are known, ``given up`` (null for what is missing) once ``wait`` has passed since
    the row arrived. Every row comes out once. A key that is silent for ``idle`` is forgotten with its facts.

    Rows of a key spread over ``salts`` states, and facts are repeated for each, so that one busy
    key is no single task.
    """
    use_rocksdb(rows)
    keys, spread = list(keys), [*keys, "_salt"]
    kept = T.StructType([f for f in rows.schema if f.name not in ("submit_time", "needs")])
    salt = F.pmod(F.xxhash64("pkt_offset"), F.lit(salts)).cast("int")
    left = rows.select(
        *keys, "submit_time", salt.alias("_salt"), F.lit(_ROW).alias("role"), F.to_json(F.struct(*kept.names)).alias("row"), "needs",
        F.lit(None).cast("string").alias("fact_name"), F.lit(None).cast("string").alias("fact"),
    )
    right = facts.select(
        *keys,
        "submit_time",
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"),
        F.lit(_FACT).alias("role"),
        F.lit(None).cast("string").alias("row"),
        F.array().cast("array<string>").alias("needs"),
        F.col("name").alias("fact_name"),
        "fact",
    )
    both = left.unionByName(right).withColumn("arrived_ms", F.unix_millis("submit_time"))
    processor = Held(_milliseconds(rows, wait), _milliseconds(rows, idle))
    held = both.groupBy(*spread).transformWithStateInPandas(processor, _HELD, "append", "eventTime", eventTimeColumnName="settled_at")
    return held.withColumn("row", F.from_json("row", kept)).select("row.*", "facts", "status", "settled_at")


def _milliseconds(df: DataFrame, interval: str) -> int:
    seconds = df.sparkSession.range(1).select(F.expr(f"cast(interval {interval} as interval second)").cast("decimal(18,3)"))
    return int(seconds.first()[0] * 1000)


_FOUND = record(session_key=TEXT, stream=TEXT, start_offset=LONG, seen_at=T.TimestampType())


class FirstSeen(StatefulProcessor):
    """State of a session: the streams it is known to have."""

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getListState("seen", record(stream=TEXT))
        self.session = handle.getValueState("session", record(newest_ms=LONG, ended_ms=LONG, alarm_ms=LONG))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        newest, ended, alarm_ms = self.session.get() or (None, None, None)
        named: list[tuple] = []
        for batch in rows:
            latest = int(batch["arrived_ms"].max())
            newest = latest if newest is None else max(newest, latest)
            for stream, start, arrived in zip(batch["stream"], batch["start_offset"].tolist(), batch["arrived_ms"].tolist()):
                if stream is None:
                    ended = arrived if ended is None else max(ended, arrived)
                else:
                    named.append((arrived, stream, start))
        known = {row[0] for row in self.seen.get()} if named and self.seen.exists() else set()
        new: dict[str, tuple] = {}
        for arrived, stream, start in sorted(named):
            if stream not in known:
                new.setdefault(stream, (key[0], stream, start, pd.Timestamp(arrived, unit="ms")))
        if new:
            self.seen.appendList([(stream,) for stream in new])
        alarm = _Alarm(self.handle, alarm_ms)
        alarm.by(min([newest + self.idle_ms, *([ended] if ended is not None else [])]))
        self.session.update((newest, ended, alarm.at))
        yield from _frames([*new.values()], _FOUND.names)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from ()
        held = self.session.get()
        if held is None:
            return
        newest, ended, _ = held
        now = timerValues.getCurrentWatermarkInMs()
        if ended is not None and ended <= now or newest + self.idle_ms <= now:
            self.seen.clear()
            self.session.clear()
            return
        alarm = _Alarm(self.handle, None)
        alarm.by(newest + self.idle_ms if ended is None else min(ended, newest + self.idle_ms))
        self.session.update((newest, ended, alarm.at))

    def close(self) -> None:
        pass


def discovered_streams(
    infos: DataFrame, ends: DataFrame, lateness: str = "1 minute", idle_ns: int = 24 * 3600 * NS_PER_SECOND
) -> DataFrame:
    """Streams of sessions as they are announced, each once: ``session_key, stream, start_offset, seen_at``.

    ``infos`` is a stream of session updates (``session_key, data_source, streams, offsets,
    submit_time``), ``ends`` one of ``session_key, submit_time``. A reader starts each stream at the
    offset it was first announced with. An ended or silent session is forgotten.
    """
    use_rocksdb(infos)
    at = infos.select("session_key", "data_source", "submit_time", "offsets", F.explode("streams").alias("stream"))
    named = at.select("session_key", "submit_time", "stream", start_offset().alias("start_offset"))
    over = ends.select(
        "session_key", "submit_time", F.lit(None).cast("string").alias("stream"), F.lit(0).cast("bigint").alias("start_offset")
    )
    both = named.unionByName(over).withColumn("arrived_ms", F.unix_millis("submit_time")).withWatermark("submit_time", lateness)
    return both.groupBy("session_key").transformWithStateInPandas(
        FirstSeen(idle_ns // 1_000_000), _FOUND, "append", "eventTime"
    )
