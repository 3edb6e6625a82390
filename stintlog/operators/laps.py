"""Laps: minimum lap time, names, which laps count, early laps, the default lap.

Laps have ``pkt_offset`` (arrival order), ``session_key``, a time column, ``trigger_source``
(0 main, 1 pit lane) and ``label``. The order of the rules is ``reject_early_laps``,
``lap_guard``, ``classify_laps``: a rejected lap never becomes "the previous lap". (A trigger
rejected as early could still rename the very first lap in the original; here it cannot.)
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

from stintlog.functions.times import NS_PER_SECOND, int_div
from stintlog.operators.ordering import BUCKET_SPAN, max_before
from stintlog.session import stored

# Fixed values.
OUT_LAP, IN_LAP, PIT_LANE = "Out Lap", "In Lap", "Pit Lane"
MAIN_TRIGGER, PIT_TRIGGER = 0, 1
GUARD_NS = 10 * NS_PER_SECOND

# Earlier than any time: the first lap of a session is always kept.
NO_LAP_YET = -(1 << 62)

# A session's time axis is cut into chunks of this many guard times.
CHUNK_GUARDS = 60

# Python handles the chunks of a part at once: this many parts per shuffle partition.
PARTS_PER_PARTITION = 4


def lap_guard(
    laps: DataFrame,
    guard_ns: int = GUARD_NS,
    time_col: str = "day_ns",
    bucket_span: int = BUCKET_SPAN,
    chunk_guards: int = CHUNK_GUARDS,
) -> DataFrame:
    """Keep the laps at least ``guard_ns`` after the last kept one, in arrival order.

    A lap that arrives late is rejected too: it lies before the last kept one. Whether a lap is
    kept depends on what was kept before it, yet no task sees a whole session:

    1. A kept lap is later than every lap that arrived before it, so only running maxima
       matter; these are in time order.
    2. A running maximum ``guard_ns`` or more after the one before it is kept in any case.
       Chunks of a session's time axis that hold only such laps are finished.
    3. In any other chunk, what is kept depends on the first lap kept in it. Each chunk is
       reduced to steps (first lap kept -> last lap kept), neighbours with the same end
       merged; the steps are walked once per session to find where each chunk starts.
    4. Each chunk is then walked from its start.

    At the default sizes a chunk is ten minutes of one session. Walks from different starts soon
    meet, so even a session with a billion triggers a day leaves well under a million steps.
    """
    keys = ["session_key", "_chunk"]
    time = F.col(time_col)
    in_chunk = Window.partitionBy(*keys)
    maxima = (
        max_before(
            laps,
            ["session_key"],
            int_div("pkt_offset", bucket_span),
            ["pkt_offset", time_col],
            time_col,
            "_prev",
        )
        .where(F.col("_prev").isNull() | (time > F.col("_prev")))
        .withColumn("_sure", F.col("_prev").isNull() | (time - F.col("_prev") >= guard_ns))
        .withColumn("_chunk", int_div(time, guard_ns * chunk_guards))
        .withColumn("_all_sure", F.min("_sure").over(in_chunk))
        .withColumn("_is_last", time == F.max(time_col).over(in_chunk))
        .drop("_prev", "_sure")
    )
    maxima = stored(maxima, "lap-maxima")
    sure = maxima.where("_all_sure")
    unsure = maxima.where("not _all_sure").drop("_all_sure", "_is_last")

    parts = PARTS_PER_PARTITION * int(laps.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def apply(rows: DataFrame, part_keys: list[str], function, schema: T.StructType) -> DataFrame:
        part = F.pmod(F.xxhash64(*part_keys), F.lit(parts)).alias("_part")
        return rows.groupBy(part).applyInPandas(function, schema)

    steps = apply(
        unsure.select(*keys, time.alias("_time")),
        keys,
        _chunk_steps(guard_ns, chunk_guards),
        _schema(maxima, keys, "_first", "_last"),
    )
    # In a chunk of sure laps any earlier state leads to the first lap, and so to the last.
    sure_steps = sure.where("_is_last").select(*keys, time.alias("_first"), time.alias("_last"))
    entries = apply(
        steps.unionByName(sure_steps),
        ["session_key"],
        _chunk_entries(guard_ns),
        _schema(maxima, keys, "_entry"),
    )
    kept = apply(
        unsure.join(entries, keys), keys, _walk(guard_ns, time_col), _schema(laps, laps.columns)
    )
    return sure.select(*laps.columns).unionByName(kept)


def _schema(df: DataFrame, columns: list[str], *times: str) -> T.StructType:
    return T.StructType(
        [df.schema[c] for c in columns] + [T.StructField(name, T.LongType()) for name in times]
    )


def _runs(*columns: np.ndarray) -> list[slice]:
    """Slices of equal consecutive rows."""
    if not len(columns[0]):
        return []
    changes = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    bounds = [0, *(np.flatnonzero(changes) + 1).tolist(), len(columns[0])]
    return [slice(a, b) for a, b in zip(bounds[:-1], bounds[1:])]


def _chunk_steps(guard_ns: int, chunk_guards: int):
    """Steps of each chunk: a start at or before ``_first`` makes ``_last`` the last kept lap."""

    def of_chunk(times: np.ndarray, chunk: int) -> tuple[np.ndarray, np.ndarray]:
        count = len(times)
        following = np.searchsorted(times, times + guard_ns)
        # Follow the kept laps to the end of the chunk for all starts at once, doubling the
        # stride; the last kept lap points to itself.
        end = np.where(following < count, following, np.arange(count))
        while not np.array_equal(further := end[end], end):
            end = further
        # Whatever was kept before the chunk, the first lap kept in it is one of these.
        border = (chunk * chunk_guards + 1) * guard_ns
        starts = min(int(np.searchsorted(times, border)) + 1, count)
        last = times[end[:starts]]
        merged = np.append(last[1:] != last[:-1], True)
        return times[:starts][merged], last[merged]

    def steps(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["session_key", "_chunk", "_time"])
        session, chunk, time = (pdf[c].to_numpy() for c in ("session_key", "_chunk", "_time"))
        out = []
        for rows in _runs(session, chunk):
            first, last = of_chunk(time[rows], int(chunk[rows.start]))
            out += zip([session[rows.start]] * len(first), [chunk[rows.start]] * len(first), first, last)
        return pd.DataFrame(out, columns=["session_key", "_chunk", "_first", "_last"])

    return steps


def _chunk_entries(guard_ns: int):
    """Earliest time at which a lap may be kept, for each chunk of each session."""

    def entries(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["session_key", "_chunk", "_first"])
        session, chunk, first, last = (
            pdf[c].to_numpy() for c in ("session_key", "_chunk", "_first", "_last")
        )
        out, current, entry = [], None, NO_LAP_YET
        for rows in _runs(session, chunk):
            if session[rows.start] != current:
                current, entry = session[rows.start], NO_LAP_YET
            out.append((current, chunk[rows.start], entry))
            step = rows.start + int(np.searchsorted(first[rows], entry))
            if step < rows.stop:
                entry = int(last[step]) + guard_ns
        return pd.DataFrame(out, columns=["session_key", "_chunk", "_entry"])

    return entries


def _walk(guard_ns: int, time_col: str):
    """Rows kept in each chunk, from its entry on."""

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["session_key", "_chunk", time_col])
        session, chunk, entry, time = (
            pdf[c].to_numpy() for c in ("session_key", "_chunk", "_entry", time_col)
        )
        kept = []
        for rows in _runs(session, chunk):
            row = rows.start + int(np.searchsorted(time[rows], entry[rows.start]))
            while row < rows.stop:
                kept.append(row)
                row = rows.start + int(np.searchsorted(time[rows], time[row] + guard_ns))
        return pdf.iloc[kept].drop(columns=["_chunk", "_entry"])

    return walk


def reject_early_laps(
    laps: DataFrame, sessions: DataFrame, time_col: str = "day_ns"
) -> DataFrame:
    """Drop laps before the start of their session, except the session's first lap."""
    first = laps.groupBy("session_key").agg(F.min("pkt_offset").alias("_first"))
    bounds = first.join(
        sessions.select("session_key", F.col("start_ns").alias("_start")), "session_key", "left"
    )
    in_time = F.col("_start").isNull() | (F.col(time_col) >= F.col("_start"))
    return (
        laps.join(bounds, "session_key")
        .where(in_time | (F.col("pkt_offset") == F.col("_first")))
        .select(*laps.columns)
    )


def classify_laps(laps: DataFrame) -> DataFrame:
    """Name the guarded laps and tell which count for the fastest lap.

    First lap: Out Lap. Pit trigger: Pit Lane, and a predecessor with a main trigger becomes
    the In Lap. Main trigger after Pit Lane: Out Lap, and the predecessor becomes Out Lap as
    well. Otherwise the label. ``counts``: see ``lap_counts_for_fastest``.

    Guarded laps are at least a guard time apart, so a session has a few thousand a day and
    a window per session is bounded however many triggers were sent.
    """
    by_arrival = Window.partitionBy("session_key").orderBy("pkt_offset")
    so_far = by_arrival.rowsBetween(Window.unboundedPreceding, 0)
    trigger = F.col("trigger_source")
    # A label may read "Pit Lane" too. Such a main-trigger lap is Pit Lane unless its
    # predecessor is, so a run of them alternates, starting from the lap before the run.
    toggles = (F.col("_row") > 1) & (trigger == MAIN_TRIGGER) & (F.col("label") == PIT_LANE)
    base = (F.col("_row") > 1) & (
        (trigger == PIT_TRIGGER) | ((trigger != MAIN_TRIGGER) & (F.col("label") == PIT_LANE))
    )
    anchored = (
        laps.withColumn("_row", F.row_number().over(by_arrival))
        .withColumn("_anchor", F.when(~toggles, F.col("_row")))
        .withColumn("_base", F.when(~toggles, base.cast("int")))
        .withColumn("_anchor", F.max("_anchor").over(so_far))
        .withColumn("_base", F.last("_base", ignorenulls=True).over(so_far))
        .withColumn("_pit", (F.col("_base") + F.col("_row") - F.col("_anchor")) % 2 == 1)
    )
    given = (
        F.when(F.col("_row") == 1, OUT_LAP)
        .when(F.col("_pit"), PIT_LANE)
        .when((trigger == MAIN_TRIGGER) & F.lag("_pit").over(by_arrival), OUT_LAP)
        .otherwise(F.col("label"))
    )
    next_trigger = F.lead(trigger).over(by_arrival)
    named = anchored.withColumn("_given", given).withColumn(
        "lap_name",
        F.when((next_trigger == PIT_TRIGGER) & (trigger == MAIN_TRIGGER), IN_LAP)
        .when((next_trigger == MAIN_TRIGGER) & F.col("_pit"), OUT_LAP)
        .otherwise(F.col("_given")),
    )
    succeeded = F.lead(F.lit(True)).over(by_arrival).isNotNull()
    counts = succeeded & ~F.col("lap_name").isin(OUT_LAP, IN_LAP, PIT_LANE)
    return named.withColumn("counts", counts).select(*laps.columns, "lap_name", "counts")


def lap_counts_for_fastest(classified: DataFrame) -> DataFrame:
    """Laps that count: succeeded by another lap and none of Out Lap, In Lap, Pit Lane."""
    return classified.where("counts")


def python_laps(laps: DataFrame, time_col: str = "day_ns") -> DataFrame:
    """The simple rule: each trigger time of a session is one lap, and every lap counts."""
    return laps.groupBy("session_key", time_col).agg(
        F.min("pkt_offset").alias("pkt_offset"),
        F.min_by("lap_number", "pkt_offset").alias("lap_number"),
        F.min_by("label", "pkt_offset").alias("lap_name"),
        F.lit(True).alias("counts"),
    )


def default_lap(sessions: DataFrame, laps: DataFrame, time_col: str = "day_ns") -> DataFrame:
    """One Out Lap, number 1, at the start of each session that has no lap."""
    with_laps = laps.select("session_key").distinct()
    return sessions.join(with_laps, "session_key", "left_anti").select(
        "session_key",
        F.col("start_ns").alias(time_col),
        F.lit(1).cast("smallint").alias("lap_number"),
        F.lit(OUT_LAP).alias("lap_name"),
        F.lit(False).alias("counts"),
    )
