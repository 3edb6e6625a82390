"""Sample blocks to the long table of samples, and CAN frames.

Every function maps a DataFrame to a DataFrame with built-in expressions only: no shuffle and
no Python on the sample path. Blocks carry ``params`` (resolved names) and wide sample lists
(see ``functions.lists.widen_list``); all other columns of a block are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stintlog.functions.lists import gcd_of, in_units, prefix_sums, sample_kind, widen_list
from stintlog.functions.times import as_column, day_time


def _carried(packets: DataFrame, *consumed: str) -> list[str]:
    return [c for c in packets.columns if c not in consumed]


def _samples(df: DataFrame, carried: list[str], ts_ns: Column, kind: str) -> DataFrame:
    return df.select(
        *carried,
        F.col("parameter"),
        ts_ns.alias("ts_ns"),
        day_time(ts_ns).alias("day_ns"),
        F.col("sample.value").alias("value"),
        F.col("sample.status").alias("status"),
        F.lit(kind).alias("kind"),
    )


def drop_zero_interval(packets: DataFrame) -> DataFrame:
    """Periodic blocks without a positive interval have no time axis and are ignored."""
    return packets.where(F.col("interval_ns") > 0)


def explode_periodic(packets: DataFrame) -> DataFrame:
    """Fixed-rate block to samples: sample ``i`` is taken at ``start + i * interval``."""
    carried = _carried(packets, "params", "columns", "start_ns")
    columns = packets.select(
        *carried, "start_ns", F.explode(F.arrays_zip("params", "columns")).alias("c")
    ).select(*carried, "start_ns", F.col("c.params").alias("parameter"), "c.columns")
    samples = columns.select(
        *carried, "start_ns", "parameter", F.posexplode("columns").alias("i", "sample")
    )
    return _samples(samples, carried, F.col("start_ns") + F.col("interval_ns") * F.col("i"), "Periodic")


def explode_rows(packets: DataFrame) -> DataFrame:
    """Row block to samples: row ``i`` has timestamp ``i``, value ``j`` belongs to parameter ``j``."""
    carried = _carried(packets, "params", "timestamps", "rows")
    rows = packets.select(
        *carried, "params", F.explode(F.arrays_zip("timestamps", "rows")).alias("r")
    ).select(*carried, "params", F.col("r.timestamps").alias("row_ns"), F.col("r.rows").alias("row"))
    values = rows.select(
        *carried, "row_ns", F.explode(F.arrays_zip("params", "row")).alias("v")
    ).select(
        *carried, "row_ns", F.col("v.params").alias("parameter"), F.col("v.row").alias("sample")
    )
    # A row that carries no readable list contributes nothing.
    return _samples(values.where(F.col("sample").isNotNull()), carried, F.col("row_ns"), "Row")


def explode_synchro(packets: DataFrame) -> DataFrame:
    """Variable-rate block to samples: sample ``i`` is taken after the first ``i`` intervals.

    A column fits when it has as many samples as intervals, or one more; others are left out
    (``misfit_synchro`` lists them).
    """
    carried = _carried(packets, "params", "columns", "start_ns", "intervals")
    times = packets.withColumn("times", prefix_sums("start_ns", "intervals"))
    columns = times.select(
        *carried, "times", F.explode(F.arrays_zip("params", "columns")).alias("c")
    ).select(*carried, "times", F.col("c.params").alias("parameter"), F.col("c.columns").alias("values"))
    samples = columns.where(fits_intervals(F.size("values"), F.size("times") - 1)).select(
        *carried, "parameter", F.explode(F.arrays_zip("times", "values")).alias("t")
    ).select(
        *carried, "parameter", F.col("t.times").alias("at_ns"), F.col("t.values").alias("sample")
    )
    return _samples(samples.where(F.col("sample").isNotNull()), carried, F.col("at_ns"), "Synchro")


def fits_intervals(n_samples: Column, n_intervals: Column) -> Column:
    """Whether a variable-rate column has as many samples as intervals, or one more."""
    return (n_samples == n_intervals) | (n_samples == n_intervals + 1)


def misfit_synchro(packets: DataFrame) -> DataFrame:
    """Variable-rate columns whose length does not match their intervals."""
    carried = _carried(packets, "params", "columns", "start_ns", "intervals")
    columns = packets.select(
        *carried, "intervals", F.explode(F.arrays_zip("params", "columns")).alias("c")
    )
    n_samples, n_intervals = F.size("c.columns"), F.size("intervals")
    return columns.where(
        F.col("c.columns").isNull() | ~fits_intervals(n_samples, n_intervals)
    ).select(
        *carried,
        F.col("c.params").alias("parameter"),
        n_samples.alias("n_samples"),
        n_intervals.alias("n_intervals"),
    )


def synchro_delta_scale(packets: DataFrame) -> DataFrame:
    """Greatest common divisor of a block's intervals, and the intervals in that unit.

    Both are null for a block whose intervals are all zero or missing.
    """
    return packets.withColumn("delta_scale", gcd_of("intervals")).withColumn(
        "scaled", in_units("intervals", "delta_scale")
    )


def widen_samples(packets: DataFrame, lists: str) -> DataFrame:
    """Turn the typed sample lists of a block (``columns`` or ``rows``) into wide ones.

    A text or empty list becomes null, and the explode operators then skip it.
    """
    return packets.withColumn(lists, F.transform(lists, widen_list))


def unreadable_lists(packets: DataFrame, lists: str) -> DataFrame:
    """The typed lists that ``widen_samples`` cannot turn into numbers, one row each."""
    carried = _carried(packets, "params", "columns", "rows", "timestamps", "intervals")
    return (
        packets.select(*carried, F.posexplode(lists).alias("list_no", "list"))
        .withColumn("list_kind", sample_kind("list"))
        .where(F.col("list_kind").isin("string", "none"))
        .drop("list")
    )


def null_invalid_samples(samples: DataFrame) -> DataFrame:
    """The value of a sample whose status is not valid becomes NaN."""
    return samples.withColumn(
        "value", F.when(F.col("status") == "VALID", F.col("value")).otherwise(F.lit(float("nan")))
    )


def can_frames(packets: DataFrame) -> DataFrame:
    """Raw CAN frames: direction 0 for transmit and 1 for anything else, bus as 16 bits."""
    return packets.select(
        *_carried(packets, "bus", "can_type", "payload", "ts_ns"),
        F.col("ts_ns"),
        day_time("ts_ns").alias("day_ns"),
        (F.col("bus") % 65536).cast("int").alias("bus"),
        F.when(F.col("can_type") == "TRANSMIT", 0).otherwise(1).cast("smallint").alias("direction"),
        F.col("payload"),
        (F.length("payload") == 0).alias("empty_payload"),
    )
