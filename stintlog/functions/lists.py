"""Array expressions over sample lists and intervals."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from stintlog.functions.times import as_column
from stintlog.schemas import WIDE_SAMPLES

# Elements per run of a prefix sum.
RUN = 32

# Euclid's algorithm on two positive 64-bit numbers ends within this many steps.
EUCLID_STEPS = 92


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once.

    A lambda that mentions an outer expression computes it again for every element.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running(start: Column, steps: Column) -> Column:
    """``[start, start + s0, start + s0 + s1, ...]`` of a short list; copies quadratically."""
    return F.aggregate(
        steps, F.array(start), lambda acc, step: F.concat(acc, F.array(F.element_at(acc, -1) + step))
    )


def prefix_sums(start: Column | str, intervals: Column | str) -> Column:
    """``[start, start + i0, start + i0 + i1, ...]``: one element more than ``intervals``.

    Sums run inside short runs first, then over the totals of the runs.
    """
    start, intervals = as_column(start).cast("bigint"), as_column(intervals).cast("array<bigint>")
    last_run = F.call_function("div", F.size(intervals) - 1, F.lit(RUN)).cast("int")
    runs = F.transform(
        F.sequence(F.lit(0), last_run), lambda r: F.slice(intervals, r * RUN + 1, RUN)
    )

    def joined(sums: Column) -> Column:
        bases = _running(start, F.transform(sums, lambda run: F.element_at(run, -1)))
        pairs = F.arrays_zip(sums.alias("sums"), bases.alias("base"))
        # The last base is the end of the last run and has no run of its own.
        shifted = F.transform(
            F.slice(pairs, 1, F.size(sums)),
            lambda p: F.transform(
                F.slice(p["sums"], 2, F.size(p["sums"])), lambda offset: offset + p["base"]
            ),
        )
        return F.concat(F.array(start), F.flatten(shifted))

    zero = F.lit(0).cast("bigint")
    sums = F.transform(runs, lambda run: _running(zero, run))
    return F.when(F.size(intervals) > 0, _bound(sums, joined)).otherwise(F.array(start))


def _gcd(a: Column, b: Column) -> Column:
    last = F.aggregate(
        F.sequence(F.lit(1), F.lit(EUCLID_STEPS)),
        F.struct(a.alias("a"), b.alias("b")),
        lambda p, _: F.when(p["b"] == 0, p).otherwise(
            F.struct(p["b"].alias("a"), (p["a"] % p["b"]).alias("b"))
        ),
    )
    return last["a"]


def gcd_of(values: Column | str) -> Column:
    """Greatest common divisor of a list of numbers from 0 to 2^63 - 1; null if all are 0 or none.

    A value that the divisor so far divides leaves it as it is; Euclid runs for the others only.
    """
    divisor = F.aggregate(
        as_column(values).cast("array<bigint>"),
        F.lit(0).cast("bigint"),
        lambda acc, v: F.when(acc == 0, v).when(v % acc == 0, acc).otherwise(_gcd(acc, v)),
    )
    return F.nullif(divisor, F.lit(0).cast("bigint"))


def in_units(values: Column | str, unit: Column | str) -> Column:
    """Whole multiples of ``unit``; null where the unit is."""
    values, unit = as_column(values), as_column(unit)
    scaled = _bound(
        unit, lambda u: F.transform(values, lambda v: F.call_function("div", v, u))
    )
    return F.when(unit.isNotNull(), scaled)


def widen_list(samples: Column | str) -> Column:
    """A typed sample list as ``array<struct<value double, status string>>``.

    Integers and booleans become doubles. Text cannot; such a list, like an empty one, is null.
    """
    samples = as_column(samples)
    return F.coalesce(
        samples["double_samples"],
        samples["int32_samples"].cast(WIDE_SAMPLES),
        samples["bool_samples"].cast(WIDE_SAMPLES),
    )


def sample_kind(samples: Column | str) -> Column:
    """Which list a typed sample list carries: double, int, bool, string or none."""
    samples = as_column(samples)
    return (
        F.when(samples["double_samples"].isNotNull(), "double")
        .when(samples["int32_samples"].isNotNull(), "int")
        .when(samples["bool_samples"].isNotNull(), "bool")
        .when(samples["string_samples"].isNotNull(), "string")
        .otherwise("none")
    )
