"""Time expressions. Nanoseconds stay in 64-bit integers; Spark timestamps hold microseconds."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

NS_PER_DAY = 86_400_000_000_000
NS_PER_SECOND = 1_000_000_000


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def int_div(value: Column | str, divisor: int) -> Column:
    """Exact 64-bit integer division."""
    return F.call_function("div", as_column(value), F.lit(divisor).cast("bigint"))


def day_time(ts_ns: Column | str) -> Column:
    """Nanoseconds since midnight of an epoch time in nanoseconds."""
    return as_column(ts_ns) % F.lit(NS_PER_DAY)


def to_timestamp(ts_ns: Column | str) -> Column:
    """Event time of an epoch time in nanoseconds, cut to microseconds."""
    return F.timestamp_micros(int_div(ts_ns, 1000))
