from __future__ import annotations

from math import gcd
from functools import reduce

import pytest
from pyspark.sql import functions as F

from stintlog.functions import lists, names, times
from stintlog.operators import samples as sm


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_day_time(spark):
    assert value(spark, times.day_time(F.lit(86_400_000_000_001))) == 1


def test_to_timestamp_keeps_microseconds(spark):
    ts = times.to_timestamp(F.lit(1_704_067_200_123_456_789))
    assert value(spark, F.unix_micros(ts)) == 1_704_067_200_123_456


@pytest.mark.parametrize(
    ("identifier", "expected"),
    [("a:b", ("a", "b")), ("a", ("a", "StreamAPI")), ("a:b:c", ("a", "StreamAPI"))],
)
def test_parse_identifier(spark, identifier, expected):
    assert tuple(value(spark, names.parse_identifier(F.lit(identifier)))) == expected


def test_full_identifier(spark):
    assert value(spark, names.full_identifier(F.lit("a"))) == "a:StreamAPI"
    assert value(spark, names.full_identifier(F.lit("a:b"))) == "a:b"


@pytest.mark.parametrize(
    ("name", "expected"),
    [("RowDataPacket", "RowData"), ("PacketPacket", "Packet"), ("Marker", "Marker")],
)
def test_packet_type_name(spark, name, expected):
    assert value(spark, names.packet_type_name(F.lit(name))) == expected


@pytest.mark.parametrize(("text", "expected"), [("1F0", 496), ("ff", 255), ("Lap", None), ("", None)])
def test_hex_id(spark, text, expected):
    assert value(spark, names.hex_id(F.lit(text))) == expected


@pytest.mark.parametrize(
    ("priority", "expected"),
    [("CRITICAL", "High"), ("HIGH", "High"), ("MEDIUM", "Medium"), ("LOW", "Low"), ("DEBUG", "Debug"),
     ("UNSPECIFIED", "Low"), ("other", None)],
)
def test_event_priority(spark, priority, expected):
    assert value(spark, names.event_priority(F.lit(priority))) == expected


@pytest.mark.parametrize(
    "intervals",
    [[10, 15, 25], [4, 8, 12], [7], [0, 6, 4], [4294967295, 2971215073, 1836311903], [4294967291, 65536, 3]],
)
def test_gcd(spark, intervals):
    column = F.array(*[F.lit(i).cast("bigint") for i in intervals])
    assert value(spark, lists.gcd_of(column)) == reduce(gcd, intervals)


@pytest.mark.parametrize("intervals", [[], [0, 0]])
def test_gcd_of_nothing(spark, intervals):
    column = F.array(*[F.lit(i) for i in intervals]).cast("array<bigint>")
    assert value(spark, lists.gcd_of(column)) is None


def test_delta_scale(spark):
    block = spark.range(1).select(F.array(F.lit(10), F.lit(15), F.lit(25)).cast("array<bigint>").alias("intervals"))
    row = sm.synchro_delta_scale(block).first()
    assert (row.delta_scale, row.scaled) == (5, [2, 3, 5])


@pytest.mark.parametrize("count", [0, 1, 31, 32, 33, 64, 100, 255])
def test_prefix_sums_of_any_length(spark, count):
    steps = [(i * 37) % 11 for i in range(count)]
    column = F.from_json(F.lit(str(steps)), "array<bigint>")
    expected = [100 + sum(steps[:i]) for i in range(count + 1)]
    assert value(spark, lists.prefix_sums(F.lit(100), column)) == expected


def test_prefix_sums(spark):
    steps = F.array(F.lit(5), F.lit(1), F.lit(4)).cast("array<bigint>")
    assert value(spark, lists.prefix_sums(F.lit(100), steps)) == [100, 105, 106, 110]
