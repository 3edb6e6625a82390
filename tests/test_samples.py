from __future__ import annotations

from math import isnan

from pyspark.sql import functions as F

from checks.fixtures import frame, periodic_blocks, row_blocks, typed_row_blocks
from stintlog.functions.lists import gcd_of
from stintlog.operators import samples as sm
from stintlog.plans.recording import sample_report

SF = "/root/testdata/sf0.001"
V = "array<struct<value: double, status: string>>"


def test_periodic_counts_and_times(spark):
    blocks = periodic_blocks(frame(spark, SF, "periodic"))
    sizes = blocks.select(F.expr("aggregate(columns, 0L, (a, c) -> a + size(c))").alias("n"))
    samples = sm.explode_periodic(blocks)
    assert samples.count() == sizes.agg(F.sum("n")).first()[0]
    by_hand = spark.createDataFrame(
        [("S", 100, 7, ["a", "b"], [[(1.0, "VALID"), (2.0, "BAD")], [(3.0, "VALID")]])],
        f"session_key string, start_ns bigint, interval_ns bigint, params array<string>, columns array<{V}>",
    )
    rows = sm.explode_periodic(by_hand).select("parameter", "ts_ns", "value", "status").collect()
    assert sorted(tuple(r) for r in rows) == [
        ("a", 100, 1.0, "VALID"), ("a", 107, 2.0, "BAD"), ("b", 100, 3.0, "VALID"),
    ]


def test_zero_interval(spark):
    blocks = spark.createDataFrame([(0,), (5,)], "interval_ns bigint")
    assert [r.interval_ns for r in sm.drop_zero_interval(blocks).collect()] == [5]


def test_rows_readable_plus_unreadable_is_input(spark):
    blocks = typed_row_blocks(frame(spark, SF, "rows"))
    n_lists = blocks.select(F.explode("rows")).count()
    readable = sm.explode_rows(sm.widen_samples(blocks, "rows")).count() / 4
    assert readable + sm.unreadable_lists(blocks, "rows").count() == n_lists


def test_widen(spark):
    typed = (
        "double_samples array<struct<value: double, status: string>>, int32_samples array<struct<value: int, status: string>>,"
        " bool_samples array<struct<value: boolean, status: string>>, string_samples array<struct<value: string, status: string>>"
    )
    lists = [([(1.5, "V")], None, None, None), (None, [(2, "V")], None, None), (None, None, [(True, "V"), (False, "X")], None),
             (None, None, None, [("t", "V")]), (None, None, None, None)]
    blocks = spark.createDataFrame([(1, lists)], f"pkt_offset bigint, columns array<struct<{typed.replace(' array', ': array')}>>")
    wide = sm.widen_samples(blocks, "columns").first()["columns"]
    assert [None if c is None else [tuple(s) for s in c] for c in wide] == [
        [(1.5, "V")], [(2.0, "V")], [(1.0, "V"), (0.0, "X")], None, None,
    ]
    rejects = sm.unreadable_lists(blocks, "columns").select("list_no", "list_kind").collect()
    assert [tuple(r) for r in rejects] == [(3, "string"), (4, "none")]


def test_synchro_widths(spark):
    def block(n_samples):
        return ("S", 0, [5, 1], ["p"], [[(float(i), "VALID") for i in range(n_samples)]])

    blocks = spark.createDataFrame(
        [block(n) for n in range(5)],
        f"session_key string, start_ns bigint, intervals array<bigint>, params array<string>, columns array<{V}>",
    )
    rows = sm.explode_synchro(blocks).select("ts_ns", "value").collect()
    assert sorted(tuple(r) for r in rows) == [(0, 0.0), (0, 0.0), (5, 1.0), (5, 1.0), (6, 2.0)]
    assert sorted(r.n_samples for r in sm.misfit_synchro(blocks).collect()) == [0, 1, 4]


def test_invalid_becomes_nan(spark):
    samples = spark.createDataFrame([(1.0, "VALID"), (2.0, "INVALID")], "value double, status string")
    good, bad = (r.value for r in sm.null_invalid_samples(samples).orderBy("status", ascending=False).collect())
    assert good == 1.0 and isnan(bad)


def test_can_direction(spark):
    frames = spark.createDataFrame(
        [(1, 65537, "TRANSMIT", bytearray(b"")), (2, 3, "RECEIVE", bytearray(b"x")), (3, 3, "UNSPECIFIED", None)],
        "ts_ns bigint, bus bigint, can_type string, payload binary",
    )
    rows = sm.can_frames(frames).orderBy("ts_ns").select("bus", "direction", "empty_payload").collect()
    assert [tuple(r) for r in rows] == [(1, 0, True), (3, 1, False), (3, 1, None)]


def test_means_are_plain_averages(spark):
    rows = [("k", 1000000.0000004), ("k", 1000000.0000004), ("big", 1e300), ("big", 0.0)]
    samples = spark.createDataFrame(rows, "parameter string, value double").selectExpr("'S' as session_key", "*", "'VALID' as status")
    means = {r.parameter: r.mean_value for r in sample_report(samples).collect()}
    assert means == {"k": 1000000.0000004, "big": 5e299}


def test_divisor_of_64_bit_numbers(spark):
    a, b = 4660046610375530309, 2880067194370816120  # neighbours in Fibonacci's row, the slowest pair
    found = spark.createDataFrame([([a, b],), ([6 * 10**18, 9 * 10**17],)], "v array<bigint>").select(gcd_of("v").alias("g")).collect()
    assert [r.g for r in found] == [1, 3 * 10**17]
