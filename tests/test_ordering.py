from __future__ import annotations

import random

from pyspark.sql import Window, functions as F

from stintlog.functions.times import int_div
from stintlog.operators.ordering import max_before, number_rows


def rows(spark):
    rng = random.Random(1)
    data = [("hot" if rng.random() < 0.6 else f"k{rng.randrange(5)}", i * 3, rng.randrange(1000)) for i in range(2000)]
    rng.shuffle(data)
    return spark.createDataFrame(data, "key string, at bigint, value int")


def test_positions_equal_row_number(spark):
    df = rows(spark)
    got = number_rows(df, ["key"], int_div("at", 100), ["at"])
    want = df.withColumn("position", F.row_number().over(Window.partitionBy("key").orderBy("at")).cast("bigint"))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_positions_without_key(spark):
    df = rows(spark)
    got = number_rows(df, [], int_div("at", 100), ["at"])
    assert [r.position for r in got.orderBy("at").collect()] == list(range(1, 2001))


def test_max_before_equals_window(spark):
    df = rows(spark)
    got = max_before(df, ["key"], int_div("at", 100), ["at"], "value", "top")
    before = Window.partitionBy("key").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("top", F.max("value").over(before))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
