"""Running results over an ordered group, without one task holding a whole group.

A plain window partitions by key, so a key with a third of all rows lands in one task. Here
the group is cut into buckets of consecutive rows: each bucket is reduced to one row, a small
window carries the result from bucket to bucket, and the row-level window runs per bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Consecutive offsets per bucket.
BUCKET_SPAN = 1 << 20


def _before(keys: Sequence[str], order: Sequence[Column | str]) -> Window:
    """All rows of the group before the current one."""
    return (
        Window.partitionBy(*keys)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    bucket: Column,
    order: Sequence[Column | str],
    name: str = "position",
) -> DataFrame:
    """Add the 1-based position of each row among the rows of its key.

    ``bucket`` must not decrease along ``order``; key and bucket columns must not be null.
    """
    keys = list(keys)
    rows = df.withColumn("_bucket", bucket)
    sizes = rows.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    starts = sizes.select(
        *keys,
        "_bucket",
        F.coalesce(F.sum("_size").over(_before(keys, ["_bucket"])), F.lit(0)).alias("_start"),
    )
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    return (
        rows.withColumn("_inside", F.row_number().over(inside))
        .join(starts, [*keys, "_bucket"])
        .withColumn(name, F.col("_start") + F.col("_inside"))
        .drop("_bucket", "_start", "_inside")
    )


def max_before(
    df: DataFrame,
    keys: Sequence[str],
    bucket: Column,
    order: Sequence[Column | str],
    value: str,
    name: str,
) -> DataFrame:
    """Add the largest ``value`` among the earlier rows of the key (null on the first row)."""
    keys = list(keys)
    rows = df.withColumn("_bucket", bucket)
    tops = rows.groupBy(*keys, "_bucket").agg(F.max(value).alias("_top"))
    carried = tops.select(
        *keys, "_bucket", F.max("_top").over(_before(keys, ["_bucket"])).alias("_carried")
    )
    return (
        rows.withColumn("_inside", F.max(value).over(_before([*keys, "_bucket"], order)))
        .join(carried, [*keys, "_bucket"])
        .withColumn(name, F.greatest("_carried", "_inside"))
        .drop("_bucket", "_carried", "_inside")
    )
