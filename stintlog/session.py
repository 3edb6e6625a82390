"""Session settings and the shared folder that jobs may write work files to."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every operator relies on. All are runtime SQL settings, so they can be applied
# to a session somebody else created.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # A lookup is broadcast only when its measured size is under autoBroadcastJoinThreshold;
    # past it Spark sort-merges, and these let it split the hot keys of that join.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Session windows of a stream are merged in each task before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the cluster's ``spark.checkpoint.dir``.

    Where that is unset, the warehouse folder is used: driver and executors share it as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or (
        spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/work"
    )
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write an intermediate result that several branches of a plan read, and read it back.

    The branches then share one computation, and a lost executor repeats only the reading.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
