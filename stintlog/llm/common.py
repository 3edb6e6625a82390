"""Helpers shared by the operators: work tables, document columns, state of a Python worker."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Built = TypeVar("Built")

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, removed when the driver's JVM ends.

    Where the setting is missing, as in tests, the warehouse folder takes its place: it is
    shared by driver and executors as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or (
        spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/work"
    )
    folder = f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    This cuts the lineage: a lost executor costs a read, and every later use sees the same rows.
    """
    return written_at(df, work_folder(df.sparkSession, purpose))


def written_at(df: DataFrame, folder: str) -> DataFrame:
    """The same in a folder that the caller removes once all that reads it is written itself."""
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def remove(spark: SparkSession, *folders: str) -> None:
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ascii_lower(text: Column) -> Column:
    """Lower-case A to Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns that operators read, so that no extra column can clash; null text is ''."""
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
    )


def per_worker(key: tuple, build: Callable[[], Built]) -> Built:
    """What ``build`` returns, made once in each Python worker and kept between its tasks.

    Functions travel by value, so a module's own globals would start anew with every task. Only
    the latest is kept: the next operator's tasks run in the same workers and need the memory.
    """
    import pyspark

    kept = pyspark.__dict__.setdefault("_kept_between_tasks", {})
    if key not in kept:
        kept.clear()
        kept[key] = build()
    return kept[key]
