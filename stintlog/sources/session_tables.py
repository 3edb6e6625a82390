"""Session tables: one Parquet table per kind of record, clustered by session."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession, functions as F

from stintlog.sources import manifest

# Folders per table. A fixed number holds any number of sessions, and rows are sorted by
# session inside, so one session is found by folder and by row-group statistics.
SESSION_BUCKETS = 64
BUCKET = "session_bucket"
BATCH = "batch"
# Columns that only say where a record is stored.
LAYOUT = (BUCKET, BATCH)


def session_bucket(session_key: Column) -> Column:
    return F.pmod(F.xxhash64(session_key), F.lit(SESSION_BUCKETS)).cast("int")


def write_session_tables(tables: Mapping[str, DataFrame], path: str) -> None:
    """Write each kind's records to its own table below ``path``, replacing it.

    The rebalance gives each folder to few tasks, and an oversized folder to several.
    """
    for kind, records in tables.items():
        _clustered(records).mode("overwrite").parquet(f"{path}/{kind}")


def _clustered(records: DataFrame) -> DataFrameWriter:
    return (
        records.withColumn(BUCKET, session_bucket(F.col("session_key")))
        .hint("rebalance", BUCKET)
        .sortWithinPartitions(BUCKET, "session_key")
        .write.partitionBy(BUCKET)
    )


def write_batch(tables: Mapping[str, DataFrame], path: str, batch_id: int) -> None:
    """Add a micro-batch to each kind's table, as a folder of its own.

    A repeated batch replaces its folder, so a retry after a failure leaves no duplicates. The
    batch is written where it was computed, without a shuffle; ``compact_table`` clusters what has
    gathered by session.
    """
    for kind, records in tables.items():
        (
            records.sortWithinPartitions("session_key")
            .write.mode("overwrite")
            .parquet(f"{path}/{kind}/batch={batch_id}")
        )


# A kind's manifest: version, merged folder, the last batch in it, folders it replaced.
_EMPTY = {"version": 0, "merged": None, "upto": -1, "replaced": []}
_MERGED = "_merged-"


def _batches(spark: SparkSession, folder: str, after: int) -> list[int]:
    """Finished micro-batches after the given one; one that is being written has no mark of success."""
    found = sorted(int(n.split("=")[1]) for n in manifest.names(spark, folder) if n.startswith("batch="))
    return [b for b in found if b > after and "_SUCCESS" in manifest.names(spark, f"{folder}/batch={b}")]


def _parts(spark: SparkSession, path: str, kind: str) -> list[DataFrame]:
    """The live parts of a kind's table: the clustered one, if there is one, and newer micro-batches."""
    folder = f"{path}/{kind}"
    now = manifest.current(spark, folder) or _EMPTY
    if not now["version"]:
        return [spark.read.parquet(folder)]
    parts = [spark.read.parquet(f"{folder}/{now['merged']}")]
    newer = _batches(spark, folder, now["upto"])
    if newer:
        parts.append(spark.read.option("basePath", folder).parquet(*[f"{folder}/batch={b}" for b in newer]))
    return parts


def compact_table(spark: SparkSession, path: str, kind: str, final: bool = False) -> bool:
    """Merge a kind's finished micro-batches into its clustered part, while streams and readers go on.

    The newest micro-batch stays as it is, since a stream may write it once more after a failure; with
    ``final`` (no stream writes any more) it is merged too. The merged folder is written aside and
    becomes live by one rename of a manifest, so a crash in between loses and doubles nothing. What it
    replaces is removed by the next call, so that readers of the old state can finish. Returns whether
    anything was merged; also false if another call was quicker.
    """
    folder = f"{path}/{kind}"
    now = manifest.current(spark, folder) or _EMPTY
    batches = _batches(spark, folder, now["upto"])
    batches = batches if final else batches[:-1]
    for name in now["replaced"]:
        manifest.delete(spark, f"{folder}/{name}")
    if not batches:
        return False
    records = spark.read.option("basePath", folder).parquet(*[f"{folder}/batch={b}" for b in batches]).drop(*LAYOUT)
    if now["merged"]:
        records = records.unionByName(spark.read.parquet(f"{folder}/{now['merged']}").drop(*LAYOUT), allowMissingColumns=True)
    merged = f"{_MERGED}{uuid.uuid4().hex}"
    _clustered(records).parquet(f"{folder}/{merged}")
    replaced = [*([now["merged"]] if now["merged"] else []), *(f"batch={b}" for b in batches)]
    then = {"version": now["version"] + 1, "merged": merged, "upto": batches[-1], "replaced": replaced}
    if manifest.publish(spark, folder, then):
        return True
    manifest.delete(spark, f"{folder}/{merged}")
    return False


def load_session(spark: SparkSession, path: str, kind: str, session_key: str) -> DataFrame:
    """Records of one kind of one stored session.

    Reads only the session's folder of a clustered table, and row groups that may hold it; of a
    compacted table also the micro-batches that came since.
    """
    found = []
    for part in _parts(spark, path, kind):
        if BUCKET in part.columns:
            part = part.where(F.col(BUCKET) == session_bucket(F.lit(session_key)))
        found.append(part.where(F.col("session_key") == session_key).drop(*LAYOUT))
    return reduce(partial(DataFrame.unionByName, allowMissingColumns=True), found)


def load_table(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """All records of a kind; columns of ``LAYOUT`` say where a record is stored."""
    return reduce(partial(DataFrame.unionByName, allowMissingColumns=True), _parts(spark, path, kind))
