"""Registries: stored tables that give each key a lasting id, shared by micro-batches and writers.

Ids are created in versions. A writer reads the newest version, writes the keys it misses aside and
publishes the next version by one rename; if another writer was quicker, it reads again and numbers
what is still missing. So a key never gets two ids and an id never two keys, whoever writes, and a
micro-batch that runs once more finds its keys there. On a file system whose rename replaces
files, such as a local one, writers must take turns.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from stintlog.operators.definitions import CHANNEL_KEYS, channel_keys, new_channels
from stintlog.operators.formats import register_event_format, register_parameter_format
from stintlog.schemas import LONG, TEXT, record
from stintlog.sources import manifest

# Parts of a registry before they are merged into one.
MAX_PARTS = 32

# What a format id stands for, and how ids of that kind are created.
_FORMATS = {"parameter": ("params", register_parameter_format), "event": ("event_identifier", register_event_format)}

CHANNELS = T.StructType([*(T.StructField(c, LONG if c == "channel_interval" else TEXT) for c in CHANNEL_KEYS), T.StructField("channel_id", LONG)])


def _read(spark: SparkSession, path: str, parts: Sequence[str], schema: T.StructType) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{part}" for part in parts])


def entries(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All keys of a registry with their ids, as of now; none before the first."""
    return _read(spark, path, (manifest.current(spark, path) or {"parts": []})["parts"], schema)


def create_missing(
    spark: SparkSession, path: str, schema: T.StructType, missing: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """All keys of a registry, after those that ``missing`` makes of the known ones were added.

    Parts gather up to ``MAX_PARTS`` and are then merged; what a merge replaced is removed by the next.
    """
    while True:
        now = manifest.current(spark, path) or {"version": 0, "parts": [], "replaced": []}
        known = _read(spark, path, now["parts"], schema)
        part = f"_part-{uuid.uuid4().hex}"
        missing(known).select(schema.names).write.parquet(f"{path}/{part}")
        if _read(spark, path, [part], schema).isEmpty():
            manifest.delete(spark, f"{path}/{part}")
            return known
        then = {"version": now["version"] + 1, "parts": [*now["parts"], part], "replaced": now["replaced"]}
        if len(then["parts"]) > MAX_PARTS:
            merged = f"_part-{uuid.uuid4().hex}"
            _read(spark, path, then["parts"], schema).hint("rebalance").write.parquet(f"{path}/{merged}")
            then |= {"parts": [merged], "replaced": then["parts"]}
        if manifest.publish(spark, path, then):
            if then["replaced"] != now["replaced"]:
                for old in now["replaced"]:
                    manifest.delete(spark, f"{path}/{old}")
            return _read(spark, path, then["parts"], schema)
        for mine in {part, *then["parts"]} - set(now["parts"]):
            manifest.delete(spark, f"{path}/{mine}")


def format_schema(by: Sequence[str] = ()) -> T.StructType:
    return T.StructType([
        *(T.StructField(c, TEXT) for c in by),
        *record(kind=TEXT, format_id=LONG, params=T.ArrayType(TEXT), event_identifier=TEXT),
    ])


def known_formats(spark: SparkSession, path: str, by: Sequence[str] = ()) -> DataFrame:
    """The formats of a registry, in the shape that ``resolve_parameter_list`` and ``resolve_event`` take."""
    return entries(spark, path, format_schema(by))


def register_formats(spark: SparkSession, path: str, seen: DataFrame, kind: str, by: Sequence[str] = ()) -> DataFrame:
    """The formats of a registry after those of ``seen`` were added: its parameter lists or event names.

    ``kind`` is ``parameter`` or ``event``; ids count over both, separately for the ``by`` columns, and
    follow the order of first appearance within a call. For a micro-batch, call it in ``foreachBatch``.
    """
    key, register = _FORMATS[kind]

    def missing(known: DataFrame) -> DataFrame:
        created = register(seen, known, by).where("is_new").withColumn("kind", F.lit(kind))
        other = "event_identifier" if kind == "parameter" else "params"
        return created.withColumn(other, F.lit(None).cast(format_schema()[other].dataType))

    return create_missing(spark, path, format_schema(by), missing)


def register_channels(spark: SparkSession, path: str, parameters: DataFrame) -> DataFrame:
    """The channels of ``parameters`` (see ``assign_channels``), created in a registry where new."""
    known = create_missing(spark, path, CHANNELS, lambda known: new_channels(parameters, known))
    return known.join(channel_keys(parameters), list(CHANNEL_KEYS), "left_semi")
