"""Which folders of a table are live: one small file a version, the highest one counts.

A change writes its folders aside and becomes live by one rename, so a crash in between changes
nothing. Spark reads no file or folder whose name starts with an underscore unless it is told to.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

_NAME = "_manifest-{:08d}.json"


def _folder(spark: SparkSession, name: str):
    """A folder as a Hadoop path, and its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    path, fs = _folder(spark, folder)
    return [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []


def delete(spark: SparkSession, name: str) -> None:
    path, fs = _folder(spark, name)
    fs.delete(path, True)


def current(spark: SparkSession, folder: str) -> dict | None:
    """The manifest that counts, with its ``version``; none if nothing was published."""
    versions = sorted(n for n in names(spark, folder) if n.startswith("_manifest-") and n.endswith(".json"))
    if not versions:
        return None
    path, fs = _folder(spark, f"{folder}/{versions[-1]}")
    stream = fs.open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def publish(spark: SparkSession, folder: str, manifest: dict) -> bool:
    """Make a manifest current; false if its version exists already."""
    target, fs = _folder(spark, f"{folder}/{_NAME.format(manifest['version'])}")
    draft, _ = _folder(spark, f"{folder}/_draft-{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    stream.write(bytearray(json.dumps(manifest).encode()))
    stream.close()
    if not fs.exists(target) and fs.rename(draft, target):
        return True
    fs.delete(draft, False)
    return False
