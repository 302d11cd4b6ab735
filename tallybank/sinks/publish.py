"""Publishing the state of a multi-directory table: a log of small files, one per version.

Data goes to new directories first; a version counts once its log file is there. The file is written under
another name and renamed, so a reader sees the old state or the new one, never half of one, and a job that
ends before the rename leaves the table as it was.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from typing import Any

from pyspark.sql import SparkSession

KEPT = 20


def latest(spark: SparkSession, base: str) -> dict[str, Any] | None:
    """The last published state; None before the first."""
    place, path = _folder(spark, base)
    versions = _versions(place, path)
    if not versions:
        return None
    stream = place.open(_path(spark, f"{base}/log/{max(versions):012d}.json"))
    try:
        return json.loads(bytes(stream.readAllBytes()))
    finally:
        stream.close()


def publish(spark: SparkSession, base: str, state: dict[str, Any]) -> None:
    """Make `state` the current one. `state["version"]` must follow the published one."""
    place, path = _folder(spark, base)
    place.mkdirs(path)
    target = _path(spark, f"{base}/log/{state['version']:012d}.json")
    draft = _path(spark, f"{base}/log/.{uuid.uuid4().hex}")
    stream = place.create(draft, False)
    try:
        stream.write(bytearray(json.dumps(state).encode()))
    finally:
        stream.close()
    if place.exists(target) or state["version"] != max(_versions(place, path), default=0) + 1 or not place.rename(draft, target):
        place.delete(draft, False)
        raise RuntimeError(f"version {state['version']} of {base} was published by another job")
    for version in _versions(place, path):
        if version <= state["version"] - KEPT:
            place.delete(_path(spark, f"{base}/log/{version:012d}.json"), False)


def _folder(spark: SparkSession, base: str):
    path = _path(spark, f"{base}/log")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _path(spark: SparkSession, name: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)


def _versions(place, path) -> list[int]:
    if not place.exists(path):
        return []
    names = [status.getPath().getName() for status in place.listStatus(path)]
    return [int(name[:-5]) for name in names if name.endswith(".json") and not name.startswith(".")]


def make_folder(spark: SparkSession, name: str) -> None:
    path = _path(spark, name)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)


def delete(spark: SparkSession, names: Iterable[str]) -> None:
    """Remove folders that no published state refers to."""
    for path in (_path(spark, name) for name in names):
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
