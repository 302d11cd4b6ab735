"""A stored customer history (SCD2) that change feeds are applied to.

`<base>/data/<version>-<id>` holds what a feed wrote, by is_current: the open versions of all keys, and the
versions that this feed closed. Older closed versions stay in the directories that wrote them, so a feed
rewrites open versions only; when there are many such directories, the next feed merges them. `<base>/log`
says which directories count (see sinks.publish), and `<base>/outcomes` has what became of every change.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallybank.operators.scd2 import changed_versions, judge_changes, known_changes
from tallybank.sinks import publish
from tallybank.sinks.tables import write_partitioned

MERGE_AT = 16


def create_history(spark: SparkSession, base: str, history: DataFrame) -> None:
    """Store a first version."""
    where = _new_directory(base, 1)
    write_partitioned(history, where, ["is_current"])
    state = {"version": 1, "open": where, "closed": [], "feeds": {}, "schema": history.schema.jsonValue()}
    publish.publish(spark, base, state)


def read_history(spark: SparkSession, base: str) -> DataFrame:
    """All versions of all keys, as last published."""
    state = _state(spark, base)
    return _open(spark, state).unionByName(_closed(spark, state))


def read_outcomes(spark: SparkSession, base: str) -> DataFrame:
    """Every different change of all feeds, with its feed, copies and outcome."""
    feeds = _state(spark, base)["feeds"]
    frames = [spark.read.parquet(where).withColumn("feed", F.lit(feed)) for feed, where in sorted(feeds.items())]
    return reduce(DataFrame.unionByName, frames)


def apply_feed(
    spark: SparkSession,
    base: str,
    feed: str,
    changes: DataFrame,
    key: str,
    tracked: Sequence[str],
    sequence: str | None = None,
) -> bool:
    """Apply a change feed once; False if it was applied before, and then nothing is written.

    The new state counts from the moment the log has it. A job that ends before leaves directories that nothing
    refers to, and may run again.
    """
    state = _state(spark, base)
    if feed in state["feeds"]:
        return False
    version = state["version"] + 1
    opened = _open(spark, state)
    untouched = opened.join(known_changes(changes, key).select(key).distinct(), key, "left_anti")
    changed = changed_versions(opened, changes, key, tracked, sequence).select(*opened.columns)
    merge = len(state["closed"]) + 1 >= MERGE_AT
    parts = [untouched.select(*opened.columns), changed, *([_closed(spark, state)] if merge else [])]

    where, outcomes = _new_directory(base, version), f"{base}/outcomes/{version}-{uuid.uuid4().hex}"
    write_partitioned(reduce(DataFrame.unionByName, parts), where, ["is_current"])
    judge_changes(opened, changes, key, tracked, sequence).write.parquet(outcomes)
    older = [] if merge else [*state["closed"], state["open"]]
    feeds = {**state["feeds"], feed: outcomes}
    publish.publish(spark, base, {**state, "version": version, "open": where, "closed": older, "feeds": feeds})
    return True


def _new_directory(base: str, version: int) -> str:
    return f"{base}/data/{version}-{uuid.uuid4().hex}"


def _state(spark: SparkSession, base: str) -> dict:
    state = publish.latest(spark, base)
    if state is None:
        raise FileNotFoundError(f"no history at {base}")
    return state


def _read(spark: SparkSession, state: dict, where: str) -> DataFrame:
    schema = StructType.fromJson(state["schema"])
    return spark.read.schema(schema).parquet(where).select(*schema.names)


def _open(spark: SparkSession, state: dict) -> DataFrame:
    return _read(spark, state, state["open"]).filter("is_current")


def _closed(spark: SparkSession, state: dict) -> DataFrame:
    """Closed versions: those of the last directory and of each older one."""
    frames = [_read(spark, state, where).filter("not is_current") for where in (state["open"], *state["closed"])]
    return reduce(DataFrame.unionByName, frames)
