"""Tables written by micro-batches whose number of folders stays bounded.

Each micro-batch writes its own folder below `<table>/recent`, named by its id, so a retried one replaces itself.
Folders of closed batches, which cannot be retried any more, are merged into segments: `FAN` folders into one of
level 0, and `FAN` segments of a level into one of the next, so each row is rewritten once per level. The log
(sinks.publish) says up to which batch the segments go; a reader takes them and the recent folders after that
batch. What a merge replaced is deleted by the next merge, so a reader that began before can finish.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tallybank.sinks import publish
from tallybank.sinks.tables import overwrite_partitions, write_partitioned

FAN = 10
BATCH = "batch_id"
EMPTY = {"version": 0, "through": -1, "segments": [], "replaced": []}

Reduce = Callable[[DataFrame], DataFrame]


def write_recent(batch: DataFrame, batch_id: int, table: str, by: Sequence[str] = ()) -> None:
    """The rows of one micro-batch, optionally partitioned further; the same id replaces its folder."""
    overwrite_partitions(batch.withColumn(BATCH, F.lit(batch_id).cast("long")), f"{table}/recent", [BATCH, *by])


def read_batches(spark: SparkSession, table: str, schema: StructType, by: Sequence[str] = ()) -> DataFrame:
    """All rows with the number of their batch; `schema` is that of the batches."""
    state = publish.latest(spark, table) or EMPTY
    whole = _with_batch(schema, by)
    recent = _recent(spark, table, whole, state["through"])
    segments = [spark.read.schema(whole).parquet(s["path"]).select(*whole.names) for s in state["segments"]]
    return reduce(DataFrame.unionByName, segments, recent)


def merge_closed(
    spark: SparkSession,
    table: str,
    batch_id: int,
    schema: StructType,
    by: Sequence[str] = (),
    reduced: Reduce | None = None,
    fan: int = FAN,
) -> bool:
    """Called while batch `batch_id` runs: merge the batches before it once there are `fan` of them.

    `reduced` may drop rows that later ones of the same merge replace. Nothing happens to the current batch.
    """
    state = publish.latest(spark, table) or EMPTY
    through = batch_id - 1
    if through - state["through"] < fan:
        return False
    whole = _with_batch(schema, by)
    closed = _recent(spark, table, whole, state["through"]).filter(F.col(BATCH) <= through)
    folders = [f"{table}/recent/{BATCH}={k}" for k in range(state["through"] + 1, through + 1)]
    segments, replaced = [*state["segments"], _write(closed, table, 0, by, reduced)], folders
    level = 0
    while len(same := [s for s in segments if s["level"] == level]) >= fan:
        frames = [spark.read.schema(whole).parquet(s["path"]).select(*whole.names) for s in same]
        merged = _write(reduce(DataFrame.unionByName, frames), table, level + 1, by, reduced)
        replaced += [s["path"] for s in same]
        segments = [s for s in segments if s["level"] != level] + [merged]
        level += 1
    new = {"version": state["version"] + 1, "through": through, "segments": segments, "replaced": replaced}
    publish.delete(spark, state["replaced"])
    publish.publish(spark, table, new)
    return True


def _with_batch(schema: StructType, by: Sequence[str]) -> StructType:
    """Partition columns come last, as Spark reads them."""
    fields = [f for f in schema.fields if f.name != BATCH and f.name not in by]
    return StructType([*fields, StructField(BATCH, LongType()), *[schema[c] for c in by]])


def _recent(spark: SparkSession, table: str, whole: StructType, through: int) -> DataFrame:
    publish.make_folder(spark, f"{table}/recent")
    return spark.read.schema(whole).parquet(f"{table}/recent").select(*whole.names).filter(F.col(BATCH) > through)


def _write(rows: DataFrame, table: str, level: int, by: Sequence[str], reduced: Reduce | None) -> dict:
    path = f"{table}/merged/{level}-{uuid.uuid4().hex}"
    rows = reduced(rows) if reduced else rows
    if by:
        write_partitioned(rows, path, by)
    else:
        rows.write.parquet(path)
    return {"level": level, "path": path}
