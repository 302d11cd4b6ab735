"""File layout of partitioned tables and placement of keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybank.sinks.tables import write_partitioned

TOO_MANY_FILES = 8
MAX_DATES = 100_000


def file_stats(spark: SparkSession, path: str, column: str = "event_date", limit: int = TOO_MANY_FILES) -> DataFrame:
    """Files and bytes per partition, from the file listing alone; flags partitions with more than `limit` files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return (
        files.groupBy(column)
        .agg(F.count(F.lit(1)).alias("file_count"), F.sum("length").alias("total_bytes"))
        .withColumn("has_small_files", F.col("file_count") > limit)
    )


def compact(
    spark: SparkSession,
    src: str,
    dst: str,
    files_per_date: int = 4,
    column: str = "event_date",
    target_bytes: int | None = None,
    max_records: int | None = None,
) -> None:
    """Rewrite a partitioned table with exactly `files_per_date` files per date.

    With `target_bytes` the number of files of a date follows its size instead, so that one date with a
    large share of the table is written by as many tasks. Hash partitioning would put several dates into
    one task; here each (date, file) pair gets its own partition id. `max_records` caps the rows per file.
    """
    table = spark.read.parquet(src)
    files = F.lit(files_per_date) if target_bytes is None else F.ceil(F.col("total_bytes") / target_bytes)
    # One row per date, from the file listing: small however large the table is.
    dates = file_stats(spark, src, column).select(
        F.col(column).cast(table.schema[column].dataType).alias("_date"), files.cast("int").alias("_files")
    )
    earlier = Window.orderBy("_date").rowsBetween(Window.unboundedPreceding, -1)
    numbered = dates.withColumn("_first", F.coalesce(F.sum("_files").over(earlier), F.lit(0)))
    count, total = dates.agg(F.count(F.lit(1)), F.sum("_files")).first()
    # Spread by position in the source file, which holds for equal rows too and survives a retry.
    position = F.xxhash64("_metadata.file_path", "_metadata.row_index")
    placed = (
        table.withColumn("_position", position)
        .join(F.broadcast(numbered) if count <= MAX_DATES else numbered, table[column].eqNullSafe(numbered["_date"]))
        .repartitionById(total, (F.col("_first") + F.pmod("_position", "_files")).cast("int"))
        .drop("_date", "_files", "_first", "_position")
    )
    write_partitioned(placed, dst, [column], max_records)


def slot_owners(spark: SparkSession, n: int, slots: int) -> DataFrame:
    """`_slot, _owner`: each hash slot goes to the owner that scores highest for it.

    With one more owner, only the slots that the new one wins change hands.
    """
    score = F.struct(F.xxhash64("_slot", "_owner").alias("score"), F.col("_owner").alias("owner"))
    return (
        spark.range(slots)
        .select(F.col("id").alias("_slot"), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("_owner"))
        .groupBy("_slot")
        .agg(F.max(score).getField("owner").alias("_owner"))
    )


def consistent_owner(df: DataFrame, key: str | Sequence[str], n: int, slots: int = 16_384) -> DataFrame:
    """Add `_owner`, the key's partition in 0..n-1, stable when n changes. `slots` must be well above n."""
    keys = [key] if isinstance(key, str) else list(key)
    owners = slot_owners(df.sparkSession, n, slots)
    return df.withColumn("_slot", F.pmod(F.xxhash64(*keys), F.lit(slots))).join(
        F.broadcast(owners), "_slot"
    ).drop("_slot")


def consistent_hash_partition(df: DataFrame, key: str | Sequence[str], n: int, slots: int = 16_384) -> DataFrame:
    """Repartition by consistent hash of the key.

    All rows of one key stay together, so a hot key still fills one partition: add a salt to the key then
    (functions.skew.salt_big and the key [key, "_salt"]).
    """
    return consistent_owner(df, key, n, slots).repartitionById(n, "_owner").drop("_owner")
