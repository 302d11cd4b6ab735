"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from tallybank.session import scratch_path, session_conf

#: Shuffle files of a finished write go at once, not when the driver's next garbage collection finds them unused.
FREED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
BATCH_BYTES = 4 << 20


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write the rows once and read them back: cuts the lineage, and survives a lost executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with session_conf(spark, FREED):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete tables of `stored` that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def short_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Hand whole texts to Python in batches of at most this many rows and of about BATCH_BYTES, for the rest of the session.

    The defaults of 10,000 rows and 64 MB take memory several times over, in the JVM, on the way, and in Python.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > rows:
        spark.conf.set(name, str(rows))
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if byte_count(spark.conf.get(name)) > BATCH_BYTES:
        spark.conf.set(name, f"{BATCH_BYTES}b")


def byte_count(setting: str) -> int:
    """Bytes of a setting such as 64m or 67108864b; without a unit they are bytes."""
    number = setting.lower().rstrip("b")
    power = "kmgtp".find(number[-1]) + 1
    return int(number[:-1] if power else number) << 10 * power
