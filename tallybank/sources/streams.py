"""Streaming readers and a replay feed."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from tallybank.schemas import table_schema
from tallybank.session import scratch_path
from tallybank.sinks.tables import write_partitioned


def stream_table(
    spark: SparkSession, path: str, schema: StructType | str | None = None, max_files: int = 2, **options: str
) -> DataFrame:
    """Parquet folder as a stream; the schema must be given, by default that of the transaction table."""
    return (
        spark.readStream.schema(schema or table_schema("transaction"))
        .option("maxFilesPerTrigger", max_files)
        .options(**options)
        .parquet(path)
    )


def stream_rate(spark: SparkSession, rps: int = 1000, accounts: int = 1000) -> DataFrame:
    """Test feed from the rate source, shaped like the transaction table."""
    rate = spark.readStream.format("rate").option("rowsPerSecond", rps).load()
    ids = F.col("value")
    return rate.select(
        (ids + 1).alias("transaction_id"),
        (ids % accounts + 1).alias("account_id"),
        (ids % 100 + 1).alias("product_id"),
        (ids % 25 + 1).alias("branch_id"),
        (ids % 2000 - 500).cast("double").alias("amount"),
        F.lit("USD").alias("currency"),
        F.lit("Deposit").alias("transaction_type"),
        F.lit("Approved").alias("status"),
        F.to_date("timestamp").alias("event_date"),
        F.col("timestamp").alias("event_ts"),
        F.to_date("timestamp").alias("ingest_date"),
    )


def land_partition(df: DataFrame, date: dt.date | str, folder: str) -> None:
    """Add one event date to a watched folder, as one day's arrival."""
    df.filter(F.col("event_date") == F.lit(str(date)).cast("date")).write.mode("append").parquet(folder)


def land_days(df: DataFrame, folder: str, column: str = "event_date", files: int = 1) -> int:
    """Land a table a day at a time, in order, each day as `files` files; returns the number of days.

    A stream over the folder that takes `files` times n files per trigger sees n whole days per micro-batch, if no
    day has fewer rows than files. The table is first stored by day, so that landing a day reads only its rows.
    """
    spark = df.sparkSession
    staged = scratch_path(spark, "days")
    write_partitioned(df.withColumn("_day", F.col(column)).hint("rebalance", "_day"), staged, ["_day"])
    schema = StructType([*df.schema.fields, StructField("_day", DateType())])
    table = spark.read.schema(schema).parquet(staged)
    # One row per day of the calendar.
    days = [row[0] for row in table.select("_day").distinct().orderBy("_day").collect()]
    for day in days:
        arrived = table.filter(F.col("_day").eqNullSafe(F.lit(day))).drop("_day")
        in_files(arrived, files).write.mode("append").parquet(folder)
    return len(days)


def in_files(df: DataFrame, files: int) -> DataFrame:
    """Rows to be written as so many files. One file is written by one task anyway, so its rows are not shuffled first."""
    return df.coalesce(1) if files == 1 else df.repartition(files)
