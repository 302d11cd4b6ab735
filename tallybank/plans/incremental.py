"""Rerun-safe daily jobs: batch watermark, incremental load and late-data reprocessing.

Both jobs deduplicate by (transaction_id, event_date), so a result depends only on the partitions
read; copies of an id on different days need the full-history form of operators.dedup.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallybank.operators.analytics import daily_spend
from tallybank.operators.dedup import dedup_latest
from tallybank.session import session_conf
from tallybank.sinks.tables import overwrite_partitions
from tallybank.sources.files import read_range

LOOKBACK_DAYS = 3
DEDUP_KEYS = ("transaction_id", "event_date")
WATERMARK = "event_date date, written_at timestamp"


def as_date(value: dt.date | str) -> dt.date:
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


def read_watermark(spark: SparkSession, path: str, default: dt.date | None = None) -> dt.date | None:
    """The last processed event date, or the default before the first run."""
    try:
        latest = spark.read.schema(WATERMARK).parquet(path).agg(F.max("event_date")).first()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return default
        raise
    return latest[0] or default


def write_watermark(spark: SparkSession, path: str, date: dt.date) -> None:
    """Record a processed date. Each run adds one row and the largest counts, so a crash cannot lose the old one."""
    row = spark.range(1).select(
        F.lit(date).cast("date").alias("event_date"), F.current_timestamp().alias("written_at")
    )
    row.coalesce(1).write.mode("append").parquet(path)


def incremental_load(
    spark: SparkSession,
    src: str,
    dst: str,
    run_date: dt.date | str,
    lookback: int = LOOKBACK_DAYS,
    control: str | None = None,
    start: dt.date | str | None = None,
) -> dt.date | None:
    """Copy the partitions since the watermark, deduplicated, and `lookback` days before it for late rows.

    The first load begins at `start`, or with the oldest day if none is given. Rows without a date belong
    to no day, so each run loads all of them. Replaces whole partitions, so a rerun changes nothing. The
    watermark moves after the write, to the last date that had rows; with nothing to load it stays and None
    is returned.
    """
    run_date = as_date(run_date)
    control = control or f"{dst}_watermark"
    watermark = read_watermark(spark, control)
    if watermark is None:
        since = dt.date.min if start is None else as_date(start)
    else:
        since = watermark - dt.timedelta(days=lookback)
    new = read_range(spark, src, since, run_date, undated=True)
    if new.isEmpty():
        return None

    seen = Observation()
    loaded = dedup_latest(new, DEDUP_KEYS).observe(seen, F.max("event_date").alias("last_date"))
    overwrite_partitions(by_day(loaded), dst)
    last = seen.get["last_date"]
    if last is not None and (watermark is None or last > watermark):
        write_watermark(spark, control, last)
    return last


def by_day(df: DataFrame, column: str = "event_date") -> DataFrame:
    """Group rows by day before a partitioned write; AQE splits big days and merges small ones into even files."""
    return df.hint("rebalance", column)


def reprocess_window(
    spark: SparkSession,
    src: str,
    account: DataFrame,
    dst: str,
    run_date: dt.date | str,
    lookback: int = LOOKBACK_DAYS,
    location: str | None = None,
) -> list[dt.date]:
    """Recompute daily customer spend for [run_date - lookback, run_date] in the partitioned table `dst`.

    The first run creates the table, below `location` if given, else in the warehouse.

    Partitions of the window are replaced, those left without rows are dropped, and others are not
    touched. Returns the dates that have rows.
    """
    run_date = as_date(run_date)
    days = [run_date - dt.timedelta(days=back) for back in range(lookback, -1, -1)]
    window = read_range(spark, src, days[0], run_date)

    seen = Observation()
    counts = [F.count_if(F.col("event_date") == F.lit(day)).alias(day.isoformat()) for day in days]
    spend = (
        daily_spend(dedup_latest(window, DEDUP_KEYS), account)
        .select("customer_id", "total_spend", "txn_count", "event_date")
        .observe(seen, *counts)
    )
    if spark.catalog.tableExists(dst):
        with session_conf(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
            by_day(spend).write.mode("overwrite").insertInto(dst)
    else:
        writer = by_day(spend).write.partitionBy("event_date")
        (writer.option("path", location) if location else writer).saveAsTable(dst)

    filled = [day for day in days if seen.get[day.isoformat()]]
    for day in sorted(set(days) - set(filled)):
        spark.sql(f"alter table {dst} drop if exists partition (event_date = date '{day.isoformat()}')")
    return filled
