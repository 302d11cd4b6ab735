"""Registered streaming queries: each runs a stream over the whole transaction table and reads its sink back."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallybank.plans.catalog import portable
from tallybank.session import scratch_path, session_conf, use_utc
from tallybank.sources.streams import land_days, stream_table
from tallybank.streaming import operators as ops
from tallybank.streaming import sinks
from tallybank.views import Bank

# Fixed value: a parameter of a registered run.
LATE = "1 day"

StreamRun = Callable[[SparkSession, str], DataFrame]


DAYS_PER_BATCH = 3
ROWS_PER_FILE = 5_000_000
ROWS_PER_STATE_TASK = 1_000_000
_FEEDS: dict[tuple[str, str, str], tuple[str, int, int]] = {}


def landed(spark: SparkSession, base: str, column: str = "event_date") -> tuple[str, int, int]:
    """The transaction table landed day by day in a watched folder, its files a day, and its rows.

    Once per application and source: all replays read the same arrivals.
    """
    key = (spark.sparkContext.applicationId, base, column)
    if key not in _FEEDS:
        table = Bank.over(spark, base).transaction
        days, rows = table.groupBy(column).count().agg(F.count("*"), F.sum("count")).first()
        files = max(1, -(-(rows or 0) // (max(days, 1) * ROWS_PER_FILE)))
        folder = scratch_path(spark, "feed")
        land_days(table, folder, column, files)
        _FEEDS[key] = (folder, files, rows or 0)
    return _FEEDS[key]


def transaction_stream(
    spark: SparkSession, base: str, column: str = "event_date", days: int = DAYS_PER_BATCH
) -> DataFrame:
    """The landed table as a stream of `days` days per micro-batch."""
    folder, files, _ = landed(spark, base, column)
    schema = Bank.over(spark, base).transaction.schema
    return stream_table(spark, folder, schema, max_files=days * files)


@contextmanager
def state_sized(spark: SparkSession, base: str) -> Iterator[None]:
    """State is split once, when a stream first starts: here by the rows that will arrive."""
    rows = landed(spark, base)[2]
    tasks = max(4, -(-rows // ROWS_PER_STATE_TASK))
    with session_conf(spark, {"spark.sql.shuffle.partitions": tasks}):
        yield


def finish(query: StreamingQuery) -> None:
    """Wait until everything present is processed."""
    try:
        query.awaitTermination()
    finally:
        query.stop()


def through_parquet(spark: SparkSession, stream: DataFrame) -> DataFrame:
    """Run a stream into a Parquet sink and read the sink."""
    folder = scratch_path(spark, "stream")
    finish(sinks.start_parquet(stream, f"{folder}/out", f"{folder}/checkpoint", once=True))
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


def through_memory(spark: SparkSession, start: Callable[[str], StreamingQuery]) -> DataFrame:
    name = f"stream_{uuid.uuid4().hex}"
    finish(start(name))
    return spark.table(name)


def stream_hourly_totals(spark: SparkSession, base: str) -> DataFrame:
    """Append mode: only windows that the watermark has closed."""
    totals = through_parquet(spark, ops.hourly_totals(transaction_stream(spark, base)))
    return totals.select(
        F.col("window.start").alias("window_start"), "account_id", "hourly_total", "txn_count"
    )


def stream_velocity(spark: SparkSession, base: str) -> DataFrame:
    """Update mode: the last count of each alert, kept in files since alerts grow with the data."""
    alerts = ops.velocity_alerts_stream(transaction_stream(spark, base))
    folder, keys = scratch_path(spark, "alerts"), ["window", "account_id"]
    finish(sinks.start_updates(alerts, f"{folder}/out", f"{folder}/checkpoint", keys, once=True))
    found = sinks.latest_updates(spark, f"{folder}/out", alerts.schema, keys)
    return found.select(F.col("window.start").alias("window_start"), "account_id", "velocity_count")


def stream_late_rows(spark: SparkSession, base: str) -> DataFrame:
    """Arrival by ingest date, a day per micro-batch, with a delay of one day: per closed hour and account, the rows
    that came in time, their total, and the rows that came too late for the watermark."""
    stream = transaction_stream(spark, base, "ingest_date", days=1)
    totals = through_parquet(spark, ops.hourly_totals(stream, delay=LATE))
    in_time = totals.select(F.col("window.start").alias("start"), F.col("account_id").alias("of"), "hourly_total", "txn_count")
    table = spark.read.schema(Bank.over(spark, base).transaction.schema).parquet(landed(spark, base, "ingest_date")[0])
    # The watermark counts milliseconds.
    newest = F.date_trunc("MILLISECOND", F.max("event_ts")) - F.expr(f"interval {LATE}")
    closed = table.agg(newest.alias("watermark"))
    every = (
        table.groupBy(F.window("event_ts", "1 hour").alias("w"), "account_id")
        .agg(F.count(F.lit(1)).alias("rows"))
        .join(F.broadcast(closed), F.col("w.end") <= F.col("watermark"))
        .select(F.col("w.start").alias("window_start"), "account_id", "rows")
    )
    same = (F.col("window_start") == F.col("start")) & F.col("account_id").eqNullSafe(F.col("of"))
    seen = F.coalesce("txn_count", F.lit(0))
    return every.join(in_time, same, "left").select(
        "window_start", "account_id", "hourly_total", seen.alias("txn_count"), (F.col("rows") - seen).alias("late_rows")
    )


def stream_enriched(spark: SparkSession, base: str) -> DataFrame:
    bank = Bank.over(spark, base)
    return through_parquet(spark, ops.enrich_stream(transaction_stream(spark, base), bank.product, bank.branch))


def unique_through(spark: SparkSession, base: str, delay: str | None) -> DataFrame:
    stream, folder = transaction_stream(spark, base), scratch_path(spark, "unique")
    finish(sinks.start_unique(stream, f"{folder}/out", f"{folder}/checkpoint", delay, once=True))
    return sinks.unique_rows(spark, f"{folder}/out", stream.schema)


def stream_dedup(spark: SparkSession, base: str) -> DataFrame:
    """Whole rows: the first of each id, and again the first after the delay."""
    return unique_through(spark, base, "3 days")


def stream_dedup_unbounded(spark: SparkSession, base: str) -> DataFrame:
    """Whole rows: the first of each id."""
    return unique_through(spark, base, None)


def stream_dedup_state(spark: SparkSession, base: str) -> DataFrame:
    """Ids let through by Spark's own bounded state; which copy it lets through is not defined."""
    unique = ops.dedup_stream(transaction_stream(spark, base))
    return through_parquet(spark, unique).select("transaction_id")


def stream_progress(spark: SparkSession, base: str) -> DataFrame:
    """Rows that each micro-batch of the hourly totals read, and whether any came too late, from the stream's own report."""
    totals, folder = ops.hourly_totals(transaction_stream(spark, base)), scratch_path(spark, "progress")
    query = sinks.start_parquet(totals, f"{folder}/out", f"{folder}/checkpoint", once=True)
    finish(query)
    report = sinks.progress_frame(spark, query).filter("input_rows > 0")
    return report.select("batch_id", "input_rows", (F.col("dropped_late_rows") > 0).alias("had_late_rows"))


def routed(spark: SparkSession, base: str) -> str:
    folder = scratch_path(spark, "routed")
    stream = transaction_stream(spark, base)
    finish(sinks.route_quality(stream, folder, f"{folder}/checkpoint", once=True))
    sinks.write_summary(spark, folder)
    return folder


def stream_quality_valid(spark: SparkSession, base: str) -> DataFrame:
    return sinks.routed_rows(spark, routed(spark, base), "valid")


def stream_quality_summary(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.parquet(f"{routed(spark, base)}/summary")


def stream_dashboard(spark: SparkSession, base: str) -> DataFrame:
    stream = transaction_stream(spark, base)
    return through_memory(spark, lambda name: sinks.dashboard(stream, name, once=True))


STREAMS: dict[str, StreamRun] = {
    "stream_hourly_totals": stream_hourly_totals,
    "stream_velocity": stream_velocity,
    "stream_enriched": stream_enriched,
    "stream_dedup": stream_dedup,
    "stream_dedup_unbounded": stream_dedup_unbounded,
    "stream_dedup_state": stream_dedup_state,
    "stream_late_rows": stream_late_rows,
    "stream_progress": stream_progress,
    "stream_quality_valid": stream_quality_valid,
    "stream_quality_summary": stream_quality_summary,
    "stream_dashboard": stream_dashboard,
}


def run_stream(name: str, spark: SparkSession, base: str) -> DataFrame:
    with state_sized(use_utc(spark), base):
        return portable(STREAMS[name](spark, base))
