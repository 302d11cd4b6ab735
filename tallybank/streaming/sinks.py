"""Streaming sinks. `once=True` processes what is there and stops."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import ArrayType, DateType, LongType, StringType, StructField, StructType

from tallybank.operators.dedup import dedup_first, dedup_latest, without_earlier
from tallybank.operators.quality import RULES, Rules, is_valid, observe_rules, percent, with_reasons
from tallybank.schemas import table_schema
from tallybank.sinks.tables import write_table
from tallybank.streaming import segments
from tallybank.streaming.operators import running_totals


DAY = "_day"


def _start(writer: DataStreamWriter, once: bool) -> StreamingQuery:
    return (writer.trigger(availableNow=True) if once else writer).start()


def start_parquet(df: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append to a Parquet folder, exactly once per row; the checkpoint resumes it."""
    writer = df.writeStream.outputMode("append").format("parquet").option("path", path)
    return _start(writer.option("checkpointLocation", checkpoint), once)


def start_console(df: DataFrame, checkpoint: str | None = None, mode: str = "update", once: bool = False):
    """Print each micro-batch."""
    writer = df.writeStream.outputMode(mode).format("console").option("truncate", False)
    return _start(writer.option("checkpointLocation", checkpoint) if checkpoint else writer, once)


def start_memory(df: DataFrame, name: str, mode: str = "complete", once: bool = False) -> StreamingQuery:
    """Keep the result as an in-memory table on the driver: only for results known to be small."""
    return _start(df.writeStream.outputMode(mode).format("memory").queryName(name), once)


def start_updates(
    df: DataFrame, path: str, checkpoint: str, keys: Sequence[str] | None = None, once: bool = False
) -> StreamingQuery:
    """Update mode to Parquet: the changed rows of each micro-batch; read with `latest_updates`.

    Closed batches are merged, and of each of the `keys` a merge keeps the last state only.
    """
    reduced = (lambda rows: _last(rows, keys)) if keys else None

    def process(batch: DataFrame, batch_id: int) -> None:
        segments.merge_closed(batch.sparkSession, path, batch_id, batch.schema, reduced=reduced)
        segments.write_recent(batch, batch_id, path)

    writer = df.writeStream.outputMode("update").foreachBatch(process)
    return _start(writer.option("checkpointLocation", checkpoint), once)


def latest_updates(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str]) -> DataFrame:
    """The last state of each key written by `start_updates`, empty before the first one."""
    return _last(segments.read_batches(spark, path, schema), keys).drop(segments.BATCH)


def _last(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key, missing parts included, the row of the last batch."""
    whole = F.struct(*rows.columns)
    return rows.groupBy(*keys).agg(F.max_by(whole, segments.BATCH).alias("_row")).select("_row.*")


def start_unique(
    df: DataFrame, path: str, checkpoint: str, delay: str | None = "3 days", once: bool = False
) -> StreamingQuery:
    """The first row of each transaction_id to Parquet, whole rows; read with `unique_rows`.

    Of a micro-batch the earliest row of an id counts, by event_ts and then all columns; it goes if the table has a row
    of that id at most `delay` apart, or any at all with `delay=None`. So a batch should not span more than the delay.
    The table itself is the state: a batch meets the ids of its own days and of those within the delay, no others.
    Rows without an id or a time are no copies of anything; they take no part in this and all stay.
    """
    schema = df.schema

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        by_day = batch.withColumn(DAY, F.to_date("event_ts"))
        segments.merge_closed(spark, path, batch_id, by_day.schema, [DAY])
        # A batch that runs again must not meet its own rows.
        earlier = segments.read_batches(spark, path, by_day.schema, [DAY]).filter(F.col(segments.BATCH) < batch_id)
        placed = F.col("transaction_id").isNotNull() & F.col("event_ts").isNotNull()
        known = by_day.filter(placed)
        if delay is not None:
            oldest, newest = known.agg(F.min("event_ts"), F.max("event_ts")).first()
            near, spans = F.expr(f"interval {delay}"), [F.lit(t).cast("timestamp") for t in (oldest, newest)]
            earlier = earlier.filter(F.col(DAY).between(F.to_date(spans[0] - near), F.to_date(spans[1] + near)))
        first = without_earlier(dedup_first(known), earlier, delay)
        segments.write_recent(first.unionByName(by_day.filter(~placed)), batch_id, path, [DAY])

    writer = df.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return _start(writer, once)


def unique_rows(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """What `start_unique` has written so far."""
    by_day = StructType([*schema.fields, StructField(DAY, DateType())])
    return segments.read_batches(spark, path, by_day, [DAY]).select(*schema.names)


def dashboard(stream: DataFrame, name: str, once: bool = False) -> StreamingQuery:
    """Running totals by type and currency as table `name`; a few dozen rows, rewritten each micro-batch."""
    return start_memory(running_totals(stream), name, "complete", once)


def write_batch(batch: DataFrame, batch_id: int, out: str, rules: Rules = RULES) -> None:
    """Write one micro-batch in one pass to out/rows, by outcome, and its counts to out/metrics.

    The same batch id replaces its own folders, so a retried batch changes nothing. Closed batches are merged.
    """
    spark = batch.sparkSession
    seen = Observation()
    outcome = F.when(is_valid(rules), "valid").otherwise("quarantine")
    routed = observe_rules(batch, seen, rules).transform(with_reasons, rules).withColumn("outcome", outcome)
    segments.merge_closed(spark, f"{out}/rows", batch_id, routed.schema, ["outcome"])
    segments.write_recent(routed, batch_id, f"{out}/rows", ["outcome"])

    counts = seen.get
    metrics = spark.range(1).select(*[F.lit(value).cast("bigint").alias(name) for name, value in counts.items()])
    segments.merge_closed(spark, f"{out}/metrics", batch_id, metrics_schema(rules), reduced=_totals)
    segments.write_recent(metrics, batch_id, f"{out}/metrics")


def metrics_schema(rules: Rules = RULES) -> StructType:
    return StructType([StructField(name, LongType()) for name in ("total", "valid", *rules)])


def _totals(metrics: DataFrame) -> DataFrame:
    """The counts of several batches as one row, under the last batch."""
    names = [c for c in metrics.columns if c != segments.BATCH]
    return metrics.agg(*[F.sum(c).alias(c) for c in names], F.max(segments.BATCH).alias(segments.BATCH))


def routed_rows(spark: SparkSession, out: str, outcome: str, schema: StructType | None = None) -> DataFrame:
    """The rows of one outcome, "valid" or "quarantine"; `schema` of the stream, by default that of transactions."""
    columns = schema or table_schema("transaction")
    whole = StructType(
        [*columns.fields, StructField("rejection_reasons", ArrayType(StringType())), StructField("outcome", StringType())]
    )
    rows = segments.read_batches(spark, f"{out}/rows", whole, ["outcome"])
    rows = rows.filter(F.col("outcome") == outcome).drop("outcome", segments.BATCH)
    return rows.drop("rejection_reasons") if outcome == "valid" else rows


def routing_summary(spark: SparkSession, out: str, rules: Rules = RULES) -> DataFrame:
    """Totals over all batches written so far."""
    return (
        segments.read_batches(spark, f"{out}/metrics", metrics_schema(rules))
        .agg(F.sum("total").alias("total_rows"), F.sum("valid").alias("valid_rows"))
        .withColumn("quarantined_rows", F.col("total_rows") - F.col("valid_rows"))
        .withColumn("quarantined_pct", percent(F.col("quarantined_rows"), F.col("total_rows")))
    )


def write_summary(spark: SparkSession, out: str, rules: Rules = RULES) -> None:
    """Refresh out/summary: every so many batches while a stream runs, and once when it has ended."""
    write_table(routing_summary(spark, out, rules), out, "summary")


def route_quality(
    stream: DataFrame, out: str, checkpoint: str, every: int = 10, rules: Rules = RULES, once: bool = False
) -> StreamingQuery:
    """Split each micro-batch into valid and quarantined rows; refresh out/summary every `every` batches."""

    def process(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, out, rules)
        if (batch_id + 1) % every == 0:
            write_summary(batch.sparkSession, out, rules)

    writer = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return _start(writer, once)


PROGRESS = (
    "batch_id bigint, input_rows bigint, state_rows bigint, state_bytes bigint, dropped_late_rows bigint, "
    "watermark string"
)


def progress_frame(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """Input, state size and late rows of the recent micro-batches; Spark keeps a bounded number of them."""
    rows = []
    for progress in query.recentProgress:
        record = json.loads(progress.json) if hasattr(progress, "json") else progress
        states = record.get("stateOperators", [])
        rows.append(
            (
                record["batchId"],
                record["numInputRows"],
                sum(state["numRowsTotal"] for state in states),
                sum(state["memoryUsedBytes"] for state in states),
                sum(state.get("numRowsDroppedByWatermark", 0) for state in states),
                record.get("eventTime", {}).get("watermark"),
            )
        )
    return spark.createDataFrame(rows, PROGRESS)
