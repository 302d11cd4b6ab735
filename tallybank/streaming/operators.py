"""Streaming transformations. Event time is event_ts; state is bounded by the watermark delay."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybank.functions.money import money_sum
from tallybank.functions.sizing import broadcast_if_small
from tallybank.functions.skew import row_hash
from tallybank.operators.joins import fill_unknown


def hourly_totals(stream: DataFrame, delay: str = "3 days") -> DataFrame:
    """Total and count per account and hour."""
    return (
        stream.withWatermark("event_ts", delay)
        .groupBy(F.window("event_ts", "1 hour"), "account_id")
        .agg(money_sum("amount").alias("hourly_total"), F.count(F.lit(1)).alias("txn_count"))
    )


def velocity_alerts_stream(
    stream: DataFrame, delay: str = "10 minutes", width: str = "2 minutes", threshold: int = 5
) -> DataFrame:
    """Accounts with at least `threshold` approved transactions in one tumbling window."""
    return (
        stream.filter(F.col("status") == "Approved")
        .withWatermark("event_ts", delay)
        .groupBy(F.window("event_ts", width), "account_id")
        .agg(F.count(F.lit(1)).alias("velocity_count"))
        .filter(F.col("velocity_count") >= threshold)
    )


def enrich_stream(stream: DataFrame, product: DataFrame, branch: DataFrame) -> DataFrame:
    """Add product and branch of the transaction; missing ones are "Unknown". Works on a batch frame as well."""
    products = product.select("product_id", "product_name", "product_group")
    branches = branch.select("branch_id", "branch_name", "state")
    joined = stream.join(broadcast_if_small(products), "product_id", "left").join(
        broadcast_if_small(branches), "branch_id", "left"
    )
    return fill_unknown(joined, "product_name", "product_group", "branch_name", "state")


def dedup_stream(stream: DataFrame, bounded: bool = True, delay: str = "3 days", salts: int = 1) -> DataFrame:
    """One row per known transaction_id, which one of a micro-batch is Spark's choice; `sinks.start_unique` fixes it.

    Bounded: an id is forgotten once the watermark passes it by the delay. Unbounded: every id is kept
    for ever, for comparison only. `salts` above 1 first removes copies per (id, salt), so an id with very
    many copies is not handled by one task; it doubles the state, and near the delay it may drop a copy
    that the plain form lets through. Rows without an id are no copies of each other: they go around the state.
    """
    timed = stream.withWatermark("event_ts", delay) if bounded else stream
    known = timed.filter(F.col("transaction_id").isNotNull())
    if not bounded:
        unique = known.dropDuplicates(["transaction_id"])
    else:
        if salts > 1:
            salted = known.withColumn("_salt", F.pmod(row_hash(stream.columns), F.lit(salts)))
            known = salted.dropDuplicatesWithinWatermark(["transaction_id", "_salt"]).drop("_salt")
        unique = known.dropDuplicatesWithinWatermark(["transaction_id"])
    return unique.unionByName(timed.filter(F.col("transaction_id").isNull()))


def running_totals(stream: DataFrame) -> DataFrame:
    """Total and count per type and currency since the stream began."""
    return stream.groupBy("transaction_type", "currency").agg(
        money_sum("amount").alias("total_amount"), F.count(F.lit(1)).alias("txn_count")
    )
