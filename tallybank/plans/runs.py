"""Registered job runs: each runs a whole job over the whole tables and reads its output back."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tallybank.functions.skew import hot_keys, salt_big, salt_counts, salt_small
from tallybank.operators import analytics, layout
from tallybank.operators.joins import bucketed_join
from tallybank.plans.catalog import portable, tier_changes, tier_history
from tallybank.plans.history import apply_feed, create_history, read_history, read_outcomes
from tallybank.plans.incremental import by_day, incremental_load, reprocess_window
from tallybank.plans.jobs import SYNTHETIC_NAMES, PipelineConfig, run_etl, run_pipeline
from tallybank.plans.quality_job import QUARANTINE, VALID, read_metrics, read_outcome, run_quality
from tallybank.session import scratch_path, use_utc
from tallybank.sinks.tables import write_bucketed, write_partitioned, write_table
from tallybank.sources.conform import conform
from tallybank.sources.files import read_csv, read_range, read_table, split_corrupt
from tallybank.views import Bank

# Parameters of the registered runs.
OWNERS = 8
FEEDS_MEET = "2023-12-15"
RANGE = ("2024-01-05", "2024-01-11")
LATE_RUN = "2024-01-15"
WITHDRAWN = "2024-01-13"
BUCKET_KEYS = ("account_id", "_salt")
FILE_ROWS = 100

JobRun = Callable[[SparkSession, Bank], DataFrame]


def stored_transactions(spark: SparkSession, bank: Bank) -> str:
    """The transaction table as a partitioned table, the input of the daily jobs."""
    path = scratch_path(spark, "transaction")
    write_partitioned(by_day(bank.transaction), path)
    return path


def days_of(spark: SparkSession, path: str) -> Row:
    """The oldest and the newest event date."""
    return read_table(spark, path).agg(F.min("event_date"), F.max("event_date")).first()


def end_to_end_run(spark: SparkSession, bank: Bank) -> DataFrame:
    output = scratch_path(spark, "end-to-end")
    run_pipeline(spark, bank, PipelineConfig(output))
    return read_table(spark, f"{output}/daily_spend").select(
        "customer_id", "event_date", "total_spend", "txn_count"
    )


def incremental_load_run(spark: SparkSession, bank: Bank) -> DataFrame:
    source, target = stored_transactions(spark, bank), scratch_path(spark, "loaded")
    incremental_load(spark, source, target, days_of(spark, source)[1])
    return read_table(spark, target)


def incremental_rerun(spark: SparkSession, bank: Bank) -> DataFrame:
    """A load up to the middle day, the same again, and one up to the last day: the rows of a single load."""
    source, target = stored_transactions(spark, bank), scratch_path(spark, "reloaded")
    oldest, newest = days_of(spark, source)
    middle = oldest + (newest - oldest) // 2
    for day in (middle, middle, newest):
        incremental_load(spark, source, target, day)
    return read_table(spark, target)


def compaction_run(spark: SparkSession, bank: Bank) -> DataFrame:
    target = scratch_path(spark, "compacted")
    layout.compact(spark, stored_transactions(spark, bank), target)
    rows = read_table(spark, target).groupBy("event_date").agg(F.count(F.lit(1)).alias("txn_count"))
    return layout.file_stats(spark, target).join(rows, "event_date").select("event_date", "file_count", "txn_count")


def consistent_hash_run(spark: SparkSession, bank: Bank) -> DataFrame:
    """Owners in use, and keys found with more than one owner: none."""
    owned = layout.consistent_owner(bank.transaction.select("account_id"), "account_id", OWNERS)
    per_key = owned.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("rows"), F.min("_owner").alias("lowest"), F.max("_owner").alias("highest")
    )
    return per_key.agg(
        F.sum("rows").alias("txn_count"),
        F.count(F.lit(1)).alias("key_count"),
        (F.max("highest") - F.min("lowest") + 1).alias("owner_count"),
        F.count_if(F.col("lowest") != F.col("highest")).alias("split_keys"),
    )


def applied_history(spark: SparkSession, bank: Bank) -> str:
    """A stored history after two feeds, the changes before FEEDS_MEET and the others; the first one comes twice."""
    base = scratch_path(spark, "history")
    changes = tier_changes(bank)
    later = F.col("change_date") >= F.lit(FEEDS_MEET).cast("date")
    feeds = {"early": changes.filter(~later | later.isNull()), "late": changes.filter(later)}
    create_history(spark, base, tier_history(bank))
    for feed in ("early", "early", "late", "early"):
        apply_feed(spark, base, feed, feeds[feed], "customer_id", ["risk_tier"])
    return base


def scd2_upsert_run(spark: SparkSession, bank: Bank) -> DataFrame:
    return read_history(spark, applied_history(spark, bank))


def scd2_rejected(spark: SparkSession, bank: Bank) -> DataFrame:
    """Changes of the feeds that were not applied, and why."""
    return read_outcomes(spark, applied_history(spark, bank)).filter("outcome <> 'applied'")


def late_data_run(spark: SparkSession, bank: Bank) -> DataFrame:
    """Daily spend as of a first arrival, and its last days recomputed after late rows came and one day was withdrawn."""
    arrived, later = scratch_path(spark, "arrived"), scratch_path(spark, "later")
    write_partitioned(by_day(bank.transaction.filter(F.col("ingest_date") <= LATE_RUN)), arrived)
    write_partitioned(by_day(bank.transaction.filter(F.col("event_date") != WITHDRAWN)), later)
    table, location = f"daily_spend_{uuid.uuid4().hex}", scratch_path(spark, "daily-spend")
    oldest, newest = days_of(spark, arrived)
    reprocess_window(spark, arrived, bank.account, table, newest, (newest - oldest).days, location)
    for _ in range(2):
        reprocess_window(spark, later, bank.account, table, LATE_RUN)
    return spark.table(table)


def quality_run(spark: SparkSession, bank: Bank) -> str:
    """The quality job over the whole table, run twice."""
    out = scratch_path(spark, "quality")
    for _ in range(2):
        run_quality(spark, bank.transaction, out, LATE_RUN)
    return out


def partition_pruned_scan(spark: SparkSession, bank: Bank) -> DataFrame:
    """Totals of a range of days from the table stored by day: only these days' folders are opened."""
    kept = read_range(spark, stored_transactions(spark, bank), *RANGE)
    return analytics.totals_by(kept, ["event_date"])


def pruned_join(spark: SparkSession, bank: Bank) -> DataFrame:
    """Totals of the days on which much arrived late; the days come from a join, which prunes the scan as it runs."""
    table = read_table(spark, stored_transactions(spark, bank))
    late = F.count_if(F.datediff("ingest_date", "event_date") >= 3) * 4 > F.count(F.lit(1))
    days = write_table(bank.transaction.groupBy("event_date").agg(late.alias("many_late")), scratch_path(spark, "days"), "day")
    return pruned_by_days(table, read_table(spark, days).filter("many_late"))


def pruned_by_days(table: DataFrame, days: DataFrame) -> DataFrame:
    return analytics.totals_by(table.join(days.select("event_date"), "event_date"), ["event_date"])


def bucketed_tables(spark: SparkSession, bank: Bank) -> tuple[str, str]:
    """Transactions and accounts in buckets of account and salt; hot accounts have several salts."""
    salts = salt_counts(hot_keys(bank.transaction, "account_id"), "account_id")
    facts = salt_big(bank.transaction.select("transaction_id", "account_id", "event_date", "amount"), salts, "account_id")
    accounts = salt_small(bank.account.select("account_id", "account_type"), salts, "account_id")
    names = []
    for kind, frame in (("transaction", facts), ("account", accounts)):
        names.append(f"bucketed_{kind}_{uuid.uuid4().hex}")
        write_bucketed(frame, names[-1], col=BUCKET_KEYS, location=scratch_path(spark, f"bucketed-{kind}"))
    return names[0], names[1]


def bucketed_run(spark: SparkSession, bank: Bank) -> DataFrame:
    return bucketed_join(spark, *bucketed_tables(spark, bank), BUCKET_KEYS).drop("_salt")


def delimited_accounts(spark: SparkSession, bank: Bank, bad: Column) -> str:
    """The account table as delimited files with a header; rows where `bad` holds have a letter in the id."""
    path = f"{scratch_path(spark, 'delimited')}/account.csv"
    canonical = conform(bank.account, "account")
    ids = F.when(bad, F.concat(F.lit("x"), F.col("account_id"))).otherwise(F.col("account_id").cast("string"))
    canonical.withColumn("account_id", ids).write.option("header", True).csv(path)
    return path


def csv_strict_run(spark: SparkSession, bank: Bank) -> DataFrame:
    """A delimited file read strictly: every row is as declared, or the job ends."""
    return read_csv(spark, delimited_accounts(spark, bank, F.lit(False)), "account")


def csv_corrupt_run(spark: SparkSession, bank: Bank) -> DataFrame:
    """A delimited file with damaged rows: good rows, and the ids that the text of bad ones starts with."""
    path = delimited_accounts(spark, bank, F.col("account_id") % 10 == 3)
    good, bad = split_corrupt(read_csv(spark, path, "account", mode="PERMISSIVE"))
    first = F.substring_index("_corrupt_record", ",", 1).alias("raw_id")
    return good.select("account_id", "balance", F.lit(None).cast("string").alias("raw_id")).unionByName(
        bad.select(first), allowMissingColumns=True
    )


def etl_run(spark: SparkSession, bank: Bank) -> tuple[DataFrame, str]:
    """The five-entity job over the stored tables; its report and the folder it wrote."""
    source, target = scratch_path(spark, "synthetic"), scratch_path(spark, "etl")
    for name in set(SYNTHETIC_NAMES.values()):
        write_table(getattr(bank, name), source, name)
    return run_etl(spark, source, target, run_date=LATE_RUN), target


def etl_report(spark: SparkSession, bank: Bank) -> DataFrame:
    """Entities, tables and rows, counted during the writes."""
    return etl_run(spark, bank)[0].drop("duration_ms")


def etl_audited(spark: SparkSession, bank: Bank) -> DataFrame:
    """Rows per table and audit date, of all five tables that the job wrote."""
    target = etl_run(spark, bank)[1]
    stamps = {"transaction": F.to_date("processed_timestamp"), **dict.fromkeys(("customer", "account", "product", "branch"), F.col("ingest_date"))}
    frames = [
        read_table(spark, f"{target}/{entity}_table").groupBy(stamp.alias("stamped")).agg(F.count(F.lit(1)).alias("row_count"))
        .withColumn("entity", F.lit(entity))
        for entity, stamp in stamps.items()
    ]
    return reduce(DataFrame.unionByName, frames)


def capped_files(spark: SparkSession, bank: Bank) -> DataFrame:
    """Days stored with at most so many rows in a file: rows of each day, and whether any file has more."""
    path = scratch_path(spark, "capped")
    write_partitioned(by_day(bank.transaction), path, max_records=FILE_ROWS)
    in_file = read_table(spark, path).groupBy("event_date", "_metadata.file_path").agg(F.count(F.lit(1)).alias("rows"))
    return in_file.groupBy("event_date").agg(
        F.sum("rows").alias("txn_count"), (F.max("rows") <= FILE_ROWS).alias("within_cap")
    )


def quarantine_run(spark: SparkSession, bank: Bank) -> DataFrame:
    """What the end-to-end job rejects, of a table in which every seventh id is missing."""
    output = scratch_path(spark, "end-to-end")
    missing = F.expr("case when transaction_id % 7 = 0 then null else transaction_id end")
    damaged = Bank(lambda table: getattr(bank, table).withColumn("transaction_id", missing) if table == "transaction" else getattr(bank, table))
    run_pipeline(spark, damaged, PipelineConfig(output))
    reasons = F.array_join("rejection_reasons", ",").alias("reasons")
    return read_table(spark, f"{output}/quarantine").groupBy(reasons).agg(F.count(F.lit(1)).alias("txn_count"))


RUNS: dict[str, JobRun] = {
    "end_to_end_run": end_to_end_run,
    "incremental_load_run": incremental_load_run,
    "incremental_rerun": incremental_rerun,
    "compaction_run": compaction_run,
    "consistent_hash_run": consistent_hash_run,
    "scd2_upsert_run": scd2_upsert_run,
    "scd2_rejected": scd2_rejected,
    "late_data_run": late_data_run,
    "quality_run_valid": lambda spark, bank: read_outcome(spark, quality_run(spark, bank), VALID),
    "quality_run_quarantine": lambda spark, bank: read_outcome(spark, quality_run(spark, bank), QUARANTINE),
    "quality_run_metrics": lambda spark, bank: read_metrics(spark, quality_run(spark, bank)),
    "partition_pruned_scan": partition_pruned_scan,
    "pruned_join": pruned_join,
    "bucketed_join": bucketed_run,
    "csv_strict_run": csv_strict_run,
    "csv_corrupt_run": csv_corrupt_run,
    "etl_report": etl_report,
    "etl_audited": etl_audited,
    "capped_files": capped_files,
    "quarantine_run": quarantine_run,
}


def run_job(name: str, spark: SparkSession, base: str) -> DataFrame:
    return portable(RUNS[name](spark, Bank.over(use_utc(spark), base)))
