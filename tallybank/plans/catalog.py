"""The registered batch queries: one function per operator, over the banking tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybank.functions.money import money_sum
from tallybank.functions.risk import risk_bucket, risk_bucket_pandas_udf, risk_bucket_udf
from tallybank.functions.skew import hot_keys
from tallybank.operators import analytics, configured, dedup, entities, joins, quality, scd2, windows
from tallybank.session import use_utc
from tallybank.sources.conform import conform
from tallybank.sources.files import in_range
from tallybank.views import Bank

# Parameters of the registered queries.
WINDOW = ("2024-01-12", "2024-01-15")
CONFIG = {
    "transformations": {
        "customer": {
            "add_columns": [
                {"name": "sort_name", "expr": "concat(upper(trim(last_name)), ', ', trim(first_name))"},
                {"name": "days_open", "expr": "datediff(effective_end, effective_start)"},
            ],
            "rename_columns": {"effective_start": "valid_from", "effective_end": "valid_to"},
            "drop_columns": ["phone", "first_name", "last_name"],
        }
    }
}

BankQuery = Callable[[Bank], DataFrame]


def portable(df: DataFrame) -> DataFrame:
    """Dates as ISO text and timestamps as epoch seconds, so results compare across engines."""

    def column(name: str, kind: str) -> Column:
        if kind == "date":
            return F.date_format(name, "yyyy-MM-dd").alias(name)
        if kind == "timestamp":
            return F.unix_seconds(name).alias(name)
        if kind == "array<string>":
            return F.array_join(name, ",").alias(name)
        return F.col(name)

    return df.select(*[column(name, kind) for name, kind in df.dtypes])


def canonical(bank: Bank, entity: str) -> DataFrame:
    table = "customer_scd2" if entity == "customer" else entity
    return conform(getattr(bank, table), entity)


def cleaned(entity: str) -> BankQuery:
    audit = ["ingest_date", "processed_timestamp"]
    return lambda bank: entities.CLEANERS[entity](canonical(bank, entity)).drop(*audit)


def risk_bucket_with(classify) -> BankQuery:
    def query(bank: Bank) -> DataFrame:
        return bank.transaction.select(
            "transaction_id",
            "transaction_type",
            "amount",
            classify(F.col("transaction_type"), F.col("amount")).alias("risk_bucket"),
        )

    return query


def risk_bucket_native(bank: Bank) -> DataFrame:
    return bank.transaction.select("transaction_id", "transaction_type", "amount", risk_bucket().alias("risk_bucket"))


def risk_bucket_counts(bank: Bank) -> DataFrame:
    return analytics.counts_by(bank.transaction.select(risk_bucket().alias("risk_bucket")), ["risk_bucket"])


def account_totals_after(join: Callable[[DataFrame, DataFrame], DataFrame]) -> BankQuery:
    """Total per account type after a row-level join, to compare join strategies."""

    def query(bank: Bank) -> DataFrame:
        facts = bank.transaction.select("transaction_id", "account_id", "amount")
        accounts = bank.account.select("account_id", "account_type")
        return join(facts, accounts).groupBy("account_type").agg(
            F.count(F.lit(1)).alias("txn_count"), money_sum("amount").alias("total_amount")
        )

    return query


def plain_salted(facts: DataFrame, accounts: DataFrame) -> DataFrame:
    return joins.salted_join(facts, accounts, "account_id")


def hot_salted(facts: DataFrame, accounts: DataFrame) -> DataFrame:
    return joins.salted_join(facts, accounts, "account_id", hot_keys=hot_keys(facts, "account_id"))


def daily_customer_spend(bank: Bank) -> DataFrame:
    return analytics.daily_spend(dedup.dedup_latest(bank.transaction), bank.account)


def daily_spend_window(bank: Bank) -> DataFrame:
    """What the late-data job writes for one window of event dates."""
    window = in_range(bank.transaction, *WINDOW)
    return analytics.daily_spend(dedup.dedup_latest(window, ["transaction_id", "event_date"]), bank.account)


def end_to_end_daily_spend(bank: Bank) -> DataFrame:
    """The daily aggregate of the end-to-end pipeline: dedup, reduced quality rules, spend."""
    valid, _ = quality.split_quality(dedup.dedup_latest(bank.transaction), quality.PIPELINE_RULES)
    owners = bank.account.select("account_id", "customer_id")
    per_account = analytics.partial_totals(valid, "account_id", "event_date")
    return analytics.roll_up(
        per_account.join(owners, "account_id", "left"), "customer_id", "event_date"
    ).transform(analytics.finish, "customer_id", "event_date", total="total_spend")


def dedup_by_day(bank: Bank) -> DataFrame:
    return dedup.dedup_latest(bank.transaction, ["transaction_id", "event_date"])


def dedup_unknown_keys(bank: Bank) -> DataFrame:
    """Deduplication of a table in which every seventh id is missing; such rows all stay."""
    missing = F.expr("case when transaction_id % 7 = 0 then null else transaction_id end")
    return dedup.dedup_latest(bank.transaction.withColumn("transaction_id", missing))


def dq_non_finite(bank: Bank) -> DataFrame:
    """Rows that pass all rules, of a table in which some amounts are not finite numbers."""
    unfit = F.expr(
        "case when transaction_id % 11 = 0 then double('NaN') when transaction_id % 13 = 0 then double('-Infinity') "
        "else amount end"
    )
    return quality.split_quality(bank.transaction.withColumn("amount", unfit))[0]


def duplicate_free_ids(bank: Bank) -> DataFrame:
    """dropDuplicates keeps any copy, so only the surviving ids are defined."""
    return dedup.dedup_any(bank.transaction).select("transaction_id")


def amount_spike(bank: Bank) -> DataFrame:
    valid = analytics.valid_accounts(analytics.real_amounts(bank.transaction))
    return windows.amount_spike(valid).filter("is_spike").drop("is_spike")


def velocity_trailing(bank: Bank) -> DataFrame:
    return windows.velocity_alerts(bank.transaction, before=119, after=0)


def velocity_tumbling(bank: Bank) -> DataFrame:
    """Batch twin of the velocity stream."""
    window = F.window("event_ts", "2 minutes")
    approved = bank.transaction.filter(F.col("status") == "Approved")
    return (
        approved.groupBy(window.alias("w"), "account_id")
        .agg(F.count(F.lit(1)).alias("velocity_count"))
        .filter("velocity_count >= 5")
        .select(F.col("w.start").alias("window_start"), "account_id", "velocity_count")
    )


def hourly_totals(bank: Bank) -> DataFrame:
    """Batch twin of the hourly stream: every window, closed or not."""
    return (
        analytics.partial_totals(bank.transaction, F.window("event_ts", "1 hour").alias("w"), "account_id")
        .withColumn("window_start", F.col("w.start"))
        .transform(analytics.finish, "window_start", "account_id", total="hourly_total")
    )


def approx_distinct_accounts(bank: Bank) -> DataFrame:
    """Whether the estimate from merged daily sketches stays within 5 percent of the exact count."""
    exact = analytics.distinct_count(bank.transaction, "account_id").withColumnRenamed("distinct_count", "exact")
    merged = analytics.merged_distinct(analytics.daily_sketches(bank.transaction, "account_id")).scalar()
    return exact.select("exact", (F.abs(merged - F.col("exact")) <= F.col("exact") * 0.05).alias("within_5_percent"))


def tier_changes(bank: Bank) -> DataFrame:
    """A change feed: from each account, 60 days after its opening, its balance sets a new tier of its owner.

    A customer with several accounts has several changes, some of them on one day or without effect. Accounts
    without an owner give changes without a key, those without a type changes without a date.
    """
    tier = F.when(F.col("balance") < 0, "High").when(F.col("balance") < 5000, "Medium").otherwise("Low")
    return bank.account.select(
        F.when(F.col("customer_id") > 0, F.col("customer_id")).alias("customer_id"),
        F.when(F.col("account_type").isNotNull(), F.date_add("open_date", 60)).alias("change_date"),
        tier.alias("risk_tier"),
    )


def tier_history(bank: Bank) -> DataFrame:
    return bank.customer_scd2.select(
        "customer_id", "first_name", "risk_tier", "effective_start", "effective_end", "is_current", "version"
    )


def scd2_upsert(bank: Bank) -> DataFrame:
    """Customer history after a change feed."""
    return scd2.scd2_upsert(tier_history(bank), tier_changes(bank), "customer_id", ["risk_tier"])


def transactions_with(operator: Callable[[DataFrame], DataFrame]) -> BankQuery:
    return lambda bank: operator(bank.transaction)


BATCH: dict[str, BankQuery] = {
    # scans and entity rules
    "conform_transaction": lambda bank: canonical(bank, "transaction"),
    "conform_customer": lambda bank: canonical(bank, "customer"),
    "conform_account": lambda bank: canonical(bank, "account"),
    "conform_product": lambda bank: canonical(bank, "product"),
    "conform_branch": lambda bank: canonical(bank, "branch"),
    "customer_clean": cleaned("customer"),
    "account_clean": cleaned("account"),
    "transaction_clean": cleaned("transaction"),
    "product_clean": cleaned("product"),
    "branch_clean": cleaned("branch"),
    "config_transform": lambda bank: configured.apply_config(bank.customer_scd2, "customer", CONFIG),
    "risk_bucket": risk_bucket_native,
    "risk_bucket_udf": risk_bucket_with(risk_bucket_udf),
    "risk_bucket_pandas_udf": risk_bucket_with(risk_bucket_pandas_udf),
    "risk_bucket_counts": risk_bucket_counts,
    # joins
    "branch_summary": lambda bank: analytics.branch_summary(bank.transaction, bank.account, bank.branch),
    "product_enrichment": lambda bank: joins.enrich_product(bank.transaction, bank.product),
    "scd2_point_in_time": lambda bank: joins.point_in_time(bank.transaction, bank.account, bank.customer_scd2),
    "scd2_current_only": lambda bank: joins.current_only(bank.transaction, bank.account, bank.customer_scd2),
    "salted_join": account_totals_after(plain_salted),
    "salted_hot_join": account_totals_after(hot_salted),
    "enriched_transactions": lambda bank: joins.enrich(
        bank.transaction, bank.account, bank.product, bank.branch, bank.customer_scd2
    ),
    # aggregations
    "daily_customer_spend": daily_customer_spend,
    "branch_totals": lambda bank: analytics.branch_totals(bank.transaction, bank.account),
    "state_totals": lambda bank: analytics.state_totals(bank.transaction, bank.account, bank.branch),
    "txn_global_stats": transactions_with(analytics.txn_stats),
    "type_currency_totals": lambda bank: analytics.totals_by(bank.transaction, ["transaction_type", "currency"]),
    "account_skew_profile": lambda bank: analytics.key_profile(bank.transaction, "account_id", 10),
    "distinct_accounts": lambda bank: analytics.distinct_count(bank.transaction, "account_id"),
    "approx_distinct_accounts": approx_distinct_accounts,
    "event_dates": transactions_with(analytics.event_dates),
    # windows and deduplication
    "dedup_latest": transactions_with(dedup.dedup_latest),
    "dedup_by_day": dedup_by_day,
    "dedup_unknown_keys": dedup_unknown_keys,
    "dedup_counts": transactions_with(dedup.dedup_report),
    "dedup_any_ids": duplicate_free_ids,
    "running_balance": transactions_with(windows.running_balance),
    "running_balance_rows": lambda bank: windows.running_balance(bank.transaction, frame="rows"),
    "velocity_alerts": transactions_with(windows.velocity_alerts),
    "velocity_trailing": velocity_trailing,
    "velocity_tumbling": velocity_tumbling,
    "rolling_7d_avg": transactions_with(windows.rolling_avg),
    "amount_spike": amount_spike,
    "daily_running_balance": transactions_with(windows.daily_running_balance),
    # quality
    "dq_non_finite": dq_non_finite,
    "dq_valid": lambda bank: quality.split_quality(bank.transaction)[0],
    "dq_quarantine": lambda bank: quality.split_quality(bank.transaction)[1].drop("rejection_reasons"),
    "dq_reasons": lambda bank: quality.split_quality(bank.transaction)[1].select(
        "transaction_id", "event_ts", "rejection_reasons"
    ),
    "dq_rule_counts": transactions_with(quality.rule_counts),
    "dq_summary": transactions_with(quality.quality_summary),
    "duplicate_ids": transactions_with(quality.duplicate_ids),
    "lateness_histogram": transactions_with(quality.lateness),
    "branch_dq": lambda bank: quality.branch_quality(bank.transaction, bank.account, bank.branch),
    "null_invalid_pct": transactions_with(quality.null_invalid_pct),
    # analytics catalogue
    "revenue_by_branch_state": analytics.revenue_by_branch_state,
    "revenue_by_product": analytics.revenue_by_product,
    "top_customers": analytics.top_customers,
    "monthly_trend": analytics.monthly_trend,
    "dormant_by_branch": analytics.dormant_by_branch,
    "avg_balance_by_type": analytics.avg_balance_by_type,
    "volume_by_state": analytics.volume_by_state,
    "revenue_by_currency": analytics.revenue_by_currency,
    "closed_accounts": analytics.closed_accounts,
    "risk_tier_changes": analytics.risk_tier_changes,
    "peak_hours": analytics.peak_hours,
    "weekend_weekday": analytics.weekend_weekday,
    "age_volume_corr": analytics.age_volume_corr,
    # incremental and production jobs
    "daily_spend_window": daily_spend_window,
    "end_to_end_daily_spend": end_to_end_daily_spend,
    "scd2_upsert": scd2_upsert,
    # batch twin of the hourly stream
    "hourly_totals": hourly_totals,
}


def run_batch(name: str, spark: SparkSession, base: str) -> DataFrame:
    return portable(BATCH[name](Bank.over(use_utc(spark), base)))
