"""Aggregations and the analytics catalogue.

Totals over account attributes are summed per account before the account table is joined: the sum
runs map-side first, so a hot account reaches the shuffle as one row per task. Revenue and spend in
the catalogue count approved transactions with a real amount.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybank.functions.money import exact_sum, fit_count, in_currency, mean
from tallybank.functions.skew import key_counts
from tallybank.operators.joins import account_homes, branch_names, enrich_product, fill_unknown
from tallybank.operators.quality import RULES
from tallybank.views import Bank

# Partial results that can be summed again: amount, rows, and rows with an amount.
SKETCH_BITS = 14
PARTS = ("_amount", "_rows", "_amounts")


def partial_totals(df: DataFrame, *keys) -> DataFrame:
    return df.groupBy(*keys).agg(
        exact_sum("amount").alias("_amount"),
        F.count(F.lit(1)).alias("_rows"),
        fit_count("amount").alias("_amounts"),
    )


def roll_up(df: DataFrame, *keys) -> DataFrame:
    """Sum partial totals by coarser keys."""
    return df.groupBy(*keys).agg(*[F.sum(part).alias(part) for part in PARTS])


def finish(df: DataFrame, *columns: str, total: str = "total_amount", count: str = "txn_count") -> DataFrame:
    """Keep the named columns with the total as an amount and the row count."""
    return df.select(*columns, in_currency("_amount").alias(total), F.col("_rows").alias(count))


def average():
    """Average over the rows that have an amount; NULL when there are none."""
    return mean("_amount", "_amounts")


def valid_accounts(txn: DataFrame) -> DataFrame:
    return txn.filter(F.col("account_id") > 0)


def real_amounts(txn: DataFrame) -> DataFrame:
    """Rows whose amount is neither missing nor a sentinel."""
    return txn.filter(RULES["failed_amount"])


def revenue_rows(txn: DataFrame) -> DataFrame:
    return real_amounts(txn).filter(F.col("status") == "Approved")


def totals_by_branch(txn: DataFrame, account: DataFrame) -> DataFrame:
    """Partial totals per branch of the account."""
    per_account = partial_totals(valid_accounts(txn), "account_id")
    return roll_up(per_account.join(account_homes(account), "account_id"), "branch_id")


def branch_summary(
    txn: DataFrame,
    account: DataFrame,
    branch: DataFrame,
    exclude: Sequence[str] = ("Reversed",),
    digits: int | None = None,
) -> DataFrame:
    """Total, count and average per branch of the account, largest total first. `digits` rounds the average."""
    kept = txn.filter(~F.col("status").isin(list(exclude)))
    avg_amount = average() if digits is None else F.round(average(), digits)
    return (
        totals_by_branch(kept, account)
        .withColumn("avg_amount", avg_amount)
        .join(branch_names(branch), "branch_id")
        .transform(finish, "branch_id", "branch_name", "state", "avg_amount")
        .orderBy(F.desc("total_amount"), "branch_id")
    )


def daily_spend(
    txn: DataFrame, account: DataFrame, valid_only: bool = False, statuses: Sequence[str] | None = None
) -> DataFrame:
    """Spend and count per customer and day. By default every amount counts, sentinels and all statuses too."""
    rows = real_amounts(txn) if valid_only else txn
    if statuses is not None:
        rows = rows.filter(F.col("status").isin(list(statuses)))
    per_account = partial_totals(rows, "account_id", "event_date")
    owners = account.select("account_id", "customer_id")
    return roll_up(per_account.join(owners, "account_id"), "customer_id", "event_date").transform(
        finish, "customer_id", "event_date", total="total_spend"
    )


def branch_totals(txn: DataFrame, account: DataFrame) -> DataFrame:
    """Total and count per branch of the account, all branch values included."""
    per_account = partial_totals(txn, "account_id")
    homes = account.select("account_id", "branch_id")
    return roll_up(per_account.join(homes, "account_id"), "branch_id").transform(finish, "branch_id")


def state_totals(txn: DataFrame, account: DataFrame, branch: DataFrame) -> DataFrame:
    """Total and count per state of the account's branch.

    Three shuffles: the fact reduced to accounts, the account table, and the states; two where AQE can
    broadcast the accounts.
    """
    per_account = partial_totals(txn, "account_id")
    homes = account.select("account_id", "branch_id").join(branch_names(branch), "branch_id")
    return roll_up(per_account.join(homes, "account_id"), "state").transform(finish, "state")


def counts_by(df: DataFrame, cols: Sequence[str], name: str = "txn_count") -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(name))


def txn_stats(df: DataFrame) -> DataFrame:
    """Row count, approved count and average amount of the whole table."""
    return df.agg(
        F.count(F.lit(1)).alias("txn_count"),
        F.count_if(F.col("status") == "Approved").alias("approved_count"),
        exact_sum("amount").alias("_amount"),
        fit_count("amount").alias("_amounts"),
    ).select("txn_count", "approved_count", average().alias("avg_amount"))


def totals_by(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Total and count per group."""
    return partial_totals(df, *cols).transform(finish, *cols)


def key_profile(df: DataFrame, key: str, n: int | None = None) -> DataFrame:
    """Rows per key and their share of all rows, most frequent first; `n` keeps a top-n report.

    The table is read once: the total is the sum of the counts.
    """
    counts = key_counts(df, key)
    total = counts.agg(F.sum("key_rows")).scalar()
    ranked = counts.orderBy(F.desc("key_rows"), F.asc_nulls_last(key))
    top = ranked if n is None else ranked.limit(n)
    return top.select(key, "key_rows", (F.col("key_rows") / total).alias("key_share"))


def distinct_count(df: DataFrame, col: str, approx: bool = False, rsd: float = 0.05) -> DataFrame:
    counted = F.approx_count_distinct(col, rsd) if approx else F.count_distinct(col)
    return df.agg(counted.alias("distinct_count"))


def daily_sketches(df: DataFrame, col: str, day: str = "event_date", bits: int = SKETCH_BITS) -> DataFrame:
    """A sketch of the distinct values of each day, of a fixed size: stored once, merged for any range of days."""
    return df.groupBy(day).agg(F.hll_sketch_agg(col, bits).alias("sketch"))


def merged_distinct(sketches: DataFrame, *by: str) -> DataFrame:
    """Estimated distinct values over all rows of sketches, or per group of them. The standard error is about
    1.04 / sqrt(2 ** bits): 0.8 % at 14 bits. Missing values do not count."""
    merged = F.hll_sketch_estimate(F.hll_union_agg("sketch"))
    return sketches.groupBy(*by).agg(merged.alias("distinct_count"))


def event_dates(df: DataFrame) -> DataFrame:
    return df.select("event_date").distinct().orderBy("event_date")


def top_n(df: DataFrame, by: str, n: int, tie: str) -> DataFrame:
    """The n largest rows; ties go to the smaller key."""
    return df.orderBy(F.desc(by), F.col(tie)).limit(n)


# Catalogue: one function per question, over the banking tables.


def revenue_by_branch_state(bank: Bank) -> DataFrame:
    per_branch = totals_by_branch(revenue_rows(bank.transaction), bank.account)
    return per_branch.join(branch_names(bank.branch), "branch_id").transform(
        finish, "branch_id", "branch_name", "state", total="revenue"
    )


def revenue_by_product(bank: Bank) -> DataFrame:
    """Revenue per product, unmatched products together under an Unknown name for each id."""
    per_product = partial_totals(revenue_rows(bank.transaction), "product_id")
    return enrich_product(per_product, bank.product).transform(
        finish, "product_id", "product_name", "product_group", total="revenue"
    )


def top_customers(bank: Bank, n: int = 10) -> DataFrame:
    """The customers with the highest approved spend, with their current name."""
    per_account = partial_totals(revenue_rows(bank.transaction), "account_id")
    owners = bank.account.filter(F.col("customer_id") > 0).select("account_id", "customer_id")
    spend = roll_up(per_account.join(owners, "account_id"), "customer_id").transform(
        finish, "customer_id", total="total_spend"
    )
    names = bank.customer_scd2.filter("is_current").select("customer_id", "first_name", "last_name", "risk_tier")
    best = F.broadcast(top_n(spend, "total_spend", n, "customer_id"))
    return names.join(best, "customer_id", "right").select(
        "customer_id", "first_name", "last_name", "risk_tier", "total_spend", "txn_count"
    )


def monthly_trend(bank: Bank) -> DataFrame:
    month = F.trunc("event_date", "month").alias("month")
    return partial_totals(bank.transaction, month).transform(finish, "month")


def dormant_by_branch(bank: Bank) -> DataFrame:
    dormant = counts_by(
        account_homes(bank.account.filter(F.col("status") == "Dormant")), ["branch_id"], "dormant_accounts"
    )
    return (
        dormant.join(branch_names(bank.branch), "branch_id")
        .select("branch_id", "branch_name", "state", "dormant_accounts")
        .orderBy(F.desc("dormant_accounts"), "branch_id")
    )


def avg_balance_by_type(bank: Bank) -> DataFrame:
    balances = bank.account.withColumnRenamed("balance", "amount")
    return partial_totals(balances, "account_type").select(
        "account_type", F.col("_rows").alias("account_count"), average().alias("avg_balance")
    )


def volume_by_state(bank: Bank) -> DataFrame:
    """State totals over valid accounts, branches without a state under Unknown."""
    named = fill_unknown(bank.branch, "state")
    return state_totals(valid_accounts(bank.transaction), bank.account, named)


def revenue_by_currency(bank: Bank) -> DataFrame:
    return partial_totals(revenue_rows(bank.transaction), "currency").transform(finish, "currency", total="revenue")


def closed_accounts(bank: Bank) -> DataFrame:
    """All closed accounts, with their current customer where one is known. Accounts carry no status history, so no change is claimed."""
    closed = bank.account.filter(F.col("status") == "Closed").select(
        "account_id", "customer_id", "branch_id", "open_date", "balance"
    )
    owners = bank.customer_scd2.filter("is_current").select("customer_id", "first_name", "last_name", "risk_tier")
    return closed.join(owners, "customer_id", "left").select(
        "account_id", "customer_id", "first_name", "last_name", "risk_tier", "branch_id", "open_date", "balance"
    )


def risk_tier_changes(bank: Bank) -> DataFrame:
    """Versions after the first, and the day they began."""
    return bank.customer_scd2.filter("version > 1").select(
        "customer_id", "version", "risk_tier", F.col("effective_start").alias("changed_on")
    )


def peak_hours(bank: Bank) -> DataFrame:
    hour = F.hour("event_ts").alias("hour")
    return partial_totals(bank.transaction, hour).transform(finish, "hour").orderBy(F.desc("txn_count"), "hour")


def weekend_weekday(bank: Bank) -> DataFrame:
    weekend = F.dayofweek("event_date").isin(1, 7)
    kind = F.when(weekend, "weekend").otherwise("weekday").alias("day_type")
    return (
        partial_totals(real_amounts(bank.transaction), kind)
        .withColumn("avg_amount", average())
        .transform(finish, "day_type", "avg_amount")
    )


def age_volume_corr(bank: Bank, as_of: dt.date | str = "2024-01-01") -> DataFrame:
    """Correlation of account age in days with the number of transactions. Shifting `as_of` does not change it."""
    volume = key_counts(valid_accounts(bank.transaction), "account_id")
    ages = bank.account.select(
        "account_id", F.datediff(F.lit(str(as_of)).cast("date"), "open_date").alias("age_days")
    )
    return (
        ages.join(volume, "account_id")
        .agg(F.count(F.lit(1)).alias("accounts"), F.corr("age_days", "key_rows").alias("correlation"))
        .select("accounts", F.round("correlation", 6).alias("age_volume_corr"))
    )
