"""Cleaning rules of the five entities in their canonical layout."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Formats and classification lists.
EMAIL_FORMAT = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
PHONE_FORMAT = r"^\d{3}-\d{3}-\d{4}$"
STATE_FORMAT = r"^[A-Z]{2}$"
TRAILING_NUMBER = r"\s+\d+$"
DATE_FORMAT = "yyyy-M-d"
LARGE_AMOUNT = 10_000
BALANCE_TIERS = [(0, "Overdrawn"), (1000, "Low"), (10000, "Medium")]
TOP_TIER = "High"
CREDIT_ACCOUNT_TYPES = ["CREDIT", "LOAN"]
PRODUCT_CATEGORIES = {
    "debit": "Debit",
    "credit": "Credit",
    "saving": "Savings",
    "loan": "Loan",
    "check": "Checking",
}
LENDING_CATEGORIES = ["Credit", "Loan"]
BRANCH_TYPES = {
    "main": "Main",
    "downtown": "Downtown",
    "suburban": "Suburban",
    "airport": "Airport",
    "online": "Online",
    "international": "International",
}


def with_audit(df: DataFrame, run_date: dt.date | str | None = None, column: str = "ingest_date") -> DataFrame:
    """Stamp the rows with the run date; a fixed date makes the job repeatable."""
    stamp = F.current_date() if run_date is None else F.lit(str(run_date)).cast("date")
    return df.withColumn(column, stamp)


def first_match(text: Column, names: dict[str, str], otherwise: str = "Other") -> Column:
    """The label of the first word of `names` that the text contains, case ignored."""
    lowered = F.lower(text)
    hits = [F.when(lowered.contains(word), F.lit(label)) for word, label in names.items()]
    return F.coalesce(*hits, F.lit(otherwise))


def matches(column: str, pattern: str) -> Column:
    """True or false, never NULL."""
    return F.coalesce(F.col(column).rlike(pattern), F.lit(False))


def clean_customer(df: DataFrame, run_date: dt.date | str | None = None) -> DataFrame:
    named = df.withColumns({part: F.initcap(F.trim(part)) for part in ("first_name", "last_name")})
    return named.withColumns(
        {
            "full_name": F.concat_ws(" ", "first_name", "last_name"),
            "email_domain": F.try_element_at(F.split("email", "@"), F.lit(2)),
            "is_email_valid": matches("email", EMAIL_FORMAT),
            "is_phone_valid": matches("phone", PHONE_FORMAT),
        }
    ).transform(with_audit, run_date)


def balance_tier(balance: Column, null_label: str | None = None) -> Column:
    """Tier by upper bound. A NULL balance is below no bound, so it gets the top tier unless `null_label` is set."""
    hits = [F.when(balance < bound, F.lit(label)) for bound, label in BALANCE_TIERS]
    tier = F.coalesce(*hits, F.lit(TOP_TIER))
    return tier if null_label is None else F.when(balance.isNull(), null_label).otherwise(tier)


def clean_account(
    df: DataFrame, run_date: dt.date | str | None = None, null_label: str | None = None
) -> DataFrame:
    kind = F.upper(F.trim("account_type"))
    return df.withColumns(
        {
            "account_type": kind,
            "balance_tier": balance_tier(F.col("balance"), null_label),
            "is_overdrawn": F.col("balance") < 0,
            "is_credit_account": kind.isin(CREDIT_ACCOUNT_TYPES),
            "account_status": F.lit("active"),
        }
    ).transform(with_audit, run_date)


def clean_transaction(
    df: DataFrame, processed_at: dt.datetime | str | None = None, null_label: str | None = None
) -> DataFrame:
    """A NULL amount counts as DEBIT unless `null_label` is set."""
    amount = F.col("amount")
    direction = F.when(amount >= 0, "CREDIT").otherwise("DEBIT")
    if null_label is not None:
        direction = F.when(amount.isNull(), null_label).otherwise(direction)
    stamp = F.current_timestamp() if processed_at is None else F.lit(str(processed_at)).cast("timestamp")
    return df.withColumns(
        {
            "transaction_date": F.try_to_date("transaction_date", DATE_FORMAT),
            "amount_direction": direction,
            "abs_amount": F.abs("amount"),
            "is_large_transaction": F.abs("amount") > LARGE_AMOUNT,
            "is_valid": F.col("transaction_id").isNotNull() & F.col("account_id").isNotNull() & amount.isNotNull(),
            "processed_timestamp": stamp,
        }
    )


def clean_product(df: DataFrame, run_date: dt.date | str | None = None) -> DataFrame:
    category = first_match(F.col("product_name"), PRODUCT_CATEGORIES)
    return (
        df.withColumnRenamed("prod_name", "product_name")
        .withColumns(
            {
                "product_category": category,
                "is_lending_product": category.isin(LENDING_CATEGORIES),
                "product_name_clean": F.trim(F.regexp_replace("product_name", TRAILING_NUMBER, "")),
            }
        )
        .transform(with_audit, run_date)
    )


def clean_branch(df: DataFrame, run_date: dt.date | str | None = None) -> DataFrame:
    return (
        df.withColumns({"city": F.trim("city"), "state": F.trim("state")})
        .withColumns(
            {
                "branch_upper": F.upper("branch_name"),
                "branch_type": first_match(F.col("branch_name"), BRANCH_TYPES),
                "is_state_valid": matches("state", STATE_FORMAT),
            }
        )
        .transform(with_audit, run_date)
    )


CLEANERS = {
    "customer": clean_customer,
    "account": clean_account,
    "transaction": clean_transaction,
    "product": clean_product,
    "branch": clean_branch,
}
