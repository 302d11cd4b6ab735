"""Quality rules and reports. A rule is a SQL condition that a good row meets, named by its failure."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tallybank.functions.skew import key_counts
from tallybank.operators.joins import account_homes, branch_names

Rules = Mapping[str, str]

# Rule names, in report order, and sentinels of dirty data.
RULES: Rules = {
    "failed_txn_id": "transaction_id is not null",
    "failed_acct_id": "account_id > 0",
    "failed_amount": "amount <> -999999.99D and abs(amount) < double('Infinity')",
    "failed_currency": "currency <> 'XXX'",
    "failed_date": "event_date is not null",
    "failed_type": "transaction_type <> 'UNKNOWN'",
}
PIPELINE_RULES: Rules = {
    name: RULES[name] for name in ("failed_txn_id", "failed_acct_id", "failed_amount", "failed_currency")
}
SENTINELS: Mapping[str, Any] = {
    "account_id": -1,
    "amount": -999999.99,
    "currency": "XXX",
    "transaction_type": "UNKNOWN",
}


def passes(condition: str) -> Column:
    """True or false; a condition on a missing value fails."""
    return F.coalesce(F.expr(condition), F.lit(False))


def is_valid(rules: Rules = RULES) -> Column:
    """True or false; to only keep valid rows, filter on `conditions`, which Spark can push into the scan."""
    return F.coalesce(conditions(rules), F.lit(False))


def conditions(rules: Rules = RULES) -> Column:
    """All rules as one condition, not true where a value is missing."""
    return F.expr(" and ".join(f"({rule})" for rule in rules.values()))


def reasons(rules: Rules = RULES) -> Column:
    """Names of the failed rules, in rule order."""
    return F.array_compact(F.array(*[F.when(~passes(rule), F.lit(name)) for name, rule in rules.items()]))


def with_reasons(df: DataFrame, rules: Rules = RULES) -> DataFrame:
    return df.withColumn("rejection_reasons", reasons(rules))


def split_quality(df: DataFrame, rules: Rules = RULES) -> tuple[DataFrame, DataFrame]:
    """Valid rows as they are, and quarantined rows with their reasons."""
    return df.filter(conditions(rules)), with_reasons(df.filter(~is_valid(rules)), rules)


def failures(condition: str) -> Column:
    return F.count_if(~passes(condition))


def rule_counts(df: DataFrame, rules: Rules = RULES) -> DataFrame:
    """Rows that break each rule, in one pass."""
    counts = df.agg(*[failures(condition).alias(name) for name, condition in rules.items()])
    return counts.unpivot([], list(rules), "rule", "violations")


def observe_rules(df: DataFrame, observation: Observation, rules: Rules = RULES) -> DataFrame:
    """Count rows and failures while the frame is written anyway: no extra scan."""
    return df.observe(
        observation,
        F.count(F.lit(1)).alias("total"),
        F.count_if(is_valid(rules)).alias("valid"),
        *[failures(condition).alias(name) for name, condition in rules.items()],
    )


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part * F.lit(100.0), whole)


def quality_summary(df: DataFrame, rules: Rules = RULES) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if(is_valid(rules)).alias("valid_rows")
    ).select(
        "total_rows",
        "valid_rows",
        (F.col("total_rows") - F.col("valid_rows")).alias("quarantined_rows"),
        percent(F.col("total_rows") - F.col("valid_rows"), F.col("total_rows")).alias("quarantined_pct"),
    )


def duplicate_ids(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Keys that occur more than once."""
    return key_counts(df, key).filter("key_rows > 1").withColumnRenamed("key_rows", "copies")


def lateness(df: DataFrame) -> DataFrame:
    """Rows per number of days between event and ingest."""
    late = F.datediff("ingest_date", "event_date")
    return df.groupBy(late.alias("days_late")).agg(F.count(F.lit(1)).alias("txn_count"))


def branch_quality(txn: DataFrame, account: DataFrame, branch: DataFrame, rules: Rules = RULES) -> DataFrame:
    """Rows and bad rows per branch of the account; counted per account before the joins."""
    per_account = (
        txn.filter(F.col("account_id") > 0)
        .groupBy("account_id")
        .agg(F.count(F.lit(1)).alias("_rows"), F.count_if(~is_valid(rules)).alias("_bad"))
    )
    per_branch = (
        per_account.join(account_homes(account), "account_id")
        .groupBy("branch_id")
        .agg(F.sum("_rows").alias("txn_count"), F.sum("_bad").alias("issue_count"))
    )
    return (
        per_branch.join(branch_names(branch), "branch_id")
        .select(
            "branch_id",
            "branch_name",
            "state",
            "txn_count",
            "issue_count",
            percent(F.col("issue_count"), F.col("txn_count")).alias("issue_pct"),
        )
        .orderBy(F.desc("issue_count"), "branch_id")
    )


def null_invalid_pct(df: DataFrame, sentinels: Mapping[str, Any] = SENTINELS) -> DataFrame:
    """NULL and sentinel counts and percentages of every column, in one pass."""
    total = F.count(F.lit(1))
    stats = []
    for column in df.columns:
        invalid = F.count_if(F.col(column) == F.lit(sentinels[column])) if column in sentinels else F.lit(0)
        stats.append(
            F.struct(
                F.lit(column).alias("column_name"),
                total.alias("total_rows"),
                F.count_if(F.col(column).isNull()).alias("null_rows"),
                invalid.cast("bigint").alias("invalid_rows"),
            )
        )
    return (
        df.agg(F.array(*stats).alias("stats"))
        .select(F.inline("stats"))
        .select(
            "column_name",
            "null_rows",
            "invalid_rows",
            percent(F.col("null_rows"), F.col("total_rows")).alias("null_pct"),
            percent(F.col("invalid_rows"), F.col("total_rows")).alias("invalid_pct"),
        )
    )
