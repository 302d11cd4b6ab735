"""Joins of the transaction fact with its dimensions.

The account's branch is the one that counts; the fact's own branch_id is kept as txn_branch_id.
account_id is the key of the account table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybank.functions.sizing import broadcast_if_small
from tallybank.functions.skew import hot_keys, row_hash, salt_big, salt_counts, salt_small

UNKNOWN = "Unknown"
OPEN_END = "9999-12-31"
POINT_IN_TIME_COLUMNS = [
    "transaction_id",
    "event_date",
    "amount",
    "customer_id",
    "first_name",
    "last_name",
    "risk_tier",
    "version",
]


def keep_own_branch(txn: DataFrame) -> DataFrame:
    return txn.withColumnRenamed("branch_id", "txn_branch_id")


def account_homes(account: DataFrame) -> DataFrame:
    """account_id and branch_id of accounts with a valid branch."""
    return account.filter(F.col("branch_id") > 0).select("account_id", "branch_id")


def branch_names(branch: DataFrame) -> DataFrame:
    return broadcast_if_small(branch.select("branch_id", "branch_name", "state"))


def join_branch(txn: DataFrame, account: DataFrame, branch: DataFrame) -> DataFrame:
    """Rows with a valid account, each with the branch of its account.

    Also takes a frame already aggregated by account_id; prefer that where only totals are wanted.
    """
    valid = keep_own_branch(txn).filter(F.col("account_id") > 0)
    return valid.join(account_homes(account), "account_id").join(branch_names(branch), "branch_id")


def fill_unknown(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(UNKNOWN)) for c in columns})


def enrich_product(txn: DataFrame, product: DataFrame, hint: bool = True) -> DataFrame:
    """Every transaction with its product's name and group, "Unknown" where there is none."""
    names = product.select("product_id", "product_name", "product_group")
    return fill_unknown(
        txn.join(broadcast_if_small(names) if hint else names, "product_id", "left"),
        "product_name",
        "product_group",
    )


def account_versions(account: DataFrame, scd: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Customer versions keyed by account: a join of two dimensions, so the fact later needs one key only."""
    # Accounts without an owner all have customer -1: one key, which no version has.
    owners = account.select("account_id", "customer_id").filter("customer_id > 0")
    return owners.join(scd.select("customer_id", "effective_start", "effective_end", *columns), "customer_id")


def valid_on(date: Column) -> Column:
    """The version's closed interval holds the date; an open end lasts forever."""
    last = F.coalesce(F.col("effective_end"), F.lit(OPEN_END).cast("date"))
    return (date >= F.col("effective_start")) & (date <= last)


def account_salts(txn: DataFrame) -> DataFrame:
    """Salts of the accounts that hold too many rows for one task."""
    return salt_counts(hot_keys(txn, "account_id"), "account_id")


def on_account(facts: DataFrame, dimension: DataFrame) -> tuple[DataFrame, Column]:
    """The salted dimension with its keys renamed, and the join condition on them."""
    keyed = dimension.withColumnsRenamed({"account_id": "_account_id", "_salt": "_salt_copy"})
    return keyed, (facts["account_id"] == keyed["_account_id"]) & (facts["_salt"] == keyed["_salt_copy"])


def point_in_time(txn: DataFrame, account: DataFrame, scd: DataFrame, how: str = "inner") -> DataFrame:
    """Each transaction with the customer attributes valid on its event date.

    The fact is shuffled once, on (account_id, salt): the customer's versions are first keyed by account.
    """
    salts = account_salts(txn)
    facts = salt_big(txn.select("transaction_id", "account_id", "event_date", "amount"), salts, "account_id")
    versions = account_versions(account, scd, ["first_name", "last_name", "risk_tier", "version"])
    versions, same_account = on_account(facts, salt_small(versions, salts, "account_id"))
    return facts.join(versions, same_account & valid_on(facts["event_date"]), how).select(*POINT_IN_TIME_COLUMNS)


def current_only(txn: DataFrame, account: DataFrame, scd: DataFrame) -> DataFrame:
    """The quick form with today's customer attributes: wrong for history, kept for comparison."""
    salts = account_salts(txn)
    facts = salt_big(txn.select("transaction_id", "account_id", "event_date", "amount"), salts, "account_id")
    versions = account_versions(
        account, scd.filter("is_current"), ["first_name", "last_name", "risk_tier", "version"]
    )
    versions, same_account = on_account(facts, salt_small(versions, salts, "account_id"))
    return facts.join(versions, same_account).select(*POINT_IN_TIME_COLUMNS)


def salted_join(
    big: DataFrame,
    small: DataFrame,
    key: str,
    n: int = 10,
    hot_keys: DataFrame | None = None,
    how: str = "inner",
) -> DataFrame:
    """Equi join that spreads each key of `big` over several tasks; same rows as the plain join.

    Without `hot_keys` every key gets n salts and `small` is copied n times. With `hot_keys`
    (`key, key_rows`, see functions.skew.hot_keys) only those keys are split, by their row count.
    The copies are shuffled, never broadcast: the optimizer's estimate does not count them, so it would
    send a table n times too large through the driver.
    """
    if hot_keys is not None:
        salts = salt_counts(hot_keys, key)
        left, right = salt_big(big, salts, key), salt_small(small, salts, key)
    else:
        left = big.withColumn("_salt", F.pmod(row_hash(big.columns), F.lit(n)).cast("int"))
        right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return left.join(right.hint("merge"), [key, "_salt"], how).drop("_salt")


def bucketed_join(spark: SparkSession, left_table: str, right_table: str, key: str | Sequence[str]) -> DataFrame:
    """Join of two tables bucketed alike on the key, or on key and salt: no shuffle is planned, nor a broadcast."""
    keys = [key] if isinstance(key, str) else list(key)
    return spark.table(left_table).join(spark.table(right_table).hint("merge"), keys)


def enrich(
    txn: DataFrame, account: DataFrame, product: DataFrame, branch: DataFrame, scd: DataFrame
) -> DataFrame:
    """Every transaction with account, branch, product and point-in-time customer columns, NULL where missing.

    Account and customer versions are both joined on (account_id, salt), so the fact is shuffled once.
    """
    salts = account_salts(txn)
    facts = salt_big(keep_own_branch(txn), salts, "account_id")

    homes = broadcast_if_small(
        branch.select(
            "branch_id",
            "branch_name",
            F.col("state").alias("branch_state"),
            F.col("open_date").alias("branch_open_date"),
        )
    )
    owners = account.select(
        "account_id",
        "customer_id",
        "branch_id",
        "account_type",
        F.col("status").alias("account_status"),
        F.col("open_date").alias("account_open_date"),
        F.col("balance").alias("account_balance"),
    ).join(homes, "branch_id", "left")
    joined = facts.join(salt_small(owners, salts, "account_id"), ["account_id", "_salt"], "left")

    attributes = ["first_name", "last_name", "email", "phone", "risk_tier", "is_current", "version"]
    versions = account_versions(account, scd, attributes).drop("customer_id")
    versions, same_account = on_account(joined, salt_small(versions, salts, "account_id"))
    joined = joined.join(versions, same_account & valid_on(joined["event_date"]), "left")

    names = broadcast_if_small(product.select("product_id", "product_name", "product_group"))
    return joined.join(names, "product_id", "left").drop("_salt", "_account_id", "_salt_copy")
