"""Finding hot keys and splitting their rows.

A hot key is one of the `top` most frequent keys with at least `min_rows` rows. The list can never
exceed `top` rows, so it is safe to broadcast, and a key outside it holds at most 1/top of all rows
(or fewer than `min_rows`), so it is safe in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOP_KEYS = 10_000
HOT_ROWS = 1_000
ROWS_PER_SALT = 1_000_000
NULL_SPREAD = 1_024


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows per key. Partial aggregation reduces a hot key to one row per input task."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("key_rows"))


def hot_keys(df: DataFrame, key: str, min_rows: int = HOT_ROWS, top: int = TOP_KEYS) -> DataFrame:
    """`key, key_rows` of the keys of a frame to treat as hot: at most `top` of them."""
    return key_counts(df, key).filter(F.col("key_rows") >= min_rows).orderBy(F.desc("key_rows"), key).limit(top)


def plain_key(column: str) -> dict[str, Column]:
    """A nullable whole-number key as two columns without NULLs, which group, sort and join like one key."""
    return {"_key": F.coalesce(F.col(column), F.lit(0)), "_no_key": F.col(column).isNull()}


def row_hash(columns: Sequence[str | Column]) -> Column:
    """A hash of the row's own values, so a retried task assigns the same salt."""
    return F.xxhash64(*columns)


def salt_counts(hot: DataFrame, key: str, rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """`_hot_key, _salts`: enough salts for each hot key that one salt holds about rows_per_salt rows.

    All salts together number at most total rows / rows_per_salt plus the hot keys.
    """
    salts = F.greatest(F.ceil(F.col("key_rows") / F.lit(rows_per_salt)), F.lit(2)).cast("int")
    return hot.filter(F.col(key).isNotNull()).select(F.col(key).alias("_hot_key"), salts.alias("_salts"))


def salt_big(big: DataFrame, salts: DataFrame, key: str) -> DataFrame:
    """Spread the rows of hot keys over their salts. NULL keys match nothing and are spread freely."""
    hashed = row_hash(big.columns)
    return (
        big.join(F.broadcast(salts), big[key] == salts["_hot_key"], "left")
        .withColumn(
            "_salt",
            F.when(F.col(key).isNull(), F.pmod(hashed, F.lit(NULL_SPREAD)))
            .when(F.col("_salts").isNotNull(), F.pmod(hashed, F.col("_salts")))
            .otherwise(F.lit(0))
            .cast("int"),
        )
        .drop("_hot_key", "_salts")
    )


def salt_small(small: DataFrame, salts: DataFrame, key: str) -> DataFrame:
    """Copy the rows of hot keys once per salt; every other row keeps the single salt 0."""
    return (
        small.join(F.broadcast(salts), small[key] == salts["_hot_key"], "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts") - 1, F.lit(0)))))
        .drop("_hot_key", "_salts")
    )
