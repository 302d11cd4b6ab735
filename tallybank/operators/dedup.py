"""Removing repeated transactions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LATEST = ("ingest_date", "event_ts")


def dedup_latest(
    df: DataFrame, keys: Sequence[str] = ("transaction_id",), order: Sequence[str] = LATEST
) -> DataFrame:
    """Keep the latest row per key: `order` descending, then every other column, so no tie is left open.

    Rows whose key is not fully known are not copies of each other: all of them stay.

    Spark limits each key to one row per input task before the shuffle, so a key with very many copies
    sends one row per task, not all of them.
    """
    return _one_per_key(df, keys, [F.desc_nulls_last(c) for c in _then_all(df, keys, order)])


def dedup_first(
    df: DataFrame, keys: Sequence[str] = ("transaction_id",), order: Sequence[str] = ("event_ts",)
) -> DataFrame:
    """Keep the earliest row per key: `order` ascending, missing values first, then every other column."""
    return _one_per_key(df, keys, [F.asc_nulls_first(c) for c in _then_all(df, keys, order)])


def _then_all(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> list[str]:
    return [*order, *[c for c in df.columns if c not in keys and c not in order]]


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Rows with an unknown key never enter the shuffle."""
    first = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.filter(~unknown(keys)).withColumn("_rank", F.row_number().over(first))
    return ranked.filter("_rank = 1").drop("_rank").unionByName(df.filter(unknown(keys)))


def without_earlier(
    df: DataFrame, earlier: DataFrame, delay: str | None, key: str = "transaction_id", time: str = "event_ts"
) -> DataFrame:
    """Rows of `df` of which `earlier` has no row with the same known key at most `delay` apart (any, if None)."""
    kept = earlier.select(F.col(key).alias("_key"), F.col(time).alias("_time"))
    same = F.col(key) == F.col("_key")
    if delay is not None:
        near = F.expr(f"interval {delay}")
        same &= F.col("_time").between(F.col(time) - near, F.col(time) + near)
    return df.join(kept, same, "left_anti")


def unknown(keys: Sequence[str]) -> Column:
    """Whether some part of the key is missing."""
    return reduce(or_, [F.col(key).isNull() for key in keys])


def dedup_any(df: DataFrame, keys: Sequence[str] = ("transaction_id",)) -> DataFrame:
    """One arbitrary row per known key, for comparison: the survivor is not defined when copies differ."""
    return df.filter(~unknown(keys)).dropDuplicates([*keys]).unionByName(df.filter(unknown(keys)))


def dedup_report(df: DataFrame, keys: Sequence[str] = ("transaction_id",)) -> DataFrame:
    """Rows before, after and removed, from the key counts alone: no row needs to be ranked for it."""
    copies = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
    return copies.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum(F.when(unknown(keys), F.col("_copies")).otherwise(1)), F.lit(0)).alias("rows_after"),
    ).withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))
