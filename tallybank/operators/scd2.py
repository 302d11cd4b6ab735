"""Applying a change feed to an SCD2 table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

HISTORY = ("effective_start", "effective_end", "is_current", "version")


def one_change_per_day(
    changes: DataFrame, key: str, tracked: Sequence[str], sequence: str | None = None
) -> DataFrame:
    """The last change of each key and day, by `sequence` and then by value.

    The aggregate runs map-side first, so a key with very many changes leaves one row per day.
    """
    order = [sequence] if sequence else []
    last = F.max(F.struct(*order, *tracked)).alias("_last")
    return changes.groupBy(key, "change_date").agg(last).select(key, "change_date", *[f"_last.{c}" for c in tracked])


def scd2_upsert(
    current: DataFrame, changes: DataFrame, key: str, tracked: Sequence[str], sequence: str | None = None
) -> DataFrame:
    """The whole table after the changes.

    `current` has the key, attributes and effective_start, effective_end, is_current, version, with one
    current row per key. `changes` has the key, change_date and the tracked columns. A change closes the
    open version the day before and opens the next one; a change to equal values is ignored; a change on
    the open version's first day replaces its values; an earlier one is stale. A new key starts at version 1.
    Untracked attributes are carried over. `judge_changes` tells what became of each change.

    Closed versions and keys without a change pass by; only changed keys are sorted.
    """
    untouched = current.join(known_changes(changes, key).select(key).distinct(), key, "left_anti")
    closed = current.filter(~F.col("is_current"))
    versions = changed_versions(current, changes, key, tracked, sequence)
    return closed.unionByName(untouched.filter("is_current")).unionByName(versions).select(*current.columns)


def known_changes(changes: DataFrame, key: str) -> DataFrame:
    """Changes whose key and date are known."""
    return changes.filter(F.col(key).isNotNull() & F.col("change_date").isNotNull())


def changed_versions(
    current: DataFrame, changes: DataFrame, key: str, tracked: Sequence[str], sequence: str | None = None
) -> DataFrame:
    """The open version of each changed key as it is now, and the versions that follow it."""
    changes = known_changes(changes, key)
    untracked = [c for c in current.columns if c not in (key, *tracked, *HISTORY)]
    opened = (
        current.filter("is_current")
        .join(changes.select(key).distinct(), key, "left_semi")
        .select(
            key,
            *tracked,
            *untracked,
            F.col("effective_start").alias("_start"),
            F.col("version").alias("_version"),
            F.lit(False).alias("_change"),
        )
    )
    arrivals = one_change_per_day(changes, key, tracked, sequence).select(
        key, *tracked, F.col("change_date").alias("_start"), F.lit(True).alias("_change")
    )
    events = opened.unionByName(arrivals, allowMissingColumns=True)

    # Per key: the open version first, then its changes by day.
    chain = Window.partitionBy(key).orderBy("_change", "_start")
    whole = Window.partitionBy(key)
    open_start = F.max(F.when(~F.col("_change"), F.col("_start"))).over(whole)
    known = events.withColumns(
        {
            "_open_start": open_start,
            "_base": F.coalesce(F.max("_version").over(whole), F.lit(1)),
            **{c: F.first(c).over(chain) for c in untracked},
        }
    ).filter(~F.col("_change") | F.col("_open_start").isNull() | (F.col("_start") >= F.col("_open_start")))

    # A change on the first day of the open version takes that version's place.
    same_day = Window.partitionBy(key, "_start").orderBy(F.desc("_change"))
    latest = known.withColumn("_rank", F.row_number().over(same_day)).filter("_rank = 1").drop("_rank")

    by_day = Window.partitionBy(key).orderBy("_start")
    values = F.struct(*tracked)
    before = F.lag(values).over(by_day)
    changed = latest.withColumn("_changed", before.isNull() | ~values.eqNullSafe(before)).filter("_changed")

    after = F.lead("_start").over(by_day)
    return changed.select(
        key,
        *tracked,
        *untracked,
        F.col("_start").alias("effective_start"),
        F.date_sub(after, 1).alias("effective_end"),
        after.isNull().alias("is_current"),
        (F.col("_base") + F.row_number().over(by_day) - 1).cast("int").alias("version"),
    )


def judge_changes(
    current: DataFrame, changes: DataFrame, key: str, tracked: Sequence[str], sequence: str | None = None
) -> DataFrame:
    """What `scd2_upsert` does with each different change, with the number of its copies in the feed.

    Outcomes: `unknown key`, `unknown date`, `superseded` (another one of the same key and day comes after it),
    `stale` (dated before the open version), `unchanged` (the values are those before it), `applied`.
    """
    order = [sequence] if sequence else []
    counted = changes.groupBy(key, "change_date", *order, *tracked).agg(F.count(F.lit(1)).alias("copies"))
    is_known = F.col(key).isNotNull() & F.col("change_date").isNotNull()
    unknown = counted.filter(~is_known).withColumn(
        "outcome", F.when(F.col(key).isNull(), "unknown key").otherwise("unknown date")
    )
    opened = current.filter("is_current").select(
        key, F.col("effective_start").alias("_open_start"), F.struct(*tracked).alias("_open")
    )
    in_order, values = F.struct(*order, *tracked), F.struct(*tracked)
    last = (
        counted.filter(is_known)
        .groupBy(key, "change_date")
        .agg(F.max(in_order).alias("_last"))
        .join(opened, key, "left")
        .withColumns(
            {
                "_values": F.struct(*[F.col(f"_last.{c}").alias(c) for c in tracked]),
                "_stale": F.coalesce(F.col("change_date") < F.col("_open_start"), F.lit(False)),
            }
        )
    )
    in_time = Window.partitionBy(key, "_stale").orderBy("change_date")
    before = F.coalesce(F.lag("_values").over(in_time), F.col("_open"))
    same = before.isNotNull() & F.col("_values").eqNullSafe(before)
    fate = F.when(F.col("_stale"), "stale").when(same, "unchanged").otherwise("applied")
    judged = last.select(key, "change_date", "_last", fate.alias("_fate"))
    known = (
        counted.join(judged, [key, "change_date"])
        .withColumn("outcome", F.when(in_order.eqNullSafe(F.col("_last")), F.col("_fate")).otherwise("superseded"))
        .drop("_last", "_fate")
    )
    return unknown.unionByName(known)


def stale_changes(current: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Changes dated before the open version of their key, which the upsert leaves out."""
    opened = current.filter("is_current").select(key, F.col("effective_start").alias("_open_start"))
    return changes.join(opened, key).filter(F.col("change_date") < F.col("_open_start")).drop("_open_start")
