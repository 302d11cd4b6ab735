"""Per-account windows that stay parallel when one account holds most of the rows.

A plain window puts an account into one task. Here an account is cut into days and counted pieces of busy
days, or rows are first summed per second, and the pieces are put together again; results equal the plain
form, which `skew_safe=False` gives for comparison.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybank.functions.money import exact_sum, fit_count, in_currency, is_fit, mean
from tallybank.functions.skew import plain_key
from tallybank.session import use_checkpoints

PIECE_ROWS = 4_000_000
BUCKET_SECONDS = 3600
NO_VALUE = -(1 << 62)
DAY = ["_key", "_no_key", "_date"]
BALANCE_COLUMNS = ["account_id", "transaction_id", "event_date", "amount", "running_balance", "txn_rank"]


def epoch_second(column: str = "event_ts") -> Column:
    return F.unix_seconds(column)


def known(value: Column) -> Column:
    """A number that sorts first where the value is missing, so that keys join and group without NULLs."""
    return F.coalesce(value, F.lit(NO_VALUE))


def total_order(df: DataFrame, *first: str) -> list[str]:
    """The given columns, then all others, so that no two different rows tie."""
    return [*first, *[c for c in df.columns if c not in first]]


def plus(*amounts: str) -> Column:
    """Sum of those that are not NULL; NULL if all are."""
    total = F.col(amounts[0])
    for amount in map(F.col, amounts[1:]):
        total = F.coalesce(total + amount, total, amount)
    return total


def running_balance(
    df: DataFrame, frame: str = "range", skew_safe: bool = True, piece_rows: int = PIECE_ROWS
) -> DataFrame:
    """Cumulative amount and rank per account in time order.

    frame "range": rows with the same event_ts share one total. frame "rows": they are added one by
    one, ordered by transaction_id. Ranks are always one by one.

    Prefix sums are taken level by level: over the rows of a piece, over the pieces of a day, and over the
    days of an account. A piece is an account's day, or a part of one that has more than `piece_rows` rows;
    see `cut_days`. Only days and pieces, never the rows of an account, meet in one task.
    """
    if frame not in ("range", "rows"):
        raise ValueError("frame must be 'range' or 'rows'")
    rows = df.select("account_id", "transaction_id", "event_date", "event_ts", "amount")
    ranking = [F.asc_nulls_first(c) for c in total_order(rows, "event_date", "event_ts", "transaction_id", "amount")]
    ordering = ranking if frame == "rows" else ranking[:2]

    if not skew_safe:
        account = Window.partitionBy("account_id")
        return rows.withColumns(
            {
                "txn_rank": F.row_number().over(account.orderBy(*ranking)),
                "running_balance": in_currency(_cumulative(account.orderBy(*ordering), frame)),
            }
        ).select(*BALANCE_COLUMNS)

    placed, keys, offsets = cut_days(rows, ranking, piece_rows)
    within = Window.partitionBy(*keys)
    local = placed.withColumns(
        {
            "_local_rank": F.row_number().over(within.orderBy(*ranking)),
            "_local": _cumulative(within.orderBy(*ordering), frame),
        }
    ).join(offsets, keys)
    if frame == "range" and "_later" in offsets.columns:
        # A moment that goes on in later pieces of the day has their rows in its total too.
        later = F.when(F.col("_moment") == F.col("_last"), F.col("_later"))
        local = local.withColumn("_later", later).withColumn("_local", plus("_local", "_later"))
    return local.withColumns(
        {
            "running_balance": in_currency(plus("_before", "_local")),
            "txn_rank": (F.col("_local_rank") + F.col("_rows_before")).cast("int"),
        }
    ).select(*BALANCE_COLUMNS)


def cut_days(rows: DataFrame, ranking: Sequence[Column], piece_rows: int) -> tuple[DataFrame, list[str], DataFrame]:
    """The rows with the keys of their pieces, and of each piece what comes before it in its account.

    Days are totalled first; of an account they are as many as the calendar has. Only where some account's day
    has more than `piece_rows` rows, the rows of these days are sorted once over all tasks, and the rows that
    fall into one task are one piece: counted rows, whatever the ids and times are.
    """
    spark = rows.sparkSession
    use_checkpoints(spark)
    keyed = rows.withColumns(
        {
            **plain_key("account_id"),
            "_date": known(day_number()),
            "_moment": known(F.unix_micros("event_ts")),
        }
    )
    days = (
        keyed.groupBy(*DAY).agg(exact_sum("amount").alias("_amount"), F.count(F.lit(1)).alias("_rows")).checkpoint()
    )
    starts = days.select(*DAY, *_before_each(DAY[:2], "_date"))

    busy = days.filter(F.col("_rows") > piece_rows).select(*DAY, "_rows")
    busy_rows = busy.agg(F.sum("_rows")).first()[0]
    if busy_rows is None:
        return keyed, DAY, starts
    tasks = -(-2 * busy_rows // piece_rows)
    in_order = [F.col(c) for c in DAY[:2]] + list(ranking)
    sorted_rows = (
        keyed.join(busy.drop("_rows"), DAY, "left_semi")
        .repartitionByRange(tasks, *in_order)
        .withColumn("_piece", F.spark_partition_id() + 1)
        .checkpoint()
    )
    calm = keyed.join(busy.drop("_rows"), DAY, "left_anti").withColumn("_piece", F.lit(0))
    pieces = busy_pieces(sorted_rows).join(starts, DAY)
    offsets = pieces.select(
        *DAY,
        "_piece",
        plus("_before", "_piece_before").alias("_before"),
        (F.col("_rows_before") + F.col("_piece_rows_before")).alias("_rows_before"),
        "_last",
        "_later",
    )
    none = starts.withColumn("_piece", F.lit(0))
    return calm.unionByName(sorted_rows), [*DAY, "_piece"], none.unionByName(offsets, allowMissingColumns=True)


def busy_pieces(rows: DataFrame) -> DataFrame:
    """Of each piece of a busy day: what the day's earlier pieces hold, its last moment, and `_later`, the amount
    of that moment in later pieces."""
    piece = [*DAY, "_piece"]
    moments = rows.groupBy(*piece, "_moment").agg(exact_sum("amount").alias("_amount"), F.count(F.lit(1)).alias("_rows"))
    pieces = moments.groupBy(*piece).agg(
        F.sum("_amount").alias("_amount"),
        F.sum("_rows").alias("_rows"),
        F.min("_moment").alias("_first"),
        F.max("_moment").alias("_last"),
        F.min_by("_amount", "_moment").alias("_head"),
    )
    same_start = Window.partitionBy(*DAY, "_first").orderBy(F.desc("_piece"))
    following = Window.partitionBy(*DAY).orderBy("_piece")
    goes_on = F.lead("_first").over(following) == F.col("_last")
    before, rows_before = _before_each(DAY, "_piece")
    return pieces.withColumn("_heads", F.sum("_head").over(same_start)).select(
        *piece,
        before.alias("_piece_before"),
        rows_before.alias("_piece_rows_before"),
        "_last",
        F.when(goes_on, F.lead("_heads").over(following)).alias("_later"),
    )


def _before_each(keys: Sequence[str], order: str) -> tuple[Column, Column]:
    """Amount (NULL if none) and rows of everything of the same keys that comes earlier."""
    earlier = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        F.sum("_amount").over(earlier).alias("_before"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows_before"),
    )


def _cumulative(window: Window, frame: str) -> Column:
    between = window.rowsBetween if frame == "rows" else window.rangeBetween
    return exact_sum("amount", between(Window.unboundedPreceding, Window.currentRow))


def velocity(
    df: DataFrame,
    before: int = 120,
    after: int = 120,
    threshold: int = 5,
    statuses: Sequence[str] | None = ("Approved",),
    skew_safe: bool = True,
) -> DataFrame:
    """Transactions of the same account within [-before, +after] seconds, itself included.

    `statuses=None` counts all rows. Rows are counted per account and second first, so a window frame
    never holds more than before + after + 1 entries, however busy the account is.
    """
    rows = df if statuses is None else df.filter(F.col("status").isin(list(statuses)))
    rows = rows.select("transaction_id", "account_id", "event_ts", "amount")

    if not skew_safe:
        near = Window.partitionBy("account_id").orderBy(epoch_second()).rangeBetween(-before, after)
        return _flagged(rows.withColumn("velocity_count", F.count(F.lit(1)).over(near)), threshold)

    rows = rows.withColumns({**plain_key("account_id"), "_second": known(epoch_second())})
    moment = ["_key", "_no_key", "_second"]
    counts = rows.groupBy(*moment).agg(F.count(F.lit(1)).alias("_rows"))
    return _flagged(rows.join(_near_counts(counts, before, after), moment), threshold)


def _near_counts(counts: DataFrame, before: int, after: int) -> DataFrame:
    """Rows around each account second. Time is cut into buckets; only edge seconds are copied to a neighbour."""
    width = max(BUCKET_SECONDS, before, after)
    second = F.col("_second")

    def bucket(at: Column) -> Column:
        return F.floor(at / width)

    spread = counts.withColumn(
        "_bucket", F.explode(F.sequence(bucket(second - after), bucket(second + before)))
    )
    near = Window.partitionBy("_bucket", "_key", "_no_key").orderBy(second).rangeBetween(-before, after)
    return (
        spread.withColumn("velocity_count", F.sum("_rows").over(near))
        .filter(F.col("_bucket") == bucket(second))
        .drop("_bucket", "_rows")
    )


def _flagged(df: DataFrame, threshold: int) -> DataFrame:
    return df.select(
        "transaction_id",
        "account_id",
        "event_ts",
        "amount",
        "velocity_count",
        (F.col("velocity_count") >= threshold).alias("is_velocity_alert"),
    )


def velocity_alerts(df: DataFrame, **options) -> DataFrame:
    """Only the flagged transactions; the threshold is applied to the counts, before they meet the rows."""
    return velocity(df, **options).filter("is_velocity_alert")


def day_number(column: str = "event_date") -> Column:
    return F.datediff(column, F.lit("1970-01-01").cast("date"))


def daily_amounts(df: DataFrame) -> DataFrame:
    """Sum and count of amounts per account and day: at most one row per day, also for a hot account."""
    return df.groupBy("account_id", "event_date").agg(
        exact_sum("amount").alias("_amount"), fit_count("amount").alias("_amounts")
    )


def rolling_avg(df: DataFrame, days: int = 7) -> DataFrame:
    """Average amount per account over the `days` days that end with each active day."""
    recent = Window.partitionBy("account_id").orderBy(day_number()).rangeBetween(-(days - 1), 0)
    return (
        daily_amounts(df)
        .withColumns({"_total": F.sum("_amount").over(recent), "rolling_count": F.sum("_amounts").over(recent)})
        .select(
            "account_id",
            "event_date",
            "rolling_count",
            mean("_total", "rolling_count").alias("rolling_avg"),
        )
    )


def daily_running_balance(df: DataFrame) -> DataFrame:
    """One row per account and active day: the day's total and the balance after it."""
    until = (
        Window.partitionBy("account_id")
        .orderBy("event_date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return daily_amounts(df).select(
        "account_id",
        "event_date",
        in_currency("_amount").alias("daily_total"),
        in_currency(F.sum("_amount").over(until)).alias("running_balance"),
    )


def amount_spike(df: DataFrame, days: int = 7, factor: float = 3.0, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Flag amounts above `factor` times the average of the account's earlier rows of the last `days` days.

    Earlier means an earlier second; the first row of a window has no average and is not flagged.

    Days are totalled first. The rows then meet once, by account and day, with what the days before hold. Rows of
    a day with more than `piece_rows` of them are first counted per second, so that no task holds them all.
    """
    use_checkpoints(df.sparkSession)
    rows = df.select("transaction_id", "account_id", "event_date", "event_ts", "amount").withColumns(
        {**plain_key("account_id"), "_date": known(day_number()), "_second": known(epoch_second())}
    )
    sums = [exact_sum("amount").alias("_amount"), fit_count("amount").alias("_amounts")]
    totals = rows.groupBy(*DAY).agg(*sums, F.count(F.lit(1)).alias("_rows")).checkpoint()
    days_before = Window.partitionBy(*DAY[:2]).orderBy("_date").rangeBetween(-(days - 1), -1)
    past = totals.select(
        *DAY,
        F.sum("_amount").over(days_before).alias("_past_amount"),
        F.sum("_amounts").over(days_before).alias("_past_amounts"),
    )
    busy = totals.filter(F.col("_rows") > piece_rows).select(*DAY)
    if busy.isEmpty():
        found = _earlier_today(rows)
    else:
        calm = _earlier_today(rows.join(busy, DAY, "left_anti"))
        found = calm.unionByName(_earlier_seconds(rows.join(busy, DAY, "left_semi"), sums))
    zero = F.lit(0)
    joined = found.join(past, DAY).withColumns(
        {
            "_total": F.coalesce("_today_amount", zero) + F.coalesce("_past_amount", zero),
            "_count": F.coalesce("_today_amounts", zero) + F.coalesce("_past_amounts", zero),
        }
    )
    average = mean("_total", "_count")
    return joined.select(
        "transaction_id",
        "account_id",
        "event_ts",
        "amount",
        average.alias("baseline_avg"),
        F.coalesce(F.col("amount") > factor * average, F.lit(False)).alias("is_spike"),
    )


def _earlier_today(rows: DataFrame) -> DataFrame:
    """Each row with the total and number of the amounts of earlier seconds of its day."""
    earlier = Window.partitionBy(*DAY).orderBy("_second").rangeBetween(Window.unboundedPreceding, -1)
    return rows.withColumns(
        {
            "_today_amount": exact_sum("amount", earlier),
            "_today_amounts": F.sum(F.when(is_fit("amount"), 1).otherwise(0)).over(earlier),
        }
    )


def _earlier_seconds(rows: DataFrame, sums: Sequence[Column]) -> DataFrame:
    """The same from totals per second: a day has at most 86,400 of them, however many rows."""
    moment = [*DAY, "_second"]
    earlier = Window.partitionBy(*DAY).orderBy("_second").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        rows.groupBy(*moment)
        .agg(*sums)
        .select(
            *moment,
            F.sum("_amount").over(earlier).alias("_today_amount"),
            F.sum("_amounts").over(earlier).alias("_today_amounts"),
        )
    )
    return rows.join(before, moment)
