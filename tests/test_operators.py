from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallybank.functions.sizing import broadcast_if_small, estimated_bytes
from tallybank.functions.skew import hot_keys, salt_big, salt_counts, salt_small
from tallybank.operators import analytics, dedup, joins, quality, scd2, windows
from tallybank.plans.tuning import plan_report
from tests.conftest import rows, same_rows, txn

SCD = (
    "customer_id bigint, first_name string, last_name string, email string, phone string, risk_tier string, "
    "effective_start date, effective_end date, is_current boolean, version int"
)
ACCOUNT = (
    "account_id bigint, customer_id bigint, branch_id bigint, account_type string, status string, open_date date, "
    "balance double"
)


def day(text):
    return dt.date.fromisoformat(text)


@pytest.fixture(scope="module")
def history(spark):
    return spark.createDataFrame(
        [
            (10, "A", "B", None, None, "Low", day("2024-01-02"), day("2024-01-04"), False, 1),
            (10, "A", "B", None, None, "High", day("2024-01-05"), None, True, 2),
        ],
        SCD,
    )


@pytest.fixture(scope="module")
def owners(spark):
    opened = day("2020-01-01")
    return spark.createDataFrame(
        [
            (1, 10, 5, "Loan", "Active", opened, 1.0),
            (2, None, 5, "Loan", "Active", opened, 1.0),
            (3, -1, 6, "Loan", "Active", opened, 1.0),
        ],
        ACCOUNT,
    )


@pytest.fixture(scope="module")
def edge_txns(spark):
    days = {1: "01-01", 2: "01-02", 3: "01-04", 4: "01-05", 5: "01-09"}
    cases = [dict(transaction_id=i, event_ts=f"2024-{d} 10:00:00") for i, d in days.items()]
    cases += [dict(transaction_id=6, account_id=2), dict(transaction_id=7, account_id=3)]
    cases += [dict(transaction_id=8, account_id=None), dict(transaction_id=9, account_id=99)]
    return txn(spark, *cases)


def test_point_in_time_bounds(edge_txns, owners, history):
    out = joins.point_in_time(edge_txns, owners, history)
    assert {r.transaction_id: r.version for r in out.collect()} == {2: 1, 3: 1, 4: 2, 5: 2}
    assert out.columns == joins.POINT_IN_TIME_COLUMNS
    left = joins.point_in_time(edge_txns, owners, history, "left")
    assert {r.transaction_id for r in left.collect()} == set(range(1, 10))


def test_current_only_ignores_dates(edge_txns, owners, history):
    out = joins.current_only(edge_txns, owners, history)
    assert {r.transaction_id: r.version for r in out.collect()} == {i: 2 for i in range(1, 6)}


def test_enrich_keeps_every_transaction(spark, edge_txns, owners, history):
    product = spark.createDataFrame(
        [(1, "Checking", "Deposit")], "product_id bigint, product_name string, product_group string"
    )
    branch = spark.createDataFrame(
        [(5, "Branch Main", "NY", day("2019-01-01"))],
        "branch_id bigint, branch_name string, state string, open_date date",
    )
    out = {r.transaction_id: r for r in joins.enrich(edge_txns, owners, product, branch, history).collect()}
    assert set(out) == set(range(1, 10))
    assert [out[i].version for i in (1, 2, 3, 4, 5)] == [None, 1, 1, 2, 2]
    assert (out[1].customer_id, out[1].branch_id, out[1].txn_branch_id, out[1].branch_name) == (10, 5, 1, "Branch Main")
    assert (out[7].branch_id, out[7].branch_name, out[8].customer_id) == (6, None, None)


def test_product_join_forms_agree(bank):
    hinted = joins.enrich_product(bank.transaction, bank.product)
    same_rows(hinted, joins.enrich_product(bank.transaction, bank.product, hint=False))
    assert hinted.count() == bank.transaction.count()


def test_broadcast_is_checked(spark, bank):
    assert estimated_bytes(bank.branch) < 64 * 1024 * 1024
    assert "UnresolvedHint broadcast" in broadcast_if_small(bank.branch)._jdf.queryExecution().logical().toString()
    big = broadcast_if_small(bank.transaction, limit=10)
    assert "UnresolvedHint broadcast" not in big._jdf.queryExecution().logical().toString()


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain(spark, bank, how):
    facts = bank.transaction.select("transaction_id", "account_id", "amount", "event_ts")
    accounts = bank.account.select("account_id", "account_type")
    plain = facts.join(accounts, "account_id", how)
    same_rows(plain, joins.salted_join(facts, accounts, "account_id", n=10, how=how))
    hot = hot_keys(facts, "account_id", min_rows=20)
    same_rows(plain, joins.salted_join(facts, accounts, "account_id", hot_keys=hot, how=how))


@pytest.mark.parametrize("hot", [False, True])
def test_salted_copies_are_not_broadcast(bank, hot):
    facts = bank.transaction.select("transaction_id", "account_id", "amount")
    accounts = bank.account.select("account_id", "account_type")
    keys = hot_keys(facts, "account_id", min_rows=20) if hot else None
    salted = joins.salted_join(facts, accounts, "account_id", hot_keys=keys)
    assert plan_report(salted)["joins"].get("SortMergeJoin") == 1
    assert plan_report(salted)["joins"].get("BroadcastHashJoin", 0) == (2 if hot else 0)  # the list of hot keys


def test_hot_salts_split_the_hot_key(bank):
    facts = bank.transaction.select("transaction_id", "account_id")
    salts = salt_counts(hot_keys(facts, "account_id", min_rows=100), "account_id", rows_per_salt=50)
    parts = salt_big(facts, salts, "account_id").groupBy("account_id", "_salt").count()
    hottest = parts.filter("account_id = 1").agg(F.max("count"), F.count("*")).first()
    total = facts.filter("account_id = 1").count()
    assert hottest[1] == -(-total // 50)
    assert hottest[0] < total / 4
    copies = salt_small(bank.account.select("account_id"), salts, "account_id")
    assert copies.filter("account_id = 1").count() == hottest[1]
    assert copies.filter("account_id = 2").count() == 1


def test_hot_keys_are_bounded(bank):
    assert hot_keys(bank.transaction, "account_id", min_rows=1, top=3).count() == 3


def test_dedup_ties_and_order(spark):
    df = txn(
        spark,
        dict(transaction_id=1, event_ts="2024-01-01 10:00:00", ingest_date="2024-01-03", amount=1.0),
        dict(transaction_id=1, event_ts="2024-01-01 11:00:00", ingest_date="2024-01-03", amount=2.0),
        dict(transaction_id=1, event_ts="2024-01-01 12:00:00", ingest_date="2024-01-02", amount=3.0),
        dict(transaction_id=2, event_ts="2024-01-01 10:00:00", amount=4.0),
        dict(transaction_id=2, event_ts="2024-01-01 10:00:00", amount=5.0),
        dict(transaction_id=2, event_ts="2024-01-01 10:00:00", amount=None),
    )
    once = dedup.dedup_latest(df)
    assert {r.transaction_id: r.amount for r in once.collect()} == {1: 2.0, 2: 5.0}
    same_rows(once, dedup.dedup_latest(once))
    same_rows(once, dedup.dedup_latest(df.repartition(7)))
    assert tuple(dedup.dedup_report(df).first()) == (6, 2, 4)
    assert dedup.dedup_any(df).count() == 2


def test_dedup_limits_rows_before_the_shuffle(bank):
    plan = dedup.dedup_latest(bank.transaction)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_running_balance_ties(spark):
    df = txn(
        spark,
        dict(transaction_id=1, amount=None),
        dict(transaction_id=3, amount=5.0, event_ts="2024-01-05 12:00:30"),
        dict(transaction_id=2, amount=7.0, event_ts="2024-01-05 12:00:30"),
        dict(transaction_id=4, amount=1.0, event_ts="2024-01-05 13:00:00"),
    )
    ranged = {r.transaction_id: (r.running_balance, r.txn_rank) for r in windows.running_balance(df).collect()}
    assert ranged == {1: (None, 1), 2: (12.0, 2), 3: (12.0, 3), 4: (13.0, 4)}
    by_row = {r.transaction_id: r.running_balance for r in windows.running_balance(df, "rows").collect()}
    assert by_row == {1: None, 2: 7.0, 3: 12.0, 4: 13.0}
    with pytest.raises(ValueError):
        windows.running_balance(df, "groups")


@pytest.mark.parametrize("frame", ["range", "rows"])
@pytest.mark.parametrize("piece_rows", [3, 40, 1_000_000])
def test_running_balance_skew_safe_equals_plain(bank, frame, piece_rows):
    safe = windows.running_balance(bank.transaction, frame, piece_rows=piece_rows)
    same_rows(safe, windows.running_balance(bank.transaction, frame, skew_safe=False))


@pytest.mark.parametrize("frame", ["range", "rows"])
def test_running_balance_of_one_busy_moment(spark, frame):
    """Most rows of one account at one moment, some without time, id or amount."""
    cases = [dict(transaction_id=i, amount=float(i), event_ts="2024-01-05 00:00:00") for i in range(1, 30)]
    cases += [dict(transaction_id=i, amount=1.0, event_ts=f"2024-01-05 00:00:{i % 60:02}") for i in range(30, 75)]
    cases += [dict(transaction_id=90, event_ts=None, event_date="2024-01-05", ingest_date="2024-01-05")]
    cases += [dict(transaction_id=None, amount=None), dict(transaction_id=91, account_id=None)]
    cases += [dict(transaction_id=i, account_id=None, event_ts="2024-01-06 00:00:00") for i in range(100, 110)]
    df = txn(spark, *cases)
    for piece_rows in (1, 5, 20):
        safe = windows.running_balance(df, frame, piece_rows=piece_rows)
        same_rows(safe, windows.running_balance(df, frame, skew_safe=False))


@pytest.mark.parametrize("frame", ["range", "rows"])
def test_running_balance_windows_stay_small(spark, frame):
    """One account with most rows, all on one day and a third of them at one moment; ids far apart.

    The windows are over the rows of a piece, the pieces of a day and the days of an account: all are counted.
    """
    ids = F.col("id")
    moment = F.when(ids % 3 == 0, F.lit(43_200)).otherwise(ids * 7 % 86_400)
    df = spark.range(6000).select(
        F.when(ids % 20 == 0, ids).otherwise(1).alias("account_id"),
        (F.xxhash64("id") * 1).alias("transaction_id"),
        F.lit("2024-01-05").cast("date").alias("event_date"),
        F.timestamp_seconds(F.lit(1_704_412_800) + moment).alias("event_ts"),
        F.when(ids % 11 != 0, (ids % 1000 - 300) / 4.0).alias("amount"),
    )
    piece_rows = 200
    rows = df.select("account_id", "transaction_id", "event_date", "event_ts", "amount")
    ranking = [F.asc_nulls_first(c) for c in ("event_date", "event_ts", "transaction_id", "amount", "account_id")]
    placed, keys, offsets = windows.cut_days(rows, ranking, piece_rows)
    largest = placed.groupBy(*keys).count().agg(F.max("count")).first()[0]
    assert largest <= 2 * piece_rows < df.count() / 10
    busiest = offsets.filter("_piece > 0").groupBy(*windows.DAY).count().agg(F.max("count")).first()[0]
    assert 6000 / (2 * piece_rows) <= busiest <= 2 * 6000 / piece_rows + 1
    safe = windows.running_balance(df, frame, piece_rows=piece_rows)
    same_rows(safe, windows.running_balance(df, frame, skew_safe=False))
    windows_in_plan = safe._jdf.queryExecution().optimizedPlan().toString().count("windowspecdefinition(account_id")
    assert windows_in_plan == 0


@pytest.mark.parametrize("bounds", [(120, 120), (119, 0), (5000, 5000)])
def test_velocity_skew_safe_equals_plain(bank, bounds):
    options = dict(before=bounds[0], after=bounds[1], statuses=None)
    safe = windows.velocity(bank.transaction, **options)
    same_rows(safe, windows.velocity(bank.transaction, skew_safe=False, **options))


def test_rows_without_time_or_account_are_kept(spark):
    untimed = dict(event_ts=None, event_date="2024-01-05", ingest_date="2024-01-05")
    cases = [dict(transaction_id=i, account_id=i % 3 or None, **untimed) for i in range(1, 9)]
    cases += [dict(transaction_id=i, account_id=i % 3 or None) for i in range(10, 20)]
    df = txn(spark, *cases)
    counted = windows.velocity(df, threshold=3)
    assert counted.count() == 18
    same_rows(counted, windows.velocity(df, threshold=3, skew_safe=False))
    assert windows.amount_spike(df).count() == 18


def test_velocity_window_edges(spark):
    seconds = ["12:00:00", "12:01:00", "12:02:00", "12:02:01", "12:03:00"]
    df = txn(spark, *[dict(transaction_id=i, event_ts=f"2024-01-05 {s}") for i, s in enumerate(seconds)])
    counts = {r.transaction_id: r.velocity_count for r in windows.velocity(df).collect()}
    assert counts == {0: 3, 1: 5, 2: 5, 3: 4, 4: 4}
    trailing = {r.transaction_id: r.velocity_count for r in windows.velocity(df, before=119, after=0).collect()}
    assert trailing == {0: 1, 1: 2, 2: 2, 3: 3, 4: 3}


def test_rolling_average_and_spike(spark):
    df = txn(
        spark,
        dict(transaction_id=1, amount=10.0, event_ts="2024-01-01 10:00:00"),
        dict(transaction_id=2, amount=20.0, event_ts="2024-01-07 10:00:00"),
        dict(transaction_id=3, amount=100.0, event_ts="2024-01-07 11:00:00"),
        dict(transaction_id=4, amount=100.0, event_ts="2024-01-08 11:00:00"),
        dict(transaction_id=5, amount=None, event_ts="2024-02-08 11:00:00"),
    )
    averages = {str(r.event_date): r.rolling_avg for r in windows.rolling_avg(df).collect()}
    assert averages == {
        "2024-01-01": 10.0,
        "2024-01-07": pytest.approx(130 / 3),
        "2024-01-08": pytest.approx(220 / 3),
        "2024-02-08": None,
    }
    spikes = {r.transaction_id: (r.baseline_avg, r.is_spike) for r in windows.amount_spike(df).collect()}
    assert spikes == {1: (None, False), 2: (10.0, False), 3: (15.0, True), 4: (60.0, False), 5: (None, False)}


def test_quality_rules(spark):
    bad = dict(
        transaction_id=None, account_id=-1, amount=-999999.99, currency="XXX", transaction_type="UNKNOWN",
        event_ts="2024-01-05 12:00:00", event_date=None,
    )
    nulls = dict(transaction_id=2, account_id=None, amount=None, currency=None, transaction_type=None)
    df = txn(spark, bad, nulls, dict(transaction_id=3))
    valid, quarantine = quality.split_quality(df)
    assert [r.transaction_id for r in valid.collect()] == [3]
    reasons = {r.transaction_id: r.rejection_reasons for r in quarantine.collect()}
    assert reasons[None] == list(quality.RULES)
    assert reasons[2] == ["failed_acct_id", "failed_amount", "failed_currency", "failed_type"]
    assert {r.rule: r.violations for r in quality.rule_counts(df).collect()}["failed_date"] == 1
    assert tuple(quality.quality_summary(df).first())[:3] == (3, 1, 2)
    untyped = df.filter("transaction_id = 3").withColumn("transaction_type", F.lit("UNKNOWN"))
    assert quality.split_quality(untyped, quality.PIPELINE_RULES)[0].count() == 1
    assert quality.split_quality(untyped)[0].count() == 0


def test_quality_split_is_complete(bank):
    valid, quarantine = quality.split_quality(bank.transaction)
    same_rows(valid.union(quarantine.drop("rejection_reasons")), bank.transaction)


def test_observed_rules_equal_counted(bank):
    from pyspark.sql import Observation

    seen = Observation()
    quality.observe_rules(bank.transaction, seen).write.format("noop").mode("overwrite").save()
    counted = {r.rule: r.violations for r in quality.rule_counts(bank.transaction).collect()}
    assert {name: seen.get[name] for name in quality.RULES} == counted
    assert seen.get["total"] == bank.transaction.count()


def test_branch_summary_rounding(bank):
    plain = analytics.branch_summary(bank.transaction, bank.account, bank.branch)
    shown = analytics.branch_summary(bank.transaction, bank.account, bank.branch, digits=2)
    pairs = zip(plain.collect(), shown.collect())
    assert all(abs(a.avg_amount - b.avg_amount) <= 0.005 + 1e-9 for a, b in pairs)


def test_branch_totals_equal_row_level_join(bank):
    row_level = (
        joins.join_branch(bank.transaction.filter("status <> 'Reversed'"), bank.account, bank.branch)
        .groupBy("branch_id").agg(F.count("*").alias("n")).collect()
    )
    early = analytics.branch_summary(bank.transaction, bank.account, bank.branch).collect()
    assert {r.branch_id: r.n for r in row_level} == {r.branch_id: r.txn_count for r in early}


def test_spend_options(spark, owners):
    df = txn(
        spark,
        dict(transaction_id=1, amount=5.0),
        dict(transaction_id=2, amount=-999999.99),
        dict(transaction_id=3, amount=7.0, status="Declined"),
    )
    whole = analytics.daily_spend(df, owners).first()
    assert (whole.total_spend, whole.txn_count) == (-999987.99, 3)
    assert analytics.daily_spend(df, owners, valid_only=True).first().total_spend == 12.0
    assert analytics.daily_spend(df, owners, True, ["Approved"]).first().total_spend == 5.0


def test_approximate_distinct(bank):
    exact = analytics.distinct_count(bank.transaction, "account_id").first()[0]
    approx = analytics.distinct_count(bank.transaction, "account_id", approx=True, rsd=0.01).first()[0]
    assert abs(approx - exact) <= exact * 0.05


def test_key_profile_and_top_n(bank):
    profile = analytics.key_profile(bank.transaction, "account_id").collect()
    assert profile[0].account_id == 1 and profile[0].key_share > 0.5
    assert sum(r.key_rows for r in profile) == bank.transaction.count()
    assert abs(sum(r.key_share for r in profile) - 1) < 1e-9
    best = analytics.top_n(bank.account, "balance", 3, "account_id").collect()
    assert len(best) == 3 and best[0].balance >= best[1].balance >= best[2].balance


def test_scd2_upsert_chain(spark, history):
    changes = spark.createDataFrame(
        [
            (10, "Medium", day("2024-02-01")),
            (10, "Medium", day("2024-02-05")),
            (10, "Low", day("2024-02-10")),
            (10, "High", day("2024-02-10")),
            (10, "Low", day("2024-01-03")),
            (11, "Low", day("2024-02-01")),
        ],
        "customer_id bigint, risk_tier string, change_date date",
    )
    out = scd2.scd2_upsert(history, changes, "customer_id", ["risk_tier"])
    assert out.columns == history.columns
    shown = [
        (r.customer_id, r.version, r.risk_tier, str(r.effective_start), str(r.effective_end), r.is_current, r[1])
        for r in out.orderBy("customer_id", "version").collect()
    ]
    assert shown == [
        (10, 1, "Low", "2024-01-02", "2024-01-04", False, "A"),
        (10, 2, "High", "2024-01-05", "2024-01-31", False, "A"),
        (10, 3, "Medium", "2024-02-01", "2024-02-09", False, "A"),
        (10, 4, "Low", "2024-02-10", "None", True, "A"),
        (11, 1, "Low", "2024-02-01", "None", True, None),
    ]
    assert [r.change_date for r in scd2.stale_changes(history, changes, "customer_id").collect()] == [day("2024-01-03")]
    same_rows(out, scd2.scd2_upsert(out, changes, "customer_id", ["risk_tier"]))


def test_scd2_same_day_change_replaces(spark, history):
    changes = spark.createDataFrame(
        [(10, "Medium", day("2024-01-05"))], "customer_id bigint, risk_tier string, change_date date"
    )
    out = scd2.scd2_upsert(history, changes, "customer_id", ["risk_tier"])
    assert [(r.version, r.risk_tier) for r in out.filter("is_current").collect()] == [(2, "Medium")]
    assert out.count() == 2


def test_scd2_invariants(bank):
    changes = bank.account.filter("customer_id > 0").select(
        "customer_id", F.when(F.col("balance") < 3000, "High").otherwise("Low").alias("risk_tier"),
        F.date_add("open_date", 900).alias("change_date"),
    )
    out = scd2.scd2_upsert(bank.customer_scd2, changes, "customer_id", ["risk_tier"])
    current = out.filter("is_current").groupBy("customer_id").count()
    assert current.filter("count <> 1").count() == 0
    assert out.filter("effective_end < effective_start").count() == 0
    a, b = out.alias("a"), out.alias("b")
    overlap = a.join(b, F.expr(
        "a.customer_id = b.customer_id and a.version < b.version and a.effective_end >= b.effective_start"
    ))
    assert overlap.count() == 0
    assert rows(out.groupBy("customer_id").agg(F.max("version") - F.count("*"))) == sorted(
        rows(out.select("customer_id", F.lit(0)).distinct()), key=repr
    )
