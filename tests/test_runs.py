"""Job runs: plans of pruned and bucketed reads, the quality job, sketches, plan comparison, unfit amounts."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from tallybank.functions import money
from tallybank.functions.risk import risk_bucket, risk_bucket_pandas_udf, risk_bucket_udf
from tallybank.functions.skew import hot_keys, salt_big, salt_counts, salt_small
from tallybank.operators import analytics, quality, windows
from tallybank.operators.joins import bucketed_join
from tallybank.plans import quality_job, runs, tuning
from tallybank.plans.catalog import BATCH
from tallybank.session import session_conf
from tallybank.sinks.tables import write_bucketed, write_table
from tallybank.sources.files import read_range, read_table
from tests.conftest import rows, same_rows, txn


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_range_of_days_opens_only_its_folders(spark, bank):
    stored = runs.stored_transactions(spark, bank)
    kept = read_range(spark, stored, *runs.RANGE)
    assert "PartitionFilters: [isnotnull(event_date" in plan_of(kept)
    folders = {r[0].split("event_date=")[1][:10] for r in kept.select("_metadata.file_path").distinct().collect()}
    assert min(folders) >= runs.RANGE[0] and max(folders) <= runs.RANGE[1] and len(folders) == 7


def test_days_of_a_join_prune_the_scan_as_it_runs(spark, bank, tmp_path):
    table = read_table(spark, runs.stored_transactions(spark, bank))
    days = bank.transaction.groupBy("event_date").agg((F.count("*") > 0).alias("wanted"))
    stored = read_table(spark, write_table(days, str(tmp_path), "days"))
    joined = runs.pruned_by_days(table, stored.filter("wanted and event_date > date '2024-01-20'"))
    assert "dynamicpruning" in plan_of(joined)
    joined.collect()
    same_rows(joined, analytics.totals_by(table.filter("event_date > date '2024-01-20'"), ["event_date"]))


def test_bucketed_join_plans_no_shuffle(spark, bank):
    names = runs.bucketed_tables(spark, bank)
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": -1, "spark.sql.adaptive.enabled": "false"}):
        joined = bucketed_join(spark, *names, runs.BUCKET_KEYS)
        plan = plan_of(joined)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    plain = bank.transaction.join(bank.account, "account_id").select("account_id", "transaction_id", "event_date", "amount", "account_type")
    same_rows(joined.drop("_salt"), plain)


def test_a_hot_key_lies_in_several_buckets(spark, bank, tmp_path):
    hot = hot_keys(bank.transaction, "account_id", min_rows=50)
    salts = salt_counts(hot, "account_id", rows_per_salt=20)
    facts = salt_big(bank.transaction.select("transaction_id", "account_id"), salts, "account_id")
    owners = salt_small(bank.account.select("account_id", "account_type"), salts, "account_id")
    for name, frame in (("hot_facts", facts), ("hot_owners", owners)):
        write_bucketed(frame, name, n=8, col=["account_id", "_salt"], files_per_bucket=2, location=f"{tmp_path}/{name}")
    per_bucket = [r["count"] for r in spark.table("hot_facts").filter("account_id = 1").groupBy(F.pmod(F.hash("account_id", "_salt"), F.lit(8))).count().collect()]
    assert len(per_bucket) > 4 and max(per_bucket) < sum(per_bucket) / 2
    same_rows(
        bucketed_join(spark, "hot_facts", "hot_owners", ["account_id", "_salt"]).drop("_salt"),
        bank.transaction.select("transaction_id", "account_id").join(bank.account.select("account_id", "account_type"), "account_id"),
    )
    for name in ("hot_facts", "hot_owners"):
        spark.sql(f"drop table {name}")


def test_quality_job_reads_once_and_is_rerun_safe(spark, bank, tmp_path):
    out = str(tmp_path / "out")
    source = read_table(spark, write_table(bank.transaction, str(tmp_path), "transaction"))
    for _ in range(2):
        metrics = {r.metric: r.row_count for r in quality_job.run_quality(spark, source, out, "2024-02-01").collect()}
    summary = quality.quality_summary(source).first()
    assert (metrics["total"], metrics["valid"], metrics["quarantined"]) == tuple(summary)[:3]
    assert {k: metrics[k] for k in quality.RULES} == {r.rule: r.violations for r in quality.rule_counts(source).collect()}
    valid, quarantine = quality.split_quality(source)
    same_rows(quality_job.read_outcome(spark, out, quality_job.VALID), valid)
    same_rows(quality_job.read_outcome(spark, out, quality_job.QUARANTINE), quarantine)
    kept = quality_job.read_outcome(spark, out, quality_job.VALID)
    assert "PartitionFilters: [isnotnull(outcome" in plan_of(kept)
    quality_job.run_quality(spark, source.limit(0), out, "2024-02-01")
    again = {r.metric: (r.row_count, r.pct) for r in quality_job.read_metrics(spark, out).collect()}
    assert set(again.values()) == {(0, None)}


def test_quality_job_scans_the_table_in_one_stage(spark, bank, tmp_path):
    source = read_table(spark, write_table(bank.transaction, str(tmp_path), "transaction"))
    tracker, group = spark.sparkContext.statusTracker(), "one-scan"
    spark.sparkContext.setJobGroup(group, group)
    try:
        quality_job.run_quality(spark, source, str(tmp_path / "out"), "2024-02-01")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = [s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    # One stage writes the rows, one the few metrics.
    assert len(stages) == 2


def test_sketches_of_days_merge(spark):
    values = spark.range(200_000).select(
        (F.col("id") % 60_000).alias("account_id"), F.date_add(F.lit("2024-01-01"), (F.col("id") % 30).cast("int")).alias("event_date")
    )
    sketches = analytics.daily_sketches(values, "account_id")
    assert sketches.agg(F.max(F.length("sketch"))).first()[0] < 20_000
    for found, exact in (
        (analytics.merged_distinct(sketches).first()[0], 60_000),
        (analytics.merged_distinct(sketches.filter("event_date <= date '2024-01-10'")).first()[0], 20_000),
    ):
        # Four standard errors.
        assert abs(found - exact) <= exact * 4 * 1.04 / math.sqrt(2**analytics.SKETCH_BITS)
    assert analytics.merged_distinct(analytics.daily_sketches(values.limit(0), "account_id")).first()[0] in (0, None)


def test_plans_of_sql_twins(spark, bank):
    """Two twins sum decimals where the library sums cents, and are the same plan once both do; the third has no way
    around the window for rows without an id."""
    for name in ("branch_totals", "type_currency_totals"):
        assert tuning.compare_plans(BATCH[name](bank), tuning.sql_twin(spark, name, bank)) == (False, {})
    decimal = F.col("amount").cast("decimal(18,2)")
    grouped = bank.transaction.groupBy("transaction_type", "currency").agg(
        F.sum(decimal).cast("double").alias("total_amount"), F.count(F.lit(1)).alias("txn_count")
    )
    assert tuning.compare_plans(grouped, tuning.sql_twin(spark, "type_currency_totals", bank)) == (True, {})
    same, differ = tuning.compare_plans(BATCH["dedup_latest"](bank), tuning.sql_twin(spark, "dedup_latest", bank))
    assert not same and differ["Union"] == (1, 0)
    filtered = bank.transaction.filter("amount > 1").select("account_id")
    assert tuning.compare_plans(filtered, spark.sql("select account_id from {t} where amount > 1", t=bank.transaction))[0]


def test_unfit_amounts_are_left_out(spark):
    amounts = [0.125, 1.005, 2.675, -0.125, 0.29, float("nan"), float("inf"), float("-inf"), 1e300, None]
    df = spark.createDataFrame([(1, a) for a in amounts], "k int, amount double")
    cents = [r[0] for r in df.select(money.cents("amount")).collect()]
    decimals = [r[0] for r in df.limit(5).select((F.col("amount").cast("decimal(18,2)") * 100).cast("bigint")).collect()]
    assert cents == [*decimals, None, None, None, None, None] and decimals == [13, 101, 268, -13, 29]
    found = df.groupBy("k").agg(money.money_sum("amount").alias("s"), money.fit_count("amount").alias("n")).first()
    assert (found.s, found.n) == (3.98, 5)
    facts = txn(spark, *[dict(transaction_id=i, amount=a) for i, a in enumerate(amounts)])
    stats = analytics.txn_stats(facts).first()
    assert stats.txn_count == 10 and stats.avg_amount == pytest.approx(3.98 / 5)
    assert {r.running_balance for r in windows.running_balance(facts).collect()} == {3.98}


def test_risk_bucket_forms_agree_on_every_amount(spark):
    amounts = [float("nan"), float("inf"), None, 5000.0, 5000.01, 1000.5, 500.5, -1.0]
    df = spark.createDataFrame([(k, a) for a in amounts for k in ("Transfer", "Deposit", None)], "transaction_type string, amount double")
    native, plain, pandas = (
        [r[0] for r in df.select(f("transaction_type", "amount")).collect()]
        for f in (risk_bucket, risk_bucket_udf, risk_bucket_pandas_udf)
    )
    assert native == plain == pandas
    assert native[:3] == ["UNKNOWN"] * 3 and native[3] == "CRITICAL"


def test_key_profile_counts_once(bank):
    plan = analytics.key_profile(bank.transaction, "account_id", 3)
    assert rows(plan.select("key_rows"))[-1][0] > 0


@pytest.mark.parametrize("piece_rows", [1, 20, 1_000_000])
def test_spikes_of_busy_days(spark, bank, piece_rows):
    plain = windows.amount_spike(bank.transaction)
    same_rows(windows.amount_spike(bank.transaction, piece_rows=piece_rows), plain)


def test_an_application_owns_one_scratch_folder(spark, monkeypatch, tmp_path):
    from tallybank import session

    monkeypatch.setattr(session, "shared_dir", lambda _: f"file://{tmp_path}")
    paths = [session.scratch_path(spark, "a") for _ in range(2)]
    spark.range(3).write.parquet(paths[0])
    assert len(set(paths)) == 2 and (tmp_path / f"tallybank-{spark.sparkContext.applicationId}").is_dir()
    session.clear_scratch(spark)
    assert not list(tmp_path.iterdir())
