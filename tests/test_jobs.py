from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from tallybank import generator
from tallybank.operators import layout
from tallybank.operators.dedup import dedup_latest
from tallybank.plans import incremental, jobs, tuning
from tallybank.plans.catalog import BATCH, portable
from tallybank.sinks.tables import write_partitioned
from tallybank.sources.files import in_range, read_table
from tallybank.views import Bank
from tests.compare import difference, oracle_connection
from tests.conftest import CHECKED, rows, same_rows, txn

KEYS = ["transaction_id", "event_date"]


@pytest.fixture
def stored(spark, bank, tmp_path):
    path = str(tmp_path / "transaction")
    write_partitioned(bank.transaction, path)
    return path


def add(spark, path, *records):
    txn(spark, *records).write.mode("append").partitionBy("event_date").parquet(path)


def test_watermark(spark, tmp_path):
    path, default = str(tmp_path / "mark"), dt.date(2024, 1, 1)
    assert incremental.read_watermark(spark, path, default) == default
    for day in (5, 9, 7):
        incremental.write_watermark(spark, path, dt.date(2024, 1, day))
    assert incremental.read_watermark(spark, path, default) == dt.date(2024, 1, 9)


def test_incremental_load(spark, bank, stored, tmp_path):
    dst = str(tmp_path / "loaded")
    control = f"{dst}_watermark"
    cold = dt.date(1970, 1, 1)

    assert incremental.incremental_load(spark, stored, dst, "2023-06-01") is None
    assert incremental.read_watermark(spark, control, cold) == cold

    assert incremental.incremental_load(spark, stored, dst, "2024-01-10") == dt.date(2024, 1, 10)
    first = dedup_latest(in_range(bank.transaction, "2024-01-01", "2024-01-10"), KEYS)
    same_rows(read_table(spark, dst), first)
    incremental.incremental_load(spark, stored, dst, "2024-01-10")
    same_rows(read_table(spark, dst), first)

    # A late row inside the lookback is picked up, one before it is not.
    add(spark, stored, dict(transaction_id=900001, event_ts="2024-01-08 10:00:00"))
    add(spark, stored, dict(transaction_id=900002, event_ts="2024-01-05 10:00:00"))
    assert incremental.incremental_load(spark, stored, dst, "2024-01-12") == dt.date(2024, 1, 12)
    ids = {r[0] for r in read_table(spark, dst).filter("transaction_id > 900000").select("transaction_id").collect()}
    assert ids == {900001}
    # The watermark only moves to dates that had rows.
    incremental.incremental_load(spark, stored, dst, "2025-01-01")
    last = bank.transaction.agg(F.max("event_date")).first()[0]
    assert incremental.read_watermark(spark, control, cold) == last


def test_first_load_takes_every_day_and_undated_rows(spark, tmp_path):
    src, dst = str(tmp_path / "src"), str(tmp_path / "dst")
    add(spark, src, dict(transaction_id=1, event_ts="2019-03-01 10:00:00"))
    add(spark, src, dict(transaction_id=2, event_ts="2024-01-05 10:00:00"))
    txn(spark, dict(transaction_id=3)).drop("event_date").write.mode("append").parquet(
        f"{src}/event_date=__HIVE_DEFAULT_PARTITION__"
    )
    for _ in range(2):
        assert incremental.incremental_load(spark, src, dst, "2024-01-10") == dt.date(2024, 1, 5)
        assert sorted(r[0] for r in read_table(spark, dst).select("transaction_id").collect()) == [1, 2, 3]
    later = str(tmp_path / "later")
    incremental.incremental_load(spark, src, later, "2024-01-10", start="2024-01-01")
    assert sorted(r[0] for r in read_table(spark, later).select("transaction_id").collect()) == [2, 3]


def test_daily_loads_equal_one_full_load(spark, bank, tmp_path):
    """Rows arrive by ingest date, up to three days late; a load after each day ends at the full result."""
    src, dst = str(tmp_path / "src"), str(tmp_path / "dst")
    arriving = in_range(bank.transaction, "2024-01-01", "2024-01-06")
    for day in range(1, 10):
        today = arriving.filter(F.col("ingest_date") == F.lit(dt.date(2024, 1, day)))
        today.write.mode("append").partitionBy("event_date").parquet(src)
        incremental.incremental_load(spark, src, dst, dt.date(2024, 1, day))
    same_rows(read_table(spark, dst), dedup_latest(arriving, KEYS))


def test_reprocess_window(spark, bank, tmp_path):
    src, dst = str(tmp_path / "src"), "daily_spend_test"
    write_partitioned(bank.transaction, src)

    def expected():
        from tallybank.operators.analytics import daily_spend

        window = in_range(read_table(spark, src), "2024-01-07", "2024-01-10")
        return daily_spend(dedup_latest(window, KEYS), bank.account)

    filled = incremental.reprocess_window(spark, src, bank.account, dst, "2024-01-10")
    assert filled == [dt.date(2024, 1, d) for d in (7, 8, 9, 10)]
    same_rows(spark.table(dst), expected())
    incremental.reprocess_window(spark, src, bank.account, dst, "2024-01-10")
    same_rows(spark.table(dst), expected())

    add(spark, src, dict(transaction_id=900001, account_id=2, event_ts="2024-01-08 10:00:00", amount=1000.0))
    add(spark, src, dict(transaction_id=900002, account_id=2, event_ts="2024-01-05 10:00:00"))
    incremental.reprocess_window(spark, src, bank.account, dst, "2024-01-10")
    same_rows(spark.table(dst), expected())

    # A later window leaves earlier partitions alone; a day without rows loses its partition.
    gone = in_range(read_table(spark, src), "2024-01-01", "2024-01-31").filter("event_date <> date '2024-01-09'")
    write_partitioned(gone, str(tmp_path / "less"))
    filled = incremental.reprocess_window(spark, str(tmp_path / "less"), bank.account, dst, "2024-01-11")
    assert dt.date(2024, 1, 9) not in filled
    dates = {r[0].day for r in spark.table(dst).select("event_date").distinct().collect()}
    assert dates == {7, 8, 10, 11}


def test_pipeline_outputs_and_report(spark, bank_checked, tmp_path):
    out = str(tmp_path / "out")
    report = jobs.run_pipeline(spark, bank_checked, jobs.PipelineConfig(out)).collect()
    counts = {r.stage: (r.rows_in, r.rows_out) for r in report}
    total = bank_checked.transaction.count()
    unique = dedup_latest(bank_checked.transaction).count()
    assert counts["dedup"] == (total, unique)
    quarantined = read_table(spark, f"{out}/quarantine").count()
    assert counts["quality"] == (unique, unique - quarantined)
    assert counts["enrich and point-in-time join"] == (unique - quarantined, unique - quarantined)
    spend = read_table(spark, f"{out}/daily_spend")
    assert counts["aggregate"][1] == spend.count()
    assert sum(r.is_slowest for r in report) >= 1 and all(r.duration_ms >= 0 for r in report)
    duck = oracle_connection(CHECKED)
    sql = registry.oracle_sql()["end_to_end_daily_spend"]
    columns = ["customer_id", "event_date", "total_spend", "txn_count"]
    assert difference(portable(spend.select(*columns)), duck, sql) is None


def test_pipeline_date_range(spark, bank, tmp_path):
    cfg = jobs.PipelineConfig(str(tmp_path / "out"), start="2024-01-05", end="2024-01-06")
    report = jobs.run_pipeline(spark, bank, cfg).first()
    assert report.rows_in == in_range(bank.transaction, "2024-01-05", "2024-01-06").count()


def test_etl_from_parquet_and_csv(spark, bank, tmp_path, capsys):
    base = tmp_path / "in"
    for table in ("transaction", "account", "customer_scd2", "product", "branch"):
        getattr(bank, table).write.parquet(str(base / table))
    report = jobs.run_etl(spark, str(base), str(tmp_path / "out"), run_date="2024-01-01", preview=2)
    counts = {r.entity: r.row_count for r in report.collect()}
    assert counts["transaction"] == bank.transaction.count() and len(counts) == 5
    customers = read_table(spark, str(tmp_path / "out/customer_table"))
    assert {r[0] for r in customers.select("ingest_date").distinct().collect()} == {dt.date(2024, 1, 1)}

    (base / "branch.csv").write_text("branch_id,branch_name,city,state\n1,Main Branch 1, City 1, State 2\n")
    report = jobs.run_etl(spark, str(base), str(tmp_path / "out2"), {"branch": "branch.csv"})
    assert [r.row_count for r in report.collect()] == [1]
    assert read_table(spark, str(tmp_path / "out2/branch_table")).first().branch_type == "Main"


def test_file_stats_and_compaction(spark, bank, tmp_path):
    src, dst = str(tmp_path / "src"), str(tmp_path / "dst")
    bank.transaction.repartition(10).write.partitionBy("event_date").parquet(src)
    stats = layout.file_stats(spark, src)
    dates = bank.transaction.select("event_date").distinct().count()
    assert stats.count() == dates and stats.filter("has_small_files").count() > 0
    layout.compact(spark, src, dst)
    assert {r.file_count for r in layout.file_stats(spark, dst).collect()} == {4}
    same_rows(read_table(spark, dst), bank.transaction)
    layout.compact(spark, src, f"{dst}2", target_bytes=20_000)
    expected = {r.event_date: -(-r.total_bytes // 20_000) for r in stats.collect()}
    assert {r.event_date: r.file_count for r in layout.file_stats(spark, f"{dst}2").collect()} == expected
    same_rows(read_table(spark, f"{dst}2"), bank.transaction)


def test_consistent_hash(spark):
    keys = spark.range(20000).withColumnRenamed("id", "account_id")
    eight = layout.consistent_owner(keys, "account_id", 8)
    sizes = [r["count"] for r in eight.groupBy("_owner").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1.15 * 20000 / 8
    nine = layout.consistent_owner(keys, "account_id", 9).withColumnRenamed("_owner", "_next")
    moved = eight.join(nine, "account_id").filter("_owner <> _next")
    assert 0 < moved.count() < 20000 / 9 * 1.2
    assert moved.filter("_next <> 8").count() == 0
    placed = layout.consistent_hash_partition(keys, "account_id", 8)
    assert placed.rdd.getNumPartitions() == 8
    per_part = placed.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sorted(r["count"] for r in per_part) == sorted(sizes)
    assert layout.consistent_hash_partition(keys, "account_id", 8).count() == 20000


def test_plan_report(bank):
    native = tuning.plan_report(BATCH["risk_bucket_counts"](bank))
    assert native["python_nodes"] == {} and native["codegen_stages"] > 0 and native["shuffles"] == 1
    assert "BatchEvalPython" in tuning.plan_report(BATCH["risk_bucket_udf"](bank))["python_nodes"]
    assert "ArrowEvalPython" in tuning.plan_report(BATCH["risk_bucket_pandas_udf"](bank))["python_nodes"]
    product = tuning.plan_report(BATCH["product_enrichment"](bank))
    assert product["joins"] == {"BroadcastHashJoin": 1} and product["shuffles"] == 0


def test_state_totals_shuffle_target(spark, bank):
    from tallybank.session import session_conf

    assert tuning.plan_report(BATCH["state_totals"](bank))["shuffles"] <= 2
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        report = tuning.plan_report(BATCH["state_totals"](bank))
    assert report["shuffles"] == 3 and report["joins"] == {"SortMergeJoin": 1, "BroadcastHashJoin": 1}


def test_one_shuffle_of_the_fact(spark, bank):
    """Row-level joins: one exchange of the fact, one per dimension, one for the hot-key counts."""
    from tallybank.session import session_conf

    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = BATCH["scd2_point_in_time"](bank)
        assert tuning.plan_report(plan)["shuffles"] == 5
        wide = BATCH["enriched_transactions"](bank).select("*")._jdf.queryExecution().executedPlan().toString()
    facts = [line for line in wide.splitlines() if "Exchange hashpartitioning(account_id" in line]
    assert len([line for line in facts if "_salt" in line]) >= 1


def test_run_configs_agree(spark, bank):
    out = tuning.run_configs(spark, lambda: BATCH["daily_customer_spend"](bank)).collect()
    assert len(out) == len(tuning.EXPERIMENT)
    assert len({r.row_count for r in out}) == 1
    by_label = {r.label: r for r in out}
    assert by_label["aqe off"].stages > 0 and by_label["aqe off"].tasks > 0
    assert all(r.output_partitions >= 1 for r in out)


@pytest.mark.parametrize("name", ["running_balance", "scd2_point_in_time", "amount_spike", "scd2_upsert"])
@pytest.mark.parametrize("partitions", [1, 7, 200])
@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_same_rows_under_any_setting(spark, bank, name, partitions, adaptive):
    from tallybank.session import session_conf

    base = rows(BATCH[name](bank))
    conf = {"spark.sql.shuffle.partitions": partitions, "spark.sql.adaptive.enabled": adaptive}
    with session_conf(spark, conf):
        assert rows(BATCH[name](bank).select("*")) == base


def test_compare_caching(bank):
    actions = [lambda d: d.count(), lambda d: d.filter("status = 'Approved'").count(),
               lambda d: d.agg(F.sum(F.col("amount").cast("decimal(18,2)"))).first()[0]]
    out = tuning.compare_caching(dedup_latest(bank.transaction), actions).collect()
    assert len(out) == 4 and len({tuple(r.results) for r in out}) == 1


def test_compare_udf(bank):
    out = {r.form: r for r in tuning.compare_udf(bank.transaction).collect()}
    assert out["native"].python_nodes == "" and "ArrowEvalPython" in out["pandas udf"].python_nodes


@pytest.mark.parametrize("name", sorted(tuning.SQL_TWINS))
def test_sql_twins(spark, bank, name):
    same_rows(tuning.sql_twin(spark, name, bank), BATCH[name](bank))


def test_timed(capsys):
    times = {}
    with tuning.timed("step", times):
        pass
    assert "step took 0.0" in capsys.readouterr().out and times["step"] >= 0


CFG = generator.GenConfig(
    num_transactions=20000, num_customers=2000, num_accounts=2000, num_products=500, num_branches=50
)


def share(df, condition):
    return df.filter(condition).count() / df.count()


def test_generator_tables(spark, tmp_path):
    from dataclasses import replace

    cfg = replace(CFG, output_path=str(tmp_path))
    generator.write_all(spark, cfg)
    bank = Bank.stored(spark, str(tmp_path))
    from tallybank.schemas import SYNTHETIC

    for table, layout_text in SYNTHETIC.items():
        assert {tuple(c.split()) for c in layout_text.split(", ")} == set(getattr(bank, table).dtypes)
    facts = bank.transaction
    assert facts.count() == 20000 and facts.select("event_date").distinct().count() == 30
    assert share(facts, "account_id = 1") == pytest.approx(0.95 * (1 - 2**-1.2), abs=0.02)
    assert share(facts, "account_id is null") == pytest.approx(0.02, abs=0.005)
    assert share(facts, "amount = -999999.99D") == pytest.approx(0.03, abs=0.005)
    assert share(facts, "datediff(ingest_date, event_date) not between 0 and 3") == 0
    assert share(facts, "to_date(event_ts) <> event_date") == 0
    repeated = 1 - facts.select("transaction_id").distinct().count() / facts.count()
    assert repeated == pytest.approx(0.02, abs=0.005)
    assert facts.filter("transaction_id < 1 or account_id > 2000").count() == 0
    history = bank.customer_scd2
    assert history.filter("is_current").count() == 2000
    assert history.filter("is_current").select("customer_id").distinct().count() == 2000
    assert history.count() == pytest.approx(2300, abs=60)
    assert history.filter("effective_end < effective_start").count() == 0


def test_generator_does_not_depend_on_partitioning(spark):
    from dataclasses import replace

    def generated(tasks):
        df = generator.gen_transaction(spark, replace(CFG, partitions=tasks))
        assert df.rdd.getNumPartitions() == tasks
        return rows(df.filter("transaction_id < 2000"))

    assert generated(1) == generated(7)


def test_zipf_share_of_the_first_id(spark):
    ids = spark.range(50000).select(generator.zipf_id(generator.uniform("z"), 10**6, 1.2).alias("i"))
    assert share(ids, "i = 1") == pytest.approx(1 - 2**-1.2, abs=0.01)
    assert ids.filter("i < 1 or i > 1000000").count() == 0


def test_generated_bank_runs_the_queries(spark, tmp_path):
    from dataclasses import replace

    small = replace(CFG, num_transactions=3000, output_path=str(tmp_path))
    generator.write_all(spark, small)
    bank = Bank.stored(spark, str(tmp_path))
    from tallybank.operators import windows

    same_rows(windows.running_balance(bank.transaction), windows.running_balance(bank.transaction, skew_safe=False))
    assert BATCH["branch_summary"](bank).count() > 0
