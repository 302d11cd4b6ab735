from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallybank.plans.tuning import plan_report
from tallybank.session import scratch_path, session_conf, shared_dir
from tallybank.sinks import tables
from tallybank.sources import files, streams
from tallybank.sources.conform import conform
from tests.conftest import rows, same_rows

HEADER = "account_id,customer_id,branch_id,account_type,balance\n"


@pytest.fixture
def csv(tmp_path):
    def write(*lines):
        path = tmp_path / "account.csv"
        path.write_text(HEADER + "\n".join(lines) + "\n")
        return str(path)

    return write


def test_csv_strict(spark, csv):
    out = files.read_csv(spark, csv("1,2,3,Loan,4.5", "2,3,4,,"), "account")
    assert rows(out) == [(1, 2, 3, "Loan", 4.5), (2, 3, 4, None, None)]


@pytest.mark.parametrize("bad", ["x,2,3,Loan,4.5", "1,2,3,Loan", "1,2,3,Loan,4.5,extra"])
def test_csv_strict_fails_on_bad_rows(spark, csv, bad):
    path = csv("1,2,3,Loan,4.5", bad)
    with pytest.raises(Exception, match="account.csv"):
        files.read_csv(spark, path, "account").collect()
    good, corrupt = files.split_corrupt(files.read_csv(spark, path, "account", "PERMISSIVE"))
    assert rows(good) == [(1, 2, 3, "Loan", 4.5)]
    assert good.count() == 1 and good.select("branch_id").count() == 1
    assert [r._corrupt_record for r in corrupt.collect()] == [bad]


def test_csv_strict_fails_on_unused_columns(spark, csv):
    with pytest.raises(Exception, match="account.csv"):
        files.read_csv(spark, csv("x,2,3,Loan,4.5"), "account").count()


def test_csv_missing_file(spark):
    with pytest.raises(FileNotFoundError, match="/nowhere/account.csv"):
        files.read_csv(spark, "/nowhere/account.csv", "account")


def test_conform_rejects_unknown(spark):
    with pytest.raises(ValueError):
        conform(spark.range(1), "nothing")


def test_parquet_round_trip(spark, bank, tmp_path):
    path = tables.write_table(bank.account, str(tmp_path), "account")
    same_rows(files.read_table(spark, path), bank.account)
    tables.write_table(bank.account.limit(1), str(tmp_path), "account")
    assert files.read_table(spark, path).count() == 1


def test_partitioned_write_and_pruning(spark, bank, tmp_path):
    path = str(tmp_path / "t")
    tables.write_partitioned(bank.transaction, path)
    same_rows(files.read_table(spark, path), bank.transaction)
    window = files.read_range(spark, path, "2024-01-05", "2024-01-06")
    filters = plan_report(window)["partition_filters"]
    assert any("event_date" in f and ">=" in f for f in filters) and any("<=" in f for f in filters)
    same_rows(window, files.in_range(bank.transaction, "2024-01-05", "2024-01-06"))


def test_filters_and_columns_reach_the_scan(spark, bank, tmp_path):
    from tallybank.operators import analytics, quality

    path = str(tmp_path / "t")
    tables.write_partitioned(bank.transaction, path)
    stored = files.read_table(spark, path)

    def scan(df):
        with session_conf(spark, {"spark.sql.maxMetadataStringLength": 2000}):
            plan = df._jdf.queryExecution().executedPlan().toString()
        return next(line for line in plan.splitlines() if "FileScan" in line)

    spend = scan(analytics.totals_by(analytics.revenue_rows(stored), ["currency"]))
    assert "EqualTo(status,Approved)" in spend and "Not(EqualTo(amount,-999999.99))" in spend
    assert "ReadSchema: struct<amount:double,currency:string,status:string>" in spend
    valid = scan(quality.split_quality(stored)[0])
    assert "GreaterThan(account_id,0)" in valid and "Not(EqualTo(currency,XXX))" in valid


def test_file_size_cap(spark, bank, tmp_path):
    path = str(tmp_path / "t")
    tables.write_partitioned(bank.transaction.coalesce(1), path, max_records=10)
    per_file = files.read_table(spark, path).groupBy(F.col("_metadata.file_path")).count()
    assert per_file.agg(F.max("count")).first()[0] <= 10


def test_dynamic_overwrite(spark, bank, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite_partitions(bank.transaction, path)
    before = rows(files.read_table(spark, path))
    day = files.in_range(bank.transaction, "2024-01-05", "2024-01-05")
    for _ in range(2):
        tables.overwrite_partitions(day, path)
        assert rows(files.read_table(spark, path)) == before
    tables.overwrite_partitions(day.limit(1), path)
    assert len(before) - files.read_table(spark, path).count() == day.count() - 1


def test_bucketed_join_has_no_shuffle(spark, bank):
    from tallybank.operators.joins import bucketed_join

    facts = bank.transaction.select("transaction_id", "account_id", "amount")
    owners = bank.account.select("account_id", "account_type")
    tables.write_bucketed(facts, "facts_bucketed", 4, files_per_bucket=2)
    tables.write_bucketed(owners, "owners_bucketed", 4, files_per_bucket=1)
    # The tables are tiny here: without this Spark would broadcast one of them.
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        joined = bucketed_join(spark, "facts_bucketed", "owners_bucketed", "account_id")
        report = plan_report(joined)
        assert report["shuffles"] == 0 and report["joins"] == {"SortMergeJoin": 1}
        same_rows(joined, facts.join(owners, "account_id"))
    files_written = spark.table("facts_bucketed").select("_metadata.file_path").distinct().count()
    assert files_written <= 8


def test_jdbc_sink(spark, bank, monkeypatch):
    url = "jdbc:derby:memory:bank;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    branches = bank.branch.select("branch_id", F.col("branch_name").cast("varchar(40)"))
    for _ in range(2):
        tables.write_jdbc(branches, url, "branches", props)
    back = spark.read.jdbc(url, "branches", properties=props)
    assert back.count() == bank.branch.count()
    monkeypatch.delenv("DB_USER", raising=False)
    monkeypatch.setenv("DB_PASSWORD", "x")
    with pytest.raises(ValueError, match="DB_USER"):
        tables.write_jdbc(branches, url, "branches")
    monkeypatch.setenv("DB_USER", "someone")
    assert tables.jdbc_credentials() == {"user": "someone", "password": "x"}


def test_land_partition(spark, bank, tmp_path):
    for date in ("2024-01-05", "2024-01-06"):
        streams.land_partition(bank.transaction, date, str(tmp_path / "feed"))
    same_rows(
        files.read_table(spark, str(tmp_path / "feed")), files.in_range(bank.transaction, "2024-01-05", "2024-01-06")
    )


def test_scratch_is_below_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == named
    assert scratch_path(spark, "x").startswith(f"{named}/x-")
    assert not Path(scratch_path(spark, "x")).exists()


def test_session_conf_is_restored(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    with pytest.raises(RuntimeError):
        with session_conf(spark, {"spark.sql.shuffle.partitions": 3, "tallybank.unset": "1"}):
            assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
            raise RuntimeError
    assert spark.conf.get("spark.sql.shuffle.partitions") == old
    assert spark.conf.get("tallybank.unset", None) is None
