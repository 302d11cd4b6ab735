from __future__ import annotations

import pytest

from tallybank.session import get_spark
from tallybank.views import Bank

SMALL = "/root/testdata/sf0.001"
CHECKED = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_spark(
        "tests",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def bank(spark):
    return Bank.over(spark, SMALL)


@pytest.fixture(scope="session")
def bank_checked(spark):
    return Bank.over(spark, CHECKED)


def rows(df):
    """Sorted plain tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def same_rows(left, right):
    assert sorted(left.columns) == sorted(right.columns)
    columns = left.columns
    assert rows(left) == rows(right.select(*columns))


TXN = (
    "transaction_id bigint, account_id bigint, product_id bigint, branch_id bigint, amount double, currency string, "
    "transaction_type string, status string, event_date date, event_ts timestamp, ingest_date date"
)


def txn(spark, *records):
    """Transactions from partial dicts; event_date and ingest_date follow event_ts unless given."""
    import datetime as dt

    base = dict(
        transaction_id=1,
        account_id=1,
        product_id=1,
        branch_id=1,
        amount=10.0,
        currency="USD",
        transaction_type="Deposit",
        status="Approved",
        event_ts="2024-01-05 12:00:00",
    )
    data = []
    for record in records:
        full = {**base, **record}
        ts = full["event_ts"]
        full["event_ts"] = dt.datetime.fromisoformat(ts).replace(tzinfo=dt.timezone.utc) if ts else None
        day = ts[:10] if ts else None
        for column in ("event_date", "ingest_date"):
            value = full.get(column, day)
            full[column] = dt.date.fromisoformat(value) if value else None
        data.append(tuple(full[c.split()[0]] for c in TXN.split(", ")))
    return spark.createDataFrame(data, TXN)
