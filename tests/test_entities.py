from __future__ import annotations

import datetime as dt

import pytest

from tallybank.operators import entities
from tallybank.operators.configured import apply_config, load_config
from tallybank.schemas import ENTITIES, entity_of, schema_for, table_schema
from tests.conftest import rows


def test_clean_customer_text(spark):
    data = [
        (1, " aLICE", "smith ", None, "555-123-4567"),
        (2, "bob", None, "a@b", "000-000-0000"),
        (3, "X", "Y", "a@b@c.com", "5551234567"),
        (4, "X", "Y", "a b@c.com", None),
        (5, "X", "Y", "invalid_email", "555-123-45678"),
        (6, "X", "Y", "u@example.com", "555-123-4567"),
    ]
    df = spark.createDataFrame(data, "customer_id int, first_name string, last_name string, email string, phone string")
    out = {r.customer_id: r for r in entities.clean_customer(df, "2024-01-01").collect()}
    assert (out[1].first_name, out[1].last_name, out[1].full_name) == ("Alice", "Smith", "Alice Smith")
    assert out[2].full_name == "Bob"
    assert [out[i].email_domain for i in range(1, 7)] == [None, "b", "b", "c.com", None, "example.com"]
    assert [out[i].is_email_valid for i in range(1, 7)] == [False, False, False, False, False, True]
    assert [out[i].is_phone_valid for i in range(1, 7)] == [True, True, False, False, False, True]
    assert out[1].ingest_date == dt.date(2024, 1, 1)


def test_clean_account_nulls_and_bounds(spark):
    balances = [None, -0.01, 0.0, 999.99, 1000.0, 9999.99, 10000.0]
    data = [(i, b, " loan " if i % 2 else None) for i, b in enumerate(balances)]
    df = spark.createDataFrame(data, "account_id int, balance double, account_type string")
    out = entities.clean_account(df, "2024-01-01").orderBy("account_id").collect()
    assert [r.balance_tier for r in out] == ["High", "Overdrawn", "Low", "Low", "Medium", "Medium", "High"]
    assert [r.is_overdrawn for r in out] == [None, True, False, False, False, False, False]
    assert [r.account_type for r in out[:2]] == [None, "LOAN"]
    assert [r.is_credit_account for r in out[:2]] == [None, True]
    assert {r.account_status for r in out} == {"active"}
    labelled = entities.clean_account(df, null_label="Unknown").orderBy("account_id").first()
    assert labelled.balance_tier == "Unknown"


def test_clean_transaction_dates_and_amounts(spark):
    data = [
        (1, 1, 1, None, "2023-2-28"),
        (2, 1, 1, 0.0, "2023-12-16"),
        (3, None, 1, -0.01, "2026-02-15"),
        (4, -1, 1, 10000.0, "garbage"),
        (None, 1, 1, 10000.01, None),
    ]
    df = spark.createDataFrame(
        data, "transaction_id int, account_id int, product_id int, amount double, transaction_date string"
    )
    out = entities.clean_transaction(df, "2024-01-01 00:00:00").collect()
    dates = [r.transaction_date for r in out]
    assert dates == [dt.date(2023, 2, 28), dt.date(2023, 12, 16), dt.date(2026, 2, 15), None, None]
    assert [r.amount_direction for r in out] == ["DEBIT", "CREDIT", "DEBIT", "CREDIT", "CREDIT"]
    assert [r.is_large_transaction for r in out] == [None, False, False, False, True]
    assert [r.is_valid for r in out] == [False, True, False, True, False]
    assert out[2].abs_amount == 0.01
    assert entities.clean_transaction(df, null_label="NONE").first().amount_direction == "NONE"


def test_clean_product_names(spark):
    names = ["Debit Card 1", "Credit Card 22", "Savings 3", "Mortgage", "Debit Credit", "Auto Loan", "Checking", None]
    df = spark.createDataFrame(list(enumerate(names)), "product_id int, prod_name string")
    out = entities.clean_product(df, "2024-01-01").orderBy("product_id").collect()
    kinds = [r.product_category for r in out]
    assert kinds == ["Debit", "Credit", "Savings", "Other", "Debit", "Loan", "Checking", "Other"]
    assert [r.is_lending_product for r in out] == [False, True, False, False, False, True, False, False]
    assert [r.product_name_clean for r in out][:4] == ["Debit Card", "Credit Card", "Savings", "Mortgage"]
    assert out[-1].product_name_clean is None


def test_clean_branch_states(spark):
    data = [
        (1, "Main Branch 1", " City 1", " State 2"),
        (2, "Branch International", None, "NY"),
        (3, "Branch Airport", None, "ZZ"),
        (4, "Elsewhere", None, "ny"),
        (5, None, None, None),
    ]
    df = spark.createDataFrame(data, "branch_id int, branch_name string, city string, state string")
    out = entities.clean_branch(df, "2024-01-01").orderBy("branch_id").collect()
    assert [r.branch_type for r in out] == ["Main", "International", "Airport", "Other", "Other"]
    assert [r.is_state_valid for r in out] == [False, True, True, False, False]
    assert (out[0].city, out[0].state, out[0].branch_upper) == ("City 1", "State 2", "MAIN BRANCH 1")


def test_audit_column_defaults_to_today(spark):
    today = spark.sql("select current_date()").first()[0]
    assert entities.with_audit(spark.range(1)).first().ingest_date == today


def test_config_order_and_missing_parts(spark, tmp_path):
    layout = "first_name string, last_name string, risk_tier string, version int"
    df = spark.createDataFrame([("a", "b", "Low", 1)], layout)
    config = {
        "transformations": {
            "customer": {
                "add_columns": [
                    {"name": "full_name", "expr": "concat(first_name, ' ', last_name)"},
                    {"name": "loud", "expr": "upper(full_name)"},
                ],
                "rename_columns": {"risk_tier": "customer_risk"},
                "drop_columns": ["version"],
            },
            "account": {"drop_columns": ["version", "absent"]},
        }
    }
    out = apply_config(df, "customer", config)
    assert out.columns == ["first_name", "last_name", "customer_risk", "full_name", "loud"]
    assert out.first().loud == "A B"
    assert apply_config(df, "branch", config).columns == df.columns
    assert apply_config(df, "customer", {}).columns == df.columns
    assert "version" not in apply_config(df, "account", config).columns
    path = tmp_path / "config.json"
    path.write_text('{"transformations": {"customer": {"drop_columns": ["version"]}}}')
    assert "version" not in apply_config(df, "customer", load_config(spark, str(path))).columns


def test_schemas_and_path_hints():
    assert {e: len(schema_for(e)) for e in ENTITIES} == {
        "customer": 5, "account": 5, "transaction": 5, "product": 3, "branch": 4,
    }
    assert len(table_schema("transaction")) == 11
    assert entity_of("/data/account/transaction.csv") == "transaction"
    assert entity_of("s/customer_scd2/") == "customer"
    for bad in ("/data/account/other.csv", "x"):
        with pytest.raises(ValueError):
            entity_of(bad)
    with pytest.raises(ValueError):
        schema_for("nothing")
    with pytest.raises(ValueError):
        table_schema("nothing")


def test_risk_bucket_forms_agree(spark):
    from pyspark.sql import functions as F

    from tallybank.functions.risk import risk_bucket, risk_bucket_pandas_udf, risk_bucket_udf

    data = [
        (None, 1.0), ("Transfer", None), ("Deposit", 5000.01), ("Transfer", 5000.0), ("Transfer", 1000.0),
        ("Deposit", 1000.01), ("Deposit", 500.0), ("Deposit", -1.0),
    ]
    df = spark.createDataFrame(data, "transaction_type string, amount double")
    kinds = F.col("transaction_type"), F.col("amount")
    out = df.select(risk_bucket(), risk_bucket_udf(*kinds), risk_bucket_pandas_udf(*kinds))
    expected = ["UNKNOWN", "UNKNOWN", "CRITICAL", "HIGH", "MEDIUM", "MEDIUM", "LOW", "LOW"]
    assert rows(out) == sorted([(e, e, e) for e in expected], key=repr)
