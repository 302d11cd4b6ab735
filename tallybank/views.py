"""The five banking tables as views over a folder of general-purpose Parquet tables.

Each text is one SQL statement valid in Spark SQL and in other ANSI engines; `{name}` stands for a
source table. Every dirty value, copy and hot key is a function of integer keys.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tallybank.session import use_utc

TRANSACTION = """
select
 case when event_id % 50 = 7 and event_id >= 500 then event_id - (event_id * 7) % 500 else event_id end + 1 as transaction_id,
 case when event_id % 50 = 0 then null when event_id % 100 in (11,33,55) then -1 when event_id % 100 < 56 then 1 else user_id + 1 end as account_id,
 case when event_id % 97 = 0 then null when event_id % 89 = 0 then 999999 else event_id % 100 + 1 end as product_id,
 event_id % 25 + 1 as branch_id,
 case when event_id % 50 = 1 then null when event_id % 100 in (12,34,56) then cast(-999999.99 as double) else cast(cast(value as decimal(12,2)) * 20 - 500 as double) end as amount,
 case when event_id % 50 = 2 then null when event_id % 100 in (13,35,57) then 'XXX' when event_id % 5 = 0 then 'USD' when event_id % 5 = 1 then 'EUR' when event_id % 5 = 2 then 'GBP' when event_id % 5 = 3 then 'JPY' else 'CAD' end as currency,
 case when event_id % 50 = 3 then null when event_id % 100 in (14,36,58) then 'UNKNOWN' when event_type = 'purchase' then 'Payment' when event_type = 'view' then 'Deposit' when event_type = 'signup' then 'Transfer' else 'Withdrawal' end as transaction_type,
 case when event_id % 3 = 0 then 'Approved' when event_id % 3 = 1 then 'Declined' else 'Reversed' end as status,
 cast(ts as date) as event_date,
 case when event_id % 500 < 36 then cast(cast(ts as date) as timestamp) + (43200 + (event_id % 500) * 8) * interval '1' second else cast(ts as timestamp) end as event_ts,
 cast(ts as date) + cast(event_id % 4 as int) as ingest_date
 from {events}
"""

ACCOUNT = """
select c_custkey + 1 as account_id,
 case when c_custkey % 50 = 5 then null when c_custkey % 100 in (17,37,67) then -1 else cast(floor(c_custkey / 2) as bigint) + 1 end as customer_id,
 cast(c_nationkey as bigint) + 1 as branch_id,
 case when c_custkey % 50 = 6 then null when c_custkey % 100 in (18,38,68) then 'INVALID_TYPE' when c_mktsegment = 'AUTOMOBILE' then 'Loan' when c_mktsegment = 'BUILDING' then 'Credit' when c_mktsegment = 'FURNITURE' then 'Savings' else 'Checking' end as account_type,
 case when c_custkey % 3 = 0 then 'Active' when c_custkey % 3 = 1 then 'Dormant' else 'Closed' end as status,
 DATE '2023-12-31' - cast(c_custkey % 3650 as int) as open_date,
 c_acctbal as balance from {customer}
"""

CUSTOMER_SCD2 = """
select cast(floor(c_custkey / 2) as bigint) + 1 as customer_id,
 case when c_custkey % 10 = 0 then ' aLICE' when c_custkey % 10 = 2 then 'bob ' when c_custkey % 10 = 4 then 'Diana' when c_custkey % 10 = 6 then 'eve' else 'FRANK' end as first_name,
 case when c_custkey % 6 = 0 then 'smith' when c_custkey % 6 = 2 then ' Garcia ' else 'DOE' end as last_name,
 case when c_custkey % 50 = 8 then null when c_custkey % 100 in (20,40,60) then 'invalid_email' else concat('user', cast(c_custkey as varchar(20)), '@example.com') end as email,
 case when c_custkey % 50 = 10 then null when c_custkey % 100 in (22,42,62) then '000-000-0000' else concat('555-', lpad(cast(c_custkey % 1000 as varchar(20)), 3, '0'), '-', lpad(cast(c_custkey * 7 % 10000 as varchar(20)), 4, '0')) end as phone,
 case when v = 1 then case when c_custkey % 3 = 0 then 'Low' when c_custkey % 3 = 1 then 'Medium' else 'High' end when c_custkey % 3 = 2 then 'Medium' else 'High' end as risk_tier,
 case when v = 1 then DATE '2023-06-01' else DATE '2024-01-01' + cast(c_custkey % 30 as int) end as effective_start,
 case when v = 1 and c_custkey % 14 = 0 then DATE '2023-12-31' + cast(c_custkey % 30 as int) else null end as effective_end,
 not (v = 1 and c_custkey % 14 = 0) as is_current, v as version
 from (select c_custkey, 1 as v from {customer} union all select c_custkey, 2 as v from {customer}) vv
 where c_custkey % 2 = 0 and (v = 1 or c_custkey % 14 = 0)
"""

PRODUCT = """
select product_id,
 case when product_id % 50 = 9 then null when product_id % 100 in (21,41,61) then 'UNKNOWN' else base_name end as product_name,
 case when base_name like '%Loan%' then 'Loan' else 'Deposit' end as product_group
 from (select p_partkey + 1 as product_id, case when p_partkey % 7 = 0 then 'Checking' when p_partkey % 7 = 1 then 'Savings' when p_partkey % 7 = 2 then 'Credit Card' when p_partkey % 7 = 3 then 'Debit Card' when p_partkey % 7 = 4 then 'Mortgage' when p_partkey % 7 = 5 then 'Auto Loan' else 'Personal Loan' end as base_name from {part}) p
"""

BRANCH = """
select cast(n_nationkey as bigint) + 1 as branch_id,
 concat('Branch ', case when n_nationkey % 6 = 0 then 'Main' when n_nationkey % 6 = 1 then 'Downtown' when n_nationkey % 6 = 2 then 'Suburban' when n_nationkey % 6 = 3 then 'Airport' when n_nationkey % 6 = 4 then 'International' else 'Online' end) as branch_name,
 case when n_nationkey = 11 then null when n_nationkey = 17 then 'ZZ' when n_nationkey % 8 = 0 then 'NY' when n_nationkey % 8 = 1 then 'CA' when n_nationkey % 8 = 2 then 'TX' when n_nationkey % 8 = 3 then 'FL' when n_nationkey % 8 = 4 then 'IL' when n_nationkey % 8 = 5 then 'NJ' when n_nationkey % 8 = 6 then 'WA' else 'MA' end as state,
 DATE '2023-12-31' - cast(n_nationkey * 100 as int) as open_date from {nation}
"""

# table -> (view text, source table)
BANK = {
    "transaction": (TRANSACTION, "events"),
    "account": (ACCOUNT, "customer"),
    "customer_scd2": (CUSTOMER_SCD2, "customer"),
    "product": (PRODUCT, "part"),
    "branch": (BRANCH, "nation"),
}


def view_sql(table: str, source: str | None = None) -> str:
    """The view's text with its source table name filled in."""
    text, default = BANK[table]
    return text.format(**{default: source or default})


def bank_table(spark: SparkSession, base: str, table: str) -> DataFrame:
    """One banking table over the Parquet folder `base`."""
    text, source = BANK[table]
    return spark.sql(text, **{source: use_utc(spark).read.parquet(f"{base}/{source}.parquet")})


class Bank:
    """The five banking tables, each opened on first use. `open_table` maps a table name to a DataFrame."""

    def __init__(self, open_table: Callable[[str], DataFrame]):
        self._open = open_table

    @classmethod
    def over(cls, spark: SparkSession, base: str) -> Bank:
        """Views over a folder of general-purpose tables."""
        return cls(lambda table: bank_table(spark, base, table))

    @classmethod
    def stored(cls, spark: SparkSession, base: str) -> Bank:
        """Tables stored in the synthetic layout, one folder each."""
        return cls(lambda table: use_utc(spark).read.parquet(f"{base}/{table}"))

    @cached_property
    def transaction(self) -> DataFrame:
        return self._open("transaction")

    @cached_property
    def account(self) -> DataFrame:
        return self._open("account")

    @cached_property
    def customer_scd2(self) -> DataFrame:
        return self._open("customer_scd2")

    @cached_property
    def product(self) -> DataFrame:
        return self._open("product")

    @cached_property
    def branch(self) -> DataFrame:
        return self._open("branch")
