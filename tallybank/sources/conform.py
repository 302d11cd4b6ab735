"""From the synthetic Parquet layout to the canonical layout of each entity."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Canonical columns as SQL over the synthetic table.
CANONICAL_COLUMNS = {
    "transaction": [
        "transaction_id",
        "account_id",
        "product_id",
        "amount",
        "cast(event_date as string) as transaction_date",
    ],
    "customer": ["customer_id", "first_name", "last_name", "email", "phone"],
    "account": ["account_id", "customer_id", "branch_id", "account_type", "balance"],
    "product": ["product_id", "product_name as prod_name", "product_group as description"],
    "branch": ["branch_id", "branch_name", "cast(null as string) as city", "state"],
}


def conform(df: DataFrame, entity: str) -> DataFrame:
    if entity not in CANONICAL_COLUMNS:
        raise ValueError(f"unknown entity {entity!r}; known: {', '.join(CANONICAL_COLUMNS)}")
    return df.selectExpr(*CANONICAL_COLUMNS[entity])
