"""Declared table layouts.

CANONICAL is the delimited-file layout of each entity, SYNTHETIC the Parquet layout that the
generator writes and that streams must be given explicitly.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

CANONICAL = {
    "customer": "customer_id int not null, first_name string, last_name string, email string, phone string",
    "account": (
        "account_id int not null, customer_id int not null, branch_id int not null, account_type string, "
        "balance double"
    ),
    "transaction": (
        "transaction_id int not null, account_id int not null, product_id int not null, amount double, "
        "transaction_date string"
    ),
    "product": "product_id int not null, prod_name string, description string",
    "branch": "branch_id int not null, branch_name string, city string, state string",
}

SYNTHETIC = {
    "branch": "branch_id bigint, branch_name string, state string, open_date date",
    "product": "product_id bigint, product_name string, product_group string",
    "account": (
        "account_id bigint, customer_id bigint, branch_id bigint, account_type string, status string, "
        "open_date date, balance double"
    ),
    "customer_scd2": (
        "customer_id bigint, first_name string, last_name string, email string, phone string, risk_tier string, "
        "effective_start date, effective_end date, is_current boolean, version int"
    ),
    "transaction": (
        "transaction_id bigint, account_id bigint, product_id bigint, branch_id bigint, amount double, "
        "currency string, transaction_type string, status string, event_date date, event_ts timestamp, "
        "ingest_date date"
    ),
}

ENTITIES = tuple(CANONICAL)


def schema_for(entity: str) -> StructType:
    """The declared delimited-file schema of an entity."""
    if entity not in CANONICAL:
        raise ValueError(f"no schema for entity {entity!r}; known: {', '.join(ENTITIES)}")
    return StructType.fromDDL(CANONICAL[entity])


def table_schema(table: str) -> StructType:
    """The declared schema of a synthetic Parquet table."""
    if table not in SYNTHETIC:
        raise ValueError(f"no schema for table {table!r}; known: {', '.join(SYNTHETIC)}")
    return StructType.fromDDL(SYNTHETIC[table])


def entity_of(path: str) -> str:
    """The entity a path holds, judged by its last segment only."""
    last = path.rstrip("/").rsplit("/", 1)[-1].lower()
    for entity in ENTITIES:
        if last.startswith(entity):
            return entity
    raise ValueError(f"the last segment of {path!r} must start with one of {', '.join(ENTITIES)}")
