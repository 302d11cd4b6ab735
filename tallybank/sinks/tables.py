"""Parquet, bucketed and JDBC writers."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, base: str, name: str) -> str:
    """Replace the Parquet table `base/name`; returns its path."""
    path = f"{base}/{name}"
    df.write.mode("overwrite").parquet(path)
    return path


def write_partitioned(
    df: DataFrame, path: str, cols: Sequence[str] = ("event_date",), max_records: int | None = None
) -> None:
    """Replace a partitioned table; `max_records` caps the rows per file."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*cols)
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.parquet(path)


def overwrite_partitions(df: DataFrame, path: str, cols: Sequence[str] = ("event_date",)) -> None:
    """Replace only the partitions present in `df`; running it again changes nothing."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*cols).parquet(path)


def write_bucketed(
    df: DataFrame,
    name: str,
    n: int = 16,
    col: str | Sequence[str] = "account_id",
    files_per_bucket: int = 8,
    location: str | None = None,
) -> None:
    """Replace a catalog table with n buckets, sorted inside, for joins without a shuffle.

    Each bucket is written by `files_per_bucket` tasks, so the bucket of a hot key is not left to one.
    A join reads a bucket in one task; where a key is too hot for that, bucket both sides on the key
    and a salt (functions.skew). The files lie below `location` if given, else in the warehouse.
    """
    cols = [col] if isinstance(col, str) else list(col)
    bucket = F.pmod(F.hash(*cols), F.lit(n))
    part = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_bucket)).cast("int")
    placed = df.repartitionById(n * files_per_bucket, bucket * files_per_bucket + part)
    writer = placed.write.mode("overwrite").bucketBy(n, *cols).sortBy(*cols)
    (writer.option("path", location) if location else writer).saveAsTable(name)


def jdbc_credentials() -> dict[str, str]:
    """User and password from DB_USER and DB_PASSWORD; a missing one is an error."""
    found = {"user": os.environ.get("DB_USER"), "password": os.environ.get("DB_PASSWORD")}
    missing = [f"DB_{name.upper()}" for name, value in found.items() if not value]
    if missing:
        raise ValueError(f"missing environment variable {', '.join(missing)}")
    return found


def write_jdbc(df: DataFrame, url: str, table: str, props: dict[str, str] | None = None) -> None:
    """Replace a database table. Without `props`, credentials come from the environment.

    Each partition opens one connection; set the `numPartitions` property to bound them.
    """
    properties = jdbc_credentials() if props is None else props
    df.write.mode("overwrite").jdbc(url, table, properties=properties)
