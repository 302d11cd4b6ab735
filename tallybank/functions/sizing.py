"""Broadcast only what the optimizer's own size estimate allows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_LIMIT = 32 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """Size from Spark's plan statistics: file sizes scaled by the columns read. Runs no job."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Hint a broadcast for a dimension that fits; otherwise leave the choice to AQE's runtime sizes."""
    return F.broadcast(df) if estimated_bytes(df) <= limit else df
