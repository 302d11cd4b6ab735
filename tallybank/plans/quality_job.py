"""The batch quality job: one pass over a table writes its rows by outcome and the counts of every rule."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallybank.operators.quality import RULES, Rules, is_valid, observe_rules, with_reasons
from tallybank.sinks.tables import write_partitioned

METRICS = "metric string, row_count bigint, pct double"
VALID, QUARANTINE = "valid", "quarantine"


def run_quality(
    spark: SparkSession, rows: DataFrame, out: str, run_date: dt.date | str, rules: Rules = RULES
) -> DataFrame:
    """Judge all rows and return the run's metrics: total, valid and quarantined rows, and violations per rule.

    `<out>/rows/run_date=<date>` gets the rows by outcome, rejected ones with their reasons, and
    `<out>/metrics/run_date=<date>` the metrics. Counts are observed during the write: the input is read once and not
    shuffled. A rerun of a date replaces its folders. With no rows, percentages are NULL.
    """
    seen = Observation()
    rejected = F.when(~is_valid(rules), F.col("rejection_reasons"))
    judged = (
        observe_rules(rows, seen, rules)
        .transform(with_reasons, rules)
        .withColumn("rejection_reasons", rejected)
        .withColumn("outcome", F.when(is_valid(rules), VALID).otherwise(QUARANTINE))
    )
    write_partitioned(judged, f"{out}/rows/run_date={run_date}", ["outcome"])
    counts = seen.get
    total = counts.pop("total")
    named = {"total": total, "valid": counts["valid"], "quarantined": total - counts.pop("valid"), **counts}
    metrics = spark.createDataFrame(
        [(name, count, 100.0 * count / total if total else None) for name, count in named.items()], METRICS
    )
    metrics.coalesce(1).write.mode("overwrite").parquet(f"{out}/metrics/run_date={run_date}")
    return metrics


def read_outcome(spark: SparkSession, out: str, outcome: str, schema=None) -> DataFrame:
    """Rows of one outcome of all runs; only that outcome's files are opened."""
    rows = spark.read.schema(schema).parquet(f"{out}/rows") if schema else spark.read.parquet(f"{out}/rows")
    rows = rows.filter(F.col("outcome") == outcome).drop("outcome", "run_date")
    return rows.drop("rejection_reasons") if outcome == VALID else rows


def read_metrics(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(f"{out}/metrics")
