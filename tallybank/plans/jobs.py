"""End-to-end pipeline and the five-entity ETL job, each with a report of its steps.

Each step ends in a written table, which the next step reads: nothing is cached, a lost executor
costs only its own tasks, and row counts are observed during the writes.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallybank.operators.analytics import finish, partial_totals
from tallybank.operators.dedup import dedup_latest
from tallybank.operators.entities import CLEANERS
from tallybank.operators.joins import enrich
from tallybank.operators.quality import PIPELINE_RULES, Rules, is_valid, with_reasons
from tallybank.plans.incremental import by_day
from tallybank.session import scratch_path
from tallybank.sinks.tables import write_partitioned, write_table
from tallybank.sources.conform import conform
from tallybank.sources.files import in_range, read_csv, read_table
from tallybank.views import Bank

REPORT = "stage string, rows_in bigint, rows_out bigint, duration_ms bigint"
ETL_REPORT = "entity string, target string, row_count bigint, duration_ms bigint"
VALID, REJECTED = "valid", "quarantine"
SYNTHETIC_NAMES = {
    "customer": "customer_scd2",
    "account": "account",
    "transaction": "transaction",
    "product": "product",
    "branch": "branch",
}


@dataclass(frozen=True)
class PipelineConfig:
    """Where the pipeline writes, the event dates it reads (all if unset) and its quality rules."""

    output: str
    start: dt.date | str | None = None
    end: dt.date | str | None = None
    rules: Rules | None = None
    staging: str | None = None


def counted(df: DataFrame, observation: Observation) -> DataFrame:
    return df.observe(observation, F.count(F.lit(1)).alias("rows"))


def elapsed_ms(action: Callable[[], object]) -> int:
    start = time.perf_counter()
    action()
    return round((time.perf_counter() - start) * 1000)


def run_pipeline(spark: SparkSession, bank: Bank, cfg: PipelineConfig) -> DataFrame:
    """Dedup, quality split, enrichment with point-in-time join, daily spend. Returns the stage report.

    Writes quarantine, enriched and daily_spend below cfg.output, the last two partitioned by event_date.
    """
    rules = PIPELINE_RULES if cfg.rules is None else cfg.rules
    staged = cfg.staging or scratch_path(spark, "deduplicated")
    quarantine, enriched, spend = (f"{cfg.output}/{name}" for name in ("quarantine", "enriched", "daily_spend"))
    stages: list[tuple[str, int, int, int]] = []

    raw = bank.transaction
    if cfg.start is not None or cfg.end is not None:
        raw = in_range(raw, cfg.start or dt.date.min, cfg.end or dt.date.max, undated=True)

    # One pass: valid and rejected rows land in different partitions, so later steps read only theirs.
    kept, checked = Observation(), Observation()
    # For stored files the count comes from their footers.
    rows_in = raw.count()
    unique = counted(dedup_latest(raw), kept)
    judged = unique.withColumn("outcome", F.when(is_valid(rules), VALID).otherwise(REJECTED))
    judged = judged.observe(checked, F.count_if(F.col("outcome") == VALID).alias("valid"))
    ms = elapsed_ms(lambda: write_partitioned(judged, staged, ["outcome"]))
    stages.append(("dedup", rows_in, kept.get["rows"], ms))

    outcomes = spark.read.schema(judged.schema).parquet(staged)
    rejected = with_reasons(outcomes.filter(F.col("outcome") == REJECTED).drop("outcome"), rules)
    ms = elapsed_ms(lambda: rejected.write.mode("overwrite").parquet(quarantine))
    stages.append(("quality", kept.get["rows"], checked.get["valid"], ms))

    valid = outcomes.filter(F.col("outcome") == VALID).drop("outcome")
    joined = Observation()
    full = counted(enrich(valid, bank.account, bank.product, bank.branch, bank.customer_scd2), joined)
    ms = elapsed_ms(lambda: write_partitioned(by_day(full), enriched))
    stages.append(("enrich and point-in-time join", checked.get["valid"], joined.get["rows"], ms))

    totals = Observation()
    daily = partial_totals(read_table(spark, enriched), "customer_id", "event_date").transform(
        finish, "customer_id", "event_date", total="total_spend"
    )
    ms = elapsed_ms(lambda: write_partitioned(by_day(counted(daily, totals)), spend))
    stages.append(("aggregate", joined.get["rows"], totals.get["rows"], ms))

    return stage_report(spark, stages)


def stage_report(spark: SparkSession, stages: list[tuple[str, int, int, int]]) -> DataFrame:
    """One row per stage, the slowest one marked."""
    slowest = max(stage[3] for stage in stages)
    report = spark.createDataFrame(stages, REPORT)
    return report.withColumn("is_slowest", F.col("duration_ms") == slowest)


def read_entity(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """An entity in its canonical layout, from a delimited file or a synthetic Parquet table."""
    if path.lower().endswith(".csv"):
        return read_csv(spark, path, entity)
    return conform(read_table(spark, path), entity)


def run_etl(
    spark: SparkSession,
    base_in: str,
    base_out: str,
    entities: Mapping[str, str] = SYNTHETIC_NAMES,
    run_date: dt.date | str | None = None,
    preview: int = 0,
) -> DataFrame:
    """Clean each entity and write `<entity>_table`. `entities` maps an entity to its file below base_in.

    Rows are counted during the write. `preview` prints that many input rows, read from the first file only.
    """
    report = []
    for entity, name in entities.items():
        source = read_entity(spark, f"{base_in}/{name}", entity)
        if preview:
            source.limit(preview).show()
        seen = Observation()
        table = counted(CLEANERS[entity](source, run_date), seen)
        target = f"{entity}_table"
        ms = elapsed_ms(lambda: write_table(table, base_out, target))
        report.append((entity, target, seen.get["rows"], ms))
    return spark.createDataFrame(report, ETL_REPORT)
