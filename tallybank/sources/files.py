"""Batch readers."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybank.schemas import schema_for

CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, entity: str, mode: str = "FAILFAST") -> DataFrame:
    """Delimited file with a header in the declared layout.

    FAILFAST ends the job at the first bad row. PERMISSIVE keeps every row and puts the text of bad
    ones into `_corrupt_record`; see `split_corrupt`. Every column is parsed, also those a query does not
    use, so a bad row is always noticed. A missing path is reported at once.
    """
    schema = schema_for(entity)
    if mode == "PERMISSIVE":
        schema = schema.add(CORRUPT, "string")
    reader = spark.read.schema(schema).options(header=True, mode=mode)
    try:
        return reader.option("columnNameOfCorruptRecord", CORRUPT).csv(path).filter(parsed(schema.names))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no {entity} file at {path}") from error
        raise


def parsed(columns: list[str]) -> Column:
    """Always true, but only known after every column was parsed; Spark skips columns nothing refers to."""
    return F.length(F.concat_ws("", *columns)) >= 0


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the raw text of bad ones, of a PERMISSIVE read."""
    corrupt = F.col(CORRUPT).isNotNull()
    return df.filter(~corrupt).drop(CORRUPT), df.filter(corrupt).select(CORRUPT)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def in_range(
    df: DataFrame, start: dt.date | str, end: dt.date | str, column: str = "event_date", undated: bool = False
) -> DataFrame:
    """Rows between two dates, both included; on a partition column Spark opens only those partitions.

    Rows without a date are in no range; with `undated` they come along, so that rules can reject them.
    """
    within = F.col(column).between(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"))
    return df.filter(within | F.col(column).isNull() if undated else within)


def read_range(
    spark: SparkSession, path: str, start: dt.date | str, end: dt.date | str, undated: bool = False
) -> DataFrame:
    return in_range(read_table(spark, path), start, end, undated=undated)
