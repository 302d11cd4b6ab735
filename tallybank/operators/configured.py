"""Column changes described by a config: add, then rename, then drop."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load_config(spark: SparkSession, path: str) -> dict[str, Any]:
    """A small JSON config from any path Spark can read."""
    text = spark.read.text(path, wholetext=True).first()
    return json.loads(text.value) if text else {}


def apply_config(df: DataFrame, entity: str, config: dict[str, Any]) -> DataFrame:
    """Apply `config["transformations"][entity]`; any missing part is skipped.

    add_columns: list of {name, expr}, in order, so a later expression may use an earlier column.
    rename_columns: {old: new}. drop_columns: list of names.
    """
    rules = config.get("transformations", {}).get(entity, {})
    for column in rules.get("add_columns", []):
        df = df.withColumn(column["name"], F.expr(column["expr"]))
    return df.withColumnsRenamed(rules.get("rename_columns", {})).drop(*rules.get("drop_columns", []))
