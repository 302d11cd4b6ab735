"""Risk bucket of a transaction, as a native expression and in two UDF forms for comparison."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Bucket limits and names.
CRITICAL_ABOVE = 5000
HIGH_ABOVE = 1000
HIGH_TYPE = "Transfer"
MEDIUM_ABOVE = 500


def risk_bucket(type_col: str = "transaction_type", amount_col: str = "amount") -> Column:
    kind, amount = F.col(type_col), F.col(amount_col)
    return (
        F.when(kind.isNull() | amount.isNull() | F.isnan(amount), "UNKNOWN")
        .when(amount > CRITICAL_ABOVE, "CRITICAL")
        .when((amount > HIGH_ABOVE) & (kind == HIGH_TYPE), "HIGH")
        .when(amount > MEDIUM_ABOVE, "MEDIUM")
        .otherwise("LOW")
    )


@F.udf(StringType())
def risk_bucket_udf(kind, amount):
    if kind is None or amount is None or amount != amount:
        return "UNKNOWN"
    if amount > CRITICAL_ABOVE:
        return "CRITICAL"
    if amount > HIGH_ABOVE and kind == HIGH_TYPE:
        return "HIGH"
    return "MEDIUM" if amount > MEDIUM_ABOVE else "LOW"


@F.pandas_udf(StringType())
def risk_bucket_pandas_udf(kind: pd.Series, amount: pd.Series) -> pd.Series:
    buckets = np.select(
        [
            kind.isna() | amount.isna(),
            amount > CRITICAL_ABOVE,
            (amount > HIGH_ABOVE) & (kind == HIGH_TYPE),
            amount > MEDIUM_ABOVE,
        ],
        ["UNKNOWN", "CRITICAL", "HIGH", "MEDIUM"],
        default="LOW",
    )
    return pd.Series(buckets, index=amount.index)
