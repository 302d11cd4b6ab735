"""Rows whose labels a model may learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of the id written as text, modulo `parts`; null ids are in fold -1, so no test fold has them."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts, F.lit(-1))


def labelled(docs: DataFrame, labels: DataFrame, label: str, parts: int, held: int, most: int) -> DataFrame:
    """(doc_id, text, label 0/1) of at most `most` labelled rows outside the held-out fold.

    The rows are those with the smallest hash of the id, so that the choice does not depend on the order of the input.
    Null labels, null ids and texts without content teach nothing; an id labelled twice counts once, by its larger label.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .filter(F.col("label").isin(0, 1) & (fold("doc_id", parts) != held) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    texts = docs.select("doc_id", "text").filter(F.length("text") > 0)
    return texts.join(F.broadcast(chosen), "doc_id")
