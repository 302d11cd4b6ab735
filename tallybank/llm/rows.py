"""Names that no column of a table has, and rows told apart where their ids do not."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybank.llm.ranks import ranked


def fresh_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores as it takes that no column has it, whatever the case of its letters."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def with_row_keys(docs: DataFrame, key: str) -> tuple[DataFrame, bool]:
    """`docs` with a whole number `key` per different (doc_id, text), null where doc_id is, and whether that is doc_id.

    Where every id occurs once, it is. Otherwise keys are numbered in the order of doc_id and then of the text's hash,
    so the smallest key of some rows belongs to the smallest doc_id; equal rows share a key.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("id")).filter("id is not null")
    if ids.groupBy("id").count().filter("count > 1").isEmpty():
        return docs.withColumn(key, F.col("doc_id").cast("long")), True
    (hashed,) = fresh_names(docs, "text_hash")
    marked = docs.withColumn(hashed, F.coalesce(F.sha2(F.col("text").cast("binary"), 256), F.lit("null")))
    different = marked.select(F.col("doc_id").cast("long").alias("id"), F.col(hashed).alias("hash"))
    different = different.filter("id is not null").distinct().withColumn("all", F.lit(0))
    numbers = ranked(different, ["all"], [F.col("id"), F.col("hash")], "row-keys")
    id_, hash_ = fresh_names(marked, "key_id", "key_hash")
    numbers = numbers.select(F.col("id").alias(id_), F.col("hash").alias(hash_), F.col("rank").alias(key))
    same = (F.col("doc_id").cast("long") == F.col(id_)) & (F.col(hashed) == F.col(hash_))
    return marked.join(numbers, same, "left").drop(id_, hash_, hashed), False
