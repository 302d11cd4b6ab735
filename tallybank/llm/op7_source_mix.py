"""Mixing sources to target weights by weighted fair queueing.

The budget is `share` times all words. Sources in code point order, null last, weigh as `weights` repeats. A source's
target is its part of the budget by weight, but at most `repeats` times its size; what that leaves over is dealt again by
weight until no source is above its limit. Documents of a source are shuffled by a hash of their id and queue up
`repeats` times. A document's virtual finish time is the number of words of its source up to and including it, divided by
the source's weight. All documents of all sources are range-sorted by finish time, and the mix takes whole documents
while the running total is within the budget. So each source ends within about one document of its target.

Running totals never gather a source or the table in one task: a source is cut into chunks of the shuffle order and the
global order into range partitions; totals of chunks and of partitions are added before the rows inside them.
Equal finish times go by source, shuffle key, doc_id and size. Repeated rows count each. Null and empty texts have size
0 and take nothing. An empty table gives no rows. Only doc_id, text and source are read.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybank.llm.rows import fresh_names
from tallybank.llm.stored import stored

WEIGHTS = (3, 1, 2)
SHARE = Fraction(3, 2)
REPEATS = 2
CHUNK_ROWS = 50_000
KEY_DIGITS = 15


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def shuffle_key(doc_id: str) -> Column:
    """The first 60 bits of the md5 of the id as text; -1 for null."""
    digest = F.substring(F.md5(F.col(doc_id).cast("string").cast("binary")), 1, KEY_DIGITS)
    return F.coalesce(F.conv(digest, 16, 10).cast("long"), F.lit(-1).cast("long"))


def running_totals(df: DataFrame, order: list[Column], sums: dict[str, str], name: str) -> DataFrame:
    """Add inclusive running totals of columns in a global order, as {new column: column}.

    Rows are range-partitioned and stored; the one window without a key sees one row per partition.
    """
    ranged = df.repartitionByRange(*order).withColumn("range_part", F.spark_partition_id())
    parts, _ = stored(ranged, name)
    before = Window.orderBy("range_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = parts.groupBy("range_part").agg(*[F.sum(column).alias(f"{new}_sum") for new, column in sums.items()])
    earlier = totals.select(
        "range_part", *[F.coalesce(F.sum(f"{new}_sum").over(before), F.lit(0)).alias(f"{new}_before") for new in sums]
    )
    inside = Window.partitionBy("range_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    within = parts.select("*", *[F.sum(column).over(inside).alias(f"{new}_inside") for new, column in sums.items()])
    added = within.join(earlier, "range_part")
    return added.withColumns({new: F.col(f"{new}_inside") + F.col(f"{new}_before") for new in sums}).select(
        *df.columns, *sums
    )


def source_targets(sized: DataFrame) -> tuple[DataFrame, float]:
    """(source, sid, source_size, n_docs, weight, target) per source, and the budget in words."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    ranked = running_totals(
        sources.withColumn("one", F.lit(1)), [F.col("source").asc_nulls_last()], {"sid": "one"}, "mix-sources"
    )
    cycle = F.array(*[F.lit(w).cast("long") for w in WEIGHTS])
    weighed = ranked.withColumn("weight", F.element_at(cycle, ((F.col("sid") - 1) % len(WEIGHTS) + 1).cast("int")))
    weighed = weighed.withColumn("limit", F.col("source_size") * REPEATS)
    filled = running_totals(
        weighed, [F.col("limit") / F.col("weight"), F.col("sid")], {"limits": "limit", "weights": "weight"}, "mix-limits"
    )
    whole = filled.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    budget, weight = float(SHARE * (whole["size"] or 0)), whole["weight"] or 0
    # A source is full if all sources after it in order of limit per weight can reach its level within the budget.
    others = F.lit(weight) - F.col("weights") + F.col("weight")
    full = F.col("limit") * others <= F.col("weight") * (F.lit(budget) - F.col("limits") + F.col("limit"))
    marked = filled.withColumn("full", full)
    used = marked.filter("full").agg(F.sum("limit").alias("limit"), F.sum("weight").alias("weight")).first()
    left = weight - (used["weight"] or 0)
    level = (budget - (used["limit"] or 0)) / left if left else 0.0
    target = F.when(F.col("full"), F.col("limit").cast("double")).otherwise(F.col("weight") * F.lit(level))
    return marked.withColumn("target", target).select(
        "source", "sid", "source_size", "n_docs", "weight", "target"
    ), budget


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target and the words taken of each row, and its number of `copies`."""
    sized, _ = stored(
        docs.select(
            F.col("doc_id").cast("long"),
            "source",
            n_words("text").alias("size"),
            shuffle_key("doc_id").alias("key"),
            F.xxhash64("text", "source").alias("mix_row"),
            F.monotonically_increasing_id().alias("rid"),
        ),
        "mix-sizes",
    )
    targets, budget = source_targets(sized)
    named = targets.withColumnRenamed("source", "target_source")
    same = F.col("source").eqNullSafe(F.col("target_source"))
    chunk = F.floor(F.greatest("key", F.lit(0)) / F.lit(16**KEY_DIGITS) * F.ceil(F.col("n_docs") / CHUNK_ROWS))
    queued, _ = stored(sized.join(named, same).drop("target_source").withColumn("chunk", chunk), "mix-queue")
    chunks = queued.groupBy("sid", "chunk").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("sid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = chunks.select("sid", "chunk", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("sid", "chunk").orderBy("key", "doc_id", "size", "rid")
    reached = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    ordered = queued.withColumn("reached", reached).join(starts, ["sid", "chunk"])
    turns = ordered.filter("size > 0").withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(REPEATS - 1))))
    finish = (F.col("turn") * F.col("source_size") + F.col("before") + F.col("reached")) / F.col("weight")
    items = turns.select("rid", "sid", "key", "doc_id", "size", finish.alias("finish"))
    order = [F.col(c) for c in ("finish", "sid", "key", "doc_id", "size", "rid")]
    taken = running_totals(items, order, {"total": "size"}, "mix-order").filter(F.col("total") <= budget)
    copies = taken.groupBy("rid").agg(F.count("*").alias("copies"))
    return (
        queued.join(copies, "rid", "left")
        .withColumn("copies", F.coalesce("copies", F.lit(0)))
        .withColumn("taken", F.col("copies") * F.col("size"))
        .select("doc_id", "source", "size", "source_size", "target", "taken", "copies", "mix_row")
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows that the mix takes, each as often as it is taken, with the columns of `docs`.

    `docs` is read twice. Rows meet their decision again by id, text and source; equal rows are numbered, as any of them
    can stand for another.
    """
    row, id_, number, turn, copies = fresh_names(docs, "mix_row", "mix_id", "mix_number", "mix_turn", "mix_copies")
    numbered = Window.partitionBy(id_, row).orderBy(F.lit(0))
    rows = docs.withColumns({row: F.xxhash64("text", "source"), id_: F.coalesce(F.col("doc_id").cast("long"), F.lit(-1))})
    rows = rows.withColumn(number, F.row_number().over(numbered))
    chosen = mix(docs).filter("copies > 0").select(
        F.coalesce("doc_id", F.lit(-1)).alias(id_), F.col("mix_row").alias(row), F.col("copies").alias(copies)
    )
    chosen = chosen.withColumn(number, F.row_number().over(numbered))
    found = rows.join(chosen, [id_, row, number])
    return found.withColumn(turn, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies)))).select(*docs.columns)
