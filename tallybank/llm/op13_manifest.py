"""A Merkle manifest of a documents table, and the proof of each row against its root.

Leaf: H (lowercase hex sha256) of doc_id, source, lang, n_chars and text, each `-` if null, else its UTF-8 byte count, `:`
and its value. The leaves of a source ascend by doc_id; runs of `FAN` consecutive nodes become their H, level by level,
until one node is left, the subroot. Subroots in the order of their sources give the root in the same way.

What is kept is a content-addressed graph: one record per inner node, digest to children. A request for a leaf starts at
the root and descends by the digits of its rank; the children it does not select are the siblings of that level. Requests
that share a way descend as one row until they part, so a proof of every leaf reads each record once. A path is collected
from the root down and reversed at the end.

Only DataFrame functions are used. A source of any size is spread over tasks: ranks come from one range shuffle, runs and
digests spread evenly. Levels are written tables, as many as the logarithm of the largest source.

Rows: a null doc_id comes first and is never tampered with; a null source is a source of its own, before all others. Rows
with the same doc_id are ordered by their leaf, so their order does not matter to the result; equal rows get equal digests
and each its own proof. An empty text counts 0 bytes, unlike null. An empty table gives no rows. Other columns are not
read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybank.llm.ranks import ranked
from tallybank.llm.stored import stored

FAN = 3
HEX = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEP = "array<struct<digit:int,siblings:string>>"


@dataclass
class Tree:
    """`roots`: (group, digest, height, leaves). `levels[k]`: records (digest, children) of the nodes at height k + 1.

    A child has its digest; the children of the lowest level, and the `lone` leaves that are roots themselves, also have
    the leaf's payload.
    """

    roots: DataFrame
    levels: list[DataFrame]
    lone: DataFrame


def digest_of(fields: list[Column]) -> Column:
    """H of values with their lengths."""
    parts = []
    for field in fields:
        text = field.cast("string")
        sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(sized, F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """(doc_id, source, leaf, offered) of each row: its leaf, and that of the row as it is offered for verification.

    Rows where `tampered` holds are offered without the \\n characters of their texts.
    """
    row = docs.select(*FIELDS)
    fields = [F.col(c) for c in FIELDS]
    line = F.lit("\n")
    cut = [*fields[:-1], F.replace(F.col("text"), line, F.lit(""))]
    touched = F.col("text").contains(line) & (F.lit(False) if tampered is None else tampered)
    return row.select(
        "doc_id",
        "source",
        digest_of(fields).alias("leaf"),
        F.when(touched, digest_of(cut)).alias("changed"),
    ).select("doc_id", "source", "leaf", F.coalesce("changed", "leaf").alias("offered"))


def build(nodes: DataFrame, payload: list[str]) -> Tree:
    """The trees of `nodes` (group, rank, n, digest and payload columns), one per group."""
    spark = nodes.sparkSession
    most = nodes.agg(F.max("n")).first()[0] or 0
    kept = [F.col(c) for c in payload]
    lone = nodes.filter("n = 1").select("digest", F.struct(*kept).alias("payload")).dropDuplicates(["digest"])
    found = nodes.filter("n = 1").select("group", "digest", F.lit(0).alias("height"), F.col("n").alias("leaves"))
    levels, at, height = [], nodes.withColumn("leaves", F.col("n")), 0
    child = F.struct(F.col("rank").alias("place"), "digest", F.struct(*kept).alias("payload"))
    while most > 1:
        height, most = height + 1, -(-most // FAN)
        runs = (
            at.filter("n > 1")
            .groupBy("group", F.expr(f"rank div {FAN}").alias("rank"))
            .agg(
                F.sort_array(F.collect_list(child)).alias("children"),
                F.expr(f"(max(n) + {FAN - 1}) div {FAN}").alias("n"),
                F.max("leaves").alias("leaves"),
            )
        )
        inner = F.concat_ws("", F.transform("children", lambda c: c["digest"]))
        at, _ = stored(runs.withColumn("digest", F.sha2(inner, 256)), f"manifest-{height}")
        levels.append(at.select("digest", "children"))
        found = found.unionByName(at.filter("n = 1").select("group", "digest", F.lit(height).alias("height"), "leaves"))
        child = F.struct(F.col("rank").alias("place"), "digest")
    roots, _ = stored(found, "manifest-roots") if levels else (found, None)
    return Tree(roots, levels, lone)


def descend(requests: DataFrame, tree: Tree, carried: list[str], wanted: DataFrame | None = None) -> DataFrame:
    """Follow the requests (digest of a root, its height, path so far, carried columns) down to the leaves of `tree`.

    Returns the carried columns, payload, digest, rank within the tree, and the path with a step per level: the digit,
    which is the place among the run's children, and the siblings in order. With `wanted` (carried columns and rank) only
    the requests for those leaves go on.
    """
    columns = [*carried, "digest", "rank", "path"]
    starts = requests.withColumn("rank", F.lit(0).cast("long"))
    at = None
    for height in range(len(tree.levels), 0, -1):
        here = starts.filter(F.col("height") == height).select(*columns)
        at = here if at is None else at.unionByName(here)
        records = tree.levels[height - 1].dropDuplicates(["digest"])
        parted = at.join(records, "digest").select(
            *carried, "rank", "path", "children", F.posexplode("children").alias("digit", "child")
        )
        others = F.filter("children", lambda c, i: i != F.col("digit"))
        step = F.struct("digit", F.concat_ws("", F.transform(others, lambda c: c["digest"])).alias("siblings"))
        payload = [F.col("child.payload").alias("payload")] if height == 1 else []
        at = parted.select(
            *carried,
            F.col("child.digest").alias("digest"),
            (F.col("rank") * FAN + F.col("digit")).alias("rank"),
            F.concat("path", F.array(step)).alias("path"),
            *payload,
        )
        if wanted is not None:
            prefix = F.expr(f"rank div {FAN ** (height - 1)}").alias("rank")
            at = _among(at, wanted.select(*carried, prefix).distinct(), [*carried, "rank"])
    alone = starts.filter("height = 0").select(*columns).join(tree.lone, "digest").select(*columns, "payload")
    if wanted is not None:
        alone = _among(alone, wanted, [*carried, "rank"])
    return alone if at is None else at.unionByName(alone)


def _among(rows: DataFrame, others: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys, nulls included, occur in `others`."""
    others = others.select(*[F.col(k).alias(f"other_{k}") for k in keys])
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"other_{k}"))
    return rows.join(others, same, "left_semi")


def folded(leaf: Column, upwards: Column) -> Column:
    """The root that a leaf and the steps of its path give."""

    def parent(digest: Column, step: Column) -> Column:
        left = step["digit"] * HEX
        before, after = F.substr(step["siblings"], F.lit(1), left), F.substr(step["siblings"], left + 1)
        return F.sha2(F.concat(before, digest, after), 256)

    return F.aggregate(upwards, leaf, parent)


def manifest(leaf_rows: DataFrame) -> tuple[Tree, Tree]:
    """The tree of each source, and the tree over the sources, of what `leaves` gives."""
    order = [F.col(c).asc_nulls_first() for c in ("doc_id", "leaf", "offered")]
    placed = ranked(leaf_rows, ["source"], order, "manifest-leaves")
    nodes, _ = stored(placed.select("*", F.col("source").alias("group"), F.col("leaf").alias("digest")), "manifest-nodes")
    sources = build(nodes, ["doc_id", "offered"])
    one = sources.roots.select(F.col("group").alias("source"), F.col("digest").alias("subroot"), "height", "leaves")
    in_order = ranked(one.withColumn("group", F.lit(0)), ["group"], [F.col("source").asc_nulls_first()], "manifest-sources")
    top = build(in_order.withColumn("digest", F.col("subroot")), ["source", "height"])
    return sources, top


def prove(sources: Tree, top: Tree, wanted: DataFrame | None = None) -> DataFrame:
    """One row per leaf, or per leaf in `wanted` (source, rank): doc_id, source, leaf, offered, subroot, root and the path."""
    empty = F.array().cast(STEP).alias("path")
    from_root = top.roots.select(F.col("digest").alias("root"), "digest", "height", empty)
    subroots = descend(from_root, top, ["root"]).select(
        "root", F.col("digest").alias("subroot"), "digest", "payload.source", "payload.height", "path"
    )
    written, _ = stored(subroots, "manifest-subroots")
    if wanted is not None:
        tops = written.select("root", "subroot", F.col("source").alias("of"))
        wanted = wanted.join(tops, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    found = descend(written, sources, ["root", "subroot", "source"], wanted)
    return found.select(
        "payload.doc_id", "source", "rank", F.col("digest").alias("leaf"), "payload.offered", "subroot", "root", "path"
    )


def verified(proofs: DataFrame) -> DataFrame:
    """The checksum of each proof, the root that the offered row gives with it, and whether that is the root."""
    upwards = F.reverse("path")
    siblings = F.concat_ws("", F.transform(upwards, lambda step: step["siblings"]))
    return (
        proofs.withColumn("proof_sha256", F.sha2(siblings, 256))
        .withColumn("folded_root", folded(F.col("offered"), upwards))
        .withColumn("verified", F.col("folded_root") == F.col("root"))
    )
