"""Jaccard join of word-shingle sets by filters under several global token orders.

A document's set holds its distinct shingles of SHINGLE words (A-Z in lower case; a shorter text is one shingle, a text
without words has none). Documents link when their sets have a Jaccard similarity of at least 4/5. Results are exact:

1. An order of tokens is: frequency class first, then a hash that differs from order to order. Frequency classes come
   from a table of counters of fixed size over all documents; they decide how much work there is, never what is found.
   Similar sets share a token among the first n - ceil(0.8 n) + 1 tokens of each, in every order.
2. Documents with equal sets are one class; only the class's smallest id goes on.
3. Prefix tokens of order 0 are joined. In token groups of up to SMALL members all pairs become candidates. In larger
   ones each member becomes a candidate with the group's centre, the member with the most shared tokens; what that links
   is one component from then on.
4. Groups that still hold several components are compared inside tasks, block by block. A pair there shares a prefix token
   under order 0; it becomes a candidate if its prefixes under order 1 have enough tokens in common, and its bitmaps
   of hashed tokens differ in at most as many bits as similar sets may differ in tokens.
5. A candidate is verified on both whole texts, after the last filter: a common prefix token under order 2.

The number of common prefix tokens that a filter demands follows from the sizes: beyond the prefixes at most
max(ceil(0.8 n)) - 1 more tokens can be equal, and 9 * intersection >= 4 * (sum of sizes) must hold. Pairs that are
already connected are not looked for, so a group of copies gives one link per copy, not all pairs.

Null ids link with nothing and get a null component; rows with the same id are one node. Null and empty texts have no
set. An empty table gives no rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybank.llm.components import components
from tallybank.llm.rows import fresh_names, with_row_keys
from tallybank.llm.stored import remove, stored
from tallybank.llm.words import blocks, hash_words, mix, windows

SHINGLE = 5
SKETCH_BITS = 23
PIECES = 16
SMALL = 32
BLOCK_ROWS = 1024
SHORT_LIST = 1_000_000
MOST_COUNT = 0xFFFFFFF
_SEEDS = [np.uint64(0), np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)]


def shingle_set(words: np.ndarray) -> np.ndarray:
    """Sorted distinct shingle hashes of one text."""
    size = min(SHINGLE, len(words))
    if not size:
        return np.zeros(0, np.uint64)
    return np.unique(windows(words, size) + np.uint64(SHINGLE - size))


def sets_of(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    for block in blocks(column):
        words = hash_words(block, lower=True)
        for row, a, b in block.texts():
            yield row, shingle_set(words[a:b])


def prefix_length(n: int) -> int:
    return n - (4 * n + 4) // 5 + 1


def prefix(tokens: np.ndarray, classes: np.ndarray, order: int) -> np.ndarray:
    """The first tokens of a set under an order."""
    if not len(tokens):
        return tokens
    rank = mix(tokens ^ _SEEDS[order])
    # Stays a total order on tokens: the class takes the upper bits, the hash the lower ones, the token breaks ties.
    key = (classes[tokens >> np.uint64(64 - SKETCH_BITS)].astype(np.uint64) << np.uint64(58)) | (rank >> np.uint64(6))
    return tokens[np.lexsort((tokens, key))[: prefix_length(len(tokens))]]


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """100 * intersection >= 80 * union, for sets that are not empty."""
    if not len(a) or not len(b):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= 80 * (len(a) + len(b) - common)


def frequency_classes(docs: DataFrame) -> np.ndarray:
    """For each counter, 0 if its tokens are as frequent as usual, else how far beyond, in powers of two."""

    def packed(table: np.ndarray) -> Iterator[pa.RecordBatch]:
        for piece, part in enumerate(np.split(table, PIECES)):
            data = zlib.compress(np.minimum(part, MOST_COUNT).astype("<u4").tobytes(), 1)
            yield pa.record_batch({"piece": pa.array([piece], pa.int32()), "counts": pa.array([data], pa.binary())})

    def unpacked(data: bytes) -> np.ndarray:
        return np.frombuffer(zlib.decompress(data), "<u4")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in batches:
            for _, tokens in sets_of(batch.column(0)):
                np.add.at(table, tokens >> np.uint64(64 - SKETCH_BITS), np.uint32(1))
        yield from packed(table)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, data in zip(batch["piece"].to_pylist(), batch["counts"].to_pylist(), strict=True):
                part = unpacked(data)
                sums[piece] = np.minimum(sums.get(piece, np.zeros(len(part), np.uint64)) + part, MOST_COUNT)
        for piece, total in sums.items():
            data = zlib.compress(total.astype("<u4").tobytes(), 1)
            yield pa.record_batch({"piece": pa.array([piece], pa.int32()), "counts": pa.array([data], pa.binary())})

    schema = "piece int, counts binary"
    counted = docs.select("text").mapInArrow(count, schema).repartition(PIECES, "piece").mapInArrow(add, schema)
    table = np.zeros((PIECES, (1 << SKETCH_BITS) // PIECES), np.uint32)
    for row in counted.toLocalIterator():
        table[row["piece"]] = unpacked(row["counts"])
    usual = float(np.median(table))
    return np.maximum(0, np.ceil(np.log2((table.ravel() + 1.0) / (usual + 4 * usual**0.5 + 5)))).astype(np.uint8)


def document_sets(docs: DataFrame, classes: np.ndarray) -> DataFrame:
    """doc_id, set size, two hashes of the set, and its prefix tokens under order 0."""
    shared = docs.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (len(t), int(t.sum()), int(mix(t + np.uint64(1)).sum()), prefix(t, shared.value, 0).view(np.int64))
                for _, t in sets_of(batch.column(1))
            ]
            sizes, one, two, tokens = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.record_batch(
                {
                    "doc_id": batch.column(0),
                    "n": pa.array(sizes, pa.int64()),
                    "s1": np.array(one, np.uint64).view(np.int64),
                    "s2": np.array(two, np.uint64).view(np.int64),
                    "tokens": pa.array(tokens, pa.list_(pa.int64())),
                }
            )

    columns = docs.select(F.col("doc_id").cast("long"), "text")
    return columns.mapInArrow(run, "doc_id long, n long, s1 long, s2 long, tokens array<long>")


def sizes_fit(n: str, m: str) -> Column:
    return 5 * F.least(n, m) >= 4 * F.greatest(n, m)


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, text) of the documents named in `ids` (id); the list is broadcast only if it is short."""
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    wanted = ids.distinct()
    return texts.join(F.broadcast(wanted) if wanted.count() <= SHORT_LIST else wanted, "id", "left_semi")


def verified(candidates: DataFrame, docs: DataFrame, classes: np.ndarray) -> DataFrame:
    """The pairs (a, b) whose whole texts are similar. Texts are looked up by id, one document at a time."""
    shared = docs.sparkSession.sparkContext.broadcast(classes)
    texts = texts_of(docs, candidates.selectExpr("a id").union(candidates.selectExpr("b id")))
    first = candidates.join(texts.withColumnsRenamed({"id": "a", "text": "text_a"}), "a")
    both = first.join(texts.withColumnsRenamed({"id": "b", "text": "text_b"}), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = ([t for _, t in sets_of(batch[name])] for name in ("text_a", "text_b"))
            keep = [
                bool(np.isin(prefix(a, shared.value, 2), prefix(b, shared.value, 2)).any()) and similar(a, b)
                for a, b in zip(left, right, strict=True)
            ]
            yield pa.record_batch({name: batch[name] for name in ("a", "b")}).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def bitmap(tokens: np.ndarray) -> np.ndarray:
    """Bytes of a bitmap of at least 8 bits per token, a power of two, with the bits of the tokens' hashes set."""
    bits = np.zeros(max(256, 1 << int(8 * len(tokens) - 1).bit_length()), bool)
    bits[mix(tokens ^ _SEEDS[1]) % np.uint64(len(bits))] = True
    return np.packbits(bits)


def fold(bitmaps: np.ndarray, size: int) -> np.ndarray:
    """The bitmaps that `size` bytes would have given."""
    while bitmaps.shape[-1] > size:
        half = bitmaps.shape[-1] // 2
        bitmaps = bitmaps[..., :half] | bitmaps[..., half:]
    return bitmaps


class Filters:
    """Upper bounds of what the documents of one task group share."""

    def __init__(self, n: np.ndarray, prefixes: pa.Array, bitmaps: list[np.ndarray]):
        self.n, self.bitmaps = n, bitmaps
        self.sizes = np.array([len(x) for x in bitmaps])
        self.by_size = {size: np.flatnonzero(self.sizes == size) for size in np.unique(self.sizes).tolist()}
        self.stacked = {size: np.stack([bitmaps[i] for i in rows]) for size, rows in self.by_size.items()}
        values = prefixes.flatten().to_numpy()
        self.bounds = np.concatenate([[0], np.cumsum(np.diff(prefixes.offsets.to_numpy()))])
        order = np.argsort(values, kind="stable")
        self.docs = np.repeat(np.arange(len(n)), np.diff(self.bounds))[order]
        self.low, self.high = (np.searchsorted(values[order], values, side) for side in ("left", "right"))

    def common_prefix(self, x: int) -> np.ndarray:
        """Prefix tokens of order 1 that each document shares with document `x`."""
        a, b = self.bounds[x], self.bounds[x + 1]
        parts = [self.docs[low:high] for low, high in zip(self.low[a:b], self.high[a:b], strict=True)]
        return np.bincount(np.concatenate(parts), minlength=len(self.n))

    def differing_bits(self, x: int) -> np.ndarray:
        """At most as many as there are tokens in only one of the two sets."""
        out = np.zeros(len(self.n), np.int64)
        for size, rows in self.by_size.items():
            least = min(size, len(self.bitmaps[x]))
            differ = fold(self.stacked[size], least) ^ fold(self.bitmaps[x], least)
            out[rows] = np.bitwise_count(differ).sum(axis=1, dtype=np.int64)
        return out

    def possible(self, x: int) -> np.ndarray:
        """Whether each document can be similar to document `x`."""
        n, m = self.n, self.n[x]
        fits = 5 * np.minimum(n, m) >= 4 * np.maximum(n, m)
        beyond = np.maximum((4 * n + 4) // 5, (4 * m + 4) // 5) - 1
        fits &= self.common_prefix(x) >= np.maximum(1, -(-4 * (n + m) // 9) - beyond)
        return fits & (self.differing_bits(x) <= (n + m) // 9)


def with_filters(ids: DataFrame, docs: DataFrame, classes: np.ndarray) -> DataFrame:
    """Of the documents in `ids` (id), the prefix under order 1, in 32 bits per token, and the bitmap."""
    shared = docs.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [t for _, t in sets_of(batch["text"])]
            short = [(prefix(t, shared.value, 1) >> np.uint64(32)).astype(np.uint32).view(np.int32) for t in sets]
            yield pa.record_batch(
                {
                    "doc": batch["id"],
                    "order1": pa.array(short, pa.list_(pa.int32())),
                    "bits": pa.array([bitmap(t).tobytes() for t in sets], pa.binary()),
                }
            )

    return texts_of(docs, ids).mapInArrow(run, "doc long, order1 array<int>, bits binary")


def cross_candidates(groups: DataFrame) -> DataFrame:
    """Pairs of different components from large token groups, by filters inside tasks.

    A group is cut into blocks of about BLOCK_ROWS documents; each pair of blocks is one task group.
    """
    chunks = F.ceil(F.col("members") / BLOCK_ROWS).cast("int")
    rows = groups.withColumn("mine", F.pmod(F.xxhash64("doc"), chunks).cast("int"))
    spread = rows.withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1))).select(
        "token",
        F.least("mine", "other").alias("i"),
        F.greatest("mine", "other").alias("j"),
        *["mine", "doc", "n", "component", "order1", "bits"],
    )

    def compare(table: pa.Table) -> pa.Table:
        doc, n, part, mine = (table[c].to_numpy() for c in ("doc", "n", "component", "mine"))
        i, j = table["i"][0].as_py(), table["j"][0].as_py()
        bitmaps = [np.frombuffer(bits, np.uint8) for bits in table["bits"].to_pylist()]
        filters, pairs = Filters(n, table["order1"].combine_chunks(), bitmaps), [np.zeros((0, 2), np.int64)]
        for x in np.flatnonzero(mine == i):
            other = part != part[x]
            other &= (doc > doc[x]) if i == j else (mine == j)
            if other.any():
                y = doc[other & filters.possible(x)]
                pairs.append(np.column_stack([np.minimum(y, doc[x]), np.maximum(y, doc[x])]))
        found = np.concatenate(pairs)
        return pa.table({"a": found[:, 0], "b": found[:, 1]})

    return spread.groupBy("token", "i", "j").applyInArrow(compare, "a long, b long")


def join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    spark = docs.sparkSession
    classes = frequency_classes(docs)
    sets, _ = stored(document_sets(docs, classes), "shingle-sets")
    known = sets.filter("n > 0 and doc_id is not null")
    same = known.groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("first"))
    copies, copies_path = stored(
        known.select("doc_id", "n", "s1", "s2").join(same, ["n", "s1", "s2"]).select("doc_id", "first").distinct(),
        "shingle-copies",
    )
    # Only one representative of each class goes on.
    others = known.select("doc_id", "n", "s1", "s2").join(same, ["n", "s1", "s2"]).filter("doc_id <> first")
    others = others.select("doc_id", "s1", "s2").distinct()
    listed = F.broadcast(others) if others.count() <= SHORT_LIST else others
    alone = known.join(listed, ["doc_id", "s1", "s2"], "left_anti")
    tokens = alone.select(F.col("doc_id").alias("doc"), "n", F.explode("tokens").alias("token"))
    members = tokens.groupBy("token").agg(F.count("*").alias("members")).filter("members > 1")
    repeated, repeated_path = stored(tokens.join(members, "token"), "shingle-tokens")

    weight = repeated.groupBy("doc").agg(F.sum("members").alias("weight"))
    large = repeated.filter(F.col("members") > SMALL)
    centres = (
        large.join(weight, "doc")
        .groupBy("token")
        .agg(F.max(F.struct("weight", (-F.col("doc")).alias("doc"), "n")).alias("centre"))
        .select("token", (-F.col("centre.doc")).alias("centre"), F.col("centre.n").alias("centre_n"))
    )
    to_centre = (
        large.join(centres, "token")
        .filter((F.col("doc") != F.col("centre")) & sizes_fit("n", "centre_n"))
        .select(F.least("doc", "centre").alias("a"), F.greatest("doc", "centre").alias("b"))
    )
    candidates, candidates_path = stored(small_pairs(repeated).union(to_centre).distinct(), "shingle-candidates")
    links, links_path = stored(verified(candidates, docs, classes), "shingle-links")
    first_links = links.union(copies.select(F.col("first").alias("a"), F.col("doc_id").alias("b")))
    found, found_path = stored(components(first_links), "shingle-components")

    placed = large.join(found.withColumnRenamed("node", "doc"), "doc", "left")
    placed = placed.withColumn("component", F.coalesce("component", "doc"))
    # Groups with several components; of groups with the same documents, one.
    groups = placed.groupBy("token").agg(
        F.min("component").alias("x"),
        F.max("component").alias("y"),
        F.count("*").alias("size"),
        F.sum(F.xxhash64("doc").cast("decimal(20,0)")).alias("one"),
        F.sum(F.xxhash64("doc", F.lit(1)).cast("decimal(20,0)")).alias("two"),
    )
    mixed = groups.filter("x < y").groupBy("size", "one", "two").agg(F.min("token").alias("token")).select("token")
    open_groups, open_path = stored(placed.join(mixed, "token"), "shingle-open")
    filters = with_filters(open_groups.selectExpr("doc id"), docs, classes)
    crossing, crossing_path = stored(cross_candidates(open_groups.join(filters, "doc")).distinct(), "shingle-crossing")
    more, more_path = stored(verified(crossing, docs, classes), "shingle-more")
    merged, _ = stored(components(first_links.union(more)), "shingle-merged")
    remove(spark, [copies_path, repeated_path, candidates_path, links_path, found_path, open_path, crossing_path, more_path])
    placed_rows = sets.select("doc_id", F.col("n").alias("n_shingles"))
    result = placed_rows.join(merged.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    return result.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def without_copies(docs: DataFrame) -> DataFrame:
    """One row of each group of linked rows: the one with the smallest doc_id. Null ids and texts without words stay.

    Rows are judged by their own texts: of rows with the same id only those go whose own text is linked to that of a row
    that stays. Of rows with the same id and the same text, the first by all columns stays.
    """
    key, linked_key, place = fresh_names(docs, "row_key", "linked_key", "row_place")
    keyed, unique = with_row_keys(docs, key)
    keyed = keyed if unique else stored(keyed, "shingle-rows")[0]
    given = keyed.select(F.col(key).alias("doc_id"), "text")
    joined, _ = stored(join(given if unique else given.dropDuplicates(["doc_id"])), "shingle-groups")
    linked = joined.filter("doc_id <> component_id").select(F.col("doc_id").alias(linked_key)).distinct()
    listed = F.broadcast(linked) if linked.count() <= SHORT_LIST else linked
    kept = keyed.join(listed, F.col(key) == F.col(linked_key), "left_anti")
    if not unique:
        first = Window.partitionBy(key).orderBy(*[F.col(f"`{c}`").asc_nulls_first() for c in docs.columns])
        once = kept.filter(F.col(key).isNotNull()).withColumn(place, F.row_number().over(first))
        kept = once.filter(F.col(place) == 1).drop(place).unionByName(kept.filter(F.col(key).isNull()))
    return kept.drop(key)


def small_pairs(repeated: DataFrame) -> DataFrame:
    """Pairs of documents that share a token group of up to SMALL members, if enough of their prefixes can be equal.

    Tokens in larger groups are not counted here, so they count as possibly equal.
    """
    large = repeated.groupBy("doc").agg(F.count_if(F.col("members") > SMALL).alias("large"))
    small = repeated.filter(F.col("members") <= SMALL).select("token", "doc", "n")
    left, right = (small.withColumnsRenamed({"doc": d, "n": n}) for d, n in (("a", "na"), ("b", "nb")))
    pairs = left.join(right, "token").filter((F.col("a") < F.col("b")) & sizes_fit("na", "nb"))
    counted = pairs.groupBy("a", "b", "na", "nb").agg(F.count("*").alias("common"))
    possible = (
        counted.join(large.withColumnsRenamed({"doc": "a", "large": "la"}), "a")
        .join(large.withColumnsRenamed({"doc": "b", "large": "lb"}), "b")
        .withColumn("possible", F.col("common") + F.least("la", "lb"))
    )
    wanted = F.ceil(4 * (F.col("na") + F.col("nb")) / 9)
    beyond = F.greatest(F.ceil(4 * F.col("na") / 5), F.ceil(4 * F.col("nb") / 5)) - 1
    return possible.filter(F.col("possible") >= F.greatest(F.lit(1), wanted - beyond)).select("a", "b")
