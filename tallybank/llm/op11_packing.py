"""Pack documents into as few sequences of a fixed number of tokens as a grouping genetic algorithm finds.

A document's ids, with an end id, are one piece if they fit; longer ones are cut into pieces of the whole capacity, of
which the first may be shorter. Pieces of the whole capacity are sequences of their own. All others are dealt by a hash
into shards of about `SHARD` pieces, and each shard is packed by `ISLANDS` islands, which are Spark groups of their own.

An individual is an assignment of a shard's pieces to sequences. Crossover takes whole well-filled sequences of one parent
into the other; the sequences there which hold any of their pieces are dissolved, and the pieces that this displaces go by
best fit, longest first, into what is open. Mutation dissolves the worst and a few other sequences in the same way. After
each epoch an island's best individual migrates to the next island through a shuffle. A shard's result is the best of its
islands: fewest sequences, then the largest sum of squared fills.

Sequences that are not well filled are taken apart again and their pieces packed anew in fewer shards, until one shard is
left or half of the pieces or more come back. So all shards together waste little more than one.

Shards are of equal expected size whatever the ids, texts or lengths are, since they follow the number of a piece in a
written table; seeds follow shard, island and epoch, so a repeated task finds the same. Rows: null texts are empty and
have the end id alone; a null doc_id is a document like any other; repeated rows are packed each. An empty table gives no
rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybank.llm.byte_ids import ByteEncoder
from tallybank.llm.rows import fresh_names
from tallybank.llm.stored import remove, stored
from tallybank.llm.words import text_bytes

CAPACITY = 1024
SHARD = 16_000
ISLANDS = 4
EPOCHS = 3
POPULATION = 4
CHILDREN = 8
WELL = 0.99
SHARD_BITS, LEVEL_BITS = 24, 57  # of a sequence id: number in the shard below, shard, level

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """PIECES of every document, with the column `ids` if asked for."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ByteEncoder.of(tokenizer)
        end = np.uint32(end_id).tobytes()
        for batch in batches:
            data, at = text_bytes(batch.column(1))
            rows: list[tuple] = []
            ids: list[np.ndarray] = []
            for row, (a, b) in enumerate(zip(at, at[1:], strict=False)):
                packed = encoder.encode(data[a:b].tobytes()) + end
                n = len(packed) // 4
                first = (n - 1) % capacity + 1
                for k, to in enumerate(range(first, n + 1, capacity)):
                    begin = max(0, to - capacity) if k else 0
                    part = packed[4 * begin : 4 * to]
                    rows.append((row, k, begin, to - begin, zlib.crc32(part)))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int32))
            if not rows:
                continue
            row, k, begin, length, crc = (np.array(c, np.int64) for c in zip(*rows, strict=True))
            columns = [batch.column(0).take(pa.array(row)), pa.array(k.astype(np.int32)), *map(pa.array, (begin, length, crc))]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.record_batch(columns, names)
        encoder.forget()

    schema = f"{PIECES}, ids array<int>" if with_ids else PIECES
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, schema)


class OpenBins:
    """Sequences by free space; `fit` takes the one with the least space that suffices, else a new one."""

    def __init__(self, fills: list[int], capacity: int):
        self.fills, self.capacity = fills, capacity
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.some = 0
        for number, fill in enumerate(fills):
            if fill < capacity:
                self._open(number, capacity - fill)

    def _open(self, number: int, free: int) -> None:
        self.by_free[free].append(number)
        self.some |= 1 << free

    def fit(self, length: int) -> int:
        enough = self.some >> length
        if enough:
            free = length + (enough & -enough).bit_length() - 1
            number = self.by_free[free].pop()
            if not self.by_free[free]:
                self.some ^= 1 << free
        else:
            free, number = self.capacity, len(self.fills)
            self.fills.append(0)
        self.fills[number] += length
        if free > length:
            self._open(number, free - length)
        return number


def place(lengths: np.ndarray, genes: np.ndarray, loose: np.ndarray, capacity: int) -> np.ndarray:
    """Best fit, in the given order, of loose pieces into the sequences of all others (`genes`; -1 for loose)."""
    fixed = genes >= 0
    numbers, genes[fixed] = np.unique(genes[fixed], return_inverse=True)
    fills = np.bincount(genes[fixed], lengths[fixed], len(numbers)).astype(np.int64).tolist()
    bins = OpenBins(fills, capacity)
    genes[loose] = [bins.fit(length) for length in lengths[loose].tolist()]
    return genes


def fills_of(lengths: np.ndarray, genes: np.ndarray) -> np.ndarray:
    return np.bincount(genes, lengths).astype(np.int64)


def rank_of(lengths: np.ndarray, genes: np.ndarray, capacity: int) -> tuple[int, float]:
    """Smaller is better: sequences, then how unevenly they are filled."""
    fills = fills_of(lengths, genes)
    return len(fills), -float(((fills / capacity) ** 2).sum())


def least_sequences(lengths: np.ndarray, capacity: int) -> int:
    """A lower bound. Two pieces of over half the capacity never meet; for each k, pieces of over capacity - k take no
    piece of k or more, and what the other long ones leave free must hold all pieces from k to half the capacity."""
    counts = np.bincount(lengths, minlength=capacity + 1)
    held, tokens = np.cumsum(counts), np.cumsum(counts * np.arange(capacity + 1))
    half, k = capacity // 2, np.arange(1, capacity // 2 + 1)
    long = held[-1] - held[half]
    free = (held[capacity - k] - held[half]) * capacity - (tokens[capacity - k] - tokens[half])
    rest = np.maximum(tokens[half] - tokens[k - 1] - free, 0)
    return int(long + (-(-rest // capacity)).max(initial=0))


def longest_first(lengths: np.ndarray, which: np.ndarray, draw: np.random.Generator, noise: float = 0.0) -> np.ndarray:
    weight = lengths[which] * (1 + noise * draw.random(len(which)))
    return which[np.argsort(-weight, kind="stable")]


def seeded(lengths: np.ndarray, noise: float, draw: np.random.Generator, capacity: int) -> np.ndarray:
    """Best fit decreasing, with noise in the order."""
    every = np.arange(len(lengths))
    return place(lengths, np.full(len(lengths), -1), longest_first(lengths, every, draw, noise), capacity)


def crossover(lengths: np.ndarray, mother: np.ndarray, father: np.ndarray, draw: np.random.Generator, capacity: int) -> np.ndarray:
    """Half of the father's well-filled sequences, whole; the mother's that share no piece with them; the rest by best fit."""
    fills = fills_of(lengths, father)
    chosen = (fills >= WELL * capacity) & (draw.random(len(fills)) < 0.5)
    injected = chosen[father]
    broken = np.zeros(mother.max() + 1, bool)
    broken[mother[injected]] = True
    child = np.where(broken[mother], -1, mother + len(fills))
    child[injected] = father[injected]
    return place(lengths, child, longest_first(lengths, np.flatnonzero(child < 0), draw), capacity)


def mutate(lengths: np.ndarray, genes: np.ndarray, draw: np.random.Generator, capacity: int) -> np.ndarray:
    """Dissolve the worst sequences and as many others."""
    fills = fills_of(lengths, genes)
    some = max(2, len(fills) // 50)
    gone = np.zeros(len(fills), bool)
    gone[np.argsort(fills, kind="stable")[:some]] = True
    gone[draw.integers(0, len(fills), some)] = True
    child = np.where(gone[genes], -1, genes)
    return place(lengths, child, longest_first(lengths, np.flatnonzero(child < 0), draw, 0.1), capacity)


def evolve(lengths: np.ndarray, population: list[np.ndarray], seed: list[int], capacity: int) -> list[np.ndarray]:
    """One epoch of an island: the population after it, the best first. Ends early when no packing can be better."""
    draw = np.random.default_rng(seed)
    least = least_sequences(lengths, capacity)
    while len(population) < POPULATION:
        population.append(seeded(lengths, 0.0 if not population else 0.3 * draw.random(), draw, capacity))
    ranked = sorted(((rank_of(lengths, g, capacity), k) for k, g in enumerate(population)))
    population = [population[k] for _, k in ranked][:POPULATION]
    ranks = [rank for rank, _ in ranked][:POPULATION]
    for _ in range(CHILDREN):
        if ranks[0][0] <= least:
            break
        a, b = draw.choice(len(population), 2, replace=False)
        child = crossover(lengths, population[a], population[b], draw, capacity)
        if draw.random() < 0.5:
            child = mutate(lengths, child, draw, capacity)
        rank = rank_of(lengths, child, capacity)
        if rank < ranks[-1] and rank not in ranks:
            at = sum(r < rank for r in ranks)
            population = [*population[:at], child, *population[at:-1]]
            ranks = [*ranks[:at], rank, *ranks[at:-1]]
    return population


def offsets_of(lengths: np.ndarray, genes: np.ndarray) -> np.ndarray:
    """Place of each piece in its sequence, without gaps."""
    order = np.argsort(genes, kind="stable")
    ends = np.cumsum(lengths[order])
    begins = ends - lengths[order]
    first = np.flatnonzero(np.diff(genes[order], prepend=-1))
    base = np.repeat(begins[first], np.diff(np.append(first, len(order))))
    out = np.empty(len(genes), np.int64)
    out[order] = begins - base
    return out


STATE = (
    "shard long, island int, lengths array<int>, population array<array<int>>, "
    "sequences int, score double, offsets array<int>, fills array<int>"
)
_INTS = pa.list_(pa.int32())
STATE_ARROW = pa.schema(
    [("shard", pa.int64()), ("island", pa.int32()), ("lengths", _INTS), ("population", pa.list_(_INTS))]
    + [("sequences", pa.int32()), ("score", pa.float64()), ("offsets", _INTS), ("fills", _INTS)]
)


def island_epoch(epoch: int, capacity: int):
    """For applyInArrow: the rows of one island, its own (with lengths) and the migrant's, to its state after an epoch."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        shard, island = key[0].as_py(), key[1].as_py()
        own, guests = None, []
        for k in range(rows.num_rows):
            genes = rows["population"][k]
            found = [np.asarray(g.values, np.int64) for g in genes] if genes.is_valid else []
            if rows["lengths"][k].is_valid:
                lengths, own = np.asarray(rows["lengths"][k].values, np.int64), found
            else:
                guests += found
        population = evolve(lengths, own + guests, [shard, island, epoch], capacity)
        best = population[0]
        sequences, score = rank_of(lengths, best, capacity)
        state = {
            "shard": shard,
            "island": island,
            "lengths": lengths.astype(np.int32),
            "population": [g.astype(np.int32) for g in population],
            "sequences": sequences,
            "score": score,
            "offsets": offsets_of(lengths, best).astype(np.int32),
            "fills": fills_of(lengths, best)[best].astype(np.int32),
        }
        return pa.Table.from_pylist([state], STATE_ARROW)

    return run


def pack_level(items: DataFrame, shards: int, capacity: int) -> DataFrame:
    """(item, length, shard, number, offset, fill) of all items (item, length): packed in that many shards."""
    spark = items.sparkSession
    shard = F.pmod(F.xxhash64("item"), F.lit(shards)).alias("shard")
    gathered = items.groupBy(shard).agg(F.sort_array(F.collect_list(F.struct("item", "length"))).alias("items"))
    dealt, _ = stored(gathered, "packing-shards")
    island = F.explode(F.array(*[F.lit(k) for k in range(ISLANDS)])).alias("island")
    none = F.lit(None).cast("array<array<int>>").alias("population")
    lengths = F.transform("items", lambda i: i["length"].cast("int")).alias("lengths")
    now, path = dealt.select("shard", island, lengths, none), None
    for epoch in range(EPOCHS):
        groups = now.groupBy("shard", "island").applyInArrow(island_epoch(epoch, capacity), STATE)
        state, written = stored(groups, f"packing-epoch-{epoch}")
        if path:
            remove(spark, [path])
        path = written
        elite = F.slice("population", 1, 1).alias("population")
        to_next = ((F.col("island") + 1) % ISLANDS).cast("int").alias("island")
        guests = state.select("shard", to_next, F.lit(None).cast("array<int>").alias("lengths"), elite)
        now = state.select("shard", "island", "lengths", "population").unionByName(guests)
    best = state.groupBy("shard").agg(
        F.min_by(
            F.struct(F.col("population")[0].alias("numbers"), "offsets", "fills"), F.struct("sequences", "score", "island")
        ).alias("best")
    )
    rows = F.arrays_zip("items", "best.numbers", "best.offsets", "best.fills")
    each = dealt.join(best, "shard").select("shard", F.explode(rows).alias("row"))
    return each.select(
        "row.items.item",
        "row.items.length",
        "shard",
        F.col("row.numbers").cast("long").alias("number"),
        F.col("row.offsets").cast("long").alias("offset"),
        F.col("row.fills").alias("fill"),
    )


def pack(cut: DataFrame, capacity: int = CAPACITY, shard_size: int = SHARD) -> DataFrame:
    """All columns of `cut` (with `length`, 1 to capacity), `sequence_id` and `offset`; columns of these names are replaced."""
    cut = cut.drop("sequence_id", "offset")
    key, other = fresh_names(cut, "item", "placed")
    rows, _ = stored(cut.withColumn(key, F.monotonically_increasing_id()), "packing-pieces")
    items = rows.filter(F.col("length") < capacity).select(F.col(key).alias("item"), F.col("length").cast("long"))
    placed, level = None, 0
    count = items.count()
    while count:
        shards = -(-count // shard_size)
        packed, _ = stored(pack_level(items, shards, capacity), f"packing-level-{level}")
        poor = F.col("fill") < WELL * capacity
        back = packed.filter(poor).count() if shards > 1 else 0
        done = packed if not 0 < 2 * back < count else packed.filter(~poor)
        number = F.lit(level << LEVEL_BITS) + F.shiftleft("shard", SHARD_BITS) + F.col("number")
        here = done.select("item", number.alias("sequence_id"), "offset")
        placed = here if placed is None else placed.unionByName(here)
        if not 0 < 2 * back < count:
            break
        items, count, level = packed.filter(poor).select("item", "length"), back, level + 1
    item = F.col(key)
    whole = rows.filter(F.col("length") >= capacity)
    out = whole.select(*cut.columns, (-1 - item).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    if placed is None:
        return out
    short = rows.filter(F.col("length") < capacity).join(placed.withColumnRenamed("item", other), F.col(key) == F.col(other))
    return out.unionByName(short.select(*cut.columns, "sequence_id", "offset"))

