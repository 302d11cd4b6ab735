"""Quality by random-indexing word vectors, pooled per document, and a two-layer numpy network.

Every word, and every word's shape (letters by case, digits, other signs, runs shortened), is a unit. A unit is hashed
to one of UNITS rows. Each row has a fixed sparse random index vector; a row's context vector is the sum of the index
vectors of the units around all its occurrences in all texts. Tasks add up their own part of this table of fixed size,
so the shuffle has one table per task, cut into pieces, and the result is small enough to broadcast.

A document is the mean of its units' normalised vectors over all occurrences and over distinct units, with its length
and its share of distinct units. The network (one hidden layer) learns from at most `most` labelled rows; one part of
them is kept back to fit the temperature that calibrates its probabilities. Null and empty texts have the zero vector and
are scored like any other. With no labels, or labels of one class only, every score is the share of label 1 (0.5 for
none). Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybank.llm.folds import fold
from tallybank.llm.words import Block, blocks, hash_words, mix

WORD_BITS, SHAPE_BITS, DIMENSIONS, NONZERO = 14, 11, 32, 4
UNITS = (1 << WORD_BITS) + (1 << SHAPE_BITS)
REACH = 2
PIECES = 16
MOST_ROWS = 12_000

_CLASS = np.arange(256, dtype=np.uint8)
for low, high in ("az", "AZ", "09"):
    _CLASS[ord(low) : ord(high) + 1] = ord(low)
_CLASS[0x80:] = ord("a")


def shape_block(block: Block) -> Block:
    """The same words, each as its shape: runs of the same class of byte become one byte."""
    kind = _CLASS[block.data]
    keep = np.ones(len(kind), bool)
    keep[1:] = kind[1:] != kind[:-1]
    keep[block.start] = True
    before = np.concatenate([[0], np.cumsum(keep)])
    return Block(block.first, kind[keep], before[block.bounds], before[block.start], before[block.end])


def units_of(block: Block) -> np.ndarray:
    """Row of each word and of its shape, in turn."""
    out = np.empty(2 * len(block.start), np.int64)
    out[0::2] = hash_words(block) >> np.uint64(64 - WORD_BITS)
    out[1::2] = (hash_words(shape_block(block)) >> np.uint64(64 - SHAPE_BITS)).astype(np.int64) + (1 << WORD_BITS)
    return out


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Of each row, the places and signs of its index vector. A pure function of the row number."""
    draw = mix(np.arange(UNITS * NONZERO, dtype=np.uint64) + np.uint64(1)).reshape(UNITS, NONZERO)
    return (draw % np.uint64(DIMENSIONS)).astype(np.int64), np.where(draw >> np.uint64(63), 1.0, -1.0)


def add_contexts(table: np.ndarray, block: Block, places: np.ndarray, signs: np.ndarray) -> None:
    """Add the index vectors of the units up to REACH away; contexts do not cross texts."""
    units, text = units_of(block), np.repeat(np.arange(len(block.bounds) - 1), 2 * np.diff(block.word_bounds))
    for away in range(1, REACH + 1):
        near = text[away:] == text[:-away]
        left, right = units[:-away][near], units[away:][near]
        for one, other in ((left, right), (right, left)):
            for k in range(NONZERO):
                at = one * DIMENSIONS + places[other, k]
                table += np.bincount(at, weights=signs[other, k], minlength=table.size)


def context_vectors(docs: DataFrame) -> np.ndarray:
    """The normalised vector of each unit, from all texts."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors()
        table = np.zeros(UNITS * DIMENSIONS)
        for batch in batches:
            for block in blocks(batch.column(0)):
                add_contexts(table, block, places, signs)
        yield packed(table)

    def packed(table: np.ndarray) -> pa.RecordBatch:
        parts = [zlib.compress(part.astype("<i8").tobytes(), 1) for part in np.split(table, PIECES)]
        return pa.record_batch({"piece": np.arange(PIECES, dtype=np.int32), "sums": pa.array(parts, pa.binary())})

    def unpacked(sums: bytes) -> np.ndarray:
        return np.frombuffer(zlib.decompress(sums), "<i8")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, sums in zip(batch["piece"].to_pylist(), batch["sums"].to_pylist(), strict=True):
                totals[piece] = totals.get(piece, 0) + unpacked(sums)
        for piece, total in totals.items():
            yield pa.record_batch(
                {
                    "piece": pa.array([piece], pa.int32()),
                    "sums": pa.array([zlib.compress(total.astype("<i8").tobytes(), 1)], pa.binary()),
                }
            )

    schema = "piece int, sums binary"
    tables = docs.select("text").mapInArrow(sums, schema)
    added = tables.repartition(PIECES, "piece").mapInArrow(add, schema).toArrow()
    total = {p: 0 for p in range(PIECES)}
    for piece, sums in zip(added["piece"].to_pylist(), added["sums"].to_pylist(), strict=True):
        total[piece] = total[piece] + unpacked(sums)
    size = UNITS * DIMENSIONS // PIECES
    table = np.concatenate([total[p] + np.zeros(size) for p in range(PIECES)]).reshape(UNITS, DIMENSIONS)
    norm = np.linalg.norm(table, axis=1, keepdims=True)
    unit = table / np.where(norm > 0, norm, 1)
    used = norm[:, 0] > 0
    return np.where(used[:, None], unit - unit[used].mean(axis=0) if used.any() else unit, 0).astype(np.float32)


FEATURES = 4 * DIMENSIONS + 2


def pool(block: Block, vectors: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Row and features of each text: means of word and shape vectors, over occurrences and over distinct units."""
    units = units_of(block)
    for row, a, b in block.texts():
        out = np.zeros(FEATURES, np.float32)
        if b > a:
            parts, distinct = [], 0
            for kind in (units[2 * a : 2 * b : 2], units[2 * a + 1 : 2 * b : 2]):
                once, count = np.unique(kind, return_counts=True)
                rows = vectors[once]
                parts += [count @ rows / len(kind), rows.mean(axis=0)]
                distinct = distinct or len(once)
            out[: 4 * DIMENSIONS] = np.concatenate(parts)
            out[-2:] = np.log1p(b - a), distinct / (b - a)
        yield row, out


@dataclass
class Network:
    """Scaling of the features, two layers, and the temperature."""

    mean: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.maximum((x - self.mean) / self.scale @ w1 + b1, 0) @ w2[:, 0] + b2[0]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -500, 500)))


def fit(x: np.ndarray, y: np.ndarray, kept_back: np.ndarray, hidden: int = 32, epochs: int = 60) -> Network:
    """Adam on the logistic loss; rows of `kept_back` fit the temperature only."""
    draw = np.random.default_rng(11)
    net = Network(
        x.mean(axis=0) if len(x) else np.zeros(x.shape[1]),
        x.std(axis=0) + 1e-6 if len(x) else np.ones(x.shape[1]),
        [
            draw.normal(0, (2 / x.shape[1]) ** 0.5, (x.shape[1], hidden)),
            np.zeros(hidden),
            draw.normal(0, (1 / hidden) ** 0.5, (hidden, 1)),
            np.zeros(1),
        ],
    )
    share = y.mean() if len(y) else 0.5
    if not len(y) or not 0 < share < 1:
        net.layers[2][:] = 0
        net.layers[3][0] = np.log((share + 1e-6) / (1 - share + 1e-6))
        return net
    both_kinds = len(np.unique(y[~kept_back])) == 2
    learn = np.flatnonzero(~kept_back) if both_kinds else np.arange(len(y))
    z, moments, step = (x - net.mean) / net.scale, [[np.zeros_like(w) for w in net.layers] for _ in "mv"], 0
    for _ in range(epochs):
        order = draw.permutation(learn)
        for at in range(0, len(order), 128):
            rows = order[at : at + 128]
            w1, b1, w2, b2 = net.layers
            inner = np.maximum(z[rows] @ w1 + b1, 0)
            error = (1 / (1 + np.exp(-np.clip(inner @ w2 + b2, -500, 500))) - y[rows, None]) / len(rows)
            back = (error @ w2.T) * (inner > 0)
            gradients = [z[rows].T @ back + 1e-4 * w1, back.sum(axis=0), inner.T @ error + 1e-4 * w2, error.sum(axis=0)]
            step += 1
            for w, g, m, v in zip(net.layers, gradients, *moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= 0.003 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    if kept_back.any():
        logits, seen = net.logits(x[kept_back]), y[kept_back]
        tried = np.geomspace(0.25, 16, 61)
        losses = [np.logaddexp(0, np.where(seen == 1, -logits, logits) / t).mean() for t in tried]
        net.temperature = float(tried[int(np.argmin(losses))])
    return net


def features_of(texts: DataFrame, vectors: np.ndarray, columns: dict[str, str]) -> DataFrame:
    """`columns` of the texts and their pooled features."""
    shared = texts.sparkSession.sparkContext.broadcast(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.zeros((batch.num_rows, FEATURES), np.float32)
            for block in blocks(batch["text"]):
                for row, out in pool(block, shared.value):
                    x[row] = out
            lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), FEATURES).cast(pa.list_(pa.float32()))
            yield pa.record_batch({name: batch[name] for name in columns} | {"features": lists})

    schema = ", ".join(f"{name} {kind}" for name, kind in columns.items()) + ", features array<float>"
    return texts.select(*columns, "text").mapInArrow(run, schema)


def train(texts: DataFrame, vectors: np.ndarray) -> Network:
    """Fit on the bounded rows of (doc_id, text, label); every fifth by the hash of the id is kept back."""
    kept = texts.withColumn("kept_back", (fold("doc_id", 25) % 5 == 1).cast("int"))
    rows = features_of(kept, vectors, {"doc_id": "long", "label": "int", "kept_back": "int"}).toArrow().sort_by("doc_id")
    x = rows["features"].combine_chunks().flatten().to_numpy().reshape(-1, FEATURES).astype(float)
    return fit(x, rows["label"].to_numpy().astype(float), rows["kept_back"].to_numpy() == 1)


def score(docs: DataFrame, vectors: np.ndarray, network: Network) -> DataFrame:
    """doc_id and the calibrated probability of label 1 for each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast((vectors, network))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, net = shared.value
        for batch in batches:
            x = np.zeros((batch.num_rows, FEATURES))
            for block in blocks(batch["text"]):
                for row, out in pool(block, known):
                    x[row] = out
            yield pa.record_batch({"doc_id": batch["doc_id"], "score": net.probability(x)})

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")
