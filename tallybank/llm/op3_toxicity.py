"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are its distinct words, word pairs and pairs with one word between them, in lower case, hashed to
2**BITS weights. Punctuation around a word is dropped. FTRL-proximal learns with a rate per weight; its L1 term leaves
most weights at exactly zero, so the model is a short list of weights that fits any broadcast: at most 2**BITS entries.

Labels are learned from at most `most` rows (parameter), in `epochs` passes by one task over rows that hold at most
MOST_FEATURES features each; longer texts are cut into several training rows of the same label, never shortened. All
texts are scored whole. Null and empty texts get the score of the intercept. An untrainable table (no labels, or one
class only) gives the share of toxic labels, or 0, as every score. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tallybank.llm.words import LOWER, Block, blocks, hash_words, mix

BITS = 18
MOST_FEATURES = 4096
MOST_ROWS = 12_000


@dataclass
class Weights:
    """Sorted places of the weights that are not zero, and the intercept."""

    places: np.ndarray
    values: np.ndarray
    intercept: float


_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def bare_words(block: Block) -> np.ndarray:
    """Hashes of the words in lower case without ASCII punctuation at either end."""
    inside = _LETTER[block.data]
    before = np.concatenate([[0], np.cumsum(inside)])
    letters = np.flatnonzero(inside)
    some = before[block.end] > before[block.start]
    start, end = block.start.copy(), block.end.copy()
    start[some] = letters[before[block.start[some]]]
    end[some] = letters[before[block.end[some]] - 1] + 1
    return hash_words(Block(block.first, block.data, block.bounds, start, end), lower=True)


def features(words: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Distinct places of the words, neighbours and skip pairs of one text."""
    shift = np.uint64(64 - bits)
    pairs = [mix(words[:-k] * np.uint64(2 * k + 1) + words[k:] * np.uint64(31)) for k in (1, 2) if len(words) > k]
    return np.unique(np.concatenate([words, *pairs]) >> shift).astype(np.int64)


def extract(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    for block in blocks(column):
        words = bare_words(block)
        for row, a, b in block.texts():
            yield row, features(words[a:b])


class Ftrl:
    """Follow the regularised leader, with one learning rate per weight."""

    def __init__(self, size: int, alpha: float, beta: float, l1: float, l2: float):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(at == len(self.z) - 1, 0.0, self.l1)
        step = -(z - np.sign(z) * l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= l1, 0.0, step)

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        gradient = float(sigmoid(w.sum())) - label
        sigma = (np.sqrt(self.n[at] + gradient * gradient) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += gradient - sigma * w
        self.n[at] += gradient * gradient


def sigmoid(x: np.ndarray | float) -> np.ndarray:
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(-np.asarray(x, float)))


def train(
    texts: DataFrame, epochs: int = 4, alpha: float = 1.0, beta: float = 1.0, l1: float = 6.0, l2: float = 0.0
) -> Weights:
    """Fit on (doc_id, text, label). Features are made where the rows are; one task takes the bounded rows in id order.

    `l1` exceeds the number of epochs, and each gradient is below 1, so a feature of one text only never gets a weight.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, at in extract(batch.column(1)):
                for k in range(0, len(at), MOST_FEATURES):
                    part = at[k : k + MOST_FEATURES].astype(np.int32)
                    yield pa.record_batch(
                        {
                            "doc_id": batch.column(0).slice(row, 1),
                            "part": pa.array([k], pa.int32()),
                            "label": batch.column(2).slice(row, 1),
                            "places": pa.array([part], pa.list_(pa.int32())),
                        }
                    )

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, labels = [], []
        for batch in batches:
            rows += [places.values.to_numpy().astype(np.int32) for places in batch["places"]]
            labels += batch["label"].to_pylist()
        if not labels:
            return
        model, last, order = Ftrl(1 << BITS, alpha, beta, l1, l2), np.array([1 << BITS]), np.random.default_rng(7)
        for _ in range(epochs if 0 < sum(labels) < len(labels) else 0):
            for i in order.permutation(len(rows)):
                model.learn(np.concatenate([rows[i], last]), labels[i])
        values = model.weights(np.arange((1 << BITS) + 1))
        places = np.flatnonzero(values[:-1])
        share = sum(labels) / len(labels)
        intercept = values[-1] if 0 < share < 1 else np.log((share + 1e-9) / (1 - share + 1e-9))
        yield pa.record_batch(
            {"place": np.append(places, -1).astype(np.int32), "value": np.append(values[places], intercept)}
        )

    examples = texts.select("doc_id", "text", "label").mapInArrow(
        hashed, "doc_id long, part int, label int, places array<int>"
    )
    model = (
        examples.repartition(1).sortWithinPartitions("doc_id", "part").mapInArrow(fit, "place int, value double")
    ).toArrow()
    places, values = model["place"].to_numpy(), model["value"].to_numpy()
    real = places >= 0
    return Weights(places[real], values[real], float(values[~real][0]) if len(values) else -np.inf)


def score(docs: DataFrame, weights: Weights, name: str = "score") -> DataFrame:
    """All columns of `docs`, and the probability of toxicity of each whole text as column `name`."""
    shared, at = docs.sparkSession.sparkContext.broadcast(weights), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        dense = np.zeros(1 << BITS)
        dense[model.places] = model.values
        for batch in batches:
            total = np.full(batch.num_rows, model.intercept)
            for row, places in extract(batch.column(at)):
                total[row] += dense[places].sum()
            yield pa.record_batch([*batch.columns, pa.array(sigmoid(total))], names=[*batch.schema.names, name])

    fields = StructType([*docs.schema.fields, StructField(name, DoubleType())])
    return docs.mapInArrow(run, fields)


def without_toxic(docs: DataFrame, weights: Weights, least: float = 0.5) -> DataFrame:
    """The rows of `docs` whose score is below `least`."""
    name = "_".join(["toxic", *docs.columns])
    return score(docs, weights, name).filter(F.col(f"`{name}`") < least).drop(name)
