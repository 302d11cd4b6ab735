"""Packing: the parts of the search, ids against the library, and whole placements."""

from __future__ import annotations

import random
import zlib
from types import SimpleNamespace

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallybank.llm import op11_packing as packing
from tallybank.llm.byte_ids import ByteEncoder
from tallybank.llm.queries import QUERIES
from tests.conftest import SMALL

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
TEXTS = [
    "", " ", "a", " a", "a ", "a  b", "a   b c", "a\nb", "a \nb", "a\n b", "a.\n\nb c\n", "\n\n a", "tab\t tab", "it's 's 12ab x2 'll",
    "a  b", "a  b", "　x 　 y", "你好 世界 a", "é ü\x1c x", "x\x85 y", "q<|endoftext|> r <|endoftext|>s", "Ω word ɐ ɏ ÿ",
    "A" * 500 + " " + "b" * 300 + " c", "é ́ z", "🙂 🙂🙂 a🙂", "!!! ... a,b;c -- --", "\r\n x \r\ny", "x\x0b y \x0c z",
]


def test_ids_equal_the_library():
    library = Tokenizer.from_file(TOKENIZER)
    encoder = ByteEncoder(TOKENIZER)
    draw = random.Random(1)
    glue = ["", " ", "  ", "\n", " \n", "\n ", "\t", " ", "."]
    texts = TEXTS + ["".join(draw.choice(TEXTS) + draw.choice(glue) for _ in range(draw.randint(1, 6))) for _ in range(1500)]
    for text in texts:
        assert np.frombuffer(encoder.encode(text.encode()), np.uint32).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def optimum(lengths, capacity):
    """The least number of sequences, by trying every placement."""
    best = [len(lengths)]

    def go(k, fills):
        if len(fills) >= best[0]:
            return
        if k == len(lengths):
            best[0] = len(fills)
            return
        for i in range(len(fills)):
            if fills[i] + lengths[k] <= capacity:
                go(k + 1, [*fills[:i], fills[i] + lengths[k], *fills[i + 1 :]])
        go(k + 1, [*fills, lengths[k]])

    go(0, [])
    return best[0]


def test_search_on_small_shards_is_optimal_and_bounded():
    draw = random.Random(2)
    for _ in range(60):
        lengths = np.array([draw.randint(1, 19) for _ in range(draw.randint(1, 9))])
        best = optimum(lengths.tolist(), 20)
        assert packing.least_sequences(lengths, 20) <= best
        population = []
        for epoch in range(6):
            population = packing.evolve(lengths, population, [epoch], 20)
        assert packing.rank_of(lengths, population[0], 20)[0] == best


def test_crossover_keeps_whole_sequences_of_both():
    draw = np.random.default_rng(3)
    lengths = draw.integers(1, 100, 400)
    mother, father = (packing.seeded(lengths, 0.5, draw, 128) for _ in range(2))
    child = packing.crossover(lengths, mother, father, draw, 128)
    assert packing.fills_of(lengths, child).max() <= 128 and packing.fills_of(lengths, child).min() > 0

    def groups(genes):
        return {frozenset(np.flatnonzero(genes == k)) for k in range(genes.max() + 1)}

    kept = groups(child)
    assert kept & groups(father) and kept & groups(mother)


def test_crossover_and_epochs_improve_a_poor_start():
    draw = np.random.default_rng(4)
    first = draw.integers(20, 80, 60)
    lengths = np.concatenate([first, 100 - first, draw.integers(20, 50, 40)])
    poor = packing.place(lengths, np.full(len(lengths), -1), np.arange(len(lengths)), 100)
    population = [poor, packing.place(lengths, np.full(len(lengths), -1), np.arange(len(lengths))[::-1], 100)]
    for epoch in range(4):
        population = packing.evolve(lengths, population, [epoch], 100)
    assert packing.rank_of(lengths, population[0], 100)[0] < packing.rank_of(lengths, poor, 100)[0]


def check_placement(rows, texts, capacity):
    """rows: (doc_id, piece, start, length, crc, sequence, offset); texts by doc_id."""
    library = Tokenizer.from_file(TOKENIZER)
    by_doc, by_sequence = {}, {}
    for doc_id, piece, start, length, crc, sequence, offset in rows:
        by_doc.setdefault(doc_id, []).append((piece, start, length, crc))
        by_sequence.setdefault(sequence, []).append((offset, length))
    assert by_doc.keys() == texts.keys()
    for doc_id, text in texts.items():
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        cut = sorted(by_doc[doc_id])
        assert [c[0] for c in cut] == list(range(-(-len(ids) // capacity)))
        assert all(c[2] == capacity for c in cut[1:])
        at = 0
        for _, start, length, crc in cut:
            assert (start, crc) == (at, zlib.crc32(ids[at : at + length].tobytes()))
            at += length
        assert at == len(ids)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def placed(frame):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return [tuple(r) for r in frame.select(*columns).collect()]


def test_many_shards_levels_and_islands(spark):
    draw = random.Random(5)
    texts = {i: " ".join(draw.choices(["alpha", "be", "gamma", "x", "."], k=draw.randint(0, 120))) for i in range(400)}
    docs = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string")
    cut = packing.pieces(docs, TOKENIZER, 2, capacity=64)
    rows = placed(packing.pack(cut, capacity=64, shard_size=60))
    sequences = check_placement(rows, texts, 64)
    lengths = np.array([r[3] for r in rows])
    # Shards of 60 pieces waste more than those of 16,000.
    assert sequences <= 1.03 * (np.sum(lengths == 64) + packing.least_sequences(lengths[lengths < 64], 64)) + 1
    levels = {r[5] >> packing.LEVEL_BITS for r in rows if r[5] >= 0}
    assert len(levels) > 1


def test_awkward_rows(spark):
    texts = dict(enumerate(["", None, " \n", "x", "x", "w " * 30_000, "A" * 5_000, "é 你好"]))
    docs = spark.createDataFrame([(i, t, "en", None, 0) for i, t in texts.items()], DOCS)
    for column in ("item", "shard", "length", "offset", "sequence_id", "piece"):
        docs = docs.withColumn(column, F.lit("mine"))
    check_placement(placed(packing.pack(packing.pieces(docs, TOKENIZER, 2))), texts, 1024)
    nothing = packing.pack(packing.pieces(docs.limit(0), TOKENIZER, 2))
    assert placed(nothing) == []
    again = docs.limit(1).union(docs.limit(1)).withColumn("doc_id", F.lit(None).cast("long"))
    assert [r[:4] for r in placed(packing.pack(packing.pieces(again, TOKENIZER, 2)))] == [(None, 0, 0, 1)] * 2


def test_pieces_with_ids_and_clashing_names(spark):
    docs = spark.createDataFrame([(1, "one two three four five"), (2, "six")], "doc_id long, text string")
    cut = packing.pieces(docs, TOKENIZER, 2, capacity=4, with_ids=True).withColumn("item", F.lit("mine"))
    rows = packing.pack(cut, capacity=4).collect()
    assert {r["item"] for r in rows} == {"mine"}
    ids = [i for r in sorted((r for r in rows if r.doc_id == 1), key=lambda r: r.piece) for i in r.ids]
    assert ids == [*Tokenizer.from_file(TOKENIZER).encode("one two three four five").ids, 2]


def test_query(spark):
    found = QUERIES["op11_packing"](spark, SMALL)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()}
    rows = placed(found)
    sequences = check_placement(rows, texts, 1024)
    tokens = sum(r[3] for r in rows)
    assert sequences <= 1.02 * -(-tokens // 1024) + 2


def test_words_of_a_long_task_are_encoded_once():
    encoder, made = ByteEncoder(TOKENIZER), []
    encoder.tokenize = lambda shown: made.append(shown) or [SimpleNamespace(id=1)]
    words = ["x" + "".join(chr(97 + k // 26**n % 26) for n in range(5)) for k in range(600_000)]
    texts = [" ".join(words[a : a + 1000]).encode() for a in range(0, len(words), 1000)]
    for text in texts:
        encoder.encode(text)
    once = len(made)
    for text in texts:
        encoder.encode(text)
    assert 590_000 < once < 610_000 and len(made) - once <= 2 * len(texts)


def test_letters_with_marks_have_the_librarys_ids():
    encoder, library = ByteEncoder(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    text = "It's the dogs' end. ABC!? a--b x.'s _a_ don't. (word) word, Word; I'll 's '' <|endoftext|>x a<| b|> é, né. n\u0303o end"
    for _ in range(2):
        assert np.frombuffer(encoder.encode(text.encode()), np.uint32).tolist() == library.encode(text, add_special_tokens=False).ids
