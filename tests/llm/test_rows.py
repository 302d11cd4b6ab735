"""Rows that share an id, clashing names, models without labels, and plain forms of some models."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallybank.llm import folds, op2_quality_model, op4_pieces, op7_source_mix, op8_passages, op9_language, op10_ngram_join
from tallybank.llm.rows import fresh_names, with_row_keys
from tests.llm.test_operators import DOCS, PIECE, sentences


def docs_of(spark, *rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS)


def test_rows_with_one_id_are_judged_by_their_texts(spark):
    a, b, c, d, e = sentences(21, 5, size=60)
    docs = docs_of(spark, (1, a, "x"), (2, b, "x"), (2, a, "x"), (3, c, "x"), (3, d, "x"), (4, e, "z"), (4, e, "y"), (5, None, "x"), (5, None, "x"), (5, "", "x"), (None, a, "x"))
    kept = sorted(((r.doc_id, r.text, r.source) for r in op10_ngram_join.without_copies(docs).collect()), key=repr)
    assert kept == sorted(
        [(1, a, "x"), (2, b, "x"), (3, c, "x"), (3, d, "x"), (4, e, "y"), (5, None, "x"), (5, "", "x"), (None, a, "x")], key=repr
    )


def test_passages_are_cut_from_their_own_rows_only(spark):
    p, a, b, c = sentences(22, 4, size=120)
    docs = docs_of(spark, (1, f"{a} {p}", "x"), (2, f"{b} {p}", "x"), (2, c, "x"), (2, c, "y"), (None, p, "x"))
    found = op8_passages.passages(docs).collect()
    # The same text under the same id twice is one document; of two rows with a passage the one with the smaller id is first.
    assert [(r.doc_id, r.start_word, r.n_words, r.first_id) for r in found] == [(2, 120, 120, 1)]
    rest = sorted(((r.doc_id, r.text) for r in op8_passages.without_passages(docs).collect()), key=repr)
    assert rest == sorted([(1, f"{a} {p}"), (2, b + " "), (2, c), (2, c), (None, p)], key=repr) or rest == sorted(
        [(1, f"{a} {p}"), (2, b), (2, c), (2, c), (None, p)], key=repr
    )


CLASHES = ["mix_row", "mix_id", "mix_number", "mix_turn", "mix_copies", "copies", "taken", "spans", "span_id", "span_key"]
CLASHES += ["row_key", "linked_id", "linked_key", "row_place", "text_hash", "key_id", "key_hash", "id", "component_id", "rank"]


@pytest.mark.parametrize("repeated", [False, True])
def test_columns_of_any_name_come_back_as_they_were(spark, repeated):
    texts = sentences(23, 6, size=60)
    rows = [(i, t, f"s{i % 2}") for i, t in enumerate([*texts, texts[0]])]
    docs = docs_of(spark, *rows, *([(0, texts[3], "s0")] if repeated else []))
    docs = docs.withColumns({name: F.concat(F.lit(f"{name} "), "source") for name in CLASHES})
    stages = (op7_source_mix.mixed_documents, op8_passages.without_passages, op10_ngram_join.without_copies)
    for stage in stages:
        done = stage(docs)
        assert done.columns == docs.columns
        out = done.collect()
        assert out and all(r[name] == f"{name} {r.source}" for r in out for name in CLASHES)


def test_row_keys(spark):
    docs = docs_of(spark, (5, "a", "x"), (3, "b", "x"), (None, "c", "x"))
    keyed, unique = with_row_keys(docs, "k")
    assert unique and {(r.doc_id, r.k) for r in keyed.collect()} == {(5, 5), (3, 3), (None, None)}
    keyed, unique = with_row_keys(docs.union(docs_of(spark, (3, "a", "x"), (3, "b", "y"))), "k")
    keys = {(r.doc_id, r.text): r.k for r in keyed.collect()}
    assert not unique and keys[(None, "c")] is None and keyed.count() == 5
    assert max(keys[(3, "a")], keys[(3, "b")]) < keys[(5, "a")] == 2
    assert fresh_names(docs, "TEXT", "k", "k") == ["TEXT_", "k", "k_"]


@pytest.mark.filterwarnings("error::RuntimeWarning")
def test_scores_without_labels_are_probabilities(spark):
    docs = docs_of(spark, *[(i, t, "x") for i, t in enumerate(["", "a b", *sentences(24, 5)])])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    vectors = op2_quality_model.context_vectors(docs)
    for known in (labels, spark.createDataFrame([(2, 1, 0)], labels.schema), spark.createDataFrame([(2, 1, 0), (3, 0, 0)], labels.schema)):
        net = op2_quality_model.train(folds.labelled(docs, known, "quality", 5, 0, 10), vectors)
        scores = [r.score for r in op2_quality_model.score(docs, vectors, net).collect()]
        assert len(scores) == 7 and all(0 <= s <= 1 for s in scores)
        if not known.count():
            assert scores == pytest.approx([0.5] * 7)


def test_round_trips_known_by_segment_equal_decoding(spark):
    pieces = op4_pieces.Pieces.of(PIECE)
    texts = ["", " ", "a", " a  b ", "a▁b", "▁", "é́ 你好 🙂", "x\ny\t z", "\x00", "A" * 300, *sentences(25, 3)]
    for text in texts:
        ids, same = pieces.encode_checked(text)
        assert ids.tolist() == pieces.encode(text).tolist()
        assert same == (pieces.decode(ids.tolist()) == text), repr(text)
    scores = {"▁": -1.0, "a": -2.0, "b": -3.0, "?": -4.0}
    lossy = op4_pieces.Pieces(scores, {p: i for i, p in enumerate(scores)}, [3] * 256, False)
    for text in ("a b", "a é b", "b"):
        ids, same = lossy.encode_checked(text)
        assert same == (lossy.decode(ids.tolist()) == text) == ("é" not in text)


def plain_backoff(train, texts):
    """Dictionary form: log frequencies of known words, else of the longest n-grams that any language knows."""
    words, grams = defaultdict(Counter), defaultdict(Counter)
    for lang, text in train:
        words[lang].update(op9_language.words_of(text))
    for lang, counter in words.items():
        for word, n in counter.items():
            for size in range(1, op9_language.LONGEST + 1):
                for at in range(len(word) + 3 - size):
                    grams[lang, size][f" {word} "[at : at + size]] += n
    langs = sorted(words)
    totals = {(lang, size): sum((words[lang] if not size else grams[lang, size]).values()) for lang in langs for size in range(6)}

    def add(lang, size, key):
        n = (words[lang] if not size else grams[lang, size])[key]
        return math.log((n + 0.5) / (totals[lang, size] + 1))

    out = []
    for text in texts:
        found = op9_language.words_of(text or "")
        if not found:
            out.append(("und", 0.0))
            continue
        scores = dict.fromkeys(langs, 0.0)
        for word in found:
            if any(word in words[lang] for lang in langs):
                for lang in langs:
                    scores[lang] += add(lang, 0, word)
                continue
            for size in range(op9_language.LONGEST, 0, -1):
                known = [f" {word} "[at : at + size] for at in range(len(word) + 3 - size)]
                known = [g for g in known if any(g in grams[lang, size] for lang in langs)]
                if known:
                    for lang in langs:
                        scores[lang] += sum(add(lang, size, g) for g in known) / len(known)
                    break
        best = max(scores.values())
        total = sum(math.exp((s - best) / len(found) ** 0.5) for s in scores.values())
        out.append((next(lang for lang in langs if scores[lang] == best), 1 / total))
    return out


@pytest.mark.parametrize("shared", [0, 20, 100_000])
def test_language_equals_a_dictionary_form(spark, shared):
    draw = random.Random(26)
    letters = {"aa": "abcdefgh", "bb": "ghijklmn", "cc": "mnopqrsa"}
    word = lambda lang: "".join(draw.choices(letters[lang], k=draw.randint(1, 7)))
    train = [(lang, " ".join(word(lang) for _ in range(30))) for lang in letters for _ in range(6)]
    texts = [" ".join(word(draw.choice(list(letters))) for _ in range(draw.randint(0, 12))) for _ in range(60)]
    texts += [None, "", "123", "zzzz yyyy", train[0][1], "a" * 90]
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(train)], "doc_id long, text string, lang string")
    counted = op9_language.count_words(docs).cache()
    model = op9_language.learn(counted, words=shared)
    given = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: (r.lang_pred, r.score) for r in op9_language.predict(given, model).collect()}
    for i, (lang, score) in enumerate(plain_backoff(train, texts)):
        assert found[i][0] == lang, (texts[i], found[i], lang)
        assert found[i][1] == pytest.approx(score, rel=1e-5)


def test_pipeline_keeps_clean_rows_that_share_an_id(spark, tmp_path):
    clean = sentences(27, 12, size=70)
    docs = docs_of(spark, *[(i // 2, t, "x") for i, t in enumerate(clean)], (99, clean[0], "x"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, str(tmp_path))
    assert sorted(r.text for r in docs.collect()) == sorted(clean)
    assert np.array([r.doc_id for r in docs.collect()]).max() == 5
    assert public_tokenizers.path("piece_bpe_32k.model") == PIECE
