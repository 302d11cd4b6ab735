"""Language by words first, and by shorter and shorter character n-grams for words that no language knows.

Learning counts the words of every training text per language, and the character n-grams of the known words. A word is
a run of letters in lower case. A known word adds its log frequency in each language. An unseen word adds the mean log
frequency of its n-grams of the longest length of which at least one is known. The language with the largest sum wins,
ties to the smaller name; the score is its share after a softmax whose temperature grows with the number of words, so
long texts do not all get exactly 1.

The model knows every word and n-gram of the training texts, in two stored tables. The `words` most frequent words and
the totals by language are also broadcast, which is faster and gives the same results: only the other distinct words of
a text are looked up by a join, each distinct word once, with the n-grams of those that training did not see. Words longer
than MOST_LETTERS letters are read in pieces of that length. Null texts and texts without a letter get `und` and score
0, as do all texts if nothing could be learned. Columns other than doc_id, text and lang are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybank.llm.stored import remove, stored

LONGEST = 5
MOST_LETTERS = 40
WORDS, SHARED_NUMBERS = 100_000, 8_000_000
_WORD = regex.compile(r"\p{L}{1,%d}" % MOST_LETTERS)
_FLUSH = 200_000


@dataclass
class Model:
    """Counts of words and n-grams as what they add to the log frequency of half a count, by place of the language."""

    languages: list[str]
    half: np.ndarray
    frequent: dict[str, int]
    frequent_adds: np.ndarray
    words: DataFrame | None = None
    grams: DataFrame | None = None

    def language(self, text: str) -> tuple[str, float]:
        if not self.languages:
            return "und", 0.0
        one = self.words.sparkSession.createDataFrame([(0, text)], "doc_id long, text string")
        row = predict(one, self).first()
        return row["lang_pred"], row["score"]


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def count_words(docs: DataFrame) -> DataFrame:
    """(lang, word, n) over all texts. Each task adds up before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                found.setdefault(batch["lang"][i].as_py(), Counter()).update(words_of(batch["text"][i].as_py()))
                if sum(map(len, found.values())) > _FLUSH:
                    yield from emit(found)
        yield from emit(found)

    def emit(found: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, counter in found.items():
            if counter:
                n = pa.array(counter.values(), pa.int64())
                yield pa.record_batch({"lang": pa.array([lang] * len(n)), "word": pa.array(counter.keys()), "n": n})
        found.clear()

    known = docs.select("lang", "text").filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    return known.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def grams_of(words: DataFrame, kept: list[str], sizes: list[int]) -> DataFrame:
    """`kept` columns and each n-gram of the word with a space at either end."""
    padded = words.select(*kept, F.concat(F.lit(" "), "word", F.lit(" ")).alias("padded"))
    length = F.length("padded")

    def runs(size: int) -> Column:
        at_each = F.transform(F.sequence(F.lit(1), length - size + 1), lambda at: F.substr("padded", at, F.lit(size)))
        return F.when(length >= size, at_each).otherwise(F.array().cast("array<string>"))

    grams = padded.select(*kept, F.explode(F.flatten(F.array(*map(runs, sizes)))).alias("gram"))
    return grams.select(*kept, F.length("gram").alias("size"), "gram")


def count_grams(counted: DataFrame) -> DataFrame:
    """(lang, size, gram, n) of the counted words, each weighed by how often it was seen."""
    return grams_of(counted, ["lang", "n"], list(range(1, LONGEST + 1))).groupBy("lang", "size", "gram").agg(
        F.sum("n").alias("n")
    )


def totals_of(counts: DataFrame) -> dict[str, int]:
    return {row["lang"]: row["n"] for row in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}


def by_key(counts: DataFrame, key: str, languages: list[str]) -> DataFrame:
    """Each key once, with how often it was seen in all and what it adds in the languages that have it."""
    place = F.create_map(*[F.lit(x) for pair in zip(languages, range(len(languages)), strict=True) for x in pair])
    entry = F.struct(place[F.col("lang")].alias("lang"), F.log(2 * F.col("n") + 1).alias("add"))
    return counts.groupBy(key).agg(F.sum("n").alias("total"), F.sort_array(F.collect_list(entry)).alias("entries"))


def most_frequent(words: DataFrame, most: int) -> DataFrame:
    """About `most` of the most frequent words, at most as many: those from some frequency on."""
    step = F.floor(F.log2("total") * 16)
    least, taken = None, 0
    for row in words.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        taken += row["count"]
        if taken > most:
            break
        least = row["step"]
    return words.filter(F.lit(False) if least is None else step >= least)


def learn(counted: DataFrame, words: int = WORDS) -> Model:
    """`counted` is read several times: pass a stored table of `count_words`. `words` are broadcast at most."""
    totals = totals_of(counted)
    if not totals:
        return Model([], np.zeros((LONGEST + 1, 0)), {}, np.zeros((0, 0), np.float32))
    languages = sorted(totals)
    known, _ = stored(by_key(counted, "word", languages), "language-known")
    gram_counts, gram_path = stored(count_grams(counted), "language-gram-counts")
    grams, _ = stored(by_key(gram_counts, "gram", languages).drop("total"), "language-grams")
    sums = np.zeros((LONGEST + 1, len(languages)))
    sums[0] = [totals[lang] for lang in languages]
    for row in gram_counts.groupBy("lang", "size").agg(F.sum("n").alias("n")).collect():
        sums[row["size"], languages.index(row["lang"])] = row["n"]
    remove(counted.sparkSession, [gram_path])
    shared = most_frequent(known, min(words, SHARED_NUMBERS // len(languages))).toArrow()
    adds, entries = np.zeros((shared.num_rows, len(languages)), np.float32), shared["entries"].combine_chunks()
    rows = np.repeat(np.arange(shared.num_rows), np.diff(entries.offsets.to_numpy()))
    flat = entries.flatten()
    adds[rows, flat.field("lang").to_numpy()] = flat.field("add").to_numpy(zero_copy_only=False)
    frequent = {word: i for i, word in enumerate(shared["word"].to_pylist())}
    return Model(languages, np.log(0.5 / (sums + 1.0)), frequent, adds, known, grams)


def sum_shared(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, number of words, how many of them are broadcast and what these add, and the other distinct words."""
    shared = docs.sparkSession.sparkContext.broadcast((model.frequent, model.frequent_adds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, adds = shared.value
        for batch in batches:
            columns = [[] for _ in range(5)]
            for i in range(batch.num_rows):
                words = words_of(batch["text"][i].as_py() or "")
                rows = [row for word in words if (row := frequent.get(word)) is not None]
                rest = Counter(word for word in words if word not in frequent) if len(rows) < len(words) else {}
                found = len(words), len(rows), adds[rows].sum(axis=0, dtype=float), list(rest), list(rest.values())
                for column, value in zip(columns, found, strict=True):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.string()), pa.list_(pa.int64())]
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
            yield pa.record_batch([batch["doc_id"], *arrays], names=["doc_id", "n_words", "shared", "sums", "rest", "times"])

    columns = docs.select(F.col("doc_id").cast("long"), "text")
    return columns.mapInArrow(
        run, "doc_id long, n_words long, shared long, sums array<double>, rest array<string>, times array<long>"
    )


def added(entries: str, lang: Column) -> Column:
    """What all entries of a language add."""
    of_lang = F.filter(entries, lambda e: e["lang"] == lang)
    return F.aggregate(of_lang, F.lit(0.0), lambda total, e: total + e["add"])


def look_up(words: DataFrame, model: Model) -> DataFrame:
    """(word, size, entries) of distinct words: size 0 for a known one, else that of its longest known n-grams.

    Lengths are tried from the longest on, so a word meets the shorter n-grams, which very many words have, only if it
    has no longer one that is known.
    """
    spark = words.sparkSession
    looked, _ = stored(words.join(model.words.select("word", "entries"), "word", "left"), "language-looked")
    found = looked.filter("entries is not null").select("word", F.lit(0).alias("size"), "entries")
    unseen, path = looked.filter("entries is null").select("word"), None
    for size in range(LONGEST, 0, -1):
        matched = grams_of(unseen, ["word"], [size]).join(model.grams, "gram")
        summed = matched.groupBy("word").agg(
            F.count("*").alias("n"), F.sort_array(F.flatten(F.collect_list("entries"))).alias("all")
        )
        # One entry per language; the sorted order makes the sums the same in every run.
        mean = F.transform(
            F.array_distinct(F.transform("all", lambda e: e["lang"])),
            lambda lang: F.struct(lang.alias("lang"), (added("all", lang) / F.col("n")).alias("add")),
        )
        placed, _ = stored(summed.select("word", F.lit(size).alias("size"), mean.alias("entries")), "language-unseen")
        found = found.union(placed)
        rest, rest_path = stored(unseen.join(placed.select("word"), "word", "left_anti"), "language-rest")
        remove(spark, [path] if path else [])
        unseen, path = rest, rest_path
        if unseen.isEmpty():
            break
    return found


def add_parts(parts: pa.ListArray, total: np.ndarray, votes: np.ndarray) -> None:
    """Add what each row's looked-up words give: to `total` by language, and their numbers to `votes` by size.

    All lists are read as flat arrays, in the order of the rows and of their parts.
    """
    if not len(parts.flatten()):
        return
    row = np.repeat(np.arange(len(parts)), np.diff(filled_offsets(parts)))
    each = parts.flatten()
    n, size, entries = each.field("n").to_numpy(), each.field("size").to_numpy(), each.field("entries")
    votes += np.bincount(row * votes.shape[1] + size, n, votes.size).reshape(votes.shape)
    count = np.diff(filled_offsets(entries))
    entry = entries.flatten()
    place = np.repeat(row, count) * total.shape[1] + entry.field("lang").to_numpy()
    weight = np.repeat(n, count) * entry.field("add").to_numpy()
    total += np.bincount(place, weight, total.size).reshape(total.shape)


def filled_offsets(lists: pa.ListArray) -> np.ndarray:
    """Offsets into the flattened lists, where null lists have no values."""
    sizes = lists.value_lengths().fill_null(0).to_numpy()
    return np.append(0, np.cumsum(sizes))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score of each whole text."""
    if not model.languages:
        return docs.select(F.col("doc_id").cast("long"), F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    first, _ = stored(sum_shared(docs, model).withColumn("row", F.monotonically_increasing_id()), "language-shared")
    pairs = first.select("row", F.explode(F.arrays_zip("rest", "times")).alias("w"))
    rest = pairs.select("row", F.col("w.rest").alias("word"), F.col("w.times").alias("n"))
    scored = rest.join(look_up(rest.select("word").distinct(), model), "word")
    # Sorted, so that sums are the same in every run; equal parts may change places.
    parts = scored.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("n", "size", "entries"))).alias("parts"))
    joined = first.drop("rest", "times").join(parts, "row", "left")
    languages, half = model.languages, model.half

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch["n_words"].to_numpy().astype(float)
            total = batch["sums"].flatten().to_numpy().reshape(-1, len(languages)).copy()
            votes = np.zeros((batch.num_rows, len(half)))
            votes[:, 0] = batch["shared"].to_numpy()
            add_parts(batch["parts"], total, votes)
            total += votes @ half
            best = total.argmax(axis=1)
            apart = (total - total[np.arange(len(total)), best][:, None]) / np.maximum(n, 1)[:, None] ** 0.5
            words = n > 0
            langs = np.where(words, np.array(languages, object)[best], "und")
            yield pa.record_batch(
                {
                    "doc_id": batch["doc_id"],
                    "lang_pred": pa.array(langs, pa.string()),
                    "score": pa.array(np.where(words, 1 / np.exp(apart).sum(axis=1), 0.0)),
                }
            )

    columns = joined.select("doc_id", "n_words", "shared", "sums", "parts")
    return columns.mapInArrow(run, "doc_id long, lang_pred string, score double")
