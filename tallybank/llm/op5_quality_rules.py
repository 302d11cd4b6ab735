"""Quality rules as weak supervision: rules vote or abstain, expectation-maximisation estimates how far to trust them.

Each rule sees one measure of a text and votes good, votes bad, or abstains between its two limits. Texts are counted by
their pattern of votes, of which there are at most 3 ** len(RULES), so the estimate needs the counts only, over all
texts that pass the base rules. For each rule the estimate finds how often it votes bad on good and on bad texts. A text is kept if the posterior
probability that it is good is at least 0.5; a text that breaks a base rule is never kept.

Null and empty texts have no words: all counts are 0 and the base rule of ten words rejects them. Repeated rows count
each. Columns other than doc_id and text are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybank.llm.words import SPACE, Block, blocks, hash_words, mix

WINDOW = 5
SYMBOLS = np.isin(np.arange(256), [ord(c) for c in "#*$%&|<>"])
_UPPER = np.isin(np.arange(256), np.arange(ord("A"), ord("Z") + 1))
_LOWER = np.isin(np.arange(256), np.arange(ord("a"), ord("z") + 1)) | (np.arange(256) >= 0xC3)
_DIGIT = np.isin(np.arange(256), np.arange(ord("0"), ord("9") + 1))
_BANG = np.isin(np.arange(256), [ord("!"), ord("?")])
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_lower"]
COUNTS += ["n_digits", "n_bangs"]

#: Measure, bad below, good from, good up to, bad above. Between them a rule abstains.
RULES = {
    "words": ("n_words", 10, 30, float("inf"), float("inf")),
    "word_length": ("word_chars / n_words", 2.0, 3.0, 9.0, 14.0),
    "symbols": ("n_symbols / n_words", 0, 0, 0.1, 0.3),
    "lines": ("n_dup_lines / greatest(n_lines, 1)", 0, 0, 0.1, 0.3),
    "repeats": ("n_repeat_words / n_words", 0, 0, 0.05, 0.15),
    "capitals": ("n_upper / greatest(n_upper + n_lower, 1)", 0, 0, 0.2, 0.5),
    "digits": ("n_digits / word_chars", 0, 0, 0.1, 0.3),
    "shouting": ("n_bangs / n_words", 0, 0, 0.05, 0.25),
}

#: Where the estimate starts: bad votes on good and on bad texts, and the share of good texts.
ON_GOOD, ON_BAD, GOOD_SHARE = 0.002, 0.2, 0.9
MOST_WRONG, LEAST_SEEN = 0.01, 0.05
COUNT_SCHEMA = "doc_id long, " + ", ".join(f"{name} long" for name in COUNTS)


def repeated_words(words: np.ndarray, size: int = WINDOW) -> int:
    """Words inside a run of `size` words that occurs at least twice. Equal hashes are confirmed on the words."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    runs = np.lib.stride_tricks.sliding_window_view(words, size)
    key = np.zeros(n, np.uint64)
    for k in range(size):
        key = key * np.uint64(0x9E3779B97F4A7C15) + words[k : n + k]
    order = np.argsort(mix(key), kind="stable")
    same = key[order][1:] == key[order][:-1]
    if not same.any():
        return 0
    maybe = np.zeros(n, bool)
    maybe[order[1:][same]] = maybe[order[:-1][same]] = True
    at = np.flatnonzero(maybe)
    _, which, count = np.unique(runs[at], axis=0, return_inverse=True, return_counts=True)
    edge = np.zeros(len(words) + 1, np.int64)
    found = at[count[which.ravel()] > 1]
    edge[found] += 1
    edge[found + size] -= 1
    return int((np.cumsum(edge) > 0).sum())


def duplicate_lines(text: bytes) -> tuple[int, int]:
    """Lines with a word that equal an earlier line, and all lines with a word."""
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\n\v\f\r")]
    return len(lines) - len(set(lines)), len(lines)


def counts(block: Block, words: np.ndarray) -> Iterator[list[int]]:
    """The COUNTS of each text of the block."""

    def per_text(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask)])
        return np.diff(sums[block.bounds])

    chars = per_text(~SPACE[block.data] & ((block.data & 0xC0) != 0x80))
    symbols, upper, lower, digits, bangs = (
        per_text(kind[block.data]) for kind in (SYMBOLS, _UPPER, _LOWER, _DIGIT, _BANG)
    )
    for i, (_, a, b) in enumerate(block.texts()):
        dup, lines = duplicate_lines(block.data[block.bounds[i] : block.bounds[i + 1]].tobytes())
        repeats = repeated_words(words[a:b])
        yield [b - a, chars[i], symbols[i], dup, repeats, lines, upper[i], lower[i], digits[i], bangs[i]]


def count_texts(docs: DataFrame) -> DataFrame:
    """doc_id and COUNTS of each whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [row for block in blocks(batch.column(1)) for row in counts(block, hash_words(block))]
            columns = np.array(found, np.int64).reshape(-1, len(COUNTS)).T
            yield pa.record_batch({"doc_id": batch.column(0)} | dict(zip(COUNTS, columns, strict=True)))

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, COUNT_SCHEMA)


def vote(rule: str) -> Column:
    """1 good, 0 bad, null to abstain."""
    measure, bad_below, good_from, good_to, bad_above = RULES[rule]
    value = F.when(F.col("n_words") > 0, F.expr(measure))
    good = (value >= good_from) & (value <= good_to)
    return F.when(good, 1).when((value < bad_below) | (value > bad_above), 0)


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def pattern() -> Column:
    """The votes of a text as one string."""
    return F.concat(*[F.coalesce(vote(rule).cast("string"), F.lit("-")) for rule in RULES])


def estimate(patterns: dict[str, int], rounds: int = 100) -> dict[str, float]:
    """Posterior probability of good for each pattern of votes, given how many texts have it.

    Good and bad texts each have their own rate of bad votes per rule. Two limits say which class is the good one: no
    rule votes bad on more than MOST_WRONG of the good texts, nor on less than LEAST_SEEN of the bad ones. So one bad
    vote outweighs the good votes of rules that look at other things, unless few bad texts get it.
    """
    if not patterns:
        return {}
    names = sorted(patterns)
    weight = np.array([patterns[name] for name in names], float)
    good = np.array([[vote == "1" for vote in name] for name in names], float)
    bad = np.array([[vote == "0" for vote in name] for name in names], float)
    on_good, on_bad, share = np.full(good.shape[1], ON_GOOD), np.full(good.shape[1], ON_BAD), GOOD_SHARE
    for _ in range(rounds):
        log_good = np.log(share) + bad @ np.log(on_good) + good @ np.log(1 - on_good)
        log_bad = np.log(1 - share) + bad @ np.log(on_bad) + good @ np.log(1 - on_bad)
        posterior = 1 / (1 + np.exp(np.clip(log_bad - log_good, -500, 500)))
        mine, other = weight * posterior, weight * (1 - posterior)
        on_good = np.clip((mine @ bad + 1e-9) / (mine @ (bad + good) + 1e-6), 1e-6, MOST_WRONG)
        on_bad = np.clip((other @ bad + 1e-9) / (other @ (bad + good) + 1e-6), LEAST_SEEN, 0.99)
        share = np.clip(mine.sum() / weight.sum(), 0.5, 0.99)
    return dict(zip(names, posterior.tolist(), strict=True))


def judge(counted: DataFrame) -> DataFrame:
    """`counted` with base_failed, the posterior `p_good` and `kept`. `counted` is read twice: pass a stored table."""
    failed = counted.withColumn("base_failed", base_failed()).withColumn("votes", pattern())
    seen = {row["votes"]: row["count"] for row in failed.filter("not base_failed").groupBy("votes").count().collect()}
    posterior = estimate(seen)
    table = counted.sparkSession.createDataFrame(list(posterior.items()), "votes string, p_good double")
    kept = ~F.col("base_failed") & (F.coalesce("p_good", F.lit(0.0)) >= 0.5)
    return failed.join(F.broadcast(table), "votes", "left").withColumn("kept", kept)
