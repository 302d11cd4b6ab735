"""Merkle manifest: brute force, tampering, proofs of some leaves, and awkward rows."""

from __future__ import annotations

import hashlib
import random
import zlib

from pyspark.sql import functions as F

from tallybank.llm import op13_manifest
from tallybank.llm.queries import QUERIES, oracle_sql
from tests.compare import difference, oracle_connection
from tests.conftest import SMALL

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, source, lang, n_chars, text):
    values = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return h(*["-" if v is None else f"{len(v.encode())}:{v}" for v in values])


def tree(nodes):
    """Root, and the siblings of each leaf from the leaf upwards as (before, after)."""
    paths, members, level = [[] for _ in nodes], [[i] for i in range(len(nodes))], list(nodes)
    while len(level) > 1:
        runs = [range(a, min(a + 3, len(level))) for a in range(0, len(level), 3)]
        for run in runs:
            for k in run:
                for i in members[k]:
                    paths[i].append(("".join(level[j] for j in run if j < k), "".join(level[j] for j in run if j > k)))
        members = [[i for k in run for i in members[k]] for run in runs]
        level = [h(*[level[k] for k in run]) for run in runs]
    return level[0], paths


def expected(rows):
    """rows: (doc_id, text, lang, source, n_chars)."""
    by_source = {}
    for doc_id, text, lang, source, n_chars in rows:
        cut = text
        if doc_id is not None and text and zlib.crc32(str(doc_id).encode()) % 2 == 0:
            cut = text.replace("\n", "")
        by_source.setdefault(source, []).append(
            (doc_id, leaf_of(doc_id, source, lang, n_chars, text), leaf_of(doc_id, source, lang, n_chars, cut))
        )
    if not by_source:
        return []
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    for name in names:
        by_source[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    subtrees = [tree([r[1] for r in by_source[name]]) for name in names]
    root, tops = tree([subroot for subroot, _ in subtrees])
    out = []
    for name, (subroot, paths), top in zip(names, subtrees, tops, strict=True):
        for (doc_id, leaf, offered), path in zip(by_source[name], paths, strict=True):
            at = offered
            for before, after in path + top:
                at = h(before, at, after)
            proof = h(*[before + after for before, after in path + top])
            out.append((doc_id, leaf, subroot, root, proof, at, at == root))
    return sorted(out, key=repr)


def run(docs):
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    trees = op13_manifest.manifest(op13_manifest.leaves(docs, tampered))
    found = op13_manifest.verified(op13_manifest.prove(*trees))
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return trees, sorted((tuple(r) for r in found.select(*columns).collect()), key=repr)


def made(seed, count, sources):
    draw = random.Random(seed)
    return [
        (i, "".join(draw.choices("ab \né", k=draw.randint(0, 30))), draw.choice(["en", None]), draw.choice(sources), i)
        for i in draw.sample(range(10 * count), count)
    ]


def test_proofs_of_every_row_equal_brute_force(spark):
    rows = made(1, 200, ["a", "b", None, "é", "Z"]) + [(5000, "alone\n", "en", "lone", 3)]
    _, found = run(spark.createDataFrame(rows, DOCS))
    assert found == expected(rows)
    assert {r[-1] for r in found} == {True, False}


def test_one_source_and_one_row(spark):
    for rows in ([(7, "a\nb", "en", "s", 3)], made(2, 28, ["s"]), made(3, 5, ["a", "b", "c", "d", "e", "f"])):
        _, found = run(spark.createDataFrame(rows, DOCS))
        assert found == expected(rows)


def test_awkward_rows(spark):
    rows = [
        (None, "x\ny", "en", "a", 3),
        (None, None, None, None, None),
        (1, "", "en", "a", 0),
        (1, "", "en", "a", 0),
        (1, "", "en", "a", 0),
        (1, "", "en", "a", 0),
        (1, "other", "en", "a", 5),
        (2, "w\n" * 200_000, "en", "", 400_000),
        (-3, "你好\n", "zh", "a", 3),
    ]
    docs = spark.createDataFrame(rows, DOCS)
    for column in ("rank", "n", "digest", "group", "leaf", "offered", "path", "at"):
        docs = docs.withColumn(column, F.lit(1))
    _, found = run(docs)
    assert found == expected(rows)
    assert run(spark.createDataFrame([], DOCS))[1] == []


def test_chosen_leaves_get_the_same_proofs(spark):
    rows = made(4, 60, ["a", "b", None]) + [(900, "x", "en", "lone", 1)]
    trees, found = run(spark.createDataFrame(rows, DOCS))
    chosen = op13_manifest.prove(*trees).select("source", "rank").filter("rank % 7 = 0")
    some = op13_manifest.verified(op13_manifest.prove(*trees, chosen))
    proofs = {r[1]: r[4] for r in found}
    assert {(r.leaf, r.proof_sha256) for r in some.collect()} <= set(proofs.items())
    assert some.count() == chosen.count() > 3


def test_a_changed_leaf_is_not_verified(spark):
    rows = made(5, 40, ["a", "b"])
    trees, _ = run(spark.createDataFrame(rows, DOCS))
    proofs = op13_manifest.prove(*trees).withColumn("offered", F.sha2(F.col("offered").cast("binary"), 256))
    assert op13_manifest.verified(proofs).filter("verified").count() == 0


def test_query_equals_sql(spark):
    found = QUERIES["op13_manifest"](spark, SMALL)
    assert difference(found, oracle_connection(SMALL), oracle_sql()["op13_manifest"]) is None
