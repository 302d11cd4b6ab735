"""Approximate nearest neighbours by collision counting.

Largest inner product becomes smallest Euclidean distance: a vector is divided by the largest norm and gets one more
component that fills it up to length 1; a query is normalised and gets 0. Each of HASHES random projections is a sorted
array of its own. A query starts with a narrow window around its own projected value in every array and widens it level
by level (virtual rehashing: the same arrays serve every radius). A vector that lies in the window of at least THRESHOLD
arrays is verified by its exact inner product. A query ends when its `k`-th best verified distance is within the radius
of the level, or when the windows hold everything, so no candidate is out of reach and nothing is capped. After some
queries the first window is the one below the median window at which the last PROBES queries ended.

Candidates are dealt into blocks by a hash of the id, queries too, and each pair of blocks is one group of bounded size
with its own arrays. Each group returns at most `k` rows per query; the best `k` of those are kept. Vectors of different
lengths are compared only with their own length. Null or zero vectors, and vectors with a null or non-finite component,
take no part, nor do null ids. Equal scores go by the smaller id; repeated ids count as separate candidates, and a query
never finds its own id. Empty tables give no rows. Columns other than the two named are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybank.llm.stored import stored

HASHES, THRESHOLD = 24, 10
CANDIDATES, QUERIES = 8192, 1024
FIRST_RADIUS, GROWTH, LAST_RADIUS = 0.5, 1.12, 4.0
PROBES = 16
HALF_WINDOW = 0.7

FOUND = "query_id long, vec_id long, score double"


def usable(vector: Column) -> Column:
    """Neither null nor zero, and all components finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def projections(dimensions: int) -> np.ndarray:
    """The same for every block and every run."""
    return np.random.default_rng(5).standard_normal((HASHES, dimensions))


def search_block(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, most: float, k: int):
    """Yield (query id, candidate rows, scores) for each query; `most` is the largest norm of all candidates."""
    scaled = vectors / most
    rest = np.sqrt(np.maximum(0, 1 - (scaled**2).sum(axis=1)))
    planes = projections(vectors.shape[1] + 1)
    values = np.column_stack([scaled, rest]) @ planes.T
    order = np.argsort(values, axis=0, kind="stable")
    arrays = [np.ascontiguousarray(values[order[:, j], j]) for j in range(HASHES)]
    order = [order[:, j].astype(np.int32) for j in range(HASHES)]
    norms = np.linalg.norm(queries, axis=1)
    centres = (queries / norms[:, None]) @ planes[:, :-1].T
    radius, ended = FIRST_RADIUS, []
    for q, (query_id, query) in enumerate(zip(query_ids, queries, strict=True)):
        if len(ended) >= PROBES:
            radius = float(np.median(ended[-PROBES:])) / GROWTH
        rows, dots = np.zeros(0, np.int64), np.zeros(0)
        while True:
            whole = radius >= LAST_RADIUS
            half = np.inf if whole else HALF_WINDOW * radius
            window = [
                o[a.searchsorted(c - half) : a.searchsorted(c + half)]
                for o, a, c in zip(order, arrays, centres[q], strict=True)
            ]
            collisions = np.bincount(np.concatenate(window), minlength=len(ids))
            hit = np.flatnonzero(collisions >= THRESHOLD)
            hit = hit[ids[hit] != query_id]
            dots = np.take(vectors, hit, axis=0, mode="clip") @ query
            if len(hit) > k:
                near = np.flatnonzero(dots >= np.partition(dots, len(dots) - k)[-k])
                hit, dots = hit[near], dots[near]
            best = np.lexsort((ids[hit], -dots))[:k]
            rows, dots = hit[best], dots[best]
            if whole or (len(best) == k and 2 - 2 * dots[-1] / (most * norms[q]) <= radius**2):
                break
            radius *= GROWTH
        ended.append(radius)
        radius = FIRST_RADIUS
        yield query_id, rows, dots


def nearest(df: DataFrame, id_column: str, vector_column: str, is_query: Column, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the `k` nearest found for each query row, among all other rows."""
    vector = F.transform(F.col(vector_column), lambda x: x.cast("double"))
    known = df.select(F.col(id_column).cast("long").alias("id"), vector.alias("v"), is_query.alias("is_query"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    rows, _ = stored(
        known.filter(F.col("id").isNotNull() & usable(F.col("v"))).withColumns({"d": F.size("v"), "norm": norm}),
        "vectors",
    )
    sizes = rows.agg(
        F.count("*").alias("n"), F.count_if("is_query").alias("queries"), F.max("norm").alias("most")
    ).first()
    candidate_blocks = max(1, -(-sizes["n"] // CANDIDATES))
    query_blocks = max(1, -(-sizes["queries"] // QUERIES))
    most = sizes["most"] or 1.0

    def block(count: int) -> Column:
        return F.pmod(F.xxhash64("id"), F.lit(count)).cast("int")

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    candidates = rows.select("id", "v", "d", block(candidate_blocks).alias("c")).withColumn("q", every(query_blocks))
    queries = rows.filter("is_query").select("id", "v", "d", block(query_blocks).alias("q"))
    queries = queries.withColumn("c", every(candidate_blocks))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, query_ids = left["id"].to_numpy(), right["id"].to_numpy()
        if not len(ids) or not len(query_ids):
            return pa.table({n: pa.array([], t) for n, t in OUT})
        vectors, asked = (
            t["v"].combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1) for t in (left, right)
        )
        found = list(search_block(ids, vectors, query_ids, asked, most, k))
        return pa.table(
            {
                "query_id": np.repeat([q for q, _, _ in found], [len(rows) for _, rows, _ in found]).astype(np.int64),
                "vec_id": ids[np.concatenate([rows for _, rows, _ in found])],
                "score": np.concatenate([scores for _, _, scores in found]),
            }
        )

    keys = ["c", "q", "d"]
    pieces = candidates.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(search, FOUND)
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = pieces.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")


OUT = [("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]
