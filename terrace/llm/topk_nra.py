"""Exact top-k inner products by aggregation without random access.

A block of candidates is held as one sorted list per dimension.  For a query
the lists are read in parallel from the end its sign asks for.  After each
depth a candidate has a lower and an upper bound: the parts already read, plus
for each list not yet read up to it the list's worst value or its current
front.  Candidates whose upper bound is under the k-th best lower bound cannot
qualify any more; when all others are settled, or the lists are spent, the
scores of the remaining few are resolved.  Depths double, and the bounds of
all queries of a block are kept as matrices.

Vectors that are null or hold a null or non-finite component take no part;
only vectors of one length are compared.  Ties go to the smaller id.  Repeated
rows are candidates of their own; a row is not a candidate of a query with
the same id, and each repeated query row gets its own list.  Sums that doubles
cannot hold exactly are resolved in Python's integers, without bounds; a score
beyond 64 bits counts as the nearest bound of that range.  A component that
overflows a double when scaled counts as non-finite.  Queries are dealt in blocks against blocks of candidates, so no
side is broadcast or collected.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Sums in doubles are exact while 2 * length * max|x|^2 is below this.
EXACT = float(1 << 53)


def nra_block(queries: np.ndarray, qids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int,
              first_depth: int = 16) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, candidate row, score) of the best ``k`` of each query; ties
    to the smaller candidate id.  Integer-valued doubles throughout."""
    m, n, dims = len(queries), len(vectors), vectors.shape[1]
    order = np.argsort(vectors, axis=0, kind="stable")
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(n)[:, None].repeat(dims, 1), axis=0)
    ranked = np.take_along_axis(vectors, order, axis=0)
    low, high = ranked[0], ranked[-1]
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    own = qids[:, None] == ids[None, :]
    alive = ~own
    depth = max(1, n // first_depth)
    while True:
        depth = min(depth, n)
        top, bottom = rank >= n - depth, rank < depth  # what the lists have shown from either end
        seen = up @ np.where(top, vectors, 0).T + down @ np.where(bottom, vectors, 0).T
        worst = up @ np.where(top, 0, low).T + down @ np.where(bottom, 0, high).T
        lower = np.where(alive, seen + worst, -np.inf)
        floor = np.partition(lower, n - k, axis=1)[:, n - k] if n >= k else np.full(m, -np.inf)
        front = up @ np.where(top, 0, ranked[n - depth]).T + down @ np.where(bottom, 0, ranked[depth - 1]).T
        alive &= seen + front >= floor[:, None]
        left = alive.sum(axis=1)
        if depth == n or left.max(initial=0) <= 4 * k:
            break
        depth *= 2
    q, c = np.nonzero(alive)
    score = np.einsum("ij,ij->i", queries[q], vectors[c])  # final scores of those that may qualify
    sort = np.lexsort((ids[c], -score, q))
    q, c, score = q[sort], c[sort], score[sort]
    start = np.searchsorted(q, np.arange(m))
    best = np.arange(len(q)) - start[q] < k
    return q[best], c[best], score[best]


def whole_block(queries: np.ndarray, qids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As :func:`nra_block`, in integers of any size."""
    limit = np.iinfo(np.int64)
    held = [[int(x) for x in v] for v in vectors]
    found: list[tuple[int, int, int]] = []
    for i, q in enumerate(queries):
        q = [int(x) for x in q]
        scores = ((max(limit.min, min(limit.max, sum(a * b for a, b in zip(q, v)))), j) for j, v in enumerate(held) if ids[j] != qids[i])
        found += [(i, j, s) for s, j in heapq.nsmallest(k, scores, key=lambda x: (-x[0], ids[x[1]]))]
    q, c, score = (np.array([f[n] for f in found], np.int64) for n in range(3))
    return q, c, score


def top_k(vectors: DataFrame, is_query, k: int = 10, scale: int = 1024, block: int = 4096, query_block: int = 1024,
          key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` best candidates of every row
    for which the Boolean expression ``is_query`` holds."""
    spark = vectors.sparkSession
    values = F.transform(F.col(vector), lambda x: x.cast("double"))
    usable = F.col(vector).isNotNull() & F.col(key).isNotNull() & F.forall(
        values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < float("inf")))
    rows = vectors.where(F.coalesce(usable, F.lit(False))).select(
        F.col(key).cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("asks"),
        F.transform(values, lambda x: F.when(F.abs(x * scale) < EXACT, F.floor(x * scale).cast("double")).otherwise(x * scale)).alias("v"),
        F.size(vector).alias("dims"))
    sizes = rows.groupBy("dims").agg(F.count("*").alias("n"), F.count_if("asks").alias("q"))
    # one row per vector length; equal lengths are the usual case
    shape = sizes.select("dims", F.ceil(F.col("n") / block).cast("int").alias("blocks"),
                         F.ceil(F.col("q") / query_block).cast("int").alias("asked")).where("asked > 0")
    rows = rows.join(shape, "dims")
    salt = F.xxhash64("id")
    all_ = rows.select("dims", F.pmod(salt, "blocks").cast("int").alias("c"),
                       F.explode(F.sequence(F.lit(0), F.col("asked") - 1)).alias("q"), "id", "v").toDF("dims_", "c_", "q_", "id", "v")
    asks = rows.where("asks").withColumn("row", F.monotonically_increasing_id()).select(
        "row", "dims", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("c"), F.pmod(salt, "asked").cast("int").alias("q"), "id", "v")

    def run(asked: pa.Table, given: pa.Table) -> pa.Table:
        names = ["row", "query_id", "vec_id", "score"]
        kinds = [pa.int64()] * 4
        if asked.num_rows == 0 or given.num_rows == 0:
            return pa.Table.from_arrays([pa.array([], t) for t in kinds], names)

        def matrix(t):
            flat = t.column("v").combine_chunks().flatten().to_numpy()
            return flat.reshape(t.num_rows, -1), t.column("id").to_numpy()

        (qv, qi), (cv, ci) = matrix(asked), matrix(given)
        exact = 2 * cv.shape[1] * max(np.abs(qv).max(initial=0), 1) * max(np.abs(cv).max(initial=0), 1) < EXACT
        row = asked.column("row").to_numpy()
        found = [[], [], [], []]
        for s in range(0, len(qv), 256):  # bounds the matrices of a step
            q, c, score = (nra_block if exact else whole_block)(qv[s:s + 256], qi[s:s + 256], cv, ci, k)
            for column, x in zip(found, (row[s:s + 256][q], qi[s:s + 256][q], ci[c], score.astype(np.int64))):
                column.append(x)
        return pa.Table.from_arrays([pa.array(np.concatenate(x), t) for x, t in zip(found, kinds)], names)

    best = asks.groupBy("dims", "c", "q").cogroup(all_.groupBy("dims_", "c_", "q_")).applyInArrow(
        run, "row long, query_id long, vec_id long, score long")
    order = Window.partitionBy("row", "query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
