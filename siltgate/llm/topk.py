"""Exact top-k by inner product: columnar branch and bound.

Vectors lie column-wise in blocks. For a query, scores grow dimension block by block; after each block a candidate
whose score cannot reach the k-th best any more, by the norms of what remains, leaves, and survivors are compacted.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltgate.llm.vectors import BLOCK_QUERIES, BLOCK_ROWS, best_per_query, matrix, one_per_id, whole

COLUMNS = 16
#: Sums of whole numbers below this are exact in doubles.
EXACT = float(1 << 53)


def search_block(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray,
                 k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per query the ids and scores of the k best rows of this block (ties to smaller ids), its own id left out."""
    n, dim = rows.shape
    order = np.argsort(ids, kind="stable")
    ids, columns = ids[order], np.ascontiguousarray(rows[order].T)
    cuts = list(range(0, dim, COLUMNS)) + [dim]
    small = max(1.0, np.abs(queries).max(initial=0)) * max(1.0, np.abs(rows).max(initial=0)) * max(1, dim) < EXACT
    if not small:  # doubles can't hold these products: whole 64-bit integers, without bounds
        exact = columns.astype(np.int64)
    # Mass that remains after each cut, per row and per query.
    left_rows = [np.sqrt((columns[c:] ** 2).sum(axis=0)) for c in cuts[1:]]
    left_queries = [np.sqrt((queries[:, c:] ** 2).sum(axis=1)) for c in cuts[1:]]
    out = []
    for i, q in enumerate(queries):
        alive = np.flatnonzero(ids != query_ids[i])
        if not small:
            score = q.astype(np.int64) @ exact[:, alive]
        else:
            score = np.zeros(len(alive))
            for b, (start, stop) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                score += q[start:stop] @ columns[start:stop][:, alive]
                if stop < dim and len(alive) > k:
                    slack = left_rows[b][alive] * left_queries[b][i] * (1 + 1e-9) + 1e-6
                    floor = np.partition(score - slack, len(alive) - k)[len(alive) - k]
                    stays = score + slack >= floor
                    alive, score = alive[stays], score[stays]
        best = np.lexsort((ids[alive], -score))[:k]
        out.append((ids[alive[best]], score[best].astype(np.int64)))
    return out


def exact_topk(vectors: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id",
               vector: str = "embedding", scale: float = 1024.0) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest integer inner products of each query, over all other rows.

    Each component becomes floor(scale * x). Rows with a null id, or whose vector is null or holds a null or
    non-finite component, take no part; vectors of different lengths don't meet. Repeated ids: every row is a
    candidate, the smallest vector is the query, and rows of the query's own id are left out. A query without
    candidates has no rows; other columns are ignored.
    """
    ints = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale))
    rows = vectors.where(F.col(key).isNotNull() & whole(F.col(vector))).select(
        F.col(key).cast("long").alias("id"), ints.alias("v"), is_query.alias("q"))
    n, n_queries = rows.agg(F.count("*"), F.count(F.when(F.col("q"), 1))).head()
    blocks, parts = max(1, -(-n // BLOCK_ROWS)), max(1, -(-n_queries // BLOCK_QUERIES))
    dim = F.size("v").alias("dim")
    # Each block of rows meets each part of the stated query set once.
    candidates = rows.select(
        "id", "v", dim, F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(False).alias("asks"))
    asking = one_per_id(rows.where("q"), "id", "v").select(
        "id", "v", dim, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
        F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part"), F.lit(True).alias("asks"))

    def cell(group: pa.Table) -> pa.Table:
        asks = group["asks"].to_numpy(zero_copy_only=False)
        ids, v = group["id"].to_numpy(), matrix(group["v"], group["dim"][0].as_py())
        found = search_block(v[asks], ids[asks], v[~asks], ids[~asks], k)
        sizes = [len(x) for x, _ in found]
        empty = np.array([], dtype=np.int64)
        return pa.table({"query_id": np.repeat(ids[asks], sizes),
                         "vec_id": np.concatenate([x for x, _ in found] or [empty]),
                         "score": np.concatenate([s for _, s in found] or [empty])})

    found = candidates.unionByName(asking).groupBy("dim", "block", "part").applyInArrow(
        cell, "query_id long, vec_id long, score long")
    return best_per_query(found, k)
