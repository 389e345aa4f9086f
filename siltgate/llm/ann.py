"""Approximate nearest neighbours by inner product: inverted lists with an adaptive dimension scan.

One more component turns the largest inner product into the smallest distance. Rows are indexed under their nearest
centre; a query probes the lists nearest to it. Within a list, rotated vectors lie in column blocks: from the distance
over the first columns a hypothesis test tells whether the whole distance could still be among the best.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltgate.llm.vectors import BLOCK_QUERIES, BLOCK_ROWS, best_per_query, matrix, one_per_id, whole

#: Centres are fitted on at most this many rows, those with the smallest id hashes; every row is indexed.
SAMPLE_ROWS = 20_000
MAX_LISTS = 1_024
#: So many of the sample's rows show how many lists a query must probe for this recall within the sample.
TRIED, RECALL = 200, 0.96
#: So many of the sample's rows bound a query's k-th distance before its lists are scanned.
SEEDS = 8_000
#: Queries that meet the seeds at a time.
SEED_QUERIES = 256
COLUMNS = 16
#: Width of the test: a row leaves when its scaled partial distance is beyond (1 + WIDTH / sqrt(columns))^2 of the best.
WIDTH = 1.2
SEED = 7


class Model:
    """Centres and rotation for vectors of one length."""

    def __init__(self, ids: np.ndarray, sample: np.ndarray, norm: float, lists: int, k: int):
        rng = np.random.default_rng(SEED)
        self.norm = norm
        dim = sample.shape[1]
        self.rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        points = self.lifted(sample)
        lists = max(1, min(lists, len(points)))
        self.centres = points[rng.choice(len(points), lists, replace=False)]
        for _ in range(10):
            near = self.nearest(points)
            count = np.bincount(near, minlength=lists)
            order = np.argsort(near, kind="stable")
            full = np.flatnonzero(count)
            sums = np.add.reduceat(points[order], (np.cumsum(count) - count)[full], axis=0)
            self.centres[full] = sums / count[full, None]
        self.probed = self._enough(sample, self.nearest(points), k)
        self.seed_ids, first = np.unique(ids[:SEEDS], return_index=True)
        self.seeds = sample[first]

    def _enough(self, sample: np.ndarray, near: np.ndarray, k: int) -> int:
        """Lists to probe so that the sample's own rows find RECALL of their k nearest."""
        tried = sample[:TRIED]
        score = tried @ sample.T
        score[np.arange(len(tried)), np.arange(len(tried))] = -np.inf
        best = np.argsort(-score, axis=1)[:, :min(k, len(sample) - 1)]
        rank = np.argsort(self.probes(tried, len(self.centres)), axis=1)
        found = np.sort(np.take_along_axis(rank, near[best], axis=1).ravel())
        return int(found[int(RECALL * (len(found) - 1))]) + 1 if len(found) else 1

    def nearest_seeds(self, ids: np.ndarray, v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query index, row id and inner product of each query's k nearest seeds."""
        score = v @ self.seeds.T
        score[ids[:, None] == self.seed_ids[None, :]] = -np.inf
        # A few more than k, since these products differ from the final ones in the last digits.
        near = np.argsort(-score, axis=1, kind="stable")[:, :k + 16]
        q, r = np.repeat(np.arange(len(ids)), near.shape[1]), near.ravel()
        other = ids[q] != self.seed_ids[r]
        return best_rows(v, q[other], self.seeds, self.seed_ids, r[other], k)

    def limits(self, ids: np.ndarray, v: np.ndarray, k: int) -> np.ndarray:
        """From the seeds: less than this above a row's own square is its distance, if it may be among the k nearest."""
        if len(self.seeds) <= k:
            return np.full(len(v), np.inf)
        score = v @ self.seeds.T
        score[ids[:, None] == self.seed_ids[None, :]] = -np.inf
        kth = np.partition(score, len(self.seeds) - k, axis=1)[:, len(self.seeds) - k]
        return (v ** 2).sum(axis=1) - 2 * kth

    def lifted(self, v: np.ndarray) -> np.ndarray:
        """Rows with the component that gives all of them the same norm."""
        rest = np.sqrt(np.maximum(self.norm ** 2 - (v ** 2).sum(axis=1), 0))
        return np.column_stack([v, rest])

    def distances(self, points: np.ndarray) -> np.ndarray:
        return (self.centres ** 2).sum(axis=1) - 2 * points @ self.centres.T

    def nearest(self, points: np.ndarray) -> np.ndarray:
        return np.concatenate([self.distances(points[i:i + 4096]).argmin(axis=1) for i in range(0, len(points), 4096)]
                              or [np.array([], dtype=np.int64)])

    def probes(self, v: np.ndarray, n: int) -> np.ndarray:
        points = np.column_stack([v, np.zeros(len(v))])
        return np.argsort(self.distances(points), axis=1, kind="stable")[:, :n]


def best_rows(queries: np.ndarray, q: np.ndarray, rows: np.ndarray, ids: np.ndarray, r: np.ndarray,
              k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the pairs (query q, row r) the k of largest inner product for each query: q, row id, product."""
    parts = [(rows[r[i:i + 65536]] * queries[q[i:i + 65536]]).sum(axis=1) for i in range(0, len(q), 65536)]
    score = np.concatenate(parts or [np.array([])])
    return first_k(q, ids[r], score, k)


def first_k(q: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k ids of highest score of each query, ties to smaller ids; a repeated id counts with its best score."""
    order = np.lexsort((-score, ids, q))
    q, ids, score = q[order], ids[order], score[order]
    new = np.ones(len(q), dtype=bool)
    new[1:] = (q[1:] != q[:-1]) | (ids[1:] != ids[:-1])
    q, ids, score = q[new], ids[new], score[new]
    order = np.lexsort((ids, -score, q))
    q, ids, score = q[order], ids[order], score[order]
    best = np.arange(len(q)) - np.searchsorted(q, q) < k
    return q[best], ids[best], score[best]


def scan_list(model: Model | None, queries: np.ndarray, query_ids: np.ndarray, limits: np.ndarray, rows: np.ndarray,
              ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query index, row id and exact inner product of each query's k nearest rows found in this list."""
    stays = ids[None, :] != query_ids[:, None]
    if model is not None and len(ids):
        # The lifted component is the same for all of a row's queries: it moves the row's limit and stays out of the test.
        points, turned, square = rows @ model.rotation, queries @ model.rotation, (rows ** 2).sum(axis=1)
        dim, first = points.shape[1], slice(0, COLUMNS)
        distance = ((turned[:, first] ** 2).sum(axis=1)[:, None] + (points[:, first] ** 2).sum(axis=1)[None, :]
                    - 2 * turned[:, first] @ points[:, first].T)
        stop = min(COLUMNS, dim)
        width = (1 + WIDTH / np.sqrt(stop)) ** 2 if stop < dim else 1 + 1e-9
        slack = 1e-9 * (1 + square[None, :] + (queries ** 2).sum(axis=1)[:, None])
        limit = limits[:, None] + square[None, :] + slack
        stays &= distance * (dim / stop) <= limit * width
        q, r = np.nonzero(stays)
        distance, limit = distance[q, r], limit[q, r]
        while stop < dim and len(q):
            block = slice(stop, stop + COLUMNS)
            distance += ((points[r, block] - turned[q, block]) ** 2).sum(axis=1)
            stop = min(stop + COLUMNS, dim)
            width = (1 + WIDTH / np.sqrt(stop)) ** 2 if stop < dim else 1 + 1e-9
            left = distance * (dim / stop) <= limit * width
            q, r, distance, limit = q[left], r[left], distance[left], limit[left]
    else:
        q, r = np.nonzero(stays)
    return best_rows(queries, q, rows, ids, r, k)


def nearest_neighbours(vectors: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id",
                       vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of largest inner product found for each query, over all other rows.

    Besides its lists a query meets the seeds that bound its distances, so it finds k rows wherever the sample has them.
    Scores are exact, in doubles, on the original vectors. Rows with a null id, or whose vector is null, zero or holds
    a null or non-finite component, take no part; vectors of different lengths don't meet. Repeated ids: the
    smallest vector is the query, rows of the query's own id are left out, and an id is found once, with its best score. A length that the
    sample lacks has no lists: its rows are searched whole. Other columns are ignored.
    """
    spark = vectors.sparkSession
    v = F.col(vector)
    rows = vectors.where(F.col(key).isNotNull() & whole(v) & F.exists(v, lambda x: x != 0)).select(
        F.col(key).cast("long").alias("id"), v.cast("array<double>").alias("v"), is_query.alias("q"),
        F.size(v).alias("dim"))
    norm = F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)))
    n, top_norm = rows.agg(F.count("*"), norm).head()
    lists = int(min(MAX_LISTS, max(1, round(n ** 0.5))))
    sample = rows.orderBy(F.xxhash64("id"), "id", "v").select("id", "dim", "v").limit(SAMPLE_ROWS).toArrow()
    fitted: dict[int, Model] = {}
    for dim in set(sample["dim"].to_pylist()):
        own = sample.filter(pa.array([d == dim for d in sample["dim"].to_pylist()]))
        fitted[dim] = Model(own["id"].to_numpy(), matrix(own["v"], dim), top_norm, lists, k)
    models = spark.sparkContext.broadcast(fitted)

    groups = max(1, -(-n // BLOCK_ROWS))

    def index(batches):
        for batch in batches:
            dims, near = batch.column("dim").to_numpy(), np.full(batch.num_rows, -1, dtype=np.int32)
            for dim in np.unique(dims):
                if (model := models.value.get(int(dim))) is not None:
                    at = np.flatnonzero(dims == dim)
                    near[at] = model.nearest(model.lifted(matrix(batch.column("v").take(pa.array(at)), int(dim))))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "v", "dim")), pa.array(near)],
                                             ["id", "v", "dim", "list"])

    def probe(batches):
        """A query goes once to each group that holds lists it probes, with those lists."""
        for batch in batches:
            dims, ids = batch.column("dim").to_numpy(), batch.column("id").to_numpy()
            row, group, lists, bounds = [], [], [], np.full(batch.num_rows, np.inf)
            for dim in np.unique(dims):
                at, model = np.flatnonzero(dims == dim), models.value.get(int(dim))
                wanted = np.full((len(at), 1), -1)
                if model is not None:
                    v = matrix(batch.column("v").take(pa.array(at)), int(dim))
                    wanted = model.probes(v, model.probed)
                    for i in range(0, len(at), SEED_QUERIES):
                        bounds[at[i:i + SEED_QUERIES]] = model.limits(ids[at[i:i + SEED_QUERIES]], v[i:i + SEED_QUERIES], k)
                for i, own in zip(at, wanted, strict=True):
                    for g in np.unique(own % groups):
                        row.append(i), group.append(int(g)), lists.append(own[own % groups == g].astype(np.int32))
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(take) for c in ("id", "v", "dim")), pa.array(group, pa.int32()),
                 pa.array(lists, pa.list_(pa.int32())), pa.array(bounds).take(take)],
                ["id", "v", "dim", "group", "lists", "bound"])

    indexed = rows.select("id", "v", "dim").mapInArrow(index, "id long, v array<double>, dim int, list int").withColumn(
        "group", F.pmod("list", F.lit(groups)))
    queries = one_per_id(rows.where("q"), "id", "v").withColumn("dim", F.size("v"))
    asking = queries.mapInArrow(probe, "id long, v array<double>, dim int, group int, lists array<int>, bound double")
    # A group that a long list makes large is cut into blocks, and the queries that probe it into parts.
    cuts = indexed.groupBy("dim", "group").agg(F.count("*").alias("n")).join(
        asking.groupBy("dim", "group").agg(F.count("*").alias("n_q")), ["dim", "group"])
    cuts = cuts.select("dim", "group", F.ceil(F.col("n") / (2 * BLOCK_ROWS)).cast("int").alias("blocks"),
                       F.ceil(F.col("n_q") / BLOCK_QUERIES).cast("int").alias("parts"))
    to_all = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    candidates = indexed.join(cuts, ["dim", "group"]).select(
        "id", "v", "dim", "group", F.array("list").alias("lists"), F.lit(0.0).alias("bound"),
        F.pmod(F.xxhash64("id", "v"), F.col("blocks")).cast("int").alias("block"),
        to_all("parts").alias("part"), F.lit(False).alias("asks"))
    asks = asking.join(cuts, ["dim", "group"]).select(
        "id", "v", "dim", "group", "lists", "bound", to_all("blocks").alias("block"),
        F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"), F.lit(True).alias("asks"))

    def cell(group: pa.Table) -> pa.Table:
        asks = group["asks"].to_numpy(zero_copy_only=False)
        dim = group["dim"][0].as_py()
        model = models.value.get(dim)
        ids, v, bounds = group["id"].to_numpy(), matrix(group["v"], dim), group["bound"].to_numpy()
        lists = group["lists"].combine_chunks()
        owner = np.repeat(np.arange(len(ids)), np.diff(lists.offsets.to_numpy()))
        values = lists.flatten().to_numpy()
        q, near, score = [np.array([], dtype=np.int64)], [np.array([], dtype=np.int64)], [np.array([])]
        for at in np.unique(values):
            own = owner[values == at]
            who, rows = own[asks[own]], own[~asks[own]]
            found = scan_list(model, v[who], ids[who], bounds[who], v[rows], ids[rows], k)
            q.append(who[found[0]]), near.append(found[1]), score.append(found[2])
        best, near, score = first_k(np.concatenate(q), np.concatenate(near), np.concatenate(score), k)
        return pa.table({"query_id": ids[best], "vec_id": near, "score": score})

    def meet_seeds(batches):
        for batch in batches:
            dims, ids = batch.column("dim").to_numpy(), batch.column("id").to_numpy()
            for dim in np.unique(dims):
                if (model := models.value.get(int(dim))) is None:
                    continue
                at = np.flatnonzero(dims == dim)
                for rows in (at[i:i + SEED_QUERIES] for i in range(0, len(at), SEED_QUERIES)):
                    v = matrix(batch.column("v").take(pa.array(rows)), int(dim))
                    q, near, score = model.nearest_seeds(ids[rows], v, k)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[rows][q]), pa.array(near), pa.array(score)],
                                                     ["query_id", "vec_id", "score"])

    found = candidates.unionByName(asks).groupBy("dim", "group", "block", "part").applyInArrow(
        cell, "query_id long, vec_id long, score double")
    found = found.unionByName(queries.mapInArrow(meet_seeds, "query_id long, vec_id long, score double"))
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return best_per_query(found, k)
