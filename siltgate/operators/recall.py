"""Nearest stored incident under a distance threshold, exact at any size.

A small memory (its size is measured first) is shipped to the tasks that read
the new incidents.  A large one is cut into cells around a few pivot vectors;
an incident visits only the cells that the triangle inequality cannot rule out,
and cells are split into blocks of bounded size on both sides.  A block returns
at most one candidate per incident, so pairs are never materialised.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltgate.sources.shared import materialise
from siltgate.spec import RECALL_THRESHOLD

SHIP_BYTES = 64 * 1024 * 1024
PIVOTS = 64
MEMORY_BLOCK = 2048
INCIDENT_BLOCK = 8192
FOUND = "new_id bigint, memory_id bigint, distance double"


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.maximum(d, 0.0)


def _matrix(vectors) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in vectors])


def best_matches(new_ids, new_vecs, old_ids, old_vecs, threshold, earlier_only) -> pd.DataFrame:
    """The nearest memory row of each incident within one block (ties to the smaller id)."""
    order = np.argsort(old_ids, kind="stable")
    old_ids, old_vecs = old_ids[order], old_vecs[order]
    d = squared_distances(new_vecs, old_vecs)
    allowed = old_ids[None, :] < new_ids[:, None] if earlier_only else np.ones(d.shape, bool)
    d = np.where(allowed, d, np.inf)
    best = d.argmin(axis=1)
    rows = np.arange(len(new_ids))
    exact = ((new_vecs - old_vecs[best]) ** 2).sum(axis=1)
    hit = np.isfinite(d[rows, best]) & (exact < threshold)
    return pd.DataFrame({
        "new_id": new_ids[hit], "memory_id": old_ids[best[hit]], "distance": exact[hit]})


def distinct_memory(memory: DataFrame) -> DataFrame:
    """One row per distinct vector with its smallest id: copies collapse before any distance."""
    return memory.groupBy("vec").agg(F.min("id").alias("id"))


def recall(incidents: DataFrame, memory: DataFrame, threshold: float = RECALL_THRESHOLD,
           earlier_only: bool = False, ship_bytes: int = SHIP_BYTES) -> DataFrame:
    """(new_id, memory_id, distance) for incidents whose nearest memory is close enough.

    Both inputs hold (id bigint, vec array<float>).  Distance is squared L2.
    ``earlier_only`` matches an incident with memory of smaller id only.
    """
    incidents = incidents.where(F.col("vec").isNotNull())
    stored = materialise(distinct_memory(memory.where(F.col("vec").isNotNull())))
    size = stored.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("dim")).first()
    if not size["n"]:
        return incidents.sparkSession.createDataFrame([], FOUND)
    if size["n"] * (size["dim"] * 8 + 8) <= ship_bytes:
        found = _shipped(incidents, stored, threshold, earlier_only)
    else:
        found = _blocked(incidents, stored, threshold, earlier_only)
    best = found.groupBy("new_id").agg(F.min(F.struct("distance", "memory_id")).alias("b"))
    return best.select("new_id", F.col("b.memory_id").alias("memory_id"), F.col("b.distance").alias("distance"))


def _shipped(incidents, stored, threshold, earlier_only):
    rows = stored.select("id", "vec").toPandas()     # size measured by the caller
    spark = incidents.sparkSession
    shared = spark.sparkContext.broadcast(
        (rows["id"].to_numpy(np.int64), _matrix(rows["vec"])))

    def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, vecs = shared.value
        for pdf in batches:
            for i in range(0, len(pdf), 256):
                part = pdf.iloc[i:i + 256]
                yield best_matches(part["id"].to_numpy(np.int64), _matrix(part["vec"]), ids, vecs,
                                   threshold, earlier_only)

    return incidents.select("id", "vec").mapInPandas(match, FOUND)


def _blocked(incidents, stored, threshold, earlier_only):
    picked = stored.orderBy(F.xxhash64("id"), "id").limit(PIVOTS).collect()
    pivots = _matrix([r["vec"] for r in picked])
    reach = math.sqrt(threshold) + 1e-6

    @F.pandas_udf("cell int, away double")
    def home(vecs: pd.Series) -> pd.DataFrame:
        d = np.sqrt(squared_distances(_matrix(vecs), pivots))
        cell = d.argmin(axis=1)
        return pd.DataFrame({"cell": cell.astype(np.int32), "away": d[np.arange(len(d)), cell]})

    placed = stored.select("id", "vec", home("vec").alias("h")).select("id", "vec", "h.cell", "h.away")
    cells = {r["cell"]: (r["n"], r["r"]) for r in placed.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.max("away").alias("r")).collect()}
    radius = np.full(len(pivots), -np.inf)
    for c, (_, r) in cells.items():
        radius[c] = r

    @F.pandas_udf("array<int>")
    def visits(vecs: pd.Series) -> pd.Series:
        d = np.sqrt(squared_distances(_matrix(vecs), pivots))
        return pd.Series([np.nonzero(row)[0].astype(np.int32) for row in d - radius[None, :] < reach])

    probes = incidents.select("id", "vec", F.explode(visits("vec")).alias("cell"))
    load = {r["cell"]: r["count"] for r in probes.groupBy("cell").count().collect()}

    def parts(counts, block):
        pairs = [x for c, n in counts.items() for x in (F.lit(c), F.lit(max(1, math.ceil(n / block))))]
        return F.element_at(F.create_map(*pairs), F.col("cell"))

    if not load:
        return incidents.sparkSession.createDataFrame([], FOUND)
    old_parts = parts({c: n for c, (n, _) in cells.items()}, MEMORY_BLOCK)
    new_parts = parts({c: load.get(c, 1) for c in cells}, INCIDENT_BLOCK)
    # Each side is cut by a hash of its own id and copied to the other side's cuts.
    new = probes.select(
        "id", "vec", "cell", F.pmod(F.xxhash64("id"), new_parts).alias("q"),
        F.explode(F.sequence(F.lit(0), (old_parts - 1).cast("int"))).alias("m"))
    old = placed.where(F.col("cell").isin(*load)).select(
        "id", "vec", "cell", F.pmod(F.xxhash64("id"), old_parts).cast("int").alias("m"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), (new_parts - 1).cast("bigint"))).alias("q"))

    def match(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame({"new_id": [], "memory_id": [], "distance": []}).astype(
                {"new_id": "int64", "memory_id": "int64", "distance": "float64"})
        return best_matches(a["id"].to_numpy(np.int64), _matrix(a["vec"]),
                            b["id"].to_numpy(np.int64), _matrix(b["vec"]), threshold, earlier_only)

    keys = ["cell", "m", "q"]
    return new.groupBy(*keys).cogroup(old.groupBy(*keys)).applyInPandas(match, FOUND)
