"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltgate.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest node it sees."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    rest = edges.join(least.hint("merge"), "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).head())


def components(edges: DataFrame) -> DataFrame:
    """edges: u, v in any order, repeats allowed -> node, component (its smallest node), for nodes other than it.

    Each round is two stored tables of at most as many rows as there are edges; no component meets in one task. Rounds
    join by merging at any size: many rounds' small tables would else go through the driver, one broadcast after another.
    """
    edges = stored(edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    state = _state(edges)
    while state[0]:
        edges = stored(_small_star(_large_star(edges)), "cc")
        now = _state(edges)
        if now == state:
            break
        state = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
