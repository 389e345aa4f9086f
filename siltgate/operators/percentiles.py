"""Exact percentiles that never gather a column in one task.

``percentile`` keeps every distinct value of a group in one buffer.  Here the
values are counted (hot values fold to one row) and cut into ranges of similar
size; only ranges that hold a wanted rank are cut again, until they are small
enough to be sorted.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltgate.sources.shared import materialise

SIDE = 16           # ranges per group = SIDE * SIDE
SMALL = 200_000     # distinct values that one buffer may hold, or one task sorts


def _cuts(edges: Column, side: int) -> Column:
    """The edges, and every ``side``-th of them for a first coarse look."""
    heads = F.array(*[F.element_at(edges, i * side) for i in range(1, side)])
    return F.struct(edges.alias("edges"), heads.alias("heads"))


def _slot(value: str, cuts: Column, side: int) -> Column:
    """How many edges lie below the value: first among the heads, then inside that
    stretch, so a value meets ``2 * side`` edges at most."""
    def below(some: Column) -> Column:
        return F.size(F.filter(some, lambda e: e < F.col(value)))

    coarse = below(cuts["heads"])
    found = coarse * side + below(F.slice(cuts["edges"], coarse * side + 1, side - 1))
    # Declared non-null: a null filter on the join key would be pushed below the
    # counting, evaluated per raw row, and would keep the counted rows from being reused.
    return F.coalesce(found, F.lit(0))


def _narrowed(rows: DataFrame, by: list[str], value: str, ranks: list[Column], side: int) -> DataFrame:
    """Of rows (group, path, value, n, offset, total) those in ranges that hold a wanted rank.

    The rows of every (group, path) are cut into side * side ranges of similar size; ``path`` grows by the range and
    ``offset`` by the rows before it.  What is broadcast is bounded: a row of edges per path, and one per kept range.
    """
    ranges = side * side
    points = F.split(F.lit(",".join(str(i / ranges) for i in range(1, ranges))), ",").cast("array<double>")
    found = rows.groupBy(*by, "path").agg(F.percentile_approx(value, points, F.lit(10_000)).alias("e"))
    cuts = found.select(*by, "path", _cuts(F.col("e"), side).alias("cuts"))
    placed = rows.join(F.broadcast(cuts), [*by, "path"]).withColumn("slot", _slot(value, F.col("cuts"), side)).drop("cuts")
    sizes = placed.groupBy(*by, "path", "slot").agg(
        F.sum("n").alias("slot_n"), F.max("total").alias("total"), F.max("offset").alias("offset"))
    ordered = Window.partitionBy(*by, "path").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("offset", F.col("offset") + F.coalesce(F.sum("slot_n").over(ordered), F.lit(0)))
    holds = [(r >= F.col("offset")) & (r < F.col("offset") + F.col("slot_n")) for r in ranks]
    needed = sizes.where(reduce(lambda a, b: a | b, holds)).select(*by, "path", "slot", "offset", "total")
    kept = placed.drop("total", "offset").join(F.broadcast(needed), [*by, "path", "slot"])
    return kept.withColumn("path", F.concat_ws(".", "path", F.col("slot").cast("string"))).drop("slot")


def exact_percentiles(long: DataFrame, probs: Sequence[float], group: str | None = "metric",
                      value: str = "value", side: int = SIDE, levels: int = 1) -> DataFrame:
    """Interpolated percentiles per group, one column ``p0 … pn`` per probability.

    ``long`` holds (group, value) rows; null values are ignored.  Values are counted, and each level descends only into
    the ranges that hold a wanted rank: what one task sorts in the end is about distinct values / (side * side) **
    levels (see :func:`levels_for`).
    """
    by = [group] if group else []
    counted = (
        long.where(F.col(value).isNotNull()).groupBy(*by, value)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    totals = counted.groupBy(*by).agg(F.sum("n").alias("total"))
    rows = (counted.join(F.broadcast(totals), by) if by else counted.withColumn("total", totals.scalar())).select(
        *by, F.lit("").alias("path"), value, "n", F.lit(0).cast("bigint").alias("offset"), "total")

    def ranks():
        for p in probs:
            spot = F.lit(p) * (F.col("total") - 1)
            yield F.floor(spot), F.ceil(spot)

    wanted = [r for pair in ranks() for r in pair]
    for level in range(levels):
        rows = _narrowed(materialise(rows) if level else rows, by, value, wanted, side)
    inside = Window.partitionBy(*by, "path").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    ranked = rows.withColumn("upto", F.sum("n").over(inside))
    last = F.col("offset") + F.col("upto")      # rows at or before this value
    first = last - F.col("n")                   # rows before this value
    picks = []
    for i, (lo, hi) in enumerate(ranks()):
        for tag, rank in (("lo", lo), ("hi", hi)):
            picks.append(F.max(F.when((rank >= first) & (rank < last), F.col(value))).alias(f"{tag}{i}"))
    picks.append(F.max("total").alias("total"))
    found = ranked.groupBy(*by).agg(*picks) if by else ranked.agg(*picks)
    out = []
    for i, p in enumerate(probs):
        spot = F.lit(p) * (F.col("total") - 1)
        lo, hi = F.col(f"lo{i}"), F.col(f"hi{i}")
        out.append((lo + (hi - lo) * (spot - F.floor(spot))).alias(f"p{i}"))
    return found.select(*by, "total", *out)


def levels_for(distinct: int, bound: int = SMALL, side: int = SIDE) -> int:
    """How often to narrow so that a range holds about ``bound`` distinct values at most."""
    levels = 1
    while distinct > max(1, bound) * (side * side) ** levels:
        levels += 1
    return levels


def column_percentiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                       sketches: dict[str, int] | None = None, small: int = SMALL) -> dict[str, list]:
    """Exact percentiles of several columns as plain numbers (null without values).

    Columns with few distinct values, by a sketch of the whole column, keep
    their counts in one bounded buffer; the others take the ranged way.
    """
    columns = list(columns)
    if not columns:
        return {}
    if sketches is None:
        sketches = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first().asDict()
    few = [c for c in columns if sketches[c] <= small]
    many = [c for c in columns if sketches[c] > small]
    out: dict[str, list] = {}
    if few:
        row = df.agg(*[F.percentile(F.col(c).cast("double"), list(probs)).alias(c) for c in few]).first()
        out.update({c: row[c] if row[c] is not None else [None] * len(probs) for c in few})
    if many:
        levels = levels_for(max(sketches[c] for c in many), small)
        for r in exact_percentiles(to_long(df, many), probs, levels=levels).collect():
            out[r["metric"]] = [r[f"p{i}"] for i in range(len(probs))]
    return out


def exact_median(df: DataFrame, column: str, small: int = SMALL) -> DataFrame:
    """One row, one column ``median`` (null for a column without values).

    A sketch of the column decides: few distinct values fit one bounded buffer, more are narrowed.
    """
    values = df.select(F.col(column).cast("double").alias("value"))
    distinct = values.agg(F.approx_count_distinct("value")).head()[0]
    if distinct <= small:
        return values.agg(F.percentile("value", 0.5).alias("median"))
    return exact_percentiles(values, [0.5], group=None, levels=levels_for(distinct, small)).select(F.col("p0").alias("median"))


def to_long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(metric, value) rows for several numeric columns in one scan."""
    pairs = [
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in columns
    ]
    return df.select(F.inline(F.array(*pairs)))
