"""One row per key, at any key skew."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def has_key(keys) -> Column:
    """True when no part of the key is null."""
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def keep_one(df: DataFrame, keys, order: list[Column]) -> DataFrame:
    """Keep the first row per key in the stated order; rows with a null key are dropped.

    The order must be total, because Spark rows have no position.  Null keys are
    removed before the window: they would all land in one partition.  The
    ``rn = 1`` filter lets Spark cut every task's rows to one per key *before*
    the shuffle, so a key that holds a third of the table moves one row per task.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.where(has_key(keys))
        .withColumn("_rn", F.row_number().over(ranked))
        .where(F.col("_rn") == 1)
        .drop("_rn")
    )


def _tie_break(df: DataFrame, keys, used) -> list[Column]:
    """The remaining columns, as a last resort that makes the order total."""
    skip = set(keys) | set(used)
    return [F.col(c).asc_nulls_first() for c in df.columns if c not in skip]


def keep_first(df: DataFrame, keys, load_order: str = "load_seq") -> DataFrame:
    order = [F.col(load_order).asc()] + _tie_break(df, keys, [load_order])
    return keep_one(df, keys, order)


def keep_last(df: DataFrame, keys, load_order: str = "load_seq") -> DataFrame:
    order = [F.col(load_order).desc()] + _tie_break(df, keys, [load_order])
    return keep_one(df, keys, order)


def distinct_rows(df: DataFrame, ignore=()) -> DataFrame:
    """Drop identical rows (optionally ignoring bookkeeping columns)."""
    cols = [c for c in df.columns if c not in ignore]
    return df.select(*cols).distinct()


def without_late_duplicates(stream: DataFrame, keys, event_time: str, delay: str) -> DataFrame:
    """Streaming form: bounded state, duplicates inside the watermark are dropped."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))
