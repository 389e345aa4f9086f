"""What the two vector searches share: which vectors take part, and Arrow lists as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Vectors of one block, and queries that meet a block in one task.
BLOCK_ROWS = 4_096
BLOCK_QUERIES = 1_024


def whole(v: Column) -> Column:
    """The vector is there and every component is a finite number."""
    return v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))


def one_per_id(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Repeated ids: the smallest vector stands for the id."""
    return df.groupBy(key).agg(F.min(vector).alias(vector))


def matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """A list column as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


def best_per_query(found: DataFrame, k: int) -> DataFrame:
    """The k highest scores of each query, ties to the smaller id."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
