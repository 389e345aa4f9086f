"""Where each layer of a dataset lives, and how tables are written there."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

LAYERS = ("raw", "silver", "masked", "quarantine", "gold", "audit")


@dataclass(frozen=True)
class Layers:
    """Path resolver under one store root (a shared folder or object store)."""

    root: str

    def path(self, layer: str, dataset: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        return f"{self.root.rstrip('/')}/{layer}/{dataset}"

    def batch_path(self, layer: str, dataset: str, batch_id: int) -> str:
        return f"{self.path(layer, dataset)}/batch_id={batch_id}"

    def find(self, spark: SparkSession, dataset: str, order=LAYERS) -> str:
        """First layer, in the given order, that holds the dataset."""
        for layer in order:
            if exists(spark, self.path(layer, dataset)):
                return self.path(layer, dataset)
        raise FileNotFoundError(dataset)


def exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the cluster's own file system layer."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def children(spark: SparkSession, path: str, marker: str) -> list[str]:
    """Names of the sub-folders that hold a marker file."""
    if not exists(spark, path):
        return []
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(where)]
    return [n for n in names if exists(spark, f"{path}/{n}/{marker}")]


def stamps(spark: SparkSession, path: str) -> dict[int, int]:
    """Batch id -> when its folder was finished, for every finished batch folder of a layer."""
    done = children(spark, path, marker="_SUCCESS")
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = {}
    for name in done:
        if name.startswith("batch_id="):
            where = jvm.org.apache.hadoop.fs.Path(f"{path}/{name}/_SUCCESS")
            out[int(name.split("=")[1])] = where.getFileSystem(conf).getFileStatus(where).getModificationTime()
    return out


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by=()) -> int:
    """Write Parquet and return the row count seen by the same job (no second scan)."""
    return write_observed(df, path, {}, mode, partition_by)["rows"]


def write_observed(df: DataFrame, path: str, metrics: dict, mode: str = "overwrite", partition_by=()) -> dict[str, int]:
    """Write Parquet; the same job counts ``rows`` and the named aggregates."""
    seen = Observation()
    watched = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in metrics.items()])
    writer = watched.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return {k: v or 0 for k, v in seen.get.items()}


def save_table(df: DataFrame, name: str, mode: str = "overwrite") -> None:
    """Create or replace a catalog table from a query result."""
    df.write.mode(mode).saveAsTable(name)


def create_table(spark: SparkSession, name: str, schema, extra=()) -> None:
    """Declare an empty catalog table, optionally the same shape plus extra fields."""
    fields = list(schema.fields) + list(extra)
    spark.createDataFrame([], type(schema)(fields)).write.mode("ignore").saveAsTable(name)


def export_csv(df: DataFrame, path: str, limit: int, by: list) -> None:
    """Export a bounded, ordered slice as CSV with a header."""
    df.orderBy(*by).limit(limit).write.mode("overwrite").option("header", True).csv(path)


def export_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
