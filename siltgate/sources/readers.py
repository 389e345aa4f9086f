"""Typed, tolerant readers and schema introspection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """Read CSV with a declared schema; rows that do not fit keep their raw text.

    No inference pass: a schema scan over the whole input would read it twice.
    """
    wide = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType(), True)])
    reader = spark.read.schema(wide).options(
        header=True, quote='"', escape='"', mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT
    )
    return lower_names(reader.options(**options).csv(path))


def parse_csv_lines(df: DataFrame, line: str, schema: T.StructType) -> DataFrame:
    """Same contract as :func:`read_csv` for lines that already sit in a column."""
    wide = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType(), True)])
    parsed = F.from_csv(
        F.col(line), wide.simpleString()[len("struct<"):-1].replace(":", " "),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "escape": '"'},
    )
    return df.select(parsed.alias("r")).select("r.*")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return lower_names(spark.read.parquet(path))


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def stamp(df: DataFrame, batch_id, ingested_at: str) -> DataFrame:
    """Add ingest columns.  The time is a value, so a retried task writes the same rows."""
    return df.withColumns({
        "batch_id": F.lit(batch_id),
        "ingested_at": F.lit(ingested_at).cast("timestamp_ntz"),
    })


def sample_rows(df: DataFrame, by: list, n: int = 5) -> DataFrame:
    """First ``n`` rows in a stated order, as text, null shown as the empty string."""
    top = df.orderBy(*by).limit(n)
    return top.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])


def type_family(dtype: str) -> str:
    """Fold Spark, pandas and warehouse type names into a few families."""
    name = dtype.lower()
    if name.startswith(("array", "map", "struct")):
        return name
    for family, marks in (
        ("timestamp", ("timestamp", "date")),
        ("int", ("int", "long", "short", "byte")),
        ("float", ("float", "double", "decimal", "number", "numeric", "real")),
        ("str", ("object", "str", "char", "text")),
        ("bool", ("bool",)),
    ):
        if any(m in name for m in marks):
            return family
    return name
