"""Schema drift: what arrived against what was expected."""

from __future__ import annotations


from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltgate.functions.columns import may_be_number
from siltgate.sources.readers import type_family
from siltgate.spec import DatasetSpec

INT_TEXT = r"^[+-]?[0-9]+$"
FLOAT_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def observed_schema(feed: DataFrame, dataset: str) -> DataFrame:
    """Infer a type family per column of an untyped text feed, from every row.

    ``int`` if all values are whole numbers, ``float`` if all are numbers, else
    ``str``; a column without values is ``str``.  One scan, counters only.
    """
    stats = []
    for i, c in enumerate(feed.columns):
        v = F.col(c)
        kind = (F.when(v.isNull(), None).when(~may_be_number(v), 3).when(v.rlike(INT_TEXT), 1)
                .when(v.rlike(FLOAT_TEXT), 2).otherwise(3))
        stats += [F.count(v).alias(f"n{i}"), F.max(kind).alias(f"k{i}")]   # the widest kind seen
    entries = []
    for i, c in enumerate(feed.columns):
        n = F.col(f"n{i}")
        family = F.when(F.col(f"k{i}") == 1, "int").when(F.col(f"k{i}") == 2, "float").otherwise("str")
        entries.append(F.struct(
            F.lit(dataset).alias("dataset"), F.lit(c).alias("column_name"),
            family.alias("actual_type"), n.alias("non_null_rows")))
    return feed.agg(*stats).select(F.inline(F.array(*entries)))


def declared_schema(df: DataFrame, dataset: str) -> DataFrame:
    """The same table for a typed DataFrame, from its schema."""
    counts = df.agg(*[F.count(c).alias(f"n{i}") for i, c in enumerate(df.columns)])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(dataset).alias("dataset"), F.lit(f.name).alias("column_name"),
                 F.lit(type_family(f.dataType.simpleString())).alias("actual_type"),
                 F.col(f"n{i}").alias("non_null_rows"))
        for i, f in enumerate(df.schema.fields)])))


def drift_events(actual: DataFrame, spec: DatasetSpec) -> DataFrame:
    """COLUMN_REMOVED, COLUMN_ADDED and TYPE_CHANGED as rows of a full outer join."""
    expected = [
        (f.name, type_family(f.dataType.simpleString())) for f in spec.schema.fields
    ]
    spark = actual.sparkSession
    want = spark.createDataFrame(expected, "column_name string, expected_type string")
    both = want.join(actual, "column_name", "full_outer")
    kind = (
        F.when(F.col("actual_type").isNull(), "COLUMN_REMOVED")
        .when(F.col("expected_type").isNull(), "COLUMN_ADDED")
        .when(F.col("actual_type") != F.col("expected_type"), "TYPE_CHANGED")
    )
    return both.withColumn("drift_type", kind).where(F.col("drift_type").isNotNull()).select(
        F.lit(spec.name).alias("dataset"), "drift_type", "column_name", "expected_type",
        "actual_type",
        F.when(F.col("drift_type") == "COLUMN_ADDED", "MEDIUM").otherwise("HIGH").alias("severity"),
        F.coalesce("non_null_rows", F.lit(0)).alias("non_null_rows"),
    )


def _name_score(old, new):
    longest = F.greatest(F.length(old), F.length(new)).cast("double")
    return 1.0 - F.levenshtein(old, new).cast("double") / longest


def _distinct_long(df: DataFrame, columns, side: str) -> DataFrame:
    pairs = [
        F.struct(F.lit(c).alias(side), F.lit(type_family(df.schema[c].dataType.simpleString())).alias("family"),
                 F.col(c).cast("string").alias("value")) for c in columns
    ]
    return df.select(F.inline(F.array(*pairs))).where(F.col("value").isNotNull()).distinct()


def renames(before: DataFrame, after: DataFrame, threshold: float = 0.6) -> DataFrame:
    """Columns that vanished and came back under a new name.

    Candidates are removed x added columns of the same family, scored by name
    distance averaged with the Jaccard overlap of their *whole* value sets; only
    mutual best pairs above the threshold are kept.  Values are made distinct
    per column first, so the join on value sees each column once per value.
    """
    removed = [c for c in before.columns if c not in after.columns]
    added = [c for c in after.columns if c not in before.columns]
    if not removed or not added:
        return before.sparkSession.createDataFrame(
            [], "old_name string, new_name string, name_score double, overlap double, score double")
    old = _distinct_long(before, removed, "old_name")
    new = _distinct_long(after, added, "new_name")
    shared = old.join(new, ["family", "value"]).groupBy("old_name", "new_name").agg(
        F.count(F.lit(1)).alias("both"))
    old_n = old.groupBy("old_name", F.col("family").alias("old_family")).agg(F.count(F.lit(1)).alias("old_n"))
    new_n = new.groupBy("new_name", F.col("family").alias("new_family")).agg(F.count(F.lit(1)).alias("new_n"))
    # One row per removed / added column on each side.
    pairs = old_n.join(new_n, F.col("old_family") == F.col("new_family"))
    scored = pairs.join(shared, ["old_name", "new_name"], "left").fillna(0, ["both"]).select(
        "old_name", "new_name",
        _name_score(F.col("old_name"), F.col("new_name")).alias("name_score"),
        (F.col("both") / (F.col("old_n") + F.col("new_n") - F.col("both"))).alias("overlap"),
    ).withColumn("score", (F.col("name_score") + F.col("overlap")) / 2.0)
    best_new = scored.groupBy("old_name").agg(
        F.max_by("new_name", F.struct("score", "new_name")).alias("new_name"))
    best_old = scored.groupBy("new_name").agg(
        F.max_by("old_name", F.struct("score", "old_name")).alias("old_name"))
    mutual = best_new.join(best_old, ["old_name", "new_name"])
    return scored.join(mutual, ["old_name", "new_name"]).where(F.col("score") >= threshold)


def rename_events(found: DataFrame, dataset: str) -> DataFrame:
    return found.select(
        F.lit(dataset).alias("dataset"), F.lit("COLUMN_RENAMED").alias("drift_type"),
        F.col("old_name").alias("column_name"), "new_name", F.lit("HIGH").alias("severity"),
        F.round("score", 4).alias("score"))


def summary(events: DataFrame) -> DataFrame:
    """Event counts by dataset, type and severity, with the rows that carry them."""
    return events.groupBy("dataset", "drift_type", "severity").agg(
        F.count(F.lit(1)).alias("events"), F.sum("non_null_rows").alias("rows_affected"))


def stamp(events: DataFrame, run_id: str, detected_at: str) -> DataFrame:
    """Log form of drift events: run id and a fixed detection time."""
    return events.withColumns({
        "run_id": F.lit(run_id), "detected_at": F.lit(detected_at).cast("timestamp_ntz")})


def batch_shapes(df: DataFrame, dataset: str, by: str = "batch_id") -> DataFrame:
    """Per batch its rows and its shape: the columns that hold a value in it, in their order."""
    columns = [c for c in df.columns if c != by]
    shape = F.array_join(F.array_compact(F.array(*[F.when(F.count(c) > 0, F.lit(c)) for c in columns])), ",")
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n_rows"), shape.alias("shape")).select(
        F.lit(dataset).alias("dataset"), by, "n_rows", "shape")


def trend(shapes: DataFrame, by: str = "batch_id") -> DataFrame:
    """Segments of successive batches of one shape, each with what it adds to and lacks of the one before.

    One row per batch and dataset is ordered, never the rows of the batches.
    """
    order = Window.partitionBy("dataset").orderBy(by)
    before = F.lag("shape").over(order)
    marked = shapes.withColumn("before", before).withColumn("new", F.coalesce((F.col("shape") != before).cast("int"), F.lit(1)))
    numbered = marked.withColumn("segment", F.sum("new").over(order))
    parts = lambda c: F.split(F.coalesce(c, F.lit("")), ",")
    found = numbered.groupBy("dataset", "segment").agg(
        F.min(by).alias("first_batch"), F.max(by).alias("last_batch"), F.count(F.lit(1)).alias("batches"),
        F.sum("n_rows").alias("n_rows"), F.min_by("shape", by).alias("shape"), F.min_by("before", by).alias("before"))
    return found.select(
        "dataset", "segment", "first_batch", "last_batch", "batches", "n_rows",
        F.array_join(F.array_except(parts(F.col("shape")), parts(F.col("before"))), ",").alias("added"),
        F.when(F.col("before").isNull(), "").otherwise(
            F.array_join(F.array_except(parts(F.col("before")), parts(F.col("shape"))), ",")).alias("removed"))
