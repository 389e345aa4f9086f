"""Table profiles, issue inspection and rule suggestion, each over the full data."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltgate.functions.columns import percent
from siltgate.operators.percentiles import column_percentiles
from siltgate.operators.validate import failing
from siltgate.sources.readers import type_family
from siltgate.spec import BETWEEN, IN_SET, MATCH_REGEX, NOT_NULL, UNIQUE, DatasetSpec, Rule

# Format library for pattern suggestion (fixed values).
PATTERNS = {
    "zip_prefix": r"\d{4,5}$",
    "iso_timestamp": r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$",
    "uuid": r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
}
NO_PATTERN_SUFFIXES = ("_id", "_phone", "_email", "_date", "_timestamp", "_at")


def column_counts(df: DataFrame, sketch: bool = True) -> DataFrame:
    """Per column: position, type, rows, nulls, null %, and, with ``sketch``, an approximate distinct count.

    One scan and one aggregation whose state is a few counters and a sketch per
    column, so it does not shuffle data.
    """
    stats = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(df.columns):
        stats.append(F.count(c).alias(f"c{i}"))
        if sketch:
            stats.append(F.approx_count_distinct(c).alias(f"d{i}"))
    entries = [
        F.struct(
            F.lit(f.name).alias("column_name"), F.lit(i + 1).alias("position"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col("n").alias("total_rows"), (F.col("n") - F.col(f"c{i}")).alias("null_count"),
            percent(F.col("n") - F.col(f"c{i}"), F.col("n")).alias("null_pct"),
            *([F.col(f"d{i}").alias("approx_distinct")] if sketch else []),
        ) for i, f in enumerate(df.schema.fields)
    ]
    return df.agg(*stats).select(F.inline(F.array(*entries)))


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Exact distinct non-null values per column.

    One scan in long form with one value field per data type, so that values are
    compared as they are, never as text; (column, value) pairs are folded per task
    before the shuffle, and the second grouping only counts.
    """
    names = list(columns or df.columns)
    kinds = list(dict.fromkeys(df.schema[c].dataType.simpleString() for c in names))
    pairs = [
        F.struct(F.lit(c).alias("column_name"), *[
            (F.col(c) if df.schema[c].dataType.simpleString() == kind else F.lit(None)).cast(kind).alias(f"v{i}")
            for i, kind in enumerate(kinds)])
        for c in names
    ]
    values = [f"v{i}" for i in range(len(kinds))]
    long = df.select(F.inline(F.array(*pairs)))
    return long.groupBy("column_name", *values).count().groupBy("column_name").agg(
        F.count(F.coalesce(*[F.when(F.col(v).isNotNull(), 1) for v in values])).alias("distinct_count")
    )


def profile(df: DataFrame, exact: bool = True) -> DataFrame:
    """Schema, null counts and distinct counts, one row per column.

    ``exact=False`` takes the distinct counts from the sketches of the first
    scan, which spares the shuffle of every distinct value.
    """
    if not exact:
        return column_counts(df).withColumnRenamed("approx_distinct", "distinct_count")
    counts = column_counts(df, sketch=False)
    return counts.join(distinct_counts(df), "column_name")


def schema_table(df: DataFrame, table: str) -> DataFrame:
    """(table, column, position, family) with the observed non-null rows."""
    stats = [F.count(c).alias(f"c{i}") for i, c in enumerate(df.columns)]
    entries = [
        F.struct(
            F.lit(table).alias("table_name"), F.lit(f.name).alias("column_name"),
            F.lit(i + 1).alias("position"),
            F.lit(type_family(f.dataType.simpleString())).alias("type_family"),
            F.col(f"c{i}").alias("non_null_rows"),
        ) for i, f in enumerate(df.schema.fields)
    ]
    return df.agg(*stats).select(F.inline(F.array(*entries)))


# --- inspection --------------------------------------------------------------


def _severity(rate):
    return F.when(rate >= 10.0, "HIGH").when(rate >= 2.0, "MEDIUM").otherwise("LOW")


def outlier_bounds(df: DataFrame, columns: Sequence[str], reach: float = 3.0) -> dict:
    """Quartile fences per column; the result is two numbers per numeric column."""
    return {
        c: (q1 - reach * (q3 - q1), q3 + reach * (q3 - q1))
        for c, (q1, q3) in column_percentiles(df, columns, [0.25, 0.75]).items() if q1 is not None
    }


def _normalised_domain(column, domain):
    v = F.lower(F.trim(F.col(column)))
    return F.col(column).isNotNull() & ~v.isin(*[d.lower() for d in domain])


def inspect(df: DataFrame, spec: DatasetSpec, samples: int = 5,
            declared: dict[str, T.DataType] | None = None) -> DataFrame:
    """Issues per column: type, severity, row count, rate and most frequent bad values.

    All row-level issues are flags of one scan.  Bad values are counted per
    (column, issue, value) before the top samples are picked.
    """
    known = dict(spec.fields)
    rules: list[tuple[str, str, object]] = []
    for c in df.columns:
        rules.append((c, "NULL_VALUES", F.col(c).isNull()))
    for c, domain in spec.domains.items():
        if c in df.columns:
            rules.append((c, "BAD_CATEGORICAL", _normalised_domain(c, domain)))
    for c, (low, high) in spec.ranges.items():
        if c in df.columns:
            rules.append((c, "OUT_OF_RANGE", failing(Rule(BETWEEN, c, min_value=low, max_value=high))))
    for c, dtype in (declared or {}).items():
        if c in df.columns:
            rules.append((c, "FORMAT_ERROR", F.col(c).isNotNull()
                          & F.col(c).try_cast(dtype).isNull()))
    numeric = [f.name for f in df.schema.fields
               if isinstance(f.dataType, T.DoubleType) and isinstance(known.get(f.name), T.DoubleType)]
    if numeric:
        for c, (low, high) in outlier_bounds(df, numeric).items():
            rules.append((c, "SUSPICIOUS_VALUE", F.coalesce(
                (F.col(c) < low) | (F.col(c) > high), F.lit(False))))

    counters = [F.count_if(flag).alias(f"i{i}") for i, (_, _, flag) in enumerate(rules)]
    totals = df.agg(F.count(F.lit(1)).alias("n"), *counters)
    entries = [
        F.struct(F.lit(c).alias("column_name"), F.lit(kind).alias("issue_type"),
                 F.col(f"i{i}").alias("issue_rows"), F.col("n").alias("n"))
        for i, (c, kind, _) in enumerate(rules)
    ]
    issues = totals.select(F.inline(F.array(*entries)))

    per_key = df.groupBy(*spec.key).count()
    dup = per_key.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("issue_rows"),
                      F.coalesce(F.sum("count"), F.lit(0)).alias("n"))
    issues = issues.unionByName(dup.select(
        F.lit("+".join(spec.key)).alias("column_name"), F.lit("DUPLICATE_KEY").alias("issue_type"),
        "issue_rows", "n"))

    shown = [
        F.when(flag, F.struct(F.lit(c).alias("column_name"), F.lit(kind).alias("issue_type"),
                              F.col(c).cast("string").alias("bad_value")))
        for c, kind, flag in rules if kind != "NULL_VALUES"
    ]
    rate = percent(F.col("issue_rows"), F.col("n"))
    is_key = F.col("column_name").isin(*spec.key, "+".join(spec.key))
    found = issues.where(F.col("issue_rows") > 0).select(
        "column_name", "issue_type", "issue_rows", rate.alias("issue_pct"),
        F.when(is_key, "HIGH").otherwise(_severity(rate)).alias("severity"),
    )
    if not shown:
        return found.withColumn("sample_bad_values", F.lit(""))
    counted = (
        df.select(F.explode(F.array_compact(F.array(*shown))).alias("b")).select("b.*")
        .groupBy("column_name", "issue_type", "bad_value").count()
    )
    ranked = Window.partitionBy("column_name", "issue_type").orderBy(F.desc("count"), F.asc("bad_value"))
    top = (
        counted.withColumn("r", F.row_number().over(ranked)).where(F.col("r") <= samples)
        .groupBy("column_name", "issue_type")
        .agg(F.array_join(F.transform(
            F.sort_array(F.collect_list(F.struct("r", "bad_value"))), lambda s: s["bad_value"]
        ), ", ").alias("sample_bad_values"))
    )
    return found.join(top, ["column_name", "issue_type"], "left").fillna("", ["sample_bad_values"])


def clean_columns(df: DataFrame, issues: DataFrame) -> DataFrame:
    """Columns with no reported issue."""
    names = df.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, df.columns))).alias("column_name"))
    return names.join(issues.select("column_name").distinct(), "column_name", "left_anti")


# --- rule suggestion ----------------------------------------------------------


def suggest(df: DataFrame, *, max_null_pct: float = 1.0, max_values: int = 50,
            max_value_ratio: float = 0.10, min_share: float = 0.005, min_match: float = 0.98,
            low_p: float = 0.001, high_p: float = 0.999, keep_unique: bool = False) -> list[Rule]:
    """Constraints that the data itself supports.

    A first scan collects null counts, sketches and pattern hits (one small
    row).  Only columns whose sketch says they can qualify are then counted
    exactly, so wide high-cardinality columns are never shuffled for a rule
    that cannot hold.  The driver receives a few numbers per column.
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    strings = [c for c, t in fields.items() if isinstance(t, T.StringType)]
    numeric = [c for c, t in fields.items() if isinstance(t, T.NumericType)]
    # No library pattern fits a printed floating-point number.
    patterned = [c for c, t in fields.items()
                 if not c.endswith(NO_PATTERN_SUFFIXES) and not isinstance(t, (T.DoubleType, T.FloatType))]
    stats = [F.count(F.lit(1)).alias("n")]
    for c in fields:
        stats += [F.count(c).alias(f"c:{c}"), F.approx_count_distinct(c).alias(f"d:{c}")]
    for c in patterned:
        for name, pattern in PATTERNS.items():
            stats.append(F.count_if(F.col(c).cast("string").rlike(f"^(?:{pattern})")).alias(f"{name}:{c}"))
    seen = df.agg(*stats).first().asDict()
    n = seen["n"]
    rules: list[Rule] = []
    if not n:
        return rules

    for c in fields:
        if (n - seen[f"c:{c}"]) / n * 100.0 <= max_null_pct:
            rules.append(Rule(NOT_NULL, c))

    if keep_unique:
        hopeful = [c for c in fields if c.endswith("_id") and seen[f"d:{c}"] >= 0.8 * seen[f"c:{c}"] > 0]
        if hopeful:
            exact = {r["column_name"]: r["distinct_count"] for r in distinct_counts(df, hopeful).collect()}
            rules += [Rule(UNIQUE, c) for c in hopeful if exact.get(c) == seen[f"c:{c}"]]

    # The sketch errs by a few percent; a factor of two leaves no qualifying column out.
    small = [c for c in strings if 0 < seen[f"d:{c}"] <= 2 * max_values]
    if small:
        pairs = [F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in small]
        table = (
            df.select(F.inline(F.array(*pairs))).where(F.col("v").isNotNull())
            .groupBy("c", "v").count().collect()      # at most 2 x max_values rows per column
        )
        by_column: dict[str, dict[str, int]] = {}
        for r in table:
            by_column.setdefault(r["c"], {})[r["v"]] = r["count"]
        for c in small:
            values = by_column.get(c, {})
            rows = sum(values.values())
            if len(values) > max_values or len(values) / n > max_value_ratio:
                continue
            kept = sorted(v for v, k in values.items() if k / rows >= min_share)
            if kept:
                rules.append(Rule(IN_SET, c, values=tuple(kept)))

    sketches = {c: seen[f"d:{c}"] for c in numeric}
    for c, (low, high) in column_percentiles(df, numeric, [low_p, high_p], sketches).items():
        if low is not None:
            # A column without negative values is not bound to its smallest one.
            floor = 0.0 if low >= 0 else round(low, 4)
            rules.append(Rule(BETWEEN, c, min_value=floor, max_value=round(high, 4)))

    for c in patterned:
        for name, pattern in PATTERNS.items():
            if seen[f"c:{c}"] and seen[f"{name}:{c}"] / seen[f"c:{c}"] >= min_match:
                rules.append(Rule(MATCH_REGEX, c, pattern=pattern))
                break
    return rules


def keep_usable(rules: Sequence[Rule], keep_unique: bool = False) -> list[Rule]:
    """Post-filter for rules of any origin: no brittle patterns, no odd value sets."""
    out = []
    for r in rules:
        if r.kind == MATCH_REGEX and r.column.endswith(NO_PATTERN_SUFFIXES):
            continue
        if r.kind == IN_SET and not 1 <= len(r.values) <= 50:
            continue
        if r.kind == UNIQUE and not keep_unique:
            continue
        out.append(r)
    return out


def rules_table(df: DataFrame, rules: Sequence[Rule], dataset: str) -> DataFrame:
    """Suggested rules as rows with the number of rows that support each one."""
    counters, entries = [F.count(F.lit(1)).alias("n")], []
    for i, r in enumerate(rules):
        counters.append(F.count_if(failing(r)).alias(f"f{i}"))
        entries.append(F.struct(
            F.lit(dataset).alias("dataset"), F.lit(r.kind).alias("expectation_type"),
            F.lit(r.column).alias("column_name"), F.lit(", ".join(r.values)).alias("value_set"),
            F.lit(r.min_value).cast("double").alias("min_value"),
            F.lit(r.max_value).cast("double").alias("max_value"),
            F.lit(r.pattern or "").alias("pattern"),
            (F.col("n") - F.col(f"f{i}")).alias("supporting_rows"),
        ))
    return df.agg(*counters).select(F.inline(F.array(*entries)))


def side_by_side(spark: SparkSession, jobs: Sequence[Callable[[], object]]) -> list:
    """Run independent driver steps at the same time, so their small Spark jobs overlap."""
    with ThreadPoolExecutor(max_workers=max(1, len(jobs))) as pool:
        return list(pool.map(lambda job: inheritable_thread_target(spark)(job)(), jobs))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
