"""Expectation suites compiled to aggregations.

Row-level rules (null, set, range, pattern, custom) become counters of *one*
aggregation: one column-pruned scan, one row per task, no data shuffle.
Uniqueness needs a shuffle on the checked column; it runs apart so that its
grouping does not drag every other counter through that shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from siltgate.functions.columns import to_number
from siltgate.spec import BETWEEN, CUSTOM, IN_SET, MATCH_REGEX, NOT_NULL, UNIQUE, Rule

RESULT_COLUMNS = (
    "rule_id", "expectation_type", "column_name", "issue", "failed_count", "evaluated_count",
    "status",
)

ABSENT = "no column "


@dataclass(frozen=True)
class Check:
    """A compiled rule: what fails, and over which rows it is evaluated."""

    rule_id: int
    rule: Rule
    fails: Column
    evaluated: Column


def failing(rule: Rule, on: Column | None = None) -> Column:
    """True where a row breaks the rule.  Null breaks ``not_null`` only.

    ``on`` checks another expression (a repaired value) in place of the column.
    """
    c = on if on is not None else (F.col(rule.column) if rule.kind != CUSTOM else None)
    if rule.kind == NOT_NULL:
        return c.isNull()
    if rule.kind == IN_SET:
        outside = ~c.cast("string").isin(*rule.values) if rule.values else F.lit(True)
        return c.isNotNull() & outside
    if rule.kind == BETWEEN:
        v = to_number(c)
        parts = []
        if rule.min_value is not None:
            parts.append(v < F.lit(rule.min_value))
        if rule.max_value is not None:
            parts.append(v > F.lit(rule.max_value))
        if not parts:
            return F.lit(False)
        return F.coalesce(reduce(lambda a, b: a | b, parts), F.lit(False))
    if rule.kind == MATCH_REGEX:
        return c.isNotNull() & ~c.cast("string").rlike(f"^(?:{rule.pattern or '.*'})")
    if rule.kind == CUSTOM:
        return ~F.coalesce(F.expr(rule.expression), F.lit(False))
    raise ValueError(f"not a row-level rule: {rule.kind}")


def evaluated(rule: Rule) -> Column:
    if rule.kind in (NOT_NULL, UNIQUE, CUSTOM):
        return F.lit(True)
    return F.col(rule.column).isNotNull()


def _problem(df: DataFrame, rule: Rule) -> str | None:
    """Compile-time trouble with one rule; it must not stop the others."""
    needed = rule.columns or (() if rule.kind == CUSTOM else (rule.column,))
    known = {c.lower() for c in df.columns}
    absent = [c for c in needed if c.lower() not in known]
    if absent:
        return ABSENT + absent[0]
    if rule.kind == UNIQUE:
        return None
    try:
        df.select(failing(rule).cast("boolean"))
    except (AnalysisException, ValueError) as err:
        return f"rule error: {err}"
    return None


def compile_suite(df: DataFrame, rules: Sequence[Rule]):
    """Split a rule list into row checks, uniqueness rules and unusable rules."""
    rows, uniques, broken = [], [], []
    for i, rule in enumerate(rules):
        trouble = _problem(df, rule)
        if trouble:
            broken.append((i, rule, trouble))
        elif rule.kind == UNIQUE:
            uniques.append((i, rule))
        else:
            rows.append(Check(i, rule, failing(rule), evaluated(rule)))
    return rows, uniques, broken


def _issue(rule: Rule, failed: Column, seen: Column) -> Column:
    """The rule and how much of what it looked at breaks it."""
    return F.concat(F.lit(f"{rule.label}: "), failed.cast("string"), F.lit(" of "), seen.cast("string"))


def _passes(rule: Rule, failed: Column, seen: Column) -> Column:
    if rule.mostly is None:
        return failed == 0
    return failed.cast("double") <= seen.cast("double") * (1.0 - rule.mostly) + 1e-9


def _result(rule_id: int, rule: Rule, failed: Column, seen: Column) -> Column:
    status = F.when(_passes(rule, failed, seen), F.lit("pass")).otherwise(F.lit("fail"))
    return F.struct(
        F.lit(rule_id).alias("rule_id"),
        F.lit(rule.kind).alias("expectation_type"),
        F.lit(rule.column).alias("column_name"),
        F.when(failed > 0, _issue(rule, failed, seen)).otherwise(F.lit("")).alias("issue"),
        failed.cast("bigint").alias("failed_count"),
        seen.cast("bigint").alias("evaluated_count"),
        status.alias("status"),
    )


def _row_results(df: DataFrame, checks: list[Check], broken) -> DataFrame:
    counters = []
    for c in checks:
        counters.append(F.count_if(c.fails).alias(f"f{c.rule_id}"))
        counters.append(F.count_if(c.evaluated).alias(f"n{c.rule_id}"))
    totals = df.agg(*(counters or [F.count(F.lit(1)).alias("rows")]))
    out = [_result(c.rule_id, c.rule, F.col(f"f{c.rule_id}"), F.col(f"n{c.rule_id}")) for c in checks]
    for i, rule, text in broken:
        status = "missing" if text.startswith(ABSENT) else "error"
        out.append(F.struct(
            F.lit(i).alias("rule_id"), F.lit(rule.kind).alias("expectation_type"),
            F.lit(rule.column).alias("column_name"), F.lit(text).alias("issue"),
            F.lit(0).cast("bigint").alias("failed_count"),
            F.lit(0).cast("bigint").alias("evaluated_count"), F.lit(status).alias("status"),
        ))
    return totals.select(F.inline(F.array(*out)))


def duplicate_counts(df: DataFrame, rules: Sequence[tuple[int, Rule]]) -> DataFrame:
    """Rows beyond the first per value, for each uniqueness rule; nulls equal each other.

    Counting per value first lets each task fold a hot value to one partial row.
    Every rule groups by its own columns as they are: no value goes through text,
    so a rule counts the same alone and among others.
    """
    parts = []
    for rule_id, rule in rules:
        grouped = df.groupBy(*(rule.columns or (rule.column,))).count()
        parts.append(grouped.agg(F.sum(F.col("count") - 1).alias("dups"), F.sum("count").alias("seen")).select(
            F.lit(rule_id).alias("rule_id"), "dups", "seen"))
    return reduce(DataFrame.unionByName, parts)


def check_results(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: counts, issue text and ``pass`` / ``fail`` / ``missing`` / ``error``."""
    rows, uniques, broken = compile_suite(df, rules)
    parts = []
    if rows or broken:
        parts.append(_row_results(df, rows, broken))
    if uniques:
        dup = duplicate_counts(df, uniques)
        found = F.coalesce(F.col("dups"), F.lit(0))
        seen = F.coalesce(F.col("seen"), F.lit(0))
        # One labelled row per rule on the left, so an empty table still reports every rule.
        picked = [
            F.struct(F.max(F.when(F.col("rule_id") == i, found)).alias("d"),
                     F.max(F.when(F.col("rule_id") == i, seen)).alias("s")).alias(f"u{i}")
            for i, _ in uniques
        ]
        wide = dup.agg(*picked)
        parts.append(wide.select(F.inline(F.array(*[
            _result(i, r, F.coalesce(F.col(f"u{i}.d"), F.lit(0)), F.coalesce(F.col(f"u{i}.s"), F.lit(0)))
            for i, r in uniques
        ]))))
    if not parts:  # no rules: no rows, which the summary reports as a fail
        parts.append(_row_results(df, [], [(0, Rule(CUSTOM, ""), "")]).where(F.lit(False)))
    return reduce(DataFrame.unionByName, parts)


def failed_checks(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Only the rules that did not pass."""
    return check_results(df, rules).where(F.col("status") != "pass")


def bad_samples(df: DataFrame, rules: Sequence[Rule], n: int = 5) -> DataFrame:
    """The ``n`` most frequent bad values per rule (ties by value).

    Values are counted before ranking, so a hot bad value costs one partial row
    per task; ranking keeps at most ``n`` rows per rule ahead of its shuffle.
    """
    from pyspark.sql import Window

    checks, _, _ = compile_suite(df, [r for r in rules if r.kind not in (UNIQUE, NOT_NULL, CUSTOM)])
    hits = [
        F.when(c.fails, F.struct(
            F.lit(c.rule.kind).alias("expectation_type"), F.lit(c.rule.column).alias("column_name"),
            F.col(c.rule.column).cast("string").alias("bad_value"),
        )) for c in checks
    ]
    counted = (
        df.select(F.explode(F.array_compact(F.array(*hits))).alias("h")).select("h.*")
        .groupBy("expectation_type", "column_name", "bad_value").count()
    )
    ranked = Window.partitionBy("expectation_type", "column_name").orderBy(
        F.desc("count"), F.asc("bad_value")
    )
    return (
        counted.withColumn("sample_rank", F.row_number().over(ranked))
        .where(F.col("sample_rank") <= n)
        .withColumnRenamed("count", "bad_count")
    )


def suite_summary(results: DataFrame) -> DataFrame:
    """Totals of a suite: rules, failures, bad values, verdict.  No rules means a fail."""
    bad = F.count_if(F.col("status") != "pass")
    return results.agg(
        F.count(F.lit(1)).alias("rules"),
        bad.alias("failed_rules"),
        F.coalesce(F.sum("failed_count"), F.lit(0)).cast("bigint").alias("bad_values"),
        ((F.count(F.lit(1)) > 0) & (bad == 0)).alias("passed"),
    )
