"""Clean / quarantine routing with the true reasons per row."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltgate.operators.heal import HealStep, apply_steps, present, unsettled
from siltgate.operators.validate import compile_suite
from siltgate.spec import NOT_NULL, STATES, UNIQUE, Rule

REASON = "quarantine_reason"
NULL_KEY = "unfixable_null_primary_key"
NULL_KEY_AFTER_RULES = "null_primary_key_after_silver_heal"


def _why(fails: list[tuple[Column, str]]) -> Column:
    """Null for a row without failures, else the labels of the rules it breaks.

    The outer condition is a plain OR, so ``reason is null`` in a filter or a
    counter reduces to the predicates; no reason text is built for clean rows.
    """
    if not fails:
        return F.lit(None).cast("string")
    broken = reduce(lambda a, b: a | b, [f for f, _ in fails])
    return F.when(broken, F.concat_ws("; ", *[F.when(f, F.lit(label)) for f, label in fails]))


def tag(df: DataFrame, rules: Sequence[Rule], steps: Sequence[HealStep] = ()) -> DataFrame:
    """Repair rows and add ``quarantine_reason`` (null for a clean row).

    Null rules look at the raw row, so a fill cannot hide a missing value that a
    rule demands; all other rules look at the repaired row.  No rules: all clean.
    """
    on_raw, _, broken = compile_suite(df, [r for r in rules if r.kind == NOT_NULL])
    marks = {f"_missing{c.rule_id}": c.fails for c in on_raw}
    healed = apply_steps(df.withColumns(marks), steps)
    # Rules that a step's closed value set already guarantees need no check per row.
    rest = [r for r in rules if r.kind not in (NOT_NULL, UNIQUE)]
    on_healed, _, more = compile_suite(healed, unsettled(rest, present(df, steps)))
    if unusable := [f"{rule.label}: {why}" for _, rule, why in broken + more]:
        raise ValueError("rules that cannot be checked would let every row pass: " + "; ".join(unusable))
    fails = [(F.col(f"_missing{c.rule_id}"), c.rule.label) for c in on_raw]
    fails += [(c.fails, c.rule.label) for c in on_healed]
    return healed.withColumn(REASON, _why(fails)).drop(*marks)


def clean(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(REASON).isNull()).drop(REASON)


def quarantine(tagged: DataFrame, quarantined_at: str | None = None) -> DataFrame:
    bad = tagged.where(F.col(REASON).isNotNull())
    if quarantined_at is None:
        return bad
    return bad.withColumn("quarantined_at", F.lit(quarantined_at).cast("timestamp_ntz"))


def null_key_rows(df: DataFrame, key: str, reason: str = NULL_KEY) -> DataFrame:
    """Rows that cannot be repaired because their record id is missing."""
    return df.where(F.col(key).isNull()).withColumn(REASON, F.lit(reason))


def sql_quarantine(customers: DataFrame) -> DataFrame:
    """Warehouse semantics: a null state is *not* selected (three-valued logic)."""
    allowed = STATES + ("UNKNOWN",)
    bad = F.col("customer_id").isNull() | ~F.col("customer_state").isin(*allowed)
    return customers.where(bad).select(
        "customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city",
        "customer_state", F.lit("null_customer_id_or_invalid_state").alias(REASON),
    )


def member_rows(df: DataFrame, column: str, allowed: DataFrame, keep: bool = True) -> DataFrame:
    """Rows whose value is, or is not, in the first column of ``allowed``, which may be of any size.

    Nulls are in no set: they go with ``keep=False``.
    """
    values = allowed.select(F.col(allowed.columns[0]).alias("_member")).distinct()
    return df.join(values, F.col(column) == F.col("_member"), "left_semi" if keep else "left_anti")
