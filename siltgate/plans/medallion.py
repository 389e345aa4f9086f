"""One batch through the layers, and what a run reports about itself."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltgate.functions.columns import percent
from siltgate.operators import heal, route
from siltgate.operators.dedup import has_key, keep_one
from siltgate.spec import DatasetSpec


@dataclass(frozen=True)
class BatchResult:
    """The lazy outputs of one batch; nothing runs until one is written."""

    silver: DataFrame
    quarantine: DataFrame
    events: DataFrame


def total_order(df: DataFrame, keys, prefer=()):
    """Preferred columns first, then every other column, so that one row wins for sure."""
    skip = set(keys) | {n for n, _ in prefer}
    lead = [F.col(n).desc_nulls_last() if d == "desc" else F.col(n).asc_nulls_last() for n, d in prefer]
    return lead + [F.col(c).asc_nulls_last() for c in df.columns if c not in skip]


def refine(raw: DataFrame, spec: DatasetSpec, prefer=(), value_policy: str = "abs") -> BatchResult:
    """Raw rows to clean rows, quarantined rows and heal events.

    Every raw row ends in exactly one place: Silver, quarantine (no usable key,
    when it arrives or after the rules have repaired what they can) or the
    duplicate count.
    """
    keyed = raw.where(has_key(spec.key))
    unkeyed = raw.where(~has_key(spec.key)).withColumn(route.REASON, F.lit(route.NULL_KEY))
    steps = heal.bronze_steps(spec.name, value_policy)
    latest = keep_one(keyed, list(spec.key), total_order(raw, spec.key, prefer))
    bronze = heal.apply_steps(latest, steps)
    ruled = heal.heal_by_rules(bronze, heal.unsettled(spec.rules, steps))
    # A repair may turn a key into no key (a custom step, a cast): those rows leave in a second stage.
    lost = ruled.where(~has_key(spec.key)).withColumn(route.REASON, F.lit(route.NULL_KEY_AFTER_RULES))
    events = heal.batch_events(raw, latest, steps, spec.rules, dataset=spec.name, keys=spec.key)
    return BatchResult(ruled.where(has_key(spec.key)), unkeyed.unionByName(lost), events)


def batch_history(incoming: DataFrame, spec: DatasetSpec, min_pass_pct: float = 95.0,
                  by: str = "batch_id") -> DataFrame:
    """One summary row per batch: raw, clean and quarantined rows, heals and status.

    One scan and one grouping by batch, whatever the number of rules; the state
    per batch is a handful of counters, so a hot batch folds on the map side.
    """
    steps = heal.present(incoming, heal.bronze_steps(spec.name))
    needs = {f"_h{i}": s.needs(F.col(s.column)) for i, s in enumerate(steps)}
    needs["_hk"] = F.col(spec.key[0]).isNull()
    flagged = route.tag(incoming.withColumns(needs), spec.rules, steps)
    counted = flagged.groupBy(by).agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(F.col(route.REASON).isNull()).alias("clean_rows"),
        *[F.count_if(F.col(n)).alias(n) for n in needs],
    )
    events = sum((F.when(F.col(n) > 0, 1).otherwise(0) for n in needs), start=F.lit(0))
    healed = sum((F.col(n) for n in needs), start=F.lit(0))
    passed = percent(F.col("clean_rows"), F.col("raw_rows"), 2)
    return counted.select(
        F.lit(spec.name).alias("dataset"), by, "raw_rows", "clean_rows",
        (F.col("raw_rows") - F.col("clean_rows")).alias("quarantine_rows"),
        events.cast("bigint").alias("heal_events"), healed.cast("bigint").alias("healed_rows"),
        F.when(passed >= min_pass_pct, "SUCCESS").otherwise("ESCALATED").alias("status"),
    )


def quality_trend(history: DataFrame) -> DataFrame:
    """Pass, quarantine and retention percentages per batch; an empty batch gives null."""
    raw = F.col("raw_rows")
    bad = percent(F.col("quarantine_rows"), raw, 1)
    return history.select(
        "dataset", "batch_id", percent(F.col("clean_rows"), raw, 1).alias("pass_pct"),
        bad.alias("quarantine_pct"), F.round(F.lit(100.0) - bad, 1).alias("retention_pct"),
        F.when(F.col("status") == "SUCCESS", 100.0).otherwise(0.0).alias("heal_success_pct"),
    )
