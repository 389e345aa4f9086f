"""Lineage, audit and run reports, built from observed counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltgate.operators.heal import HealStep, present
from siltgate.operators.mask import masked
from siltgate.operators import route
from siltgate.spec import HIGH, MEDIUM, DatasetSpec

#: What a batch writes: the layer it reads and the layer it fills.
WRITES = (("bronze", "silver"), ("bronze", "quarantine"), ("silver", "masked"), ("silver", "gold"))

#: The audit record's fields and states (fixed values: readers of the log know them by these names).
AUDIT_FIELDS = ("audit_id", "run_id", "dataset", "node_name", "error_type", "error_message", "fix_applied", "pipeline_status",
                "clean_rows", "quarantine_rows", "raw_rows", "heal_count")
HEALED, SUMMARY = "HEALED", "PIPELINE_SUMMARY"


def run_counts(raw: DataFrame, spec: DatasetSpec, steps: list[HealStep]) -> DataFrame:
    """Raw, clean and quarantined rows and the number of failing rules, in one scan."""
    from siltgate.operators.validate import compile_suite

    checks, _, _ = compile_suite(raw, spec.rules)
    flags = {f"_f{c.rule_id}": c.fails for c in checks}
    tagged = route.tag(raw.withColumns(flags), spec.rules, steps)
    totals = tagged.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(F.col(route.REASON).isNull()).alias("clean_rows"),
        *[F.count_if(F.col(n)).alias(n) for n in flags])
    failing = sum((F.when(F.col(n) > 0, 1).otherwise(0) for n in flags), start=F.lit(0))
    return totals.select(
        F.lit(spec.name).alias("dataset"), "raw_rows", "clean_rows",
        (F.col("raw_rows") - F.col("clean_rows")).alias("quarantine_rows"),
        failing.cast("bigint").alias("failed_rules"))


def table_edges(counts: DataFrame, run_id: str) -> DataFrame:
    """One edge per write of a batch, with the rows counted in both layers.

    ``counts`` has a row per (layer, dataset).
    """
    per = counts.groupBy("dataset").agg(F.map_from_entries(F.collect_list(F.struct("layer", "n_rows"))).alias("rows"))
    edges = [F.struct(F.lit(a).alias("source_layer"), F.lit(b).alias("target_layer"),
                      F.try_element_at("rows", F.lit(a)).alias("rows_in"),
                      F.try_element_at("rows", F.lit(b)).alias("rows_out")) for a, b in WRITES]
    return per.select(F.lit(run_id).alias("run_id"), "dataset", F.inline(F.array(*edges)))


def column_edges(raw: DataFrame, spec: DatasetSpec, steps: list[HealStep]) -> DataFrame:
    """Column lineage derived from the heal and mask plans, with the rows each changes."""
    by_column = {s.column: s for s in present(raw, steps)}
    words = {HIGH: "SHA-256 hash", MEDIUM: "partial mask"}
    counters, entries = [], []
    for i, c in enumerate(raw.columns):
        step, level = by_column.get(c), spec.pii.get(c, ("NONE", ""))[0]
        value = step.value(F.col(c)) if step else F.col(c)
        final = masked(value, level)
        text = " + ".join(([step.fix] if step else []) + ([words[level]] if level in words else []))
        changed = ~F.col(c).cast("string").eqNullSafe(final.cast("string"))
        counters.append(F.count_if(changed).alias(f"c{i}"))
        entries.append(F.struct(
            F.lit(f"raw.{spec.name}").alias("source_table"), F.lit(c).alias("source_column"),
            F.lit(text or "pass-through").alias("transform"),
            F.lit(f"masked.{spec.name}").alias("target_table"), F.lit(c).alias("target_column"),
            F.col(f"c{i}").alias("rows_changed")))
    return raw.agg(*counters).select(F.inline(F.array(*entries)))


def audit_rows(events: DataFrame, counts: DataFrame, run_id: str) -> DataFrame:
    """One audit row per heal event plus one summary per dataset.

    Events number a few per dataset, so ranking them per dataset is cheap.
    """
    order = Window.partitionBy("dataset").orderBy("layer", "column_name", "issue")
    events = events.withColumn("heal_count", F.count(F.lit(1)).over(Window.partitionBy("dataset"))).withColumn(
        "i", F.row_number().over(order))
    known = events.select("dataset", "heal_count").distinct()
    totals = counts.join(known, "dataset", "left").fillna(0, ["heal_count"])

    def record(df: DataFrame, suffix, node, kind, message, fix, status) -> DataFrame:
        values = dict(zip(AUDIT_FIELDS, (F.concat_ws("-", F.lit(run_id), "dataset", suffix), F.lit(run_id), F.col("dataset"),
                                         node, kind, message, fix, status), strict=False))
        return df.select(*[values.get(f, F.col(f)).alias(f) for f in AUDIT_FIELDS])

    heals = record(events.drop("heal_count").join(totals, "dataset"), F.concat(F.lit("heal-"), F.col("i").cast("string")),
                   F.col("layer"), F.col("issue"), F.concat(F.col("healed_rows").cast("string"), F.lit(" rows in "), F.col("column_name")),
                   F.col("fix"), F.lit(HEALED))
    summary = record(totals, F.lit("summary"), F.lit(SUMMARY), F.lit("none"), F.lit(""), F.lit("completed"),
                     F.when(F.col("clean_rows") > 0, "SUCCESS").otherwise("ESCALATED"))
    return heals.unionByName(summary)


def as_records(df: DataFrame, payload: list[str]) -> DataFrame:
    """Fold free-form columns into one open ``payload`` variant column."""
    fixed = [c for c in df.columns if c not in payload]
    body = F.try_parse_json(F.to_json(F.struct(*payload)))
    return df.select(*fixed, body.alias("payload"))


def stage_status(counts: DataFrame) -> DataFrame:
    """What each layer holds of each dataset; only an empty quarantine is good news."""
    state = F.when(F.col("n_rows") > 0, "filled").when(F.col("layer") == "quarantine", "nothing held back")
    return counts.select("dataset", "layer", "n_rows", state.otherwise("empty").alias("status"))


def run_report(counts: DataFrame, events: DataFrame, drift: DataFrame, log: DataFrame) -> DataFrame:
    """The numbers of a run, one row per dataset."""
    heals = events.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("heal_events"), F.sum("healed_rows").alias("healed_rows"))
    drifts = drift.groupBy("dataset").agg(F.count(F.lit(1)).alias("drift_events"))
    hidden = log.groupBy("dataset").agg(
        F.count_if(F.col("action").isin("SHA256", "PARTIAL_MASK")).alias("masked_columns"))
    joined = counts.join(heals, "dataset", "left").join(drifts, "dataset", "left").join(hidden, "dataset", "left")
    return joined.fillna(0, ["heal_events", "healed_rows", "drift_events", "masked_columns"])
