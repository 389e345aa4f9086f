"""Repairs as declarative steps, folded into one projection.

A step names the column, says which raw values need repair and gives the
repaired value.  The same steps drive the repair (one ``select``) and the event
counts (one aggregation), so the two can never disagree.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltgate.functions import columns as C
from siltgate.spec import (
    BETWEEN, IN_SET, NOT_NULL, ORDER_STATUSES, PAYMENT_TYPES, PRODUCT_NUMERICS, STATES, DatasetSpec, Rule,
)
from siltgate.operators.validate import failing


@dataclass(frozen=True)
class HealStep:
    column: str
    issue: str
    fix: str
    needs: Callable[[Column], Column]
    value: Callable[[Column], Column]
    outputs: tuple[str, ...] = ()       # every value the step can leave, if that is a closed set


def _state_needs(c: Column) -> Column:
    return ~C.is_in(F.upper(F.trim(c)), STATES + ("UNKNOWN",))


def state_step(column="customer_state", aliases=False) -> HealStep:
    if aliases:
        return HealStep(
            column, "invalid or null state", "alias resolved, else UNKNOWN",
            _state_needs, C.state_code_with_aliases, STATES + ("UNKNOWN",),
        )
    return HealStep(column, "invalid or null state", "set to UNKNOWN", _state_needs, C.state_code,
                    STATES + ("UNKNOWN",))


def city_step(column="customer_city") -> HealStep:
    return HealStep(column, "null city", "filled unknown", lambda c: c.isNull(), C.city_name)


def status_step(column="order_status") -> HealStep:
    return HealStep(
        column, "invalid or null status", "set to unknown",
        lambda c: ~C.is_in(F.lower(c), ORDER_STATUSES + ("unknown",)),
        lambda c: C.one_of(c, ORDER_STATUSES, "unknown", lower=True), ORDER_STATUSES + ("unknown",),
    )


def sentinel_step(column: str) -> HealStep:
    return HealStep(
        column, "null timestamp", "filled sentinel", lambda c: c.isNull(), C.fill_sentinel
    )


def value_step(column="payment_value", policy="abs") -> HealStep:
    fix = "abs or 0" if policy == "abs" else "floored at 0"
    return HealStep(
        column, "negative or null value", fix,
        lambda c: F.coalesce(C.to_number(c) < 0, F.lit(True)),
        lambda c: C.non_negative(c, policy),
    )


def payment_type_step(column="payment_type") -> HealStep:
    return HealStep(
        column, "invalid or null type", "set to boleto",
        lambda c: ~C.is_in(F.lower(F.trim(c)), PAYMENT_TYPES),
        lambda c: C.one_of(c, PAYMENT_TYPES, "boleto", lower=True, trim=True), PAYMENT_TYPES,
    )


def category_step(column="product_category_name") -> HealStep:
    return HealStep(
        column, "null category", "filled unknown", lambda c: c.isNull(),
        lambda c: F.coalesce(c, F.lit("unknown")),
    )


def null_to_zero_step(column: str) -> HealStep:
    return HealStep(
        column, "null value", "filled 0", lambda c: C.to_number(c).isNull(),
        lambda c: F.coalesce(C.to_number(c), F.lit(0.0)),
    )


def bronze_steps(dataset: str, value_policy: str = "abs") -> list[HealStep]:
    """The first-pass repairs of one dataset."""
    plans = {
        "customers": [state_step(), city_step()],
        "orders": [status_step()] + [
            sentinel_step(c) for c in (
                "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date",
            )
        ],
        "payments": [value_step(policy=value_policy), payment_type_step()],
        "products": [category_step()] + [value_step(c, value_policy) for c in PRODUCT_NUMERICS],
    }
    return plans[dataset]


def present(df: DataFrame, steps: Sequence[HealStep]) -> list[HealStep]:
    return [s for s in steps if s.column in df.columns]


def apply_steps(df: DataFrame, steps: Sequence[HealStep]) -> DataFrame:
    """All repairs in one projection; several steps on a column apply in order."""
    folded: dict[str, Column] = {}
    for s in present(df, steps):
        folded[s.column] = s.value(folded.get(s.column, F.col(s.column)))
    return df.select(*[folded.get(c, F.col(c)).alias(c) for c in df.columns])


EVENT_FIELDS = ("layer", "dataset", "column_name", "issue", "fix", "healed_rows")


def _event(layer, dataset, column, issue, fix, n: Column) -> Column:
    texts = zip(EVENT_FIELDS, (layer, dataset, column, issue, fix))
    return F.struct(
        *[F.lit(v).alias(k) for k, v in texts], n.cast("bigint").alias("healed_rows")
    )


def heal_events(df: DataFrame, steps: Sequence[HealStep], *, dataset: str, layer="BRONZE",
                keys=(), by=()) -> DataFrame:
    """One event per repaired column with its row count, in one aggregation.

    ``by`` counts per group (for example per batch).  Null keys, which are
    quarantined rather than repaired, are reported too.
    """
    steps = present(df, steps)
    counters = [F.count_if(s.needs(F.col(s.column))).alias(f"h{i}") for i, s in enumerate(steps)]
    events = [
        _event(layer, dataset, s.column, s.issue, s.fix, F.col(f"h{i}")) for i, s in enumerate(steps)
    ]
    if keys:
        counters.append(F.count_if(F.col(keys[0]).isNull()).alias("hk"))
        events.append(_event(layer, dataset, keys[0], "null key", "quarantined", F.col("hk")))
    counted = df.groupBy(*by).agg(*counters) if by else df.agg(*counters)
    return counted.select(*by, F.inline(F.array(*events))).where(F.col("healed_rows") > 0)


# --- generic fills ---------------------------------------------------------


def typed_default(dtype: T.DataType) -> Column | None:
    if isinstance(dtype, T.StringType):
        return F.lit("UNKNOWN")
    if isinstance(dtype, T.NumericType):
        return F.lit(0).cast(dtype)
    return None


def fill_nulls_by_type(df: DataFrame, columns=None) -> DataFrame:
    """Null text becomes ``UNKNOWN``, a null number becomes 0; other types stay."""
    wanted = set(columns or df.columns)
    out = []
    for f in df.schema.fields:
        default = typed_default(f.dataType) if f.name in wanted else None
        out.append((F.coalesce(F.col(f.name), default) if default is not None
                    else F.col(f.name)).alias(f.name))
    return df.select(*out)


# --- rule-driven repairs ---------------------------------------------------


def most_common_valid(df: DataFrame, value: Column, allowed: Sequence[str]) -> DataFrame:
    """One row, one column: the most frequent allowed value, ties to the smallest.

    Grouping is bounded by the rule's own value set.
    """
    text = value.cast("string")
    return (
        df.select(text.alias("v")).where(C.is_in(F.col("v"), allowed))
        .groupBy("v").count().orderBy(F.desc("count"), F.asc("v")).limit(1).select("v")
    )


def common_valid(df: DataFrame, wanted: Sequence[tuple[int, Column, Sequence[str]]]) -> DataFrame:
    """One row, one map: for each (number, value, allowed values) the most frequent allowed value, ties to the smallest.

    One scan and one grouping, whatever the number of rules; a rule holds at most its own value set.
    """
    pairs = [F.struct(F.lit(i).alias("rule"), F.when(C.is_in(now.cast("string"), allowed), now.cast("string")).alias("v"))
             for i, now, allowed in wanted]
    counted = df.select(F.inline(F.array(*pairs))).where(F.col("v").isNotNull()).groupBy("rule", "v").count()
    best = counted.groupBy("rule").agg(F.min_by("v", F.struct(-F.col("count"), "v")).alias("v"))
    return best.agg(F.map_from_entries(F.collect_list(F.struct("rule", "v"))).alias("modes"))


def unsettled(rules: Sequence[Rule], steps: Sequence[HealStep]) -> list[Rule]:
    """Rules that first-pass steps have not already made true.

    A step with a closed output set satisfies an ``in_set`` rule (and a null rule)
    that covers it, so the rule's search for the most common value, a second pass
    over the data, can be left out.
    """
    closed = {s.column: set(s.outputs) for s in steps if s.outputs}

    def settled(r: Rule) -> bool:
        left = closed.get(r.column)
        return left is not None and (r.kind == NOT_NULL or (r.kind == IN_SET and left <= set(r.values)))

    return [r for r in rules if not settled(r)]


def heal_by_rules(df: DataFrame, rules: Sequence[Rule], mode_of=None) -> DataFrame:
    """Repair what a rule list still finds, in list order.

    ``not_null`` fills a typed default, ``in_set`` writes the most common valid
    value (null counts as invalid here), ``between`` clamps.  Later rules see
    earlier repairs because each column's expression is folded; only ``in_set``
    needs data: one scan gives the values of all such rules, but for a second one
    on the same column, which depends on the first.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    folded: dict[str, Column] = {}
    modes = None
    if mode_of is None:
        before: dict[str, Column] = {}
        asked = []
        for i, rule in enumerate(rules):
            now = before.get(rule.column, F.col(rule.column))
            if rule.kind == NOT_NULL and rule.column in types and (default := typed_default(types[rule.column])) is not None:
                before[rule.column] = F.coalesce(now, default)
            elif rule.kind == BETWEEN and rule.column in types:
                before[rule.column] = _bounded(now, rule, types[rule.column])
            elif rule.kind == IN_SET and rule.values and rule.column in types and all(
                    r.column != rule.column for r in rules[:i] if r.kind == IN_SET):
                asked.append((i, now, rule.values))
        modes = common_valid(df, asked) if asked else None
        known = {i for i, *_ in asked}
    for i, rule in enumerate(rules):
        if rule.column not in types:
            continue
        now = folded.get(rule.column, F.col(rule.column))
        if rule.kind == NOT_NULL:
            default = typed_default(types[rule.column])
            if default is not None:
                folded[rule.column] = F.coalesce(now, default)
        elif rule.kind == IN_SET and rule.values:
            best = (F.try_element_at(modes.scalar(), F.lit(i)) if modes is not None and i in known else
                    (mode_of or most_common_valid)(df, now, rule.values).scalar())
            filler = F.coalesce(best, F.lit(rule.values[0])).cast(types[rule.column])
            valid = C.is_in(now.cast("string"), rule.values)
            folded[rule.column] = F.when(valid, now).otherwise(filler)
        elif rule.kind == BETWEEN:
            folded[rule.column] = _bounded(now, rule, types[rule.column])
    return df.select(*[folded.get(c, F.col(c)).alias(c) for c in df.columns])


def _bounded(now: Column, rule: Rule, dtype: T.DataType) -> Column:
    v = C.to_number(now)
    return F.when(v.isNull(), now).otherwise(C.clamp(v, rule.min_value, rule.max_value).cast(dtype))


RULE_FIXES = {
    NOT_NULL: ("nulls after first pass", "filled UNKNOWN/0"),
    IN_SET: ("values not in set", "most common valid value"),
    BETWEEN: ("values out of range", "clamped"),
}


def batch_events(raw: DataFrame, latest: DataFrame, steps: Sequence[HealStep], rules: Sequence[Rule], *, dataset: str,
                 keys, by=()) -> DataFrame:
    """All heal events of a batch: repairs are counted on ``latest``, the rows that survive deduplication.

    A row that a newer version replaces is never repaired; it counts as a duplicate.  Rows without a usable key are
    quarantined.  Rule events look at the repaired value, exactly what :func:`heal_by_rules` would change.  One
    aggregation over the keys of ``raw``, one over ``latest``; ``by`` counts per group (for example per batch).
    """
    from siltgate.operators.dedup import has_key

    steps = present(latest, steps)
    repaired: dict[str, Column] = {}
    for s in steps:
        repaired[s.column] = s.value(repaired.get(s.column, F.col(s.column)))
    counters = {f"h{i}": F.count_if(s.needs(F.col(s.column))) for i, s in enumerate(steps)}
    events = [_event("BRONZE", dataset, s.column, s.issue, s.fix, F.col(f"h{i}")) for i, s in enumerate(steps)]
    for i, rule in enumerate(r for r in rules if r.kind in RULE_FIXES and r.column in latest.columns):
        now = repaired.get(rule.column, F.col(rule.column))
        counters[f"r{i}"] = F.count_if(
            ~C.is_in(now.cast("string"), rule.values) if rule.kind == IN_SET else failing(rule, now))
        issue, fix = RULE_FIXES[rule.kind]
        events.append(_event("SILVER", dataset, rule.column, issue, fix, F.col(f"r{i}")))
    key = "+".join(keys)
    events.append(_event("BRONZE", dataset, key, "null key", "quarantined", F.col("unkeyed")))
    events.append(_event("BRONZE", dataset, key, "duplicate rows", "kept last occurrence", F.col("keyed") - F.col("kept")))
    arrived = raw.groupBy(*by).agg(F.count_if(~has_key(keys)).alias("unkeyed"), F.count_if(has_key(keys)).alias("keyed"))
    kept = latest.groupBy(*by).agg(F.count(F.lit(1)).alias("kept"), *[c.alias(n) for n, c in counters.items()])
    # Both sides hold one row per group; a batch without any usable key has no kept rows.
    names = ["unkeyed", "keyed", "kept", *counters]
    both = arrived.unionByName(kept, allowMissingColumns=True).groupBy(*by).agg(
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
    return both.select(*by, F.inline(F.array(*events))).where(F.col("healed_rows") > 0)


def kpi_events(rows: DataFrame) -> DataFrame:
    """The repairs of :func:`heal_kpi_rows` as heal events."""
    return rows.where(F.col("kpi_issue").isNotNull()).select(
        F.lit("GOLD").alias("layer"), "dataset", F.col("kpi_key").alias("column_name"), F.col("kpi_issue").alias("issue"),
        F.when(F.col("kpi_issue") == "negative", "absolute value").otherwise("set to 0").alias("fix"),
        F.lit(1).cast("bigint").alias("healed_rows"))


def heal_from_checks(df: DataFrame, spec: DatasetSpec, failed: Sequence[Rule]) -> DataFrame:
    """Repair only the columns whose checks failed.

    A null failure takes the default of the column's type; any other failure
    takes the repair that the dataset declares for that column, if it has one.
    """
    declared = {s.column: s.value for s in bronze_steps(spec.name)}
    values = {c: F.col(c) for c in df.columns}
    for rule in failed:
        if rule.column not in values:
            continue
        if rule.kind != NOT_NULL:
            values[rule.column] = declared.get(rule.column, lambda c: c)(values[rule.column])
        elif (default := typed_default(df.schema[rule.column].dataType)) is not None:
            values[rule.column] = F.coalesce(values[rule.column], default)
    return df.select(*[v.alias(c) for c, v in values.items()])


# --- user-supplied repairs -------------------------------------------------

@dataclass(frozen=True)
class RepairSpec:
    """Set ``column`` to an SQL expression on the rows where a condition holds."""

    column: str
    set_expr: str
    where_expr: str


@dataclass(frozen=True)
class DropSpec:
    """Remove the rows where a condition holds."""

    where_expr: str


def _row_expression(df: DataFrame, text: str) -> Column:
    """An SQL expression over the columns of df that looks at one row alone.

    Decided on the plan that Spark's analysis makes of it: an aggregate, window or generator changes the plan around
    the projection, a subquery hangs below it, and an unknown column fails.
    """
    try:
        plan = df.select(F.expr(text))._jdf.queryExecution().analyzed()
    except AnalysisException as err:
        raise ValueError(f"a repair may only use row-level expressions over known columns: {err}") from err
    own = df._jdf.queryExecution().analyzed()
    if plan.nodeName() != "Project" or not plan.child().equals(own) or not plan.subqueries().isEmpty():
        raise ValueError("a repair may only use row-level expressions")
    return F.expr(text)


def repair(df: DataFrame, specs: Sequence[RepairSpec | DropSpec]) -> DataFrame:
    """Apply repairs in order as projections and filters; no statement is executed."""
    for spec in specs:
        hit = F.coalesce(_row_expression(df, spec.where_expr), F.lit(False))
        if isinstance(spec, DropSpec):
            df = df.where(~hit)
            continue
        if spec.column not in df.columns:
            raise ValueError(f"unknown column {spec.column!r}")
        dtype = df.schema[spec.column].dataType
        fixed = F.when(hit, _row_expression(df, spec.set_expr).cast(dtype)).otherwise(F.col(spec.column))
        df = df.withColumn(spec.column, fixed)
    return df


# --- gold sanity -----------------------------------------------------------

#: KPIs of our Gold tables that cannot be negative, in the long form and in the wide one.
SIGNED_KPIS = ("total_revenue", "avg_payment_value", "max_payment_value",
               "total_revenue_brl", "avg_order_value_brl", "max_order_value_brl")


def sane_kpi(name: str, c: Column) -> Column:
    """NaN, infinity and null become 0; a negative on a revenue figure becomes its size."""
    finite = F.when(
        c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(0.0)
    ).otherwise(c)
    return F.abs(finite) if name in SIGNED_KPIS else finite


def heal_kpi_rows(rows: DataFrame) -> DataFrame:
    """The same for long (dataset, kpi_key, kpi_value) rows; ``kpi_issue`` says what was repaired, null for nothing."""
    number = F.col("kpi_value").try_cast("double")
    issue = F.when(F.col("kpi_value").isNull() | F.isnan(number) | (F.abs(number) == float("inf")), "not_a_number").when(
        F.col("kpi_key").isin(*SIGNED_KPIS) & (number < 0), "negative")
    return rows.withColumn("kpi_issue", issue).withColumn("kpi_value", F.when(
        F.col("kpi_issue") == "not_a_number", "0").when(
        F.col("kpi_issue") == "negative", F.ltrim("kpi_value", F.lit("-"))).otherwise(F.col("kpi_value")))


def heal_gold(kpis: DataFrame) -> DataFrame:
    """Apply :func:`sane_kpi` to every floating-point KPI column."""
    return kpis.select(*[
        (sane_kpi(f.name, F.col(f.name)) if isinstance(f.dataType, (T.DoubleType, T.FloatType))
         else F.col(f.name)).alias(f.name)
        for f in kpis.schema.fields
    ])
