"""Cumulative store, batch history, lineage, audit, and operations."""

from pyspark.sql import functions as F

from siltgate.catalog.healing import (
    ABS_SQL, HEALED, NULL_RULED, PREFER, TYPE_SQL, _NEEDS, heal_log, pay_order, replaced,
)
from siltgate.catalog.quality import all_drift
from siltgate.catalog.registry import CTES, query
from siltgate.catalog.silver_gold import _COLUMNS as COLUMNS
from siltgate.catalog.silver_gold import _kpi_sql, _logs
from siltgate.functions.columns import non_negative
from siltgate.operators import drift, heal, lineage, ops, profile, recall, route, store
from siltgate.operators.dedup import has_key, keep_one
from siltgate.plans import gold, medallion
from siltgate.sources.layers import Layers
from siltgate.sources.shared import materialise, scratch_folder
from siltgate.spec import SPECS

PAYS = ["order_id", "payment_sequential"]


# --- cumulative store ---------------------------------------------------------


@query("bronze_append", " UNION ALL ".join(
    f"SELECT '{d}' AS dataset, batch_id, COUNT(*) AS n_rows FROM incoming_{d} GROUP BY batch_id" for d in SPECS))
def bronze_append(t):
    """Row counts of the append-only Bronze log, per dataset and batch."""
    log = store.append_with_missing([
        t.incoming(d).select(F.lit(d).alias("dataset"), "batch_id") for d in SPECS])
    return log.groupBy("dataset", "batch_id").agg(F.count(F.lit(1)).alias("n_rows"))


CTES["payment_versions"] = f"""
SELECT order_id, payment_sequential, batch_id, {TYPE_SQL} AS payment_type, payment_installments, {ABS_SQL} AS payment_value
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id, payment_sequential, batch_id
        ORDER BY payment_value DESC NULLS LAST, payment_type, payment_installments) AS rn
      FROM incoming_payments WHERE order_id IS NOT NULL) WHERE rn = 1"""


def payment_versions(t):
    """One healed row per payment and batch: the Silver log before latest-wins."""
    kept = keep_one(t.incoming("payments"), PAYS + ["batch_id"], pay_order())
    return heal.apply_steps(kept, heal.bronze_steps("payments"))


CUT = 200001


@query("upsert_latest_wins", f"""
WITH old AS (SELECT * EXCLUDE rn FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id, payment_sequential ORDER BY batch_id DESC) AS rn
  FROM payment_versions WHERE batch_id < {CUT}) WHERE rn = 1),
new AS (SELECT * EXCLUDE rn FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id, payment_sequential ORDER BY batch_id DESC) AS rn
  FROM payment_versions WHERE batch_id >= {CUT}) WHERE rn = 1)
SELECT * FROM new UNION ALL BY NAME
SELECT * FROM old WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.order_id = old.order_id AND new.payment_sequential = old.payment_sequential)""")
def upsert_latest_wins(t):
    """The store up to 1999 with all later batches merged in."""
    log = payment_versions(t)
    history = store.latest_view(log.where(F.col("batch_id") < CUT), PAYS)
    batch = store.latest_view(log.where(F.col("batch_id") >= CUT), PAYS)
    return store.upsert(history, batch, PAYS)


@query("revenue_growth", """
WITH b AS (SELECT DISTINCT batch_id AS upto FROM payment_versions),
s AS (SELECT upto, order_id, payment_sequential, arg_max(payment_value, batch_id) AS v
      FROM b JOIN payment_versions p ON p.batch_id <= b.upto GROUP BY ALL),
g AS (SELECT upto AS batch_id, SUM(v) AS total, COUNT(*) AS silver_rows FROM s GROUP BY upto)
SELECT batch_id, ROUND(total - COALESCE(LAG(total) OVER (ORDER BY batch_id), 0.0), 2) AS revenue_change,
       ROUND(total, 2) AS total_revenue, silver_rows FROM g""")
def revenue_growth(t):
    """Gold revenue after every batch, from changes rather than repeated recomputation."""
    raw = t.incoming("payments").where(has_key(PAYS))
    versions = raw.groupBy(*PAYS, "batch_id").agg(F.max("payment_value").alias("v")).withColumn(
        "v", non_negative(F.col("v"), "abs"))
    return store.running_total(versions, PAYS, "v")


def _latest_sql(dataset):
    keys = ", ".join(SPECS[dataset].key)
    new = dict(HEALED[dataset])
    if dataset == "orders":
        new["customer_id"] = "COALESCE(customer_id, 'UNKNOWN')"
    order = {"customers": "load_seq DESC", "orders": "load_seq DESC", "products": "product_id",
             "payments": "payment_value DESC NULLS LAST, payment_type, payment_installments"}[dataset]
    return f"""SELECT {replaced(dataset, **new)} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn
  FROM dirty_{dataset} WHERE {SPECS[dataset].record_id} IS NOT NULL) WHERE rn = 1"""


for _d in SPECS:
    CTES[f"refined_{_d}"] = _latest_sql(_d)


def refined(t, dataset):
    return medallion.refine(t.raw(dataset), SPECS[dataset], PREFER[dataset])


@query("gold_recompute", _kpi_sql(lambda d: f"refined_{d}", COLUMNS))
def gold_recompute(t):
    """Gold KPIs from the full, cleaned Silver of every dataset."""
    return profile.union_all([gold.kpi_rows(d, refined(t, d).silver) for d in SPECS])


@query("union_quarantine", """
SELECT 'customers' AS dataset, *, 'unfixable_null_primary_key' AS quarantine_reason FROM dirty_customers WHERE customer_id IS NULL
UNION ALL BY NAME SELECT 'orders' AS dataset, *, 'unfixable_null_primary_key' AS quarantine_reason FROM dirty_orders WHERE order_id IS NULL
UNION ALL BY NAME SELECT 'payments' AS dataset, *, 'unfixable_null_primary_key' AS quarantine_reason FROM dirty_payments WHERE order_id IS NULL
UNION ALL BY NAME SELECT 'products' AS dataset, *, 'unfixable_null_primary_key' AS quarantine_reason FROM dirty_products WHERE product_id IS NULL""")
def union_quarantine(t):
    return store.append_with_missing([
        refined(t, d).quarantine.withColumn("dataset", F.lit(d)) for d in SPECS])


CTES["layer_rows"] = " UNION ALL ".join(
    f"SELECT 'bronze' AS layer, '{d}' AS dataset, COUNT(*) AS n_rows FROM dirty_{d} "
    f"UNION ALL SELECT 'silver', '{d}', COUNT(*) FROM refined_{d} "
    f"UNION ALL SELECT 'quarantine', '{d}', COUNT(*) FROM dirty_{d} WHERE {SPECS[d].record_id} IS NULL" for d in SPECS)


def layer_rows(t):
    """Silver has one row per usable key: one grouping of the keys gives all three layers."""
    return profile.union_all([store.keyed_layers(t.raw(d), d, s.key) for d, s in SPECS.items()])


@query("layer_counts", "SELECT * FROM layer_rows")
def layer_counts(t):
    return layer_rows(t)


@query("layer_funnel", "SELECT layer, CAST(SUM(n_rows) AS BIGINT) AS n_rows FROM layer_rows GROUP BY layer")
def layer_funnel(t):
    return store.layer_funnel(layer_rows(t))


@query("quality_pct", """
SELECT dataset, CAST(SUM(n_rows) FILTER (layer = 'bronze') AS BIGINT) AS bronze_rows,
  CAST(SUM(n_rows) FILTER (layer = 'silver') AS BIGINT) AS silver_rows,
  CAST(SUM(n_rows) FILTER (layer = 'quarantine') AS BIGINT) AS quarantine_rows,
  ROUND(CAST(SUM(n_rows) FILTER (layer = 'silver') AS DOUBLE) * 100.0 / SUM(n_rows) FILTER (layer = 'bronze'), 1) AS quality_pct
FROM layer_rows GROUP BY dataset""")
def quality_pct(t):
    return store.quality_pct(layer_rows(t))


# --- batch history -------------------------------------------------------------


def _history_sql(dataset):
    clean = " AND ".join(f"{c} IS NOT NULL" for c in NULL_RULED[dataset])
    conds = [cond for *_, cond in _NEEDS[dataset]] + [f"{SPECS[dataset].record_id} IS NULL"]
    some = " + ".join(f"(COUNT(*) FILTER ({c}) > 0)::BIGINT" for c in conds)
    rows = " + ".join(f"COUNT(*) FILTER ({c})" for c in conds)
    return f"""SELECT *, CASE WHEN ROUND(CAST(clean_rows AS DOUBLE) * 100.0 / raw_rows, 2) >= 95.0
  THEN 'SUCCESS' ELSE 'ESCALATED' END AS status FROM (
  SELECT '{dataset}' AS dataset, batch_id, COUNT(*) AS raw_rows, COUNT(*) FILTER ({clean}) AS clean_rows,
    COUNT(*) - COUNT(*) FILTER ({clean}) AS quarantine_rows, {some} AS heal_events, {rows} AS healed_rows
  FROM incoming_{dataset} GROUP BY batch_id)"""


CTES["batch_log"] = " UNION ALL ".join(_history_sql(d) for d in SPECS)


def batch_log(t):
    return profile.union_all([medallion.batch_history(t.incoming(d), s) for d, s in SPECS.items()])


@query("batch_summary", "SELECT * FROM batch_log")
def batch_summary(t):
    return batch_log(t)


@query("batch_quality_trend", """
SELECT dataset, batch_id, ROUND(CAST(clean_rows AS DOUBLE) * 100.0 / raw_rows, 1) AS pass_pct,
  ROUND(CAST(quarantine_rows AS DOUBLE) * 100.0 / raw_rows, 1) AS quarantine_pct,
  ROUND(100.0::DOUBLE - ROUND(CAST(quarantine_rows AS DOUBLE) * 100.0 / raw_rows, 1), 1) AS retention_pct,
  CASE WHEN status = 'SUCCESS' THEN 100.0::DOUBLE ELSE 0.0::DOUBLE END AS heal_success_pct
FROM batch_log""")
def batch_quality_trend(t):
    return medallion.quality_trend(batch_log(t))


@query("run_status", "SELECT dataset, status, COUNT(*) AS batches FROM batch_log GROUP BY dataset, status")
def run_status(t):
    return batch_log(t).groupBy("dataset", "status").agg(F.count(F.lit(1)).alias("batches"))


@query("history_retention", "SELECT * FROM batch_log ORDER BY batch_id DESC, dataset LIMIT 50")
def history_retention(t):
    return ops.most_recent(batch_log(t), 50, F.desc("batch_id"), F.asc("dataset"))


# --- heal analytics --------------------------------------------------------------


def batch_heals(t):
    return heal_log(t, ("batch_id",))


@query("heals_by_layer", """
SELECT layer, COUNT(*) AS heal_events, CAST(SUM(healed_rows) AS BIGINT) AS healed_rows FROM batch_heal_log GROUP BY layer""")
def heals_by_layer(t):
    return ops.heals_by(batch_heals(t), "layer")


@query("heals_by_batch", """
SELECT batch_id, layer, COUNT(*) AS heal_events, CAST(SUM(healed_rows) AS BIGINT) AS healed_rows
FROM batch_heal_log GROUP BY batch_id, layer""")
def heals_by_batch(t):
    return ops.heals_by(batch_heals(t), "batch_id", "layer")


@query("heal_top_columns", """
SELECT column_name, layer, CAST(SUM(healed_rows) AS BIGINT) AS healed_rows FROM batch_heal_log
GROUP BY column_name, layer ORDER BY healed_rows DESC, column_name, layer LIMIT 20""")
def heal_top_columns(t):
    return ops.top_healed_columns(batch_heals(t))


@query("heal_error_types", """
SELECT issue, COUNT(*) AS heal_events, CAST(SUM(healed_rows) AS BIGINT) AS healed_rows FROM batch_heal_log GROUP BY issue""")
def heal_error_types(t):
    return ops.heals_by(batch_heals(t), "issue")


@query("recent_heals", """
SELECT * FROM batch_heal_log ORDER BY batch_id DESC, dataset, layer, column_name, issue LIMIT 50""")
def recent_heals(t):
    return ops.most_recent(batch_heals(t), 50, F.desc("batch_id"), F.asc("dataset"), F.asc("layer"),
                           F.asc("column_name"), F.asc("issue"))


# --- lineage, audit, reports -------------------------------------------------------


def _failed_sql(dataset):
    from siltgate.catalog.quality import suite_sql

    return f"(SELECT COUNT(*) FROM ({suite_sql(dataset, SPECS[dataset].rules)}) WHERE status != 'pass')"


CTES["run_totals"] = " UNION ALL ".join(
    f"SELECT '{d}' AS dataset, COUNT(*) AS raw_rows, COUNT(*) FILTER (quarantine_reason IS NULL) AS clean_rows, "
    f"COUNT(*) FILTER (quarantine_reason IS NOT NULL) AS quarantine_rows, {_failed_sql(d)} AS failed_rules "
    f"FROM tagged_{d}" for d in SPECS)


def run_totals(t):
    return profile.union_all([
        lineage.run_counts(t.raw(d), s, heal.bronze_steps(d)) for d, s in SPECS.items()])


_LAYERS = {"bronze": "b", "silver": "s", "quarantine": "q", "masked": "s", "gold": "g"}


@query("lineage_edges", f"""
WITH kpis AS (SELECT dataset, COUNT(*) AS g FROM ({_kpi_sql(lambda d: f"silver_{d}")}) GROUP BY dataset),
held AS (SELECT dataset, MAX(n_rows) FILTER (layer = 'bronze') AS b, MAX(n_rows) FILTER (layer = 'silver') AS s,
         MAX(n_rows) FILTER (layer = 'quarantine') AS q FROM layer_rows GROUP BY dataset)
""" + " UNION ALL ".join(
    f"SELECT 'run' AS run_id, dataset, '{a}' AS source_layer, '{b}' AS target_layer, {_LAYERS[a]} AS rows_in, {_LAYERS[b]} AS rows_out "
    "FROM held JOIN kpis USING (dataset)" for a, b in lineage.WRITES))
def lineage_edges(t):
    """Masked holds what Silver holds, and Gold a KPI row per key of its dataset; neither is computed to be counted."""
    rows = layer_rows(t)
    masked = rows.where("layer = 'silver'").withColumn("layer", F.lit("masked"))
    kpis = [(d, "gold", len(gold.KPI_KEYS[d])) for d in SPECS]
    given = t.spark.createDataFrame(kpis, "dataset string, layer string, n_rows bigint")
    return lineage.table_edges(rows.unionByName(masked).unionByName(given), "run")


def _column_edges_sql(dataset):
    fixes = {c: fix for c, _, fix, _ in _NEEDS[dataset]}
    parts = []
    for c in COLUMNS[dataset]:
        level = SPECS[dataset].pii.get(c, ("NONE",))[0]
        word = {"HIGH": "SHA-256 hash", "MEDIUM": "partial mask"}.get(level)
        text = " + ".join(x for x in (fixes.get(c), word) if x) or "pass-through"
        changed = (f"COUNT({c})" if word else
                   f"COUNT(*) FILTER ({c} IS DISTINCT FROM {HEALED[dataset][c]})" if c in HEALED[dataset]
                   else "COUNT(*) FILTER (FALSE)")
        parts.append(
            f"SELECT 'raw.{dataset}' AS source_table, '{c}' AS source_column, '{text}' AS transform, "
            f"'masked.{dataset}' AS target_table, '{c}' AS target_column, {changed} AS rows_changed FROM dirty_{dataset}")
    return " UNION ALL ".join(parts)


@query("lineage_columns", " UNION ALL ".join(_column_edges_sql(d) for d in SPECS))
def lineage_columns(t):
    return profile.union_all([
        lineage.column_edges(t.raw(d), s, heal.bronze_steps(d)) for d, s in SPECS.items()])


_AUDIT_SQL = """
WITH e AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY dataset ORDER BY layer, column_name, issue) AS i,
           COUNT(*) OVER (PARTITION BY dataset) AS heal_count FROM heal_log),
h AS (SELECT dataset, COUNT(*) AS heal_count FROM heal_log GROUP BY dataset)
SELECT 'run-' || dataset || '-heal-' || i AS audit_id, 'run' AS run_id, dataset, layer AS node_name, issue AS error_type,
  healed_rows || ' rows in ' || column_name AS error_message, fix AS fix_applied, 'HEALED' AS pipeline_status,
  clean_rows, quarantine_rows, raw_rows, heal_count FROM e JOIN run_totals USING (dataset)
UNION ALL SELECT 'run-' || dataset || '-summary', 'run', dataset, 'PIPELINE_SUMMARY', 'none', '', 'completed',
  CASE WHEN clean_rows > 0 THEN 'SUCCESS' ELSE 'ESCALATED' END, clean_rows, quarantine_rows, raw_rows,
  COALESCE(heal_count, 0) FROM run_totals LEFT JOIN h USING (dataset)"""


@query("audit_rows", _AUDIT_SQL)
def audit_rows(t):
    return lineage.audit_rows(heal_log(t), run_totals(t), "run")


def appended(t, layer, name, tables):
    """Each dataset's rows written and committed to a store, the whole batch replayed once, and read back."""
    st, out = store.Store(Layers(scratch_folder(t.spark))), []
    for d, df in tables.items():
        for _ in range(2):
            attempt = st.begin(t.spark, SPECS[d], 0)
            attempt.put(layer, df, name(d))
            attempt.commit()
        out.append(st.read(t.spark, layer, SPECS[d], name(d)).drop("batch_id").withColumn("dataset", F.lit(d)))
    return store.append_with_missing(out)


@query("audit_log_append", _AUDIT_SQL)
def audit_log_append(t):
    """The audit log as a store holds it: a replay takes the place of a batch's rows and appends nothing twice."""
    rows = materialise(audit_rows(t))
    return appended(t, "audit", lambda d: f"audit_{d}", {d: rows.where(F.col("dataset") == d) for d in SPECS})


@query("quarantine_append", " UNION ALL BY NAME ".join(
    f"SELECT '{d}' AS dataset, batch_id AS arrived, *, 'unfixable_null_primary_key' AS quarantine_reason "
    f"FROM (SELECT * FROM incoming_{d}) WHERE {' OR '.join(f'{c} IS NULL' for c in SPECS[d].key)}" for d in SPECS).replace(
        "batch_id AS arrived, *", "batch_id AS arrived, * EXCLUDE (batch_id)"))
def quarantine_append(t):
    """Rows without a usable key, as the quarantine of a store holds them."""
    return appended(t, "quarantine", lambda d: d, {
        d: t.incoming(d).where(~has_key(s.key)).withColumnRenamed("batch_id", "arrived").withColumn(
            route.REASON, F.lit(route.NULL_KEY)) for d, s in SPECS.items()})


def _shape_sql(dataset):
    shape = ", ".join(f"CASE WHEN COUNT({c}) > 0 THEN '{c}' END" for c in COLUMNS[dataset])
    return (f"SELECT '{dataset}' AS dataset, batch_id, COUNT(*) AS n_rows, concat_ws(',', {shape}) AS shape "
            f"FROM incoming_{dataset} GROUP BY batch_id")


_EXCEPT = "array_to_string(list_filter(string_split({a}, ','), lambda x: NOT list_contains(string_split({b}, ','), x)), ',')"


@query("drift_trend", f"""
WITH shapes AS ({' UNION ALL '.join(_shape_sql(d) for d in SPECS)}),
marked AS (SELECT *, LAG(shape) OVER (PARTITION BY dataset ORDER BY batch_id) AS prior FROM shapes),
numbered AS (SELECT *, SUM(CASE WHEN shape = prior THEN 0 ELSE 1 END) OVER (PARTITION BY dataset ORDER BY batch_id) AS segment FROM marked),
folded AS (SELECT dataset, CAST(segment AS BIGINT) AS segment, MIN(batch_id) AS first_batch, MAX(batch_id) AS last_batch,
  COUNT(*) AS batches, CAST(SUM(n_rows) AS BIGINT) AS n_rows, arg_min(shape, batch_id) AS shape, arg_min(COALESCE(prior, ''), batch_id) AS prior
  FROM numbered GROUP BY dataset, segment)
SELECT dataset, segment, first_batch, last_batch, batches, n_rows, {_EXCEPT.format(a='shape', b='prior')} AS added,
  {_EXCEPT.format(a='prior', b='shape')} AS removed FROM folded""")
def drift_trend(t):
    """When the columns that hold values changed, over all batches of the four datasets."""
    return drift.trend(profile.union_all([drift.batch_shapes(t.incoming(d), d) for d in SPECS]))


@query("stage_status", """
SELECT dataset, layer, n_rows, CASE WHEN n_rows > 0 THEN 'filled' WHEN layer = 'quarantine' THEN 'nothing held back'
  ELSE 'empty' END AS status FROM layer_rows""")
def stage_status(t):
    return lineage.stage_status(layer_rows(t))


@query("run_report", """
SELECT r.*, COALESCE(heal_events, 0) AS heal_events, COALESCE(healed_rows, 0) AS healed_rows,
  COALESCE(drift_events, 0) AS drift_events, COALESCE(masked_columns, 0) AS masked_columns
FROM run_totals r
LEFT JOIN (SELECT dataset, COUNT(*) AS heal_events, CAST(SUM(healed_rows) AS BIGINT) AS healed_rows FROM heal_log GROUP BY 1) USING (dataset)
LEFT JOIN (SELECT dataset, COUNT(*) AS drift_events FROM schema_changes GROUP BY 1) USING (dataset)
LEFT JOIN (SELECT dataset, COUNT(*) FILTER (action IN ('SHA256', 'PARTIAL_MASK')) AS masked_columns FROM masking_log GROUP BY 1) USING (dataset)""")
def run_report(t):
    return lineage.run_report(run_totals(t), heal_log(t), all_drift(t), _logs(t))


@query("audit_variant_extract", """
SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(value AS DOUBLE) AS amount FROM events""")
def audit_variant_extract(t):
    """Fold open fields into a variant payload and read them back."""
    events = t.table("events").select("event_id", "event_type", F.parse_json("props").alias("props"), "value")
    records = lineage.as_records(events, ["props", "value"])
    return records.select(
        "event_id", "event_type", F.try_variant_get("payload", "$.props.k", "bigint").alias("k"),
        F.try_variant_get("payload", "$.value", "double").alias("amount"))


# --- usage and decisions -------------------------------------------------------------


@query("usage_cost", """
SELECT conv_id, turn, role, p AS prompt_tokens, c AS completion_tokens, ROUND(p * 5.9e-07 + c * 7.9e-07, 10) AS cost_usd
FROM (SELECT conv_id, turn, role, CASE WHEN role = 'assistant' THEN 0 ELSE length(text) // 4 END AS p,
        CASE WHEN role = 'assistant' THEN length(text) // 4 ELSE 0 END AS c FROM conversations)""")
def usage_cost(t):
    return ops.turn_costs(t.table("conversations"))


CTES["usage_rows"] = """
SELECT event_type AS node, CAST(ts AS DATE) AS usage_day, CAST(FLOOR(value) AS BIGINT) AS prompt_tokens,
       CAST(json_extract(props, '$.k') AS BIGINT) AS completion_tokens FROM events"""


def _cost_sql(by, extra=""):
    return f"""SELECT *, ROUND(prompt_tokens * 5.9e-07 + completion_tokens * 7.9e-07, 8) AS cost_usd{extra} FROM (
  SELECT {by}, COUNT(*) AS calls, CAST(SUM(prompt_tokens) AS BIGINT) AS prompt_tokens,
    CAST(SUM(completion_tokens) AS BIGINT) AS completion_tokens FROM usage_rows GROUP BY {by})"""


@query("usage_by_node", _cost_sql("usage_day, node"))
def usage_by_node(t):
    return ops.cost_by(ops.usage_of(t.table("events")), "usage_day", "node")


@query("usage_daily_budget", _cost_sql(
    "usage_day", ", ROUND(prompt_tokens * 5.9e-07 + completion_tokens * 7.9e-07, 8) > 2.0 AS over_budget"))
def usage_daily_budget(t):
    return ops.daily_budget(ops.usage_of(t.table("events")))


@query("approval_latest", """
SELECT user_id, event_type, event_id, ts, CASE WHEN value < 20 THEN 'PENDING' WHEN value < 60 THEN 'APPROVED' ELSE 'REJECTED' END AS decision
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def approval_latest(t):
    """Latest decision per (run, stage); users stand for runs, event types for stages."""
    v = F.col("value")
    log = t.table("events").select(
        "user_id", "event_type", "event_id", "ts",
        F.when(v < 20, "PENDING").when(v < 60, "APPROVED").otherwise("REJECTED").alias("decision"))
    return ops.latest_decision(log, ["user_id", "event_type"], "ts", "event_id")


@query("approval_pending", """
SELECT user_id, event_type, event_id, ts, 'PENDING' AS decision
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1 AND value < 20""")
def approval_pending(t):
    return ops.pending(approval_latest(t))


@query("incident_remember", """
SELECT 'fix_' || sha256(text) AS memory_id, arg_min(doc_id, doc_id) AS doc_id, arg_min(source, doc_id) AS source,
       arg_min(lang, doc_id) AS lang, COUNT(*) AS seen FROM documents GROUP BY 1""")
def incident_remember(t):
    return ops.remember(t.table("documents"), "text", "doc_id", "source", "lang")


RECALL_AT = 1.25


@query("incident_recall", f"""
WITH d AS (SELECT q.vec_id AS q, m.vec_id AS m, m.label AS label,
  list_sum(list_transform(list_zip(q.embedding, m.embedding), lambda p: (p[1]::DOUBLE - p[2]::DOUBLE) * (p[1]::DOUBLE - p[2]::DOUBLE))) AS dist
  FROM embeddings q JOIN embeddings m ON m.vec_id < q.vec_id),
b AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY q ORDER BY dist, m) AS rn FROM d)
SELECT q AS new_id, m AS memory_id, ROUND(dist, 6) AS distance, label AS recalled_fix FROM b WHERE rn = 1 AND dist < {RECALL_AT}""")
def incident_recall(t):
    """Every incident against all earlier ones; the stored label is the recalled fix."""
    table = t.table("embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), "label")
    found = recall.recall(table, table, RECALL_AT, earlier_only=True)
    fixes = table.select(F.col("id").alias("memory_id"), F.col("label").alias("recalled_fix"))
    return found.join(fixes, "memory_id").select(
        "new_id", "memory_id", F.round("distance", 6).alias("distance"), "recalled_fix")
