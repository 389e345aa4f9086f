"""Routing, quarantine, dedup, repairs and scalar families."""

from pyspark.sql import functions as F

from siltgate.catalog.registry import CTES, query, texts
from siltgate.catalog.silver_gold import _COLUMNS as COLUMNS
from siltgate.functions import columns as C
from siltgate.operators import dedup, heal, profile, route
from siltgate.plans import medallion, silver
from siltgate.spec import (
    CUSTOMERS, ORDER_STATUSES, ORDERS, PAYMENT_TYPES, PAYMENTS, SPECS, STATES, between, in_set,
    not_null,
)

STATE_SQL = (f"CASE WHEN UPPER(TRIM(customer_state)) IN ({texts(STATES)}) "
             "THEN UPPER(TRIM(customer_state)) ELSE 'UNKNOWN' END")
CITY_SQL = "COALESCE(LOWER(TRIM(customer_city)), 'unknown')"
STATUS_SQL = (f"CASE WHEN LOWER(order_status) IN ({texts(ORDER_STATUSES)}) "
              "THEN LOWER(order_status) ELSE 'unknown' END")
TYPE_SQL = (f"CASE WHEN LOWER(TRIM(payment_type)) IN ({texts(PAYMENT_TYPES)}) "
            "THEN LOWER(TRIM(payment_type)) ELSE 'boleto' END")
ABS_SQL = "ABS(COALESCE(payment_value, 0.0))"
SENTINEL = "'1970-01-01 00:00:00'"
PAY_ORDER = "payment_value DESC NULLS LAST, payment_type, payment_installments"


def pay_order():
    return [F.col("payment_value").desc_nulls_last(), F.col("payment_type").asc_nulls_last(),
            F.col("payment_installments").asc()]


def replaced(dataset, **new):
    """A select list of a dataset with some columns replaced."""
    return ", ".join(f"{new[c]} AS {c}" if c in new else c for c in COLUMNS[dataset])


# --- routing -----------------------------------------------------------------

HEALED = {
    "customers": {"customer_state": STATE_SQL, "customer_city": CITY_SQL},
    "orders": {"order_status": STATUS_SQL, **{
        c: f"COALESCE({c}, {SENTINEL})" for c in (
            "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date")}},
    "payments": {"payment_value": ABS_SQL, "payment_type": TYPE_SQL},
    "products": {"product_category_name": "COALESCE(product_category_name, 'unknown')", **{
        c: f"ABS(COALESCE({c}, 0.0))" for c in (
            "product_name_lenght", "product_photos_qty", "product_weight_g", "product_length_cm")}},
}
NULL_RULED = {
    "customers": ("customer_id", "customer_state"), "orders": ("order_id", "customer_id"),
    "payments": ("order_id", "payment_value"), "products": ("product_id",),
}
for _d, _cols in NULL_RULED.items():
    _why = ", ".join(f"CASE WHEN {c} IS NULL THEN 'not_null({c})' END" for c in _cols)
    CTES[f"tagged_{_d}"] = (
        f"SELECT {replaced(_d, **HEALED[_d])}, NULLIF(concat_ws('; ', {_why}), '') AS quarantine_reason, batch_id "
        f"FROM incoming_{_d}")


@query("route_clean", "SELECT * EXCLUDE (quarantine_reason, batch_id) FROM tagged_payments WHERE quarantine_reason IS NULL")
def route_clean(t):
    return route.clean(route.tag(t.payments, PAYMENTS.rules, heal.bronze_steps("payments")))


@query("route_quarantine", f"""
SELECT * FROM (SELECT order_id, payment_sequential, payment_type, payment_installments, payment_value,
  NULLIF(concat_ws('; ', CASE WHEN order_id IS NULL THEN 'not_null(order_id)' END,
    CASE WHEN payment_value IS NULL THEN 'not_null(payment_value)' END,
    CASE WHEN payment_value < 0 OR payment_value > 999999 THEN 'between(payment_value)' END,
    CASE WHEN payment_type NOT IN ({texts(PAYMENT_TYPES)}) THEN 'in_set(payment_type)' END), '') AS quarantine_reason
FROM dirty_payments) WHERE quarantine_reason IS NOT NULL""")
def route_quarantine(t):
    return route.quarantine(route.tag(t.payments, PAYMENTS.rules))


def _null_key_sql(dataset):
    return f"""SELECT '{dataset}' AS dataset, COUNT(*) AS quarantined_rows, 'unfixable_null_primary_key' AS quarantine_reason
FROM dirty_{dataset} WHERE {SPECS[dataset].record_id} IS NULL"""


@query("quarantine_null_key", " UNION ALL ".join(_null_key_sql(d) for d in SPECS))
def quarantine_null_key(t):
    return profile.union_all([
        route.null_key_rows(t.raw(d), s.record_id).groupBy(route.REASON)
        .agg(F.count(F.lit(1)).alias("quarantined_rows"))
        .select(F.lit(d).alias("dataset"), "quarantined_rows", route.REASON)
        for d, s in SPECS.items()])


@query("quarantine_after_rules", f"""
SELECT {replaced('orders', **HEALED['orders'])}, 'null_primary_key_after_silver_heal' AS quarantine_reason
FROM dirty_orders WHERE order_id IS NULL""")
def quarantine_after_rules(t):
    """Rows whose id is still missing after rules that do not fill the id have run."""
    rules = [r for r in ORDERS.rules if r.column not in ORDERS.key and r.column != "customer_id"]
    healed = heal.heal_by_rules(heal.apply_steps(t.orders, heal.bronze_steps("orders")), rules)
    return route.null_key_rows(healed, "order_id", route.NULL_KEY_AFTER_RULES)


@query("quarantine_sql", f"""
SELECT customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state,
       'null_customer_id_or_invalid_state' AS quarantine_reason
FROM dirty_customers WHERE customer_id IS NULL OR customer_state NOT IN ({texts(STATES + ('UNKNOWN',))})""")
def quarantine_sql(t):
    return route.sql_quarantine(t.customers)


# --- dedup -------------------------------------------------------------------


def _rank_sql(dataset, key, order):
    cols = ", ".join(COLUMNS[dataset])
    return f"""SELECT {cols} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY {order}) AS rn
  FROM dirty_{dataset} WHERE {' AND '.join(f'{k} IS NOT NULL' for k in key.split(', '))}) WHERE rn = 1"""


@query("dedup_first", _rank_sql("customers", "customer_id", "load_seq"))
def dedup_first(t):
    return dedup.keep_first(t.customers, ["customer_id"])


@query("dedup_last", _rank_sql("payments", "order_id, payment_sequential", PAY_ORDER))
def dedup_last(t):
    return dedup.keep_one(t.payments, ["order_id", "payment_sequential"], pay_order())


@query("dedup_full_row", "SELECT DISTINCT * EXCLUDE (load_seq) FROM dirty_customers")
def dedup_full_row(t):
    return dedup.distinct_rows(t.customers, ignore=("load_seq",))


# --- column repairs ----------------------------------------------------------


@query("fill_nulls_by_type", "SELECT " + ", ".join(
    f"COALESCE({c}, {'0' if c.startswith('product_') and c not in ('product_id', 'product_category_name') else repr('UNKNOWN')}) AS {c}"
    for c in COLUMNS["products"]) + " FROM dirty_products")
def fill_nulls_by_type(t):
    return heal.fill_nulls_by_type(t.products)


def _one(t, dataset, steps):
    return heal.apply_steps(t.raw(dataset), steps)


@query("heal_state", f"SELECT {replaced('customers', customer_state=STATE_SQL)} FROM dirty_customers")
def heal_state(t):
    return _one(t, "customers", [heal.state_step(aliases=True)])


@query("heal_city", f"SELECT {replaced('customers', customer_city=CITY_SQL)} FROM dirty_customers")
def heal_city(t):
    return _one(t, "customers", [heal.city_step()])


@query("heal_status", f"SELECT {replaced('orders', order_status=STATUS_SQL)} FROM dirty_orders")
def heal_status(t):
    return _one(t, "orders", [heal.status_step()])


@query("heal_ts_sentinel", "SELECT " + replaced("orders", **{
    c: v for c, v in HEALED["orders"].items() if c != "order_status"}) + " FROM dirty_orders")
def heal_ts_sentinel(t):
    return _one(t, "orders", heal.bronze_steps("orders")[1:])


@query("parse_timestamps", "SELECT order_id, load_seq, " + ", ".join(
    f"TRY_CAST({c} AS TIMESTAMP) AS {c}" for c in silver.ORDER_TIMES) + " FROM dirty_orders")
def parse_timestamps(t):
    return t.orders.select(
        "order_id", "load_seq", *[C.to_timestamp(F.col(c)).alias(c) for c in silver.ORDER_TIMES])


@query("heal_value_abs", f"SELECT {replaced('payments', payment_value=ABS_SQL)} FROM dirty_payments")
def heal_value_abs(t):
    return _one(t, "payments", [heal.value_step(policy="abs")])


@query("heal_value_clamp", "SELECT " + replaced(
    "payments", payment_value="GREATEST(COALESCE(payment_value, 0.0), 0.0)") + " FROM dirty_payments")
def heal_value_clamp(t):
    return _one(t, "payments", [heal.value_step(policy="zero")])


@query("heal_payment_type", f"SELECT {replaced('payments', payment_type=TYPE_SQL)} FROM dirty_payments")
def heal_payment_type(t):
    return _one(t, "payments", [heal.payment_type_step()])


@query("heal_product_numerics", "SELECT " + replaced("products", **{
    c: v for c, v in HEALED["products"].items() if c != "product_category_name"}) + " FROM dirty_products")
def heal_product_numerics(t):
    return _one(t, "products", heal.bronze_steps("products")[1:])


@query("heal_product_nulls", "SELECT " + replaced("products", **{
    c: f"COALESCE({c}, 0.0)" for c in HEALED["products"] if c != "product_category_name"}) + " FROM dirty_products")
def heal_product_nulls(t):
    return _one(t, "products", [heal.null_to_zero_step(c) for c in HEALED["products"]
                                if c != "product_category_name"])


# --- rule-driven -------------------------------------------------------------


@query("heal_rule_not_null", "SELECT " + replaced(
    "orders", customer_id="COALESCE(customer_id, 'UNKNOWN')", order_status="COALESCE(order_status, 'UNKNOWN')")
    + " FROM dirty_orders")
def heal_rule_not_null(t):
    return heal.heal_by_rules(t.orders, [not_null("customer_id"), not_null("order_status")])


_MODE = f"""COALESCE((SELECT payment_type FROM dirty_payments WHERE payment_type IN ({texts(PAYMENT_TYPES)})
  GROUP BY payment_type ORDER BY COUNT(*) DESC, payment_type LIMIT 1), 'boleto')"""


@query("heal_rule_mode", "SELECT " + replaced(
    "payments", payment_type=f"CASE WHEN payment_type IN ({texts(PAYMENT_TYPES)}) THEN payment_type ELSE {_MODE} END")
    + " FROM dirty_payments")
def heal_rule_mode(t):
    return heal.heal_by_rules(t.payments, [in_set("payment_type", PAYMENT_TYPES)])


@query("heal_rule_clamp", "SELECT " + replaced(
    "payments", payment_value="CASE WHEN payment_value IS NULL THEN NULL ELSE LEAST(GREATEST(payment_value, 0.0), 90000.0) END",
    payment_installments="LEAST(GREATEST(payment_installments, 2), 10)") + " FROM dirty_payments")
def heal_rule_clamp(t):
    return heal.heal_by_rules(
        t.payments, [between("payment_value", 0, 90000), between("payment_installments", 2, 10)])


@query("heal_from_checks", "SELECT " + replaced(
    "customers", customer_id="COALESCE(customer_id, 'UNKNOWN')",
    customer_state=STATE_SQL.replace("customer_state", "COALESCE(customer_state, 'UNKNOWN')")) + " FROM dirty_customers")
def heal_from_checks(t):
    """Find the failing rules, then repair exactly those columns."""
    from siltgate.operators.validate import failed_checks

    bad = {r["rule_id"] for r in failed_checks(t.customers, CUSTOMERS.rules).select("rule_id").collect()}
    return heal.heal_from_checks(t.customers, CUSTOMERS, [r for i, r in enumerate(CUSTOMERS.rules) if i in bad])


@query("repair_update", "SELECT " + replaced(
    "orders", order_status="CASE WHEN order_status IN ('pending', 'null') THEN lower('PROCESSING') ELSE order_status END",
    order_approved_at="CASE WHEN order_approved_at = 'not-a-date' THEN order_purchase_timestamp ELSE order_approved_at END")
    + " FROM dirty_orders")
def repair_update(t):
    return heal.repair(t.orders, [
        heal.RepairSpec("order_status", "lower('PROCESSING')", "order_status IN ('pending', 'null')"),
        heal.RepairSpec("order_approved_at", "order_purchase_timestamp", "order_approved_at = 'not-a-date'"),
    ])


@query("repair_delete", "SELECT * FROM dirty_payments WHERE NOT COALESCE(payment_value < 0 OR order_id IS NULL, FALSE)")
def repair_delete(t):
    return heal.repair(t.payments, [heal.DropSpec("payment_value < 0 OR order_id IS NULL")])


@query("heal_gold", """
SELECT payment_type, ABS(CASE WHEN v IS NULL THEN 0.0 ELSE v END) AS total_revenue,
       CASE WHEN r IS NULL OR isnan(r) OR isinf(r) THEN 0.0 ELSE r END AS refund_ratio
FROM (SELECT payment_type, ROUND(SUM(LEAST(payment_value, 0.0)), 2) AS v,
        ROUND(SUM(LEAST(payment_value, 0.0)) / NULLIF(SUM(CASE WHEN payment_type = 'cash' THEN 0.0 ELSE payment_value END), 0.0), 4) AS r
      FROM dirty_payments GROUP BY payment_type)""")
def heal_gold(t):
    """KPIs that need care: all-negative sums and ratios over an empty base."""
    refunds = F.sum(F.least(F.col("payment_value"), F.lit(0.0)))
    base = F.sum(F.when(F.col("payment_type") == "cash", 0.0).otherwise(F.col("payment_value")))
    kpis = t.payments.groupBy("payment_type").agg(
        F.round(refunds, 2).alias("total_revenue"),
        F.round(refunds / F.nullif(base, F.lit(0.0)), 4).alias("refund_ratio"))
    return heal.heal_gold(kpis)


# --- heal events -------------------------------------------------------------

_NEEDS = {
    "customers": [
        ("customer_state", "invalid or null state", "set to UNKNOWN",
         f"NOT COALESCE(UPPER(TRIM(customer_state)) IN ({texts(STATES + ('UNKNOWN',))}), FALSE)"),
        ("customer_city", "null city", "filled unknown", "customer_city IS NULL")],
    "orders": [
        ("order_status", "invalid or null status", "set to unknown",
         f"NOT COALESCE(LOWER(order_status) IN ({texts(ORDER_STATUSES + ('unknown',))}), FALSE)")] + [
        (c, "null timestamp", "filled sentinel", f"{c} IS NULL") for c in (
            "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date")],
    "payments": [
        ("payment_value", "negative or null value", "abs or 0", "COALESCE(payment_value < 0, TRUE)"),
        ("payment_type", "invalid or null type", "set to boleto",
         f"NOT COALESCE(LOWER(TRIM(payment_type)) IN ({texts(PAYMENT_TYPES)}), FALSE)")],
    "products": [
        ("product_category_name", "null category", "filled unknown", "product_category_name IS NULL")] + [
        (c, "negative or null value", "abs or 0", f"COALESCE({c} < 0, TRUE)") for c in (
            "product_name_lenght", "product_photos_qty", "product_weight_g", "product_length_cm")],
}


#: Which of a key's rows is the newest: the stated columns, then all others by value.
PREFER = {
    "customers": (("load_seq", "desc"),), "orders": (("load_seq", "desc"),), "products": (),
    "payments": (("payment_value", "desc"), ("payment_type", "asc"), ("payment_installments", "asc")),
}


def _events_sql(dataset, by):
    cols, stated = SPECS[dataset].key, dict(PREFER[dataset])
    order = [f"{c} {'DESC' if d == 'desc' else 'ASC'} NULLS LAST" for c, d in stated.items()]
    order += [f"{c} ASC NULLS LAST" for c in COLUMNS[dataset] if c not in stated and c not in cols]
    lead, group = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    keyed = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    newest = (f"(SELECT *, {keyed} AS keyed, CASE WHEN {keyed} THEN ROW_NUMBER() OVER (PARTITION BY {lead}{', '.join(cols)} "
              f"ORDER BY {', '.join(order)}) END AS rn FROM incoming_{dataset})")
    rows = [("BRONZE", c, issue, fix, f"rn = 1 AND ({cond})") for c, issue, fix, cond in _NEEDS[dataset]]
    rows += [("BRONZE", "+".join(cols), "null key", "quarantined", "NOT keyed"),
             ("BRONZE", "+".join(cols), "duplicate rows", "kept last occurrence", "rn > 1")]
    if dataset == "orders":
        rows.append(("SILVER", "customer_id", "nulls after first pass", "filled UNKNOWN/0", "rn = 1 AND customer_id IS NULL"))
    parts = [f"SELECT {lead}'{layer}' AS layer, '{dataset}' AS dataset, '{c}' AS column_name, '{issue}' AS issue, "
             f"'{fix}' AS fix, COUNT(*) FILTER ({cond}) AS healed_rows FROM {newest}{group}"
             for layer, c, issue, fix, cond in rows]
    return " UNION ALL ".join(f"SELECT * FROM ({p}) WHERE healed_rows > 0" for p in parts)


CTES["heal_log"] = " UNION ALL ".join(_events_sql(d, "") for d in SPECS)
CTES["batch_heal_log"] = " UNION ALL ".join(_events_sql(d, "batch_id") for d in SPECS)


def heal_log(t, by=()):
    """All Bronze and Silver heal events of the four datasets, repairs counted on the rows that deduplication keeps."""
    parts = []
    for d, s in SPECS.items():
        raw = t.incoming(d)
        keys = [*by, *s.key]
        latest = dedup.keep_one(raw.where(dedup.has_key(s.key)), keys, medallion.total_order(raw, keys, PREFER[d]))
        parts.append(heal.batch_events(raw, latest, heal.bronze_steps(d), s.rules, dataset=d, keys=s.key, by=by))
    return profile.union_all(parts)


@query("heal_events", "SELECT * FROM heal_log")
def heal_events(t):
    return heal_log(t)


# --- scalar families ---------------------------------------------------------


@query("scalar_string", """
SELECT customer_email, load_seq, upper(customer_city) AS up, lower(customer_state) AS low, trim(customer_city) AS trimmed,
  left(customer_email, 6) || '...' AS prefix, repeat('*', CAST(length(customer_unique_id) AS INT)) AS stars,
  instr(customer_email, '@') AS at_position, substr(customer_phone, 5, 2) AS area,
  regexp_matches(customer_email, '^user[0-9]+5@') AS ends_in_five,
  CASE upper(trim(customer_state)) WHEN 'S' THEN 'SP' ELSE upper(trim(customer_state)) END AS aliased,
  sha256(customer_email) AS digest
FROM dirty_customers""")
def scalar_string(t):
    city, state, mail = F.col("customer_city"), F.col("customer_state"), F.col("customer_email")
    code = F.upper(F.trim(state))
    return t.customers.select(
        "customer_email", "load_seq", F.upper(city).alias("up"), F.lower(state).alias("low"),
        F.trim(city).alias("trimmed"), F.concat(F.left(mail, F.lit(6)), F.lit("...")).alias("prefix"),
        F.repeat(F.lit("*"), F.length("customer_unique_id")).alias("stars"),
        F.instr(mail, "@").cast("bigint").alias("at_position"),
        F.substring("customer_phone", 5, 2).alias("area"),
        mail.rlike("^user[0-9]+5@").alias("ends_in_five"),
        F.when(code == "S", "SP").otherwise(code).alias("aliased"),
        F.sha2(mail, 256).alias("digest"))


@query("scalar_math", """
SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice * l_discount, 4) AS discount_value,
  greatest(l_quantity, 10.0) AS at_least_ten, abs(l_quantity - 25.0) AS off_centre,
  nullif(l_tax, 0.0) AS taxed, try_cast(l_returnflag AS DOUBLE) AS flag_number,
  coalesce(nullif(l_discount, 0.0), l_tax) AS first_rate
FROM lineitem""")
def scalar_math(t):
    q, d = F.col("l_quantity"), F.col("l_discount")
    return t.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.round(F.col("l_extendedprice") * d, 4).alias("discount_value"),
        F.greatest(q, F.lit(10.0)).alias("at_least_ten"), F.abs(q - 25.0).alias("off_centre"),
        F.nullif(F.col("l_tax"), F.lit(0.0)).alias("taxed"),
        C.to_number(F.col("l_returnflag")).alias("flag_number"),
        F.coalesce(F.nullif(d, F.lit(0.0)), F.col("l_tax")).alias("first_rate"))


@query("scalar_date", """
SELECT event_id, CAST(ts AS DATE) AS event_day, date_trunc('month', ts) AS event_month,
  year(ts) * 100 + month(ts) AS month_number, hour(ts) AS event_hour, strftime(ts, '%Y-%m-%d %H:%M') AS shown
FROM events""")
def scalar_date(t):
    ts = F.col("ts")
    return t.table("events").select(
        "event_id", F.to_date(ts).alias("event_day"),
        F.date_trunc("month", ts).cast("timestamp_ntz").alias("event_month"),
        (F.year(ts) * 100 + F.month(ts)).cast("bigint").alias("month_number"),
        F.hour(ts).cast("bigint").alias("event_hour"),
        F.date_format(ts, "yyyy-MM-dd HH:mm").alias("shown"))
