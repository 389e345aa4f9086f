"""Profiles, inspection, rule suggestion, PII classes, drift and validation."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltgate.catalog.registry import CTES, query, texts
from siltgate.catalog.silver_gold import _COLUMNS as COLUMNS
from siltgate.operators import drift, pii, profile, validate
from siltgate.operators.profile import PATTERNS
from siltgate.sources import readers
from siltgate.spec import (
    BETWEEN, IN_SET, MATCH_REGEX, NOT_NULL, ORDER_STATUSES, PAYMENT_TYPES, SPECS, STATES, UNIQUE, between, custom, in_set, match_regex, not_null, unique,
)

TYPE_OF = {
    "customer_zip_code_prefix": "bigint", "load_seq": "int", "payment_sequential": "int",
    "payment_installments": "int", "payment_value": "double", "product_name_lenght": "double",
    "product_photos_qty": "double", "product_weight_g": "double", "product_length_cm": "double",
}


def _union(parts):
    return profile.union_all(list(parts))


def _tagged(dataset, df):
    return df.select(F.lit(dataset).alias("dataset"), "*")


# --- scans -------------------------------------------------------------------


@query("scan_typed", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders""")
def scan_typed(t):
    return readers.lower_names(t.table("orders"))


@query("scan_csv_typed", "SELECT *, CAST(NULL AS VARCHAR) AS _corrupt_record FROM dirty_payments")
def scan_csv_typed(t):
    """Rows written as CSV lines and read back under the declared types."""
    df = t.payments
    lines = df.select(F.to_csv(F.struct(*df.columns), {
        "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    }).alias("line"))
    return readers.parse_csv_lines(lines, "line", df.schema)


@query("sample_rows", "SELECT " + ", ".join(
    f"COALESCE(CAST({c} AS VARCHAR), '') AS {c}" for c in COLUMNS["customers"]
) + " FROM (SELECT * FROM dirty_customers ORDER BY customer_email, load_seq LIMIT 5)")
def sample_rows(t):
    return readers.sample_rows(t.customers, [F.col("customer_email"), F.col("load_seq")], 5)


SCHEMAS = {
    "customer": "c_custkey:int c_name:str c_nationkey:int c_acctbal:float c_mktsegment:str",
    "orders": "o_orderkey:int o_custkey:int o_orderstatus:str o_totalprice:float "
              "o_orderdate:timestamp o_orderpriority:str",
    "lineitem": "l_orderkey:int l_partkey:int l_suppkey:int l_linenumber:int l_quantity:float "
                "l_extendedprice:float l_discount:float l_tax:float l_returnflag:str "
                "l_linestatus:str l_shipdate:timestamp",
    "part": "p_partkey:int p_name:str p_brand:str p_type:str p_size:int p_retailprice:float",
    "supplier": "s_suppkey:int s_name:str s_nationkey:int s_acctbal:float",
    "events": "event_id:int ts:timestamp user_id:int event_type:str value:float props:str",
    "conversations": "conv_id:int turn:int role:str text:str",
    "region": "r_regionkey:int r_name:str",
    "nation": "n_nationkey:int n_name:str n_regionkey:int",
    "documents": "doc_id:int text:str lang:str source:str n_chars:int",
    "embeddings": "vec_id:int embedding:array<float> label:int",
    "pages": "page_id:int url:str html:str",
    "benchmark": "item_id:int text:str",
    "labels": "doc_id:int quality:int toxic:int",
}


@query("profile_schema", " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, '{c.split(':')[0]}' AS column_name, {i} AS position, "
    f"'{c.split(':')[1]}' AS type_family, COUNT({c.split(':')[0]}) AS non_null_rows FROM {table}"
    for table, cols in SCHEMAS.items() for i, c in enumerate(cols.split(), 1)))
def profile_schema(t):
    return _union(profile.schema_table(t.table(name), name) for name in SCHEMAS)


# --- profile -----------------------------------------------------------------


def _profile_sql(dataset, full):
    rows = []
    for i, c in enumerate(COLUMNS[dataset], 1):
        extra = (f", {i} AS position, '{TYPE_OF.get(c, 'string')}' AS data_type, COUNT(*) AS total_rows, "
                 f"COUNT(DISTINCT {c}) AS distinct_count") if full else ""
        rows.append(
            f"SELECT '{dataset}' AS dataset, '{c}' AS column_name, COUNT(*) - COUNT({c}) AS null_count, "
            f"ROUND(CAST(COUNT(*) - COUNT({c}) AS DOUBLE) * 100.0 / COUNT(*), 2) AS null_pct{extra} "
            f"FROM dirty_{dataset}")
    return " UNION ALL ".join(rows)


@query("profile_columns", " UNION ALL ".join(_profile_sql(d, True) for d in COLUMNS))
def profile_columns(t):
    return _union(_tagged(d, profile.profile(df)) for d, df in t.all_raw().items())


@query("profile_nulls", " UNION ALL ".join(_profile_sql(d, False) for d in COLUMNS))
def profile_nulls(t):
    return _union(
        _tagged(d, profile.column_counts(df, sketch=False)).select("dataset", "column_name", "null_count", "null_pct")
        for d, df in t.all_raw().items())


# --- inspection --------------------------------------------------------------

NUMERIC = {
    "payments": ("payment_value",),
    "products": ("product_name_lenght", "product_photos_qty", "product_weight_g", "product_length_cm"),
}
DOMAIN_LOWER = {
    ("customers", "customer_state"): texts(s.lower() for s in STATES + ("UNKNOWN",)),
    ("orders", "order_status"): texts(ORDER_STATUSES + ("unknown",)),
    ("payments", "payment_type"): texts(PAYMENT_TYPES),
}
RANGE = {("payments", "payment_value"): (0, 999999), ("products", "product_weight_g"): (0, 100000)}
TIMES = ("order_purchase_timestamp", "order_approved_at")


def _inspect_sql(dataset):
    table, key = f"dirty_{dataset}", SPECS[dataset].key
    flags = [(c, "NULL_VALUES", f"{c} IS NULL") for c in COLUMNS[dataset]]
    for (d, c), allowed in DOMAIN_LOWER.items():
        if d == dataset:
            flags.append((c, "BAD_CATEGORICAL", f"{c} IS NOT NULL AND LOWER(TRIM({c})) NOT IN ({allowed})"))
    for (d, c), (low, high) in RANGE.items():
        if d == dataset:
            flags.append((c, "OUT_OF_RANGE", f"({c} < {low} OR {c} > {high})"))
    if dataset == "orders":
        flags += [(c, "FORMAT_ERROR", f"{c} IS NOT NULL AND TRY_CAST({c} AS TIMESTAMP) IS NULL") for c in TIMES]
    for c in NUMERIC.get(dataset, ()):
        q = f"(SELECT quantile_cont({c}, {{}}) FROM {table})".format
        flags.append((c, "SUSPICIOUS_VALUE",
                      f"({c} < {q(0.25)} - 3.0 * ({q(0.75)} - {q(0.25)}) OR "
                      f"{c} > {q(0.75)} + 3.0 * ({q(0.75)} - {q(0.25)}))"))
    parts = []
    for c, kind, cond in flags:
        sample = "''" if kind == "NULL_VALUES" else (
            f"COALESCE((SELECT string_agg(v, ', ' ORDER BY n DESC, v) FROM (SELECT CAST({c} AS VARCHAR) AS v, "
            f"COUNT(*) AS n FROM {table} WHERE {cond} GROUP BY 1 ORDER BY n DESC, v LIMIT 5)), '')")
        sev = "'HIGH'" if c in key else (
            "CASE WHEN p >= 10.0 THEN 'HIGH' WHEN p >= 2.0 THEN 'MEDIUM' ELSE 'LOW' END")
        parts.append(f"""SELECT '{dataset}' AS dataset, '{c}' AS column_name, '{kind}' AS issue_type,
  k AS issue_rows, p AS issue_pct, {sev} AS severity, {sample} AS sample_bad_values
FROM (SELECT COUNT(*) FILTER ({cond}) AS k, ROUND(CAST(COUNT(*) FILTER ({cond}) AS DOUBLE) * 100.0 / COUNT(*), 2) AS p
      FROM {table}) WHERE k > 0""")
    cols = ", ".join(key)
    parts.append(f"""SELECT '{dataset}', '{"+".join(key)}', 'DUPLICATE_KEY', CAST(d AS BIGINT),
  ROUND(CAST(d AS DOUBLE) * 100.0 / n, 2), 'HIGH', ''
FROM (SELECT SUM(c - 1) AS d, SUM(c) AS n FROM (SELECT COUNT(*) AS c FROM {table} GROUP BY {cols})) WHERE d > 0""")
    return " UNION ALL ".join(parts)


@query("inspect_issues", " UNION ALL ".join(_inspect_sql(d) for d in COLUMNS))
def inspect_issues(t):
    declared = {"orders": {c: T.TimestampNTZType() for c in TIMES}}
    jobs = [
        lambda d=d: _tagged(d, profile.inspect(t.raw(d), SPECS[d], declared=declared.get(d))) for d in SPECS
    ]
    return _union(profile.side_by_side(t.spark, jobs))


# --- rule suggestion ----------------------------------------------------------


def _suggest_sql(dataset):
    table, parts = f"dirty_{dataset}", []
    head = "SELECT '{d}' AS dataset, '{k}' AS expectation_type, '{c}' AS column_name, {v} AS value_set, {lo} AS min_value, {hi} AS max_value, {p} AS pattern, {s} AS supporting_rows FROM {f}"
    null = "CAST(NULL AS DOUBLE)"
    for c in COLUMNS[dataset]:
        kind = TYPE_OF.get(c, "string")
        parts.append(head.format(
            d=dataset, k=NOT_NULL, c=c, v="''", lo=null, hi=null, p="''", s="s",
            f=f"(SELECT COUNT({c}) AS s, COUNT(*) AS n FROM {table}) WHERE (n - s) * 100.0 / n <= 1.0"))
        if kind == "string":
            parts.append(f"""SELECT '{dataset}', '{IN_SET}', '{c}', kept, {null}, {null}, '', n_all - lost FROM (
  SELECT string_agg(v, ', ' ORDER BY v) FILTER (CAST(k AS DOUBLE) / total >= 0.005) AS kept, COUNT(*) AS values_seen,
         COALESCE(SUM(k) FILTER (CAST(k AS DOUBLE) / total < 0.005), 0)::BIGINT AS lost
  FROM (SELECT {c} AS v, COUNT(*) AS k, SUM(COUNT(*)) OVER () AS total FROM {table} WHERE {c} IS NOT NULL GROUP BY 1)),
  (SELECT COUNT(*) AS n_all FROM {table}) WHERE values_seen BETWEEN 1 AND 50 AND values_seen / n_all <= 0.10""")
        else:
            parts.append(f"""SELECT '{dataset}', '{BETWEEN}', '{c}', '', lo, hi, '', (SELECT COUNT(*) FROM {table} WHERE
   {c} IS NULL OR ({c} >= lo AND {c} <= hi)) FROM (SELECT CASE WHEN quantile_cont(CAST({c} AS DOUBLE), 0.001) >= 0 THEN 0.0
   ELSE ROUND(quantile_cont(CAST({c} AS DOUBLE), 0.001), 4) END AS lo,
   ROUND(quantile_cont(CAST({c} AS DOUBLE), 0.999), 4) AS hi FROM {table})""")
        if not c.endswith(profile.NO_PATTERN_SUFFIXES):
            for i, (_, pattern) in enumerate(PATTERNS.items()):
                hit = f"regexp_matches(CAST({c} AS VARCHAR), '^(?:{pattern})')"
                parts.append(f"""SELECT '{dataset}', '{MATCH_REGEX}', '{c}', '', {null}, {null}, '{pattern}', s FROM (
  SELECT COUNT(*) FILTER ({c} IS NULL OR {hit}) AS s, COUNT(*) FILTER ({hit}) AS h, COUNT({c}) AS n FROM {table})
  WHERE n > 0 AND CAST(h AS DOUBLE) / n >= 0.98""")
    return " UNION ALL ".join(parts)


@query("suggest_rules", " UNION ALL ".join(_suggest_sql(d) for d in COLUMNS))
def suggest_rules(t):
    def one(dataset):
        df = t.raw(dataset)
        return profile.rules_table(df, profile.keep_usable(profile.suggest(df)), dataset)

    return _union(profile.side_by_side(t.spark, [lambda d=d: one(d) for d in SPECS]))


# --- PII ---------------------------------------------------------------------


def _pii_sql(dataset):
    table, parts = f"dirty_{dataset}", []
    for c in COLUMNS[dataset]:
        level, reason = pii.level_from_name(c)
        if TYPE_OF.get(c, "string") != "string":
            parts.append(f"SELECT '{dataset}' AS dataset, '{c}' AS column_name, '{level}' AS pii_level, "
                         f"'{reason}' AS reason, 0.0::DOUBLE AS value_match_rate FROM (SELECT COUNT(*) FROM {table})")
            continue
        m = f"CAST(COUNT(*) FILTER (regexp_full_match({c}, '{{}}')) AS DOUBLE) / GREATEST(COUNT({c}), 1)".format
        phone = (f"CAST(COUNT(*) FILTER (regexp_full_match({c}, '{pii.PHONE}') AND NOT "
                 f"regexp_matches({c}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}')) AS DOUBLE) / GREATEST(COUNT({c}), 1)")
        best, why = f"'{level}'", f"'{reason}'"
        if pii.RANK[level] < 2:
            best = f"CASE WHEN u >= 0.5 THEN 'MEDIUM' ELSE {best} END"
            why = f"CASE WHEN u >= 0.5 THEN 'values look like uuids' ELSE {why} END"
        if pii.RANK[level] < 3:
            best = f"CASE WHEN GREATEST(e, p) >= 0.5 THEN 'HIGH' ELSE {best} END"
            why = (f"CASE WHEN e >= 0.5 THEN 'values look like e-mails' WHEN p >= 0.5 THEN "
                   f"'values look like phones' ELSE {why} END")
        parts.append(f"""SELECT '{dataset}' AS dataset, '{c}' AS column_name, {best} AS pii_level, {why} AS reason,
  ROUND(GREATEST(e, p, u), 4) AS value_match_rate
FROM (SELECT {m(pii.EMAIL)} AS e, {phone} AS p, {m(pii.UUID)} AS u FROM {table})""")
    return " UNION ALL ".join(parts)


@query("pii_classify", " UNION ALL ".join(_pii_sql(d) for d in COLUMNS))
def pii_classify(t):
    return _union(pii.classify(df, d) for d, df in t.all_raw().items())


@query("pii_text_scan", f"""
SELECT * FROM (SELECT doc_id, lang, source,
  CAST(len(regexp_extract_all(text, '{pii.EMAIL}')) AS INT) AS email_hits,
  CAST(len(regexp_extract_all(text, '{pii.PHONE_IN_TEXT}')) AS INT) AS phone_hits
FROM documents) WHERE email_hits > 0 OR phone_hits > 0""")
def pii_text_scan(t):
    return pii.scan_text(t.table("documents"), "doc_id", "text", "lang", "source")


# --- drift -------------------------------------------------------------------

EXPECTED = {
    d: [(n, readers.type_family(dt.simpleString())) for n, dt in s.fields] for d, s in SPECS.items()
}


def feed(t, dataset):
    """A text feed whose installments arrive as decimals, as happens after a nullable load."""
    df = t.raw(dataset)
    if dataset == "payments":
        df = df.withColumn("payment_installments", F.col("payment_installments").cast("double"))
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def _family_sql(dataset):
    parts = []
    for c in COLUMNS[dataset]:
        value = f"CAST({c} AS DOUBLE)" if c == "payment_installments" else c
        text = f"CAST({value} AS VARCHAR)"
        parts.append(f"""SELECT '{dataset}' AS dataset, '{c}' AS column_name, COUNT({c}) AS non_null_rows,
  CASE WHEN COUNT({c}) > 0 AND COUNT(*) FILTER (regexp_matches({text}, '{drift.INT_TEXT}')) = COUNT({c}) THEN 'int'
       WHEN COUNT({c}) > 0 AND COUNT(*) FILTER (regexp_matches({text}, '{drift.FLOAT_TEXT}')) = COUNT({c}) THEN 'float'
       ELSE 'str' END AS actual_type FROM dirty_{dataset}""")
    return " UNION ALL ".join(parts)


CTES["arrived_schema"] = " UNION ALL ".join(_family_sql(d) for d in COLUMNS)
CTES["wanted_schema"] = "SELECT * FROM (VALUES " + ", ".join(
    f"('{d}', '{c}', '{f}')" for d, cols in EXPECTED.items() for c, f in cols
) + ") w(dataset, column_name, expected_type)"
CTES["schema_changes"] = """
SELECT * FROM (SELECT COALESCE(w.dataset, a.dataset) AS dataset,
  CASE WHEN actual_type IS NULL THEN 'COLUMN_REMOVED' WHEN expected_type IS NULL THEN 'COLUMN_ADDED'
       WHEN actual_type != expected_type THEN 'TYPE_CHANGED' END AS drift_type,
  COALESCE(w.column_name, a.column_name) AS column_name, expected_type, actual_type,
  CASE WHEN expected_type IS NULL THEN 'MEDIUM' ELSE 'HIGH' END AS severity,
  COALESCE(non_null_rows, 0) AS non_null_rows
FROM wanted_schema w FULL JOIN arrived_schema a ON w.dataset = a.dataset AND w.column_name = a.column_name)
WHERE drift_type IS NOT NULL"""


def all_drift(t):
    return _union(
        drift.drift_events(drift.observed_schema(feed(t, d), d).drop("dataset"), SPECS[d]) for d in SPECS)


@query("schema_drift", "SELECT * FROM schema_changes")
def schema_drift(t):
    return all_drift(t)


@query("drift_summary", """
SELECT dataset, drift_type, severity, COUNT(*) AS events, CAST(SUM(non_null_rows) AS BIGINT) AS rows_affected
FROM schema_changes GROUP BY ALL""")
def drift_summary(t):
    return drift.summary(all_drift(t))


RENAMED = {
    "product_category_name": ("product_category", "str"),
    "product_weight_g": ("product_weight_grams", "float"),
    "product_length_cm": ("product_len_cm", "float"),
}


def _values_sql(pairs, side):
    return " UNION ALL ".join(
        f"SELECT DISTINCT '{name}' AS {side}, '{fam}' AS family, CAST({c} AS VARCHAR) AS value "
        f"FROM dirty_products WHERE {c} IS NOT NULL" for c, name, fam in pairs)


@query("schema_rename", f"""
WITH o AS ({_values_sql([(c, c, f) for c, (_, f) in RENAMED.items()], 'old_name')}),
n AS ({_values_sql([(c, v, f) for c, (v, f) in RENAMED.items()], 'new_name')}),
oc AS (SELECT old_name, family, COUNT(*) AS n FROM o GROUP BY ALL),
nc AS (SELECT new_name, family, COUNT(*) AS n FROM n GROUP BY ALL),
sh AS (SELECT old_name, new_name, COUNT(*) AS b FROM o JOIN n USING (family, value) GROUP BY ALL),
sc AS (SELECT oc.old_name, nc.new_name,
  1.0::DOUBLE - CAST(levenshtein(oc.old_name, nc.new_name) AS DOUBLE) / GREATEST(LENGTH(oc.old_name), LENGTH(nc.new_name)) AS name_score,
  CAST(COALESCE(b, 0) AS DOUBLE) / (oc.n + nc.n - COALESCE(b, 0)) AS overlap
  FROM oc JOIN nc USING (family) LEFT JOIN sh ON sh.old_name = oc.old_name AND sh.new_name = nc.new_name),
rk AS (SELECT *, (name_score + overlap) / 2 AS s,
  ROW_NUMBER() OVER (PARTITION BY old_name ORDER BY (name_score + overlap) DESC, new_name DESC) AS r1,
  ROW_NUMBER() OVER (PARTITION BY new_name ORDER BY (name_score + overlap) DESC, old_name DESC) AS r2 FROM sc)
SELECT 'products' AS dataset, 'COLUMN_RENAMED' AS drift_type, old_name AS column_name, new_name,
       'HIGH' AS severity, ROUND(s, 4) AS score FROM rk WHERE r1 = 1 AND r2 = 1 AND s >= 0.6""")
def schema_rename(t):
    after = t.products.withColumnsRenamed({c: v for c, (v, _) in RENAMED.items()})
    return drift.rename_events(drift.renames(t.products, after), "products")


# --- validation --------------------------------------------------------------

_RESULT = ("SELECT {i} AS rule_id, '{k}' AS expectation_type, '{c}' AS column_name, "
           "CASE WHEN f > 0 THEN '{t}: ' || f || ' of ' || n ELSE '' END AS issue, "
           "f AS failed_count, n AS evaluated_count, CASE WHEN {ok} THEN 'pass' ELSE 'fail' END AS status "
           "FROM (SELECT {f} AS f, {n} AS n FROM {table})")


def check_sql(i, rule, table, ok="f = 0"):
    """One validation result row in SQL."""
    c = rule.column
    bad = {
        NOT_NULL: f"COUNT(*) FILTER ({c} IS NULL)",
        IN_SET: f"COUNT(*) FILTER (CAST({c} AS VARCHAR) NOT IN ({texts(rule.values)}))",
        BETWEEN: "COUNT(*) FILTER (" + " OR ".join(
            [f"{c} < {rule.min_value}"] * (rule.min_value is not None)
            + [f"{c} > {rule.max_value}"] * (rule.max_value is not None)) + ")",
        MATCH_REGEX: f"COUNT(*) FILTER (NOT regexp_matches(CAST({c} AS VARCHAR), '^(?:{rule.pattern})'))",
        UNIQUE: "CAST(COALESCE(SUM(k - 1), 0) AS BIGINT)",
    }.get(rule.kind) or f"COUNT(*) FILTER (NOT COALESCE({rule.expression}, FALSE))"
    seen = f"COUNT({c})" if rule.kind in (IN_SET, BETWEEN, MATCH_REGEX) else "COUNT(*)"
    if rule.kind == UNIQUE:
        cols = ", ".join(rule.columns or (c,))
        table, seen = f"(SELECT COUNT(*) AS k FROM {table} GROUP BY {cols})", "CAST(SUM(k) AS BIGINT)"
    return _RESULT.format(i=i, k=rule.kind, c=c, t=rule.label, f=bad, n=seen, table=table, ok=ok)


def suite_sql(dataset, rules, first=0):
    return " UNION ALL ".join(check_sql(i, r, f"dirty_{dataset}") for i, r in enumerate(rules, first))


def with_dataset(dataset, sql):
    return f"SELECT '{dataset}' AS dataset, * FROM ({sql})"


NULL_RULES = {
    d: tuple(not_null(c) for c in COLUMNS[d] if c not in ("load_seq",)) for d in COLUMNS
}


@query("validate_not_null", " UNION ALL ".join(
    with_dataset(d, suite_sql(d, NULL_RULES[d])) for d in NULL_RULES))
def validate_not_null(t):
    return _union(_tagged(d, validate.check_results(t.raw(d), NULL_RULES[d])) for d in NULL_RULES)


UNIQUE_RULES = {
    "customers": (unique("customer_id"), unique("customer_unique_id"), unique("customer_email")),
    "orders": (unique("order_id"),),
    "payments": (unique("order_id"), unique("order_id", "payment_sequential")),
    "products": (unique("product_id"),),
}


@query("validate_unique", " UNION ALL ".join(
    with_dataset(d, suite_sql(d, r)) for d, r in UNIQUE_RULES.items()) + f"""
UNION ALL SELECT 'conversations', * FROM ({check_sql(0, unique('conv_id', 'turn'), 'conversations')})""")
def validate_unique(t):
    frames = [_tagged(d, validate.check_results(t.raw(d), r)) for d, r in UNIQUE_RULES.items()]
    turns = validate.check_results(t.table("conversations"), [unique("conv_id", "turn")])
    return _union(frames + [_tagged("conversations", turns)])


SET_RULES = {
    "customers": (in_set("customer_state", STATES + ("UNKNOWN",)),),
    "orders": (in_set("order_status", ORDER_STATUSES + ("unknown",)),),
    "payments": (in_set("payment_type", PAYMENT_TYPES), in_set("payment_sequential", range(1, 8))),
}


@query("validate_in_set", " UNION ALL ".join(
    with_dataset(d, suite_sql(d, r)) for d, r in SET_RULES.items()) + f"""
UNION ALL SELECT 'conversations', * FROM ({check_sql(0, in_set('role', ('user', 'assistant')), 'conversations')})
UNION ALL SELECT 'labels', * FROM ({check_sql(0, in_set('quality', (0, 1)), 'labels')})""")
def validate_in_set(t):
    frames = [_tagged(d, validate.check_results(t.raw(d), r)) for d, r in SET_RULES.items()]
    roles = validate.check_results(t.table("conversations"), [in_set("role", ("user", "assistant"))])
    marks = validate.check_results(t.table("labels"), [in_set("quality", (0, 1))])
    return _union(frames + [_tagged("conversations", roles), _tagged("labels", marks)])


def _samples_sql(dataset, kind, column, cond):
    return f"""SELECT '{dataset}' AS dataset, '{kind}' AS expectation_type, '{column}' AS column_name, bad_value, bad_count,
  CAST(ROW_NUMBER() OVER (ORDER BY bad_count DESC, bad_value) AS INT) AS sample_rank
FROM (SELECT CAST({column} AS VARCHAR) AS bad_value, COUNT(*) AS bad_count FROM dirty_{dataset} WHERE {cond} GROUP BY 1)
QUALIFY sample_rank <= 5"""


@query("validate_bad_samples", " UNION ALL ".join([
    _samples_sql("customers", IN_SET, "customer_state", f"customer_state NOT IN ({texts(STATES + ('UNKNOWN',))})"),
    _samples_sql("orders", IN_SET, "order_status", f"order_status NOT IN ({texts(ORDER_STATUSES + ('unknown',))})"),
    _samples_sql("payments", IN_SET, "payment_type", f"payment_type NOT IN ({texts(PAYMENT_TYPES)})"),
    _samples_sql("payments", BETWEEN, "payment_value", "payment_value < 0 OR payment_value > 999999"),
    _samples_sql("products", BETWEEN, "product_weight_g", "product_weight_g < 0 OR product_weight_g > 100000")]))
def validate_bad_samples(t):
    return _union(
        _tagged(d, validate.bad_samples(t.raw(d), spec.rules)) for d, spec in SPECS.items())


RANGE_RULES = {
    "payments": (between("payment_value", 0, 999999), between("payment_installments", 1, 10),
                 between("payment_value", 1000)),
    "products": (between("product_weight_g", 0, 100000), between("product_photos_qty", None, 6)),
    "customers": (between("customer_zip_code_prefix", 1000, 90000),),
}


@query("validate_between", " UNION ALL ".join(
    with_dataset(d, suite_sql(d, r)) for d, r in RANGE_RULES.items()))
def validate_between(t):
    return _union(_tagged(d, validate.check_results(t.raw(d), r)) for d, r in RANGE_RULES.items())


REGEX_RULES = {
    "customers": (match_regex("customer_zip_code_prefix", "[0-9]{5}$"), match_regex("customer_state", "[A-Z]{2}"),
                  match_regex("customer_email", "user[0-9]+@example")),
    "orders": (match_regex("order_approved_at", "[0-9]{4}-[0-9]{2}-[0-9]{2}"), match_regex("order_id", "o[0-9]+$")),
}


@query("validate_regex", " UNION ALL ".join(
    with_dataset(d, suite_sql(d, r)) for d, r in REGEX_RULES.items()))
def validate_regex(t):
    return _union(_tagged(d, validate.check_results(t.raw(d), r)) for d, r in REGEX_RULES.items())


@query("validate_missing_column", suite_sql("products", (not_null("product_id"),)) + f"""
UNION ALL SELECT 1, '{NOT_NULL}', 'product_height_cm', 'no column product_height_cm',
  0::BIGINT, 0::BIGINT, 'missing' FROM (SELECT COUNT(*) FROM dirty_products)""")
def validate_missing_column(t):
    return validate.check_results(t.products, [not_null("product_id"), not_null("product_height_cm")])


for _d in SPECS:
    def _suite(t, d=_d):
        return validate.check_results(t.raw(d), SPECS[d].rules)

    _suite.__name__ = f"validate_defaults_{_d}"
    query(f"validate_defaults_{_d}", suite_sql(_d, SPECS[_d].rules))(_suite)


@query("validate_suite", " UNION ALL ".join(f"""
SELECT '{d}' AS dataset, COUNT(*) AS rules, COUNT(*) FILTER (status != 'pass') AS failed_rules,
  CAST(SUM(failed_count) AS BIGINT) AS bad_values, COUNT(*) > 0 AND COUNT(*) FILTER (status != 'pass') = 0 AS passed
FROM ({suite_sql(d, SPECS[d].rules)})""" for d in SPECS))
def validate_suite(t):
    return _union(
        _tagged(d, validate.suite_summary(validate.check_results(t.raw(d), SPECS[d].rules))) for d in SPECS)


MOSTLY = {
    "customers": (not_null("customer_id", mostly=0.98), not_null("customer_id", mostly=0.95)),
    "orders": (not_null("customer_id", mostly=0.98), in_set("order_status", ORDER_STATUSES, mostly=0.9),
               unique("order_id", mostly=0.98)),
    "payments": (between("payment_value", 0, 999999, mostly=0.98),),
}


@query("validate_mostly", " UNION ALL ".join(
    with_dataset(d, " UNION ALL ".join(
        check_sql(i, r, f"dirty_{d}", f"f <= n * (1.0 - {r.mostly}) + 1e-9") for i, r in enumerate(rules)))
    for d, rules in MOSTLY.items()))
def validate_mostly(t):
    return _union(_tagged(d, validate.check_results(t.raw(d), r)) for d, r in MOSTLY.items())


CUSTOM_RULES = {
    "payments": (custom("installments_need_value", "payment_installments <= 6 OR payment_value >= 5000"),),
    "orders": (custom("approved_not_before_purchase",
                      "order_approved_at IS NULL OR order_approved_at >= order_purchase_timestamp"),),
}


@query("custom_rule_expr", " UNION ALL ".join(
    with_dataset(d, suite_sql(d, r)) for d, r in CUSTOM_RULES.items()))
def custom_rule_expr(t):
    return _union(_tagged(d, validate.check_results(t.raw(d), r)) for d, r in CUSTOM_RULES.items())
