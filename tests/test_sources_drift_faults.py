from pyspark.sql import functions as F

from siltgate.operators import drift, lineage, ops, pii, profile
from siltgate.sources import layers, readers
from siltgate.spec import BETWEEN, CUSTOMERS, IN_SET, NOT_NULL, PAYMENTS, UNIQUE, in_set, match_regex, unique


def test_csv_with_quotes_and_a_corrupt_row(spark, tmp_path):
    file = tmp_path / "payments.csv"
    file.write_text('ORDER_ID,payment_sequential,payment_type,payment_installments,payment_value\n'
                    '"o1",1,"credit, card",3,150.0\no2,x,boleto,1,2.0\n')
    rows = readers.read_csv(spark, str(file), PAYMENTS.schema).cache().orderBy("order_id").collect()
    assert (rows[0]["order_id"], rows[0]["payment_type"], rows[0]["_corrupt_record"]) == ("o1", "credit, card", None)
    assert rows[1]["payment_sequential"] is None and rows[1]["_corrupt_record"].startswith("o2,x")


def test_layers_write_count_find_and_export(spark, customers, tmp_path):
    where = layers.Layers(str(tmp_path))
    assert layers.write_table(customers, where.path("raw", "customers")) == 5
    assert where.find(spark, "customers") == where.path("raw", "customers")
    layers.write_table(customers.limit(2), where.path("silver", "customers"))
    assert where.find(spark, "customers", ("silver", "raw")).endswith("silver/customers")
    layers.write_table(customers.limit(3), where.path("raw", "customers"))
    assert readers.read_table(spark, where.path("raw", "customers")).count() == 3
    layers.export_csv(customers, str(tmp_path / "slice"), 2, [F.col("customer_id")])
    assert spark.read.option("header", True).csv(str(tmp_path / "slice")).count() == 2
    layers.export_json(customers, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 5


def test_catalog_tables(spark, customers):
    from pyspark.sql import types as T

    layers.save_table(customers, "raw_customers_t")
    layers.save_table(customers.limit(1), "raw_customers_t")
    assert spark.table("raw_customers_t").count() == 1
    extra = [T.StructField("quarantined_at", T.TimestampNTZType()), T.StructField("quarantine_reason", T.StringType())]
    layers.create_table(spark, "quarantine_customers_t", CUSTOMERS.schema, extra)
    assert spark.table("quarantine_customers_t").columns[-2:] == ["quarantined_at", "quarantine_reason"]
    assert spark.table("quarantine_customers_t").count() == 0


def test_stamp_is_a_value(customers):
    row = readers.stamp(customers, 7, "2024-01-01 00:00:00").first()
    assert row["batch_id"] == 7 and str(row["ingested_at"]) == "2024-01-01 00:00:00"


def test_type_families():
    assert [readers.type_family(t) for t in ("VARCHAR(36)", "NUMBER(10,2)", "int64", "timestamp_ntz", "object")] == [
        "str", "float", "int", "timestamp", "str"]


def test_drift_on_a_declared_schema(spark):
    df = spark.createDataFrame([("c", "u", "12", "x", "y@z.com")],
                               "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
                               "customer_city string, customer_email string")
    events = drift.drift_events(drift.declared_schema(df, "customers").drop("dataset"), CUSTOMERS)
    got = {(r["drift_type"], r["column_name"], r["severity"]) for r in events.collect()}
    assert got == {("COLUMN_REMOVED", "customer_state", "HIGH"), ("COLUMN_ADDED", "customer_email", "MEDIUM"),
                   ("TYPE_CHANGED", "customer_zip_code_prefix", "HIGH")}
    logged = drift.stamp(events, "r1", "2024-01-01 00:00:00").first()
    assert logged["run_id"] == "r1" and logged["detected_at"] is not None


def test_rename_needs_similar_names_or_values(spark):
    old = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "city string, weight double")
    new = spark.createDataFrame([("a", 7.5), ("b", 8.5)], "town string, unrelated double")
    got = {(r["old_name"], r["new_name"]) for r in drift.renames(old, new, 0.4).collect()}
    assert got == {("city", "town")}
    assert drift.renames(old, old).count() == 0


def test_rule_suggestion_and_filter(spark):
    rows = [(f"k{i}", "ab"[i % 2] if i else "rare", float(i), "12345") for i in range(1000)]
    df = spark.createDataFrame(rows, "thing_id string, kind string, size double, zip string")
    rules = profile.suggest(df, keep_unique=True)
    kinds = {(r.kind, r.column) for r in rules}
    assert {(NOT_NULL, "thing_id"), (UNIQUE, "thing_id"), (IN_SET, "kind"), (BETWEEN, "size")} <= kinds
    assert next(r for r in rules if r.kind == IN_SET and r.column == "kind").values == ("a", "b")
    assert profile.suggest(df.limit(0)) == []
    odd = [unique("a"), in_set("b", []), in_set("b", range(51)), match_regex("x_id", "a"), in_set("b", ["1"])]
    assert profile.keep_usable(odd) == [in_set("b", ["1"])]


def test_clean_columns(inputs):
    df = inputs.payments
    issues = profile.inspect(df, PAYMENTS)
    assert {r[0] for r in profile.clean_columns(df, issues).collect()} == {"payment_sequential", "payment_installments"}


def test_pii_names_and_values(spark):
    assert pii.level_from_name("customer_email")[0] == "HIGH"
    assert pii.level_from_name("order_id")[0] == "MEDIUM"
    assert pii.level_from_name("product_category_name")[0] == "LOW"
    assert pii.level_from_name("created_at")[0] == "NONE"
    df = spark.createDataFrame([("a@b.com", "z"), ("c@d.org", "z")], "contact string, note string")
    got = {r["column_name"]: r["pii_level"] for r in pii.classify(df, "t").collect()}
    assert got == {"contact": "HIGH", "note": "NONE"}


def test_budget_flag(inputs):
    usage = ops.usage_of(inputs.table("events"))
    assert ops.daily_budget(usage, 0.0).where("over_budget").count() > 0
    assert ops.daily_budget(usage, 1e9).where("over_budget").count() == 0


def test_variant_payload(spark):
    df = spark.createDataFrame([(1, "a", 2.5)], "id int, note string, amount double")
    out = lineage.as_records(df, ["note", "amount"])
    row = out.select("id", F.variant_get("payload", "$.amount", "double").alias("a")).first()
    assert tuple(row) == (1, 2.5)


def test_ordered_sample_shows_null_as_blank(dirty_customers):
    rows = readers.sample_rows(dirty_customers, [F.col("customer_unique_id")], 2).collect()
    assert rows[1]["customer_id"] == "" and rows[0]["customer_zip_code_prefix"] == "1310"


def test_text_scan_equals_plain_search_and_reads_long_runs_once(spark):
    import re
    import time

    texts = ["a@b.com_x@d.org", "x@y", "mail: q.w+e@host-1.co.uk, z@z.io.", "a@b@c.com", "a@b.comc@d.org", "none",
             "call +55-11-91234567 or +1 202 5550100"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {r["id"]: r["email_hits"] for r in pii.scan_text(df, "id", "text").collect()}
    want = {i: len(re.findall(pii.EMAIL, t)) for i, t in enumerate(texts)}
    assert {i: n for i, n in want.items() if n} == {i: n for i, n in got.items() if n}
    long = spark.range(1).select("id", F.concat(F.repeat(F.lit("x"), 400_000), F.lit(" a@b.com")).alias("text"))
    start = time.time()
    assert pii.scan_text(long, "id", "text").first()["email_hits"] == 1
    assert time.time() - start < 20


def test_approximate_profile_spares_the_shuffle(customers):
    got = {r["column_name"]: r["distinct_count"] for r in profile.profile(customers, exact=False).collect()}
    assert got["customer_id"] == 5


def test_trend_folds_batches_of_one_shape(spark):
    rows = [(1, "a", None, None), (1, None, None, None), (2, "a", None, None), (4, "a", 1, None), (5, None, 1, 2.0), (9, "b", 1, None)]
    df = spark.createDataFrame(rows, "batch_id long, x string, y int, z double")
    found = drift.trend(drift.batch_shapes(df, "d")).orderBy("segment").collect()
    assert [tuple(r)[1:] for r in found] == [
        (1, 1, 2, 2, 3, "x", ""), (2, 4, 4, 1, 1, "y", ""), (3, 5, 5, 1, 1, "z", "x"), (4, 9, 9, 1, 1, "x", "z")]
    assert drift.trend(drift.batch_shapes(df.limit(0), "d")).count() == 0
