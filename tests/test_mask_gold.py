import hashlib

from pyspark.sql import functions as F

from siltgate.functions.columns import partial_mask
from siltgate.operators import mask
from siltgate.plans import gold
from siltgate.spec import CUSTOMERS


def test_mask_levels(spark):
    df = spark.createDataFrame([("ana@example.com", "abcdefg", "abc", "x"), (None, None, None, None)],
                               "e string, m string, s string, o string")
    pii = {"e": ("HIGH", ""), "m": ("MEDIUM", ""), "s": ("MEDIUM", ""), "o": ("LOW", "")}
    a, b = mask.mask_table(df, pii).collect()
    assert tuple(a) == (hashlib.sha256(b"ana@example.com").hexdigest(), "abcd***", "***", "x")
    assert tuple(b) == (None, None, None, None)


def test_short_values_can_stay_readable(spark):
    df = spark.createDataFrame([("abc",), ("abcdef",)], "v string")
    assert [r[0] for r in df.select(partial_mask(F.col("v"), mask_short=False)).collect()] == ["abc", "abcd**"]


def test_salt_changes_the_digest(spark):
    df = spark.createDataFrame([("a",)], "v string")
    pii = {"v": ("HIGH", "")}
    assert mask.mask_table(df, pii).first() != mask.mask_table(df, pii, salt="s").first()


def test_no_raw_high_value_survives(inputs):
    raw, out = inputs.customers, mask.mask_table(inputs.customers, CUSTOMERS.pii)
    for c in ("customer_email", "customer_phone"):
        assert out.join(raw.select(c), c, "left_semi").isEmpty()


def test_log_skips_absent_columns(customers):
    log = {r["column_name"]: (r["action"], r["rows_masked"]) for r in
           mask.masking_log(customers, CUSTOMERS.pii, "customers").collect()}
    assert log["customer_email"] == ("SKIP", 0) and log["customer_id"] == ("PARTIAL_MASK", 5)
    assert log["customer_city"] == ("NOT_MASKED", 0)


def test_payment_kpis(spark):
    rows = [("credit_card", 250.0), ("credit_card", 150.0), ("boleto", 90.4), ("voucher", 40.0), ("credit_card", 150.0)]
    df = spark.createDataFrame([("o%d" % i, 1, t, 1, v) for i, (t, v) in enumerate(rows)],
                               "order_id string, payment_sequential int, payment_type string, "
                               "payment_installments int, payment_value double")
    got = {r["kpi_key"]: r["kpi_value"] for r in gold.kpi_rows("payments", df).collect()}
    assert got["total_revenue"] == "680.40" and got["total_payments"] == "5"
    assert got["payment_type_breakdown"] == '{"credit_card":3,"boleto":1,"voucher":1}'


def test_customer_kpis(customers):
    got = gold.customer_kpis(customers).first()
    assert (got["total_customers"], got["states_covered"]) == (5, 5)
