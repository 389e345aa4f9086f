from siltgate.operators import validate
from siltgate.spec import (
    CUSTOM, IN_SET, NOT_NULL, PAYMENTS, STATES, UNIQUE, Rule, between, custom, in_set, match_regex, not_null, unique,
)

CUSTOMER_RULES = [
    not_null("customer_id"), unique("customer_id"), in_set("customer_state", STATES + ("UNKNOWN",))]


def counts(df, rules):
    return {(r["expectation_type"], r["column_name"]): (r["failed_count"], r["status"])
            for r in validate.check_results(df, rules).collect()}


def test_clean_rows_pass(customers):
    assert all(v == (0, "pass") for v in counts(customers, CUSTOMER_RULES).values())


def test_dirty_rows_fail_each_rule(dirty_customers):
    got = counts(dirty_customers, CUSTOMER_RULES)
    assert got == {(NOT_NULL, "customer_id"): (1, "fail"), (UNIQUE, "customer_id"): (1, "fail"),
                   (IN_SET, "customer_state"): (1, "fail")}


def test_payment_rules(spark):
    df = spark.createDataFrame([("o1", "credit_card", 100.0), (None, "invalid_type", -10.0), ("o3", "boleto", 50.0)],
                               "order_id string, payment_type string, payment_value double")
    rules = [not_null("order_id"), in_set("payment_type", PAYMENTS.domains["payment_type"]),
             between("payment_value", 0, 999999)]
    assert [v[0] for v in counts(df, rules).values()] == [1, 1, 1]


def test_nulls_equal_each_other_for_uniqueness(spark):
    df = spark.createDataFrame([(None,), (None,), (None,), ("a",), ("a",)], "id string")
    assert counts(df, [unique("id")])[(UNIQUE, "id")] == (3, "fail")


def test_null_passes_everything_but_not_null(spark):
    df = spark.createDataFrame([(None,)], "v string")
    got = validate.check_results(df, [in_set("v", ["x"]), between("v", 1, 2), match_regex("v", "x")]).collect()
    assert [r["failed_count"] for r in got] == [0, 0, 0]


def test_pattern_is_anchored_at_the_start_only(spark):
    df = spark.createDataFrame([("abc",), ("xabc",), ("abcd",)], "v string")
    assert validate.check_results(df, [match_regex("v", "abc")]).first()["failed_count"] == 1


def test_bounds_are_inclusive_and_text_is_coerced(spark):
    df = spark.createDataFrame([("1",), ("10",), ("11",), ("zero",)], "v string")
    assert validate.check_results(df, [between("v", 1, 10)]).first()["failed_count"] == 1


def test_missing_and_broken_rules_do_not_stop_the_rest(customers):
    rules = [not_null("nope"), custom("bad", "no_such_column > 1"), Rule("unknown_kind", "customer_id"),
             not_null("customer_id")]
    got = {r["rule_id"]: r["status"] for r in validate.check_results(customers, rules).collect()}
    assert got == {0: "missing", 1: "error", 2: "error", 3: "pass"}


def test_custom_rule_treats_null_as_failure(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "v int")
    got = validate.check_results(df, [custom("small", "v < 3")]).first()
    assert (got["expectation_type"], got["failed_count"]) == (CUSTOM, 2)


def test_summary(dirty_customers, customers):
    bad = validate.suite_summary(validate.check_results(dirty_customers, CUSTOMER_RULES)).first()
    assert (bad["rules"], bad["failed_rules"], bad["bad_values"], bad["passed"]) == (3, 3, 3, False)
    assert validate.suite_summary(validate.check_results(customers, CUSTOMER_RULES)).first()["passed"]


def test_empty_suite_fails(customers):
    results = validate.check_results(customers, CUSTOMER_RULES).limit(0)
    assert validate.suite_summary(results).first()["passed"] is False


def test_rule_wire_form_round_trip():
    raw = {"expectation_type": IN_SET, "column": "c", "kwargs": {"value_set": ["a", "b"], "mostly": 0.9}}
    assert Rule.from_dict(raw).to_dict() == raw


def test_rules_on_an_empty_table(spark):
    df = spark.createDataFrame([], "id string")
    got = validate.check_results(df, [not_null("id"), unique("id")]).collect()
    assert [(r["failed_count"], r["status"]) for r in got] == [(0, "pass"), (0, "pass")]


def test_a_unique_rule_counts_the_same_alone_and_in_a_suite(spark):
    df = spark.sql("""SELECT * FROM VALUES
        (1, timestamp_ntz'2024-01-01 00:00:00.000001', 0.0D, 'a'), (1, timestamp_ntz'2024-01-01 00:00:00.000002', -0.0D, 'a'),
        (1, NULL, 1.5D, NULL), (1, NULL, NULL, NULL) AS t(k, at, v, s)""")
    rules = [unique("at"), unique("v"), unique("s"), Rule(UNIQUE, "k", columns=("k", "at")), Rule(UNIQUE, "k", columns=("s", "v"))]
    together = {r["rule_id"]: r["failed_count"] for r in validate.check_results(df, rules).collect()}
    alone = {i: validate.check_results(df, [r]).first()["failed_count"] for i, r in enumerate(rules)}
    assert together == alone == {0: 1, 1: 1, 2: 2, 3: 1, 4: 1}


def test_a_suite_without_rules_is_a_reported_fail(customers):
    results = validate.check_results(customers, [])
    assert results.count() == 0
    assert validate.suite_summary(results).first()["passed"] is False
