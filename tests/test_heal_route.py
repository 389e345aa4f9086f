import pytest
from pyspark.sql import functions as F

from siltgate.functions import columns as C
from siltgate.operators import dedup, heal, route
from siltgate.operators.validate import check_results
from siltgate.plans import medallion
from siltgate.spec import CUSTOMERS, PAYMENTS, SPECS, between, in_set, not_null


def test_states_are_standardised(spark):
    df = spark.createDataFrame([("sp",), ("SAO PAULO",), (" rj ",), ("XX",), (None,)], "customer_state string")
    plain = [r[0] for r in heal.apply_steps(df, [heal.state_step()]).collect()]
    known = [r[0] for r in heal.apply_steps(df, [heal.state_step(aliases=True)]).collect()]
    assert plain == ["SP", "UNKNOWN", "RJ", "UNKNOWN", "UNKNOWN"]
    assert known == ["SP", "SP", "RJ", "UNKNOWN", "UNKNOWN"]


def test_negative_payments(spark):
    df = spark.createDataFrame([(-100.0,), (50.0,), (None,), (float("nan"),)], "payment_value double")
    assert [r[0] for r in heal.apply_steps(df, [heal.value_step(policy="abs")]).collect()] == [100.0, 50.0, 0.0, 0.0]
    assert [r[0] for r in heal.apply_steps(df, [heal.value_step(policy="zero")]).collect()] == [0.0, 50.0, 0.0, 0.0]


def test_dedup_first_and_last(spark):
    df = spark.createDataFrame([("c1", 1, "a"), ("c1", 2, "b"), ("c2", 1, "c"), (None, 1, "d")],
                               "customer_id string, load_seq int, v string")
    assert sorted(r["v"] for r in dedup.keep_first(df, ["customer_id"]).collect()) == ["a", "c"]
    assert sorted(r["v"] for r in dedup.keep_last(df, ["customer_id"]).collect()) == ["b", "c"]


def test_quarantine_has_true_reasons(spark, dirty_customers):
    tagged = route.tag(dirty_customers, CUSTOMERS.rules, heal.bronze_steps("customers"))
    assert [r[route.REASON] for r in route.quarantine(tagged).collect()] == ["not_null(customer_id)"]
    raw = route.tag(dirty_customers, CUSTOMERS.rules)
    assert [r[route.REASON] for r in route.quarantine(raw).collect()] == ["not_null(customer_id); in_set(customer_state)"]


def test_no_rules_means_all_clean(dirty_customers):
    assert route.clean(route.tag(dirty_customers, [])).count() == 5


@pytest.mark.parametrize("dataset", list(SPECS))
def test_rows_add_up(inputs, dataset):
    spec, raw = SPECS[dataset], inputs.raw(dataset)
    out = medallion.refine(raw, spec)
    keys = raw.where(dedup.has_key(spec.key)).select(*spec.key).distinct().count()
    extra = sum(r["healed_rows"] for r in out.events.collect() if r["issue"] == "duplicate rows")
    assert out.silver.count() == keys
    assert out.silver.count() + out.quarantine.count() + extra == raw.count()


@pytest.mark.parametrize("dataset", list(SPECS))
def test_healing_twice_changes_nothing(inputs, dataset):
    steps = heal.bronze_steps(dataset)
    once = heal.apply_steps(inputs.raw(dataset), steps)
    twice = heal.apply_steps(once, steps)
    assert once.exceptAll(twice).isEmpty() and twice.exceptAll(once).isEmpty()


def test_rules_pass_after_rule_healing(inputs):
    rules = [r for r in PAYMENTS.rules]
    healed = heal.heal_by_rules(inputs.payments, rules)
    assert {r["status"] for r in check_results(healed, rules).collect()} == {"pass"}


def test_mode_fill_uses_the_most_common_then_the_first(spark):
    df = spark.createDataFrame([("b",), ("b",), ("a",), ("z",), (None,)], "v string")
    assert [r[0] for r in heal.heal_by_rules(df, [in_set("v", ["a", "b"])]).collect()] == ["b", "b", "a", "b", "b"]
    none = spark.createDataFrame([("z",)], "v string")
    assert heal.heal_by_rules(none, [in_set("v", ["q", "a"])]).first()[0] == "q"


def test_later_rules_see_earlier_repairs(spark):
    df = spark.createDataFrame([(None,), (5.0,)], "v double")
    rules = [not_null("v"), between("v", 1, 3)]
    assert [r[0] for r in heal.heal_by_rules(df, rules).collect()] == [1.0, 3.0]


def test_event_counts_equal_changed_rows(inputs):
    raw = inputs.customers
    healed = heal.apply_steps(raw, [heal.state_step()])
    n = heal.heal_events(raw, [heal.state_step()], dataset="customers").first()["healed_rows"]
    bad = raw.where(~C.is_in(F.upper(F.trim("customer_state")), CUSTOMERS.domains["customer_state"])).count()
    assert n == bad == healed.where("customer_state = 'UNKNOWN'").count()


def test_repairs_accept_row_expressions_only(customers):
    with pytest.raises(ValueError):
        heal.repair(customers, [heal.RepairSpec("customer_city", "max(customer_city) OVER ()", "true")])
    with pytest.raises(ValueError):
        heal.repair(customers, [heal.RepairSpec("nope", "'x'", "true")])
    kept = heal.repair(customers, [heal.DropSpec("customer_state = 'SP'")])
    assert kept.count() == 4


def test_gold_sanity(spark):
    df = spark.createDataFrame([(float("nan"), float("inf"), -5.0, None)],
                               "avg_payment double, ratio double, total_revenue double, max_payment double")
    assert tuple(heal.heal_gold(df).first()) == (0.0, 0.0, 5.0, 0.0)


def test_steps_with_closed_outputs_settle_rules():
    steps = heal.bronze_steps("payments")
    assert [r.column for r in heal.unsettled(PAYMENTS.rules, steps)] == ["order_id", "payment_value", "payment_value"]
    assert heal.unsettled(PAYMENTS.rules, []) == list(PAYMENTS.rules)


def test_closed_outputs_hold(inputs):
    for dataset, spec in SPECS.items():
        for step in heal.bronze_steps(dataset):
            if step.outputs:
                healed = heal.apply_steps(inputs.raw(dataset), [step])
                assert healed.where(~C.is_in(F.col(step.column), step.outputs)).isEmpty()


def test_gold_rows_are_made_sane_and_say_so(spark):
    rows = [("p", "total_revenue", "-5.00"), ("p", "avg_installments", None), ("p", "total_payments", "3"),
            ("p", "status_breakdown", '{"a":1}'), ("p", "min_payment_value", "-1.00"), ("p", "max_payment_value", "NaN")]
    got = {r["kpi_key"]: (r["kpi_value"], r["kpi_issue"]) for r in heal.heal_kpi_rows(
        spark.createDataFrame(rows, "dataset string, kpi_key string, kpi_value string")).collect()}
    assert got == {"total_revenue": ("5.00", "negative"), "avg_installments": ("0", "not_a_number"),
                   "total_payments": ("3", None), "status_breakdown": ('{"a":1}', None),
                   "min_payment_value": ("-1.00", None), "max_payment_value": ("0", "not_a_number")}


def test_a_misspelt_rule_stops_routing(dirty_customers):
    with pytest.raises(ValueError, match="no column nope"):
        route.tag(dirty_customers, [not_null("nope")])


def test_members_of_a_set_of_any_size(spark, customers):
    allowed = spark.createDataFrame([("SP",), ("SP",), ("RJ",), (None,)], "s string")
    assert {r["customer_state"] for r in route.member_rows(customers, "customer_state", allowed).collect()} == {"SP", "RJ"}
    assert route.member_rows(customers, "customer_state", allowed, keep=False).count() == 3


def test_repairs_are_judged_by_the_analysed_expression(spark):
    df = spark.createDataFrame([(1, "select one"), (2, "b")], "a int, b string")
    found = heal.repair(df, [heal.RepairSpec("b", "'select one'", "b = 'b'")])
    assert [r.b for r in found.collect()] == ["select one", "select one"]
    refused = ("percentile(a, 0.5)", "max_by(a, b)", "count (1)", "sum(a) over (order by a)", "explode(array(a))",
               "(select max(1))", "nothing", "a in (select 1)")
    for text in refused:
        with pytest.raises(ValueError, match="row-level"):
            heal.repair(df, [heal.RepairSpec("a", text, "true")])
        with pytest.raises(ValueError, match="row-level"):
            heal.repair(df, [heal.DropSpec(f"{text} is null")])


def test_one_scan_fills_every_value_rule(spark, tmp_path):
    rows = [("a", "x", 1.0), ("a", "y", None), ("z", "y", 5.0), (None, None, 99.0)]
    spark.createDataFrame(rows, "p string, q string, v double").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    rules = [in_set("p", ["a", "b"]), in_set("q", ["x", "y"]), not_null("v"), between("v", 0, 10)]
    found = heal.heal_by_rules(df, rules)
    assert sorted(map(tuple, found.collect())) == [("a", "x", 1.0), ("a", "y", 0.0), ("a", "y", 5.0), ("a", "y", 10.0)]

    def scans(plan):
        return plan._jdf.queryExecution().optimizedPlan().toString().count("Relation [")

    # The subquery of all rules is one plan: more rules make no more of it.
    assert scans(heal.heal_by_rules(df, rules[:1])) == 2
    found.collect()
    executed = found._jdf.queryExecution().executedPlan().toString()
    assert executed.split("Initial Plan")[0].count("FileScan") <= 2
    again = heal.heal_by_rules(df, [in_set("p", ["a", "b"]), in_set("p", ["b", "z"])])
    assert {r.p for r in again.collect()} == {"b"}
