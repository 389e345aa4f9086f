"""Plan shape: what must and must not appear in physical plans."""

import re

import pytest

import __spark_entry__ as entry
from siltgate.operators import dedup, heal, validate
from siltgate.spec import PAYMENTS
from tests.conftest import FOLDER

QUERIES = entry.queries()
PYTHON = {"incident_recall"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_rows_and_no_cross_products(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text
    if name not in PYTHON:
        assert "Python" not in text and "InPandas" not in text


def test_a_suite_is_one_scan(inputs):
    text = plan(validate.check_results(inputs.payments, PAYMENTS.rules))
    assert len(re.findall(r"FileScan", text)) == 1
    assert "l_linenumber" not in text.split("ReadSchema")[1]


def test_repairs_are_one_projection(inputs):
    text = plan(heal.apply_steps(inputs.payments, heal.bronze_steps("payments")))
    # The input's own projection, and one for all repairs.
    assert text.count("Project ") <= 2 and "Exchange" not in text


def test_dedup_cuts_hot_keys_before_the_shuffle(inputs):
    text = plan(dedup.keep_last(inputs.customers, ["customer_id"]))
    assert re.search(r"WindowGroupLimit.*Partial", text) and re.search(r"WindowGroupLimit.*Final", text)


def test_scalar_filters_reach_the_scan(inputs):
    from siltgate.operators.ops import usage_of

    text = plan(usage_of(inputs.table("events")).where("node = 'click'"))
    assert "EqualTo(event_type,click)" in text


def test_routing_filters_on_predicates_not_on_reason_text(inputs):
    from siltgate.operators import route

    clean = plan(route.clean(route.tag(inputs.payments, PAYMENTS.rules, heal.bronze_steps("payments"))))
    assert "concat_ws" not in clean


def test_share_of_total_reads_the_table_once(spark):
    df = QUERIES["gold_revenue_by_type"](spark, FOLDER)
    df.collect()
    text = plan(df).split("Initial Plan")[0]
    assert "ReusedExchange" in plan(df) and len(re.findall("FileScan", text)) <= 1
