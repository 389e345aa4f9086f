"""Operators with a scale-out path against brute force on small, skewed fixtures."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltgate.operators import recall
from siltgate.operators import percentiles
from siltgate.operators.percentiles import column_percentiles, exact_median, exact_percentiles, to_long
from siltgate.operators.profile import distinct_counts
from siltgate.operators import validate
from siltgate.spec import unique


def test_percentiles_match_numpy_with_a_hot_value(spark):
    rng = np.random.default_rng(3)
    a = np.concatenate([np.full(4000, 7.25), rng.normal(0, 50, 6000).round(3)])
    b = rng.integers(0, 5, 10_000).astype(float)
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a double, b double").repartition(6)
    probs = [0.0, 0.001, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {r["metric"]: r for r in exact_percentiles(to_long(df, ["a", "b"]), probs, side=4).collect()}
    for name, values in (("a", a), ("b", b)):
        want = np.percentile(values, [p * 100 for p in probs])
        assert np.allclose([got[name][f"p{i}"] for i in range(len(probs))], want)
    # b has few distinct values, a has many: both ways in one call, and all on either way.
    for small in (100, 0, 10**6):
        both = column_percentiles(df, ["a", "b"], probs, small=small)
        assert np.allclose(both["a"], np.percentile(a, [p * 100 for p in probs]))
        assert np.allclose(both["b"], np.percentile(b, [p * 100 for p in probs]))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-3, 3).map(float), st.floats(-1e6, 1e6)), min_size=1, max_size=40))
def test_median_of_anything(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    real = [v for v in values if v is not None]
    row = exact_median(df, "v").first()
    if not real:
        assert row["median"] is None
    else:
        assert row["median"] == pytest.approx(float(np.median(real)))


def vectors(n, dim, seed, copies=0):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dim))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    near = rng.integers(0, n, n // 3)
    v[near] = v[(near * 7 + 1) % n] + rng.normal(scale=0.02, size=(len(near), dim))
    if copies:
        v[-copies:] = v[0]      # one vector holds a third of all rows
    return v.astype(np.float32)


def brute(v, threshold):
    v = v.astype(np.float64)
    out = {}
    for i in range(1, len(v)):
        d = ((v[:i] - v[i]) ** 2).sum(axis=1)
        j = int(d.argmin())
        if d[j] < threshold:
            out[i] = (j, round(float(d[j]), 6))
    return out


@pytest.mark.parametrize("ship_bytes", [1 << 26, 0])
@pytest.mark.parametrize("threshold", [0.35, 1.6])
def test_recall_is_exact_on_both_paths(spark, monkeypatch, ship_bytes, threshold):
    monkeypatch.setattr(recall, "PIVOTS", 6)
    monkeypatch.setattr(recall, "MEMORY_BLOCK", 20)
    monkeypatch.setattr(recall, "INCIDENT_BLOCK", 30)
    v = vectors(180, 12, 5, copies=60)
    df = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(v)], "id bigint, vec array<float>")
    found = recall.recall(df, df, threshold, earlier_only=True, ship_bytes=ship_bytes).collect()
    got = {r["new_id"]: (r["memory_id"], round(r["distance"], 6)) for r in found}
    assert got == brute(v, threshold)


def test_recall_with_empty_memory(spark):
    df = spark.createDataFrame([(1, [1.0])], "id bigint, vec array<float>")
    assert recall.recall(df, df.limit(0), 1.0).count() == 0


def test_hot_keys_count_right(spark):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.when(F.col("id") % 2 == 0, None).otherwise(F.col("id")).alias("n"))
    got = {r["column_name"]: r["distinct_count"] for r in distinct_counts(df).collect()}
    assert got == {"k": 6001, "n": 4500}
    res = validate.check_results(df, [unique("k"), unique("n"), unique("k", "n")]).collect()
    assert [r["failed_count"] for r in sorted(res, key=lambda r: r["rule_id"])] == [2999, 4499, 1499]


@pytest.mark.parametrize("n", [900, 9_000])
def test_what_one_task_sorts_stays_bounded(spark, monkeypatch, n):
    """Ten times the rows take more levels, not larger ranges; answers stay exact, skewed values and hot ones included."""
    rng = np.random.default_rng(n)
    values = np.concatenate([rng.exponential(1, n) ** 6, rng.integers(0, 5, n // 3).astype(float)])
    df = spark.createDataFrame([(float(v),) for v in values], "a double").repartition(4)
    bound, side, seen = 60, 2, []
    real = percentiles._narrowed

    def narrowed(rows, by, *args):
        out = real(rows, by, *args)
        seen.append(out.groupBy(*by, "path").count().agg(F.max("count")).head()[0])
        return out

    monkeypatch.setattr(percentiles, "_narrowed", narrowed)
    levels = percentiles.levels_for(n, bound, side)
    probs = [0.0, 0.01, 0.5, 0.977, 1.0]
    got = exact_percentiles(to_long(df, ["a"]), probs, side=side, levels=levels).first()
    assert np.allclose([got[f"p{i}"] for i in range(5)], np.quantile(values, probs))
    assert len(seen) == levels and seen[-1] <= 2 * bound
    assert percentiles.levels_for(9_000, bound, side) > percentiles.levels_for(900, bound, side)
