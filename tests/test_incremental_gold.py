"""Gold from retractable state equals a full recompute on histories with late, replaced and failed batches."""

import random

import pytest
from pyspark.sql import functions as F

from siltgate.operators import store
from siltgate.plans import gold, medallion
from siltgate.plans.incremental import GoldState
from siltgate.sources.layers import Layers
from siltgate.spec import SPECS
from siltgate.streaming.runner import Job


def kpis(df):
    return sorted((r.kpi_key, r.kpi_value) for r in df.collect())


@pytest.mark.parametrize(("dataset", "seed"), [("payments", 1), ("customers", 2), ("orders", 3), ("products", 4)])
def test_random_histories(spark, inputs, tmp_path, dataset, seed):
    spec, rng = SPECS[dataset], random.Random(seed)
    st = store.Store(Layers(str(tmp_path)))
    clean = medallion.refine(inputs.incoming(dataset).drop("batch_id").limit(150), spec).silver
    path = str(tmp_path / "rows")
    clean.withColumn("draw", F.abs(F.xxhash64(*spec.key))).write.parquet(path)
    clean = spark.read.parquet(path)
    other = clean.columns[-2]
    state = GoldState(st, spark, spec, buckets=3)
    written = []
    # New batches, late ones between them, and replays that change, add and drop keys.
    for batch in (0, 3, 5, 4, 3, 0, 6) if dataset == "payments" else (0, 3, 1, 3):
        part = clean.where(F.pmod("draw", F.lit(3)) != rng.randrange(3)).drop("draw")
        for c, t in part.dtypes:
            if t == "double":
                part = part.withColumn(c, F.round(F.col(c) * rng.choice([1, 2, 0.37]), 2))
        if rng.random() < 0.5:
            part = part.withColumn(other, F.when(F.pmod(F.xxhash64(*spec.key), F.lit(4)) > 0, F.col(other)))
        attempt = st.begin(spark, spec, batch)
        attempt.put("silver", part)
        reads = []
        real = store.Store._rows
        with pytest.MonkeyPatch.context() as patched:
            patched.setattr(store.Store, "_rows", lambda self, a, b, layer, entries: reads.append((layer, set(entries))) or real(
                self, a, b, layer, entries))
            state.apply(attempt)
            found = state.kpi_rows()
        if batch not in written:
            # A new batch reads the state and itself, however long the history.
            assert all(layer == "state" or batches == {batch} for layer, batches in reads)
            assert all("/state/" in f for f in found.inputFiles())
        attempt.commit()
        written.append(batch)
        assert kpis(found) == kpis(gold.kpi_rows(dataset, st.silver(spark, spec).drop("batch_id")))
    # A try that was applied but never committed is replaced, and a state that lags catches up.
    failed = st.begin(spark, spec, 7)
    failed.put("silver", clean.drop("draw").limit(5))
    state.apply(failed)
    st.put("silver", spec, 7, clean.drop("draw").limit(9))
    st.put("silver", spec, 2, clean.drop("draw").limit(20))
    assert state.catch_up() == [2, 7] and state.catch_up() == []
    assert kpis(state.kpi_rows()) == kpis(gold.kpi_rows(dataset, st.silver(spark, spec).drop("batch_id")))


def test_the_stream_can_keep_gold_by_state(spark, inputs, tmp_path):
    raw = inputs.incoming("payments").drop("batch_id").limit(200)
    draw = F.pmod(F.xxhash64(*raw.columns), F.lit(2))
    jobs = [Job(SPECS["payments"], store.Store(Layers(str(tmp_path / str(i)))), incremental=i) for i in (False, True)]
    for job in jobs:
        for b in (0, 1):
            job.process(raw.where(draw == b), b)
        job.replay(spark, 0)
    both = [sorted((r.batch_id, r.kpi_key, r.kpi_value) for r in job.store.read(spark, "gold", job.spec).collect()) for job in jobs]
    assert both[0] == both[1] and len(both[0]) == 2 * len(gold.KPI_KEYS["payments"])
