"""Commits over many tables: whole or not at all, replays, schemas with defaults, bounded folders and calls."""

import pytest
from pyspark.sql import functions as F

from siltgate.operators import store
from siltgate.sources import manifest
from siltgate.sources.layers import Layers
from siltgate.spec import CUSTOMERS, ORDERS, PAYMENTS
from siltgate.streaming.runner import Job

KINDS = ("heals", "drift", "lineage", "audit")


def contents(spark, job):
    """Everything a reader sees of a dataset, as text."""
    out = {}
    for layer in ("silver", "quarantine", "masked", "gold"):
        df = job.store.read(spark, layer, job.spec)
        out[layer] = sorted(map(str, df.collect())) if df is not None else []
    for kind in KINDS:
        df = job.log(spark, kind)
        out[kind] = sorted(map(str, df.drop("detected_at").collect())) if df is not None else []
    return out


def batches(spark, inputs, dataset, n):
    raw = inputs.incoming(dataset).drop("batch_id").limit(60 * n)
    draw = F.pmod(F.xxhash64(*raw.columns), F.lit(n))
    return [raw.where(draw == i) for i in range(n)]


@pytest.mark.parametrize("broken", [1, 4, 6, 8])
def test_a_batch_that_breaks_between_two_writes_leaves_nothing(spark, inputs, tmp_path, monkeypatch, broken):
    first, second = batches(spark, inputs, "payments", 2)
    job = Job(PAYMENTS, store.Store(Layers(str(tmp_path))), (("payment_value", "desc"),), retries=0)
    job.process(first, 0)
    before = contents(spark, job)
    real, seen = store.Attempt.put, []

    def put(self, *args, **kw):
        seen.append(args[0])
        if len(seen) == broken:
            raise RuntimeError("no space left")
        return real(self, *args, **kw)

    with monkeypatch.context() as patched:
        patched.setattr(store.Attempt, "put", put)
        job.process(second, 1)
    assert len(seen) == broken and job.failed(spark) == [1] and contents(spark, job) == before
    if broken == 8:
        job.replay(spark, 1)
        whole = contents(spark, job)
        assert all(len(whole[k]) > len(before[k]) for k in ("silver", "lineage", "audit", "gold"))
        job.replay(spark, 1)
        assert contents(spark, job) == whole
        assert {r["batch_id"] for r in job.log(spark, "audit").select("batch_id").collect()} == {0, 1}


def test_lineage_is_what_the_writes_counted(spark, inputs, tmp_path):
    (raw,) = batches(spark, inputs, "customers", 1)
    job = Job(CUSTOMERS, store.Store(Layers(str(tmp_path))))
    job.process(raw, 0)
    rows = {layer: job.store.read(spark, layer, CUSTOMERS).count() for layer in ("silver", "quarantine", "masked", "gold")}
    rows["bronze"] = raw.count()
    edges = job.log(spark, "lineage").collect()
    assert len(edges) == 4 and all(r.rows_in == rows[r.source_layer] and r.rows_out == rows[r.target_layer] for r in edges)
    assert job.store.read(spark, "raw", CUSTOMERS).where("ingested_at is null").count() == 0
    duplicates = job.log(spark, "heals").where("issue = 'duplicate rows'").agg(F.sum("healed_rows")).head()[0] or 0
    assert rows["bronze"] == rows["silver"] + rows["quarantine"] + duplicates


def table(spark, st, batch, rows, schema="order_id string, customer_id string", layer="silver"):
    st.put(layer, ORDERS, batch, spark.createDataFrame(rows, schema))


def test_commits_fold_and_reading_costs_a_bounded_number_of_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(manifest, "FOLD_EVERY", 4)
    held = manifest.Manifest(spark, str(tmp_path), "orders")
    for i in range(30):
        entry = manifest.Entry("silver/orders", f"silver/orders/batch_id={i % 20}/try=t{i}", i, "{}", {"n": i})
        held.commit(i % 20, [entry])
    reads = []
    real = manifest.Files.read
    monkeypatch.setattr(manifest.Files, "read", lambda self, name: reads.append(name) or real(self, name))
    state = held.state()
    assert len(reads) <= 4 and sorted(state) == list(range(20))
    assert [state[b].of("silver/orders").rows for b in range(20)] == [*range(20, 30), *range(10, 20)]
    assert held.forget() > 0 and held.state() == state
    # Two writers never share a number.
    assert not held.files.create(sorted(n for n in held.files.names() if n[0] != ".")[0], "other") and held.state() == state
    a, b = (manifest.Manifest(spark, str(tmp_path), "orders").commit(50, []) for _ in range(2))
    assert b.number == a.number + 1 and held.state()[50] == b


def test_columns_that_batches_lack_hold_their_default(spark, tmp_path):
    st = store.Store(Layers(str(tmp_path)))
    table(spark, st, 0, [("a", "0")])
    table(spark, st, 1, [("b", "1", 7)], "order_id string, customer_id string, extra int")
    table(spark, st, 2, [("c", "2")])
    assert {r.order_id: r.extra for r in st.silver(spark, ORDERS).collect()} == {"a": None, "b": 7, "c": None}
    st.set_default(spark, ORDERS, "silver", "extra", "3")
    st.set_default(spark, ORDERS, "silver", "extra", "5")
    st.set_default(spark, ORDERS, "gold", "extra", "9")
    assert {r.order_id: r.extra for r in st.silver(spark, ORDERS).collect()} == {"a": 5, "b": 7, "c": 5}
    table(spark, st, 3, [("d", "3", "text")], "order_id string, customer_id string, extra string")
    with pytest.raises(ValueError, match="cannot merge silver/orders: extra is int in some batches and string in others"):
        st.silver(spark, ORDERS)


def test_folders_stay_bounded_and_no_answer_changes(spark, tmp_path):
    st = store.Store(Layers(str(tmp_path)))
    files = manifest.Files(spark, str(tmp_path))

    def folders():
        return sum(len(files.names(f"{t}/{b}")) for t in ("audit/heals_orders", "gold/orders", "silver/orders", "snapshots/orders")
                   for b in files.names(t))

    counted = []
    for i in range(18):
        for again in range(2):       # every batch is replayed once
            attempt = st.begin(spark, ORDERS, i)
            attempt.put("silver", spark.createDataFrame([(f"o{i % 7}", str(i + again))], "order_id string, customer_id string"))
            attempt.put("audit", spark.createDataFrame([(i,)], "n int"), "heals_orders")
            attempt.put("gold", spark.createDataFrame([(i,)], "n int"))
            if again or i % 3:
                attempt.commit()
        if i % 3 == 2:
            st.compact(spark, ORDERS, i, st.newest_snapshot(spark, ORDERS))
            before = sorted(map(tuple, st.silver(spark, ORDERS, st.newest_snapshot(spark, ORDERS)).collect()))
            st.sweep(spark, ORDERS, keep_logs=4)
            after = sorted(map(tuple, st.silver(spark, ORDERS, st.newest_snapshot(spark, ORDERS)).collect()))
            assert before == after == sorted(map(tuple, st.silver(spark, ORDERS).collect()))
            counted.append(folders() - i - 1)       # Silver keeps one folder per batch
    assert max(counted) <= 4 + 4 + 2
    assert sorted(r.n for r in st.read(spark, "audit", ORDERS, "heals_orders").collect()) == [14, 15, 16, 17]
    assert len(files.names("commits/orders")) < 40
