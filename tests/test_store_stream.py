import pytest
from pyspark.sql import functions as F

from siltgate.operators import store
from siltgate.plans import medallion
from siltgate.sources.layers import Layers
from siltgate.spec import ORDERS, PAYMENTS, SPECS
from siltgate.streaming.runner import Job, run_all

PREFER = (("payment_value", "desc"),)


def same(a, b):
    cols = sorted(a.columns)
    return (sorted(a.columns) == sorted(b.columns)
            and a.select(cols).exceptAll(b.select(cols)).isEmpty()
            and b.select(cols).exceptAll(a.select(cols)).isEmpty())


def test_upsert_newest_wins_and_null_keys_stay(spark):
    old = spark.createDataFrame([("a", 1), ("b", 1), (None, 9)], "k string, v int")
    new = spark.createDataFrame([("b", 2), ("c", 3)], "k string, v int")
    once = store.upsert(old, new, ["k"])
    assert sorted(map(tuple, once.collect()), key=str) == sorted([("a", 1), ("b", 2), ("c", 3), (None, 9)], key=str)
    assert same(store.upsert(once, new, ["k"]), once)


def test_union_of_differing_schemas(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([("q",)], "y string")
    assert sorted(map(tuple, store.append_with_missing([a, b]).collect()), key=str) == [(1, None), (None, "q")]


def split_source(spark, inputs, tmp_path, dataset, parts=3):
    """Three arrival files; whole keys may recur across files."""
    raw = inputs.incoming(dataset).drop("batch_id")
    path = str(tmp_path / f"source_{dataset}")
    key = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in raw.columns])
    for i in range(parts):
        raw.where(F.pmod(key, F.lit(parts)) == i).coalesce(1).write.mode("append").parquet(path)
    return path, raw


@pytest.mark.parametrize("compact_every", [None, 2])
def test_stream_equals_batch_and_replays_are_idempotent(spark, inputs, tmp_path, compact_every):
    path, raw = split_source(spark, inputs, tmp_path, "orders")
    st = store.Store(Layers(str(tmp_path / "store")))
    job = Job(ORDERS, st, compact_every=compact_every)
    run_all(spark, [(job, path, raw.schema)], str(tmp_path / "cp"), files_per_batch=1)
    whole = medallion.refine(raw, ORDERS)
    snap = st.newest_snapshot(spark, ORDERS)
    assert (snap is not None) == bool(compact_every)
    silver = st.silver(spark, ORDERS, snap).drop("batch_id")
    assert same(silver, whole.silver)
    assert st.read(spark, "quarantine", ORDERS).count() == whole.quarantine.count()
    assert st.read(spark, "raw", ORDERS).count() == raw.count()
    history = {r["batch_id"]: r["status"] for r in job.history(spark).collect()}
    assert history == {0: "complete", 1: "complete", 2: "complete"}
    before = {layer: st.read(spark, layer, ORDERS).count() for layer in ("silver", "quarantine", "gold")}
    job.replay(spark, 2)
    assert before == {layer: st.read(spark, layer, ORDERS).count() for layer in before}


def test_datasets_run_side_by_side(spark, inputs, tmp_path):
    st = store.Store(Layers(str(tmp_path / "store")))
    jobs = []
    for d in ("customers", "products"):
        path, raw = split_source(spark, inputs, tmp_path, d, parts=2)
        jobs.append((Job(SPECS[d], st), path, raw.schema))
    run_all(spark, jobs, str(tmp_path / "cp"), files_per_batch=1)
    for job, _, _ in jobs:
        assert job.history(spark).count() == 2
        assert st.silver(spark, job.spec).count() > 0


def test_a_bad_batch_is_recorded_and_the_stream_goes_on(spark, inputs, tmp_path, monkeypatch):
    path, raw = split_source(spark, inputs, tmp_path, "payments")
    st = store.Store(Layers(str(tmp_path / "store")))
    job = Job(PAYMENTS, st, PREFER, retries=0)
    real, seen = medallion.refine, []

    def sometimes(*args, **kw):
        seen.append(1)
        if len(seen) == 2:
            raise RuntimeError("poison batch")
        return real(*args, **kw)

    monkeypatch.setattr(medallion, "refine", sometimes)
    run_all(spark, [(job, path, raw.schema)], str(tmp_path / "cp"), files_per_batch=1)
    history = {r["batch_id"]: (r["status"], r["error"]) for r in job.history(spark).collect()}
    assert history[1] == ("error", "poison batch") and history[2][0] == "complete"
    job.replay(spark, 1)
    assert {r["status"] for r in job.history(spark).collect()} == {"complete"}
    assert st.read(spark, "raw", PAYMENTS).count() == raw.count()


def test_running_total_follows_corrections(spark):
    rows = [("a", 1, 10.0), ("b", 1, 5.0), ("a", 2, 4.0), ("c", 3, 1.0), ("b", 3, 7.0)]
    df = spark.createDataFrame(rows, "k string, batch_id int, v double")
    got = [(r["batch_id"], r["total_revenue"], r["silver_rows"]) for r in
           store.running_total(df, ["k"], "v").orderBy("batch_id").collect()]
    assert got == [(1, 15.0, 2), (2, 9.0, 2), (3, 12.0, 3)]


def test_stream_dedup_inside_the_watermark(spark, inputs, tmp_path):
    from siltgate.operators.dedup import without_late_duplicates

    events = inputs.table("events").withColumn("at", F.col("ts").cast("timestamp")).drop("ts")
    path = str(tmp_path / "events")
    events.union(events).coalesce(1).write.parquet(path)
    stream = spark.readStream.schema(events.schema).parquet(path)
    out = without_late_duplicates(stream, ["event_id"], "at", "1 day")
    q = (out.writeStream.format("parquet").option("path", str(tmp_path / "out"))
         .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == events.count()


def test_observed_heals_reach_the_progress_report(spark, inputs, tmp_path):
    from siltgate.streaming.runner import live_heals

    raw = inputs.payments
    path = str(tmp_path / "in")
    raw.coalesce(1).write.parquet(path)
    q = (live_heals(spark.readStream.schema(raw.schema).parquet(path), PAYMENTS).writeStream.format("noop")
         .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    q.awaitTermination()
    seen = [p.observedMetrics["heals"] for p in q.recentProgress if p.observedMetrics]
    assert sum(r["rows"] for r in seen) == raw.count() and sum(r["payment_type"] for r in seen) > 0


def put(spark, st, batch, rows, schema="order_id string, customer_id string"):
    st.put("silver", ORDERS, batch, spark.createDataFrame(rows, schema))


def held(df):
    return {r["order_id"]: r["customer_id"] for r in df.collect()}


def test_a_batch_older_than_the_snapshot_is_read(spark, tmp_path):
    st = store.Store(Layers(str(tmp_path / "store")))
    put(spark, st, 0, [("a", "0"), ("b", "0")])
    put(spark, st, 2, [("b", "2")])
    st.compact(spark, ORDERS, 2)
    put(spark, st, 1, [("b", "1"), ("c", "1")])
    snap = st.newest_snapshot(spark, ORDERS)
    assert snap == 2
    assert held(st.silver(spark, ORDERS, snap)) == held(st.silver(spark, ORDERS)) == {"a": "0", "b": "2", "c": "1"}
    st.compact(spark, ORDERS, 2, snap)
    assert held(st.silver(spark, ORDERS, st.newest_snapshot(spark, ORDERS))) == {"a": "0", "b": "2", "c": "1"}


def test_a_snapshot_of_a_rewritten_batch_counts_no_longer(spark, tmp_path):
    st = store.Store(Layers(str(tmp_path / "store")))
    put(spark, st, 0, [("a", "0")])
    st.compact(spark, ORDERS, 0)
    put(spark, st, 1, [("b", "1")])
    st.compact(spark, ORDERS, 1, 0)
    put(spark, st, 1, [("b", "new")])
    assert st.newest_snapshot(spark, ORDERS) == 0
    assert held(st.silver(spark, ORDERS, 0)) == {"a": "0", "b": "new"}


def test_a_column_that_a_later_batch_adds_stays(spark, tmp_path):
    st = store.Store(Layers(str(tmp_path / "store")))
    put(spark, st, 0, [("a", "0")])
    put(spark, st, 2, [("b", "2", 7)], "order_id string, customer_id string, extra int")
    st.compact(spark, ORDERS, 2)
    for snap in (None, 2):
        assert {r["order_id"]: r["extra"] for r in st.silver(spark, ORDERS, snap).collect()} == {"a": None, "b": 7}
    put(spark, st, 3, [("c", "3", "text")], "order_id string, customer_id string, extra string")
    with pytest.raises(Exception, match="MERGE|merge"):
        st.silver(spark, ORDERS).collect()


def test_a_passing_fault_is_retried_and_history_tells_what_was_written(spark, inputs, tmp_path, monkeypatch):
    raw = inputs.incoming("orders").drop("batch_id").limit(200)
    st = store.Store(Layers(str(tmp_path / "store")))
    job = Job(ORDERS, st, retries=1)
    real, seen = Job.recompute_gold, []

    def flaky(self, *args):
        seen.append(1)
        if len(seen) in fails:
            raise RuntimeError("first line\nsecond line")
        return real(self, *args)

    monkeypatch.setattr(Job, "recompute_gold", flaky)
    fails = {1}
    job.process(raw, 0)
    row = job.history(spark).where("batch_id = 0").first()
    assert (row["status"], row["attempts"], row["error"]) == ("complete", 2, None) and row["ended_at"] >= row["started_at"]
    fails = {3, 4}
    job.process(raw, 1)
    row = job.history(spark).where("batch_id = 1").first()
    assert row["status"] == "error" and row["error"] == "first line\nsecond line"
    # Nothing of a failed batch is visible, and its history says so.
    assert row["silver_rows"] == st.read(spark, "silver", ORDERS).where("batch_id = 1").count() == 0
    assert job.failed(spark) == [1] and job.retry_failed(spark) == [] and job.failed(spark) == []
    assert [r["batch_id"] for r in job.history(spark, newest=1).collect()] == [1]
    assert job.recent(spark).where("seconds >= 0").count() == 2
