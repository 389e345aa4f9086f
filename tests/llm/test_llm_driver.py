"""What the stages of the pipeline send through the driver."""

import numpy as np
from tests.conftest import FOLDER

from siltgate.llm import components, langid, ngram_join


def spied(monkeypatch, df, name):
    """What calls of df's method of this name return."""
    kind = next(k for k in type(df).__mro__ if name in vars(k))
    method, results = vars(kind)[name], []

    def call(self, *args):
        results.append(method(self, *args))
        return results[-1]

    monkeypatch.setattr(kind, name, call)
    return results


def test_levels_come_packed(spark, monkeypatch):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    like = ngram_join.Likeness()
    grams = [ngram_join.shingles(r.text, like.words) & (ngram_join.COUNTERS - 1) for r in docs.collect()]
    counts = np.bincount(np.concatenate(grams), minlength=ngram_join.COUNTERS).astype(float)
    want = np.digitize((counts - counts.mean()) / max(1.0, counts.mean() ** 0.5), ngram_join.DEVIATIONS)
    rows, tables = (spied(monkeypatch, docs, name) for name in ("collect", "toArrow"))
    assert (ngram_join.column_levels(docs, "text", like) == want).all()
    sent = sum(len(x) for found in rows for r in found for x in r if isinstance(x, (bytes, bytearray)))
    assert sent + sum(t.nbytes for t in tables) < ngram_join.COUNTERS
    assert (ngram_join.column_levels(docs.limit(0), "text", like) < 8).all()


def test_training_rows_come_packed(spark, monkeypatch):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    tables = spied(monkeypatch, docs, "toArrow")
    trained = {}
    monkeypatch.setattr(langid, "_train", lambda ids, part, langs, bucket, n: trained.update(bucket=bucket, n=n))
    langid.fit(docs)
    entries = sum(map(len, trained["bucket"]))
    assert entries == sum(map(len, trained["n"])) > 10_000
    assert sum(t.nbytes for t in tables) < 4 * entries


def test_rounds_of_components_broadcast_nothing(spark, monkeypatch):
    plans = []

    def stored(df, name, write=components.stored):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(components, "stored", stored)
    edges = spark.createDataFrame([(i, i + 1) for i in range(40) if i % 10], "u long, v long")
    found = dict(map(tuple, components.components(edges).collect()))
    assert found == {i: i // 10 * 10 + 1 for i in range(2, 41) if i % 10 != 1} | {i: i - 9 for i in (10, 20, 30, 40)}
    assert len(plans) > 2 and not any("Broadcast" in p for p in plans)
