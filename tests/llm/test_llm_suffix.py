"""Repeated passages against a dictionary of all windows."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tests.conftest import FOLDER
from tests.llm.test_llm_text import DOCS, ODD

from siltgate.llm import queries, suffix


def plain(rows, length=50):
    """(key, text) rows -> Counter of (key, n_bytes, removed spans, kept)."""
    order = lambda key: suffix.LAST_KEY if key is None else key
    least = {}
    for key, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - length + 1):
            part = data[i:i + length]
            least[part] = min(least.get(part, order(key)), order(key))
    found = Counter()
    for key, text in rows:
        data = (text or "").encode()
        spans = []
        for i in range(len(data) - length + 1):
            if least[data[i:i + length]] < order(key):
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + length
                else:
                    spans.append([i, i + length])
        edges = [0, *(e for s in spans for e in s), len(data)]
        kept = b"".join(data[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True))
        found[(key, len(data), tuple(map(tuple, spans)), kept)] += 1
    return found


def result(df, key="doc_id"):
    return Counter((r[key], r.n_bytes, tuple((s.start, s.end) for s in r.removed), bytes(r.kept)) for r in df.collect())


def test_query_equals_all_windows(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    found = queries.QUERIES["op13_suffix_dedup"](spark, FOLDER)
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    want = Counter((k, n, sum(y - x for x, y in s), len(s), hashlib.sha256(kept).hexdigest()) for k, n, s, kept in
                   plain([(r.doc_id, r.text) for r in docs]).elements())
    assert Counter(map(tuple, found.collect())) == want and sum(r[2] for r in want) > 10_000


def passages(seed, count):
    """Texts of few words and shared passages: matches of every length around the bound, at borders, within a document."""
    rng = np.random.default_rng(seed)
    words = ["ab", "ça", "the", "\n", "x" * 9, "日本", "0 0 0 0", "aaaa"]
    shared = [" ".join(rng.choice(words, n)) for n in (3, 9, 15, 20, 25, 40, 90)]
    for i in range(count):
        parts = [str(rng.choice(shared)) if rng.random() < 0.5 else "".join(map(chr, rng.integers(97, 123, rng.integers(1, 60))))
                 for _ in range(rng.integers(0, 9))]
        yield i * 3, "".join(parts)


@pytest.mark.parametrize("batches", [1, 4, 7])
def test_small_pieces_and_many_levels(spark, monkeypatch, batches):
    monkeypatch.setattr(suffix, "PIECE", 64)
    monkeypatch.setattr(suffix, "SORTED", 500)
    monkeypatch.setattr(suffix, "BUCKET_SUFFIXES", 40)
    rows = list(passages(batches, 70))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(suffix.remove_repeats(docs, batches=batches)) == plain(rows)


def test_odd_rows(spark):
    copy = "a passage of more than fifty bytes that several documents share, whole"
    rows = [*enumerate([*ODD, None, "", "x" * 49, "x" * 50, "x" * 51]), (None, copy), (None, copy + "!"), (None, None),
            (70, copy), (70, copy), (70, copy + " and more"), (71, "head " + copy), (72, copy[:49]), (73, copy[1:51]),
            (None, "y" * 60), (None, "y" * 70), (80, "z" * 120 + copy), (-5, "z" * 60)]
    docs = spark.createDataFrame([(k, t, "en", "s", 1, "n", "u", "h") for k, t in rows], DOCS).repartition(3)
    docs = docs.withColumns({c: docs.u for c in ("key", "ord", "copy", "kind", "bucket")})
    assert result(suffix.remove_repeats(docs)) == plain(rows)
    assert result(suffix.remove_repeats(docs, length=7)) == plain(rows, 7)
    assert suffix.remove_repeats(docs.limit(0)).count() == 0


def test_levels_merge_geometrically(spark):
    rows = list(passages(5, 60))
    docs = suffix._identified(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")
    family = suffix.SuffixFamily(4)
    sizes = []
    for i in range(6):
        family.add(docs.where(docs.key.between(i * 30, i * 30 + 29)))
        sizes.append([n for n, *_ in family.levels])
    assert sizes == [[1], [2], [2, 1], [4], [4, 1], [4, 2]]
    held = defaultdict(int)
    for _, level, _ in family.levels:
        for r in level.collect():
            for k in suffix.unsqueezed(r.k).tolist():
                held[r.bucket, k] += 1
    assert held and max(held.values()) <= len(family.levels)


def test_larger_buckets_send_fewer_rows(spark, monkeypatch):
    # Every bucket sends rows to every bucket: with buckets of one size their number grows with the square of the input.
    monkeypatch.setattr(suffix, "BUCKET_SUFFIXES", 6)
    monkeypatch.setattr(suffix, "FEW", 4, raising=False)
    sent, stored_in = Counter(), suffix.stored_in

    def counted(df, name, *by):
        found, folder = stored_in(df, name, *by)
        rows = found.select("kind", "ord").collect() if "kind" in found.columns else []
        sent.update(rows=len(rows), entries=sum(len(suffix.unsqueezed(r.ord)) for r in rows))
        return found, folder

    monkeypatch.setattr(suffix, "stored_in", counted)
    rows = list(passages(9, 300))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(suffix.remove_repeats(docs)) == plain(rows)
    assert sent["entries"] > 4 * sent["rows"]


def test_suffixes_are_dealt_evenly(spark):
    letters = np.random.default_rng(10).integers(97, 123, (20, 3000))
    docs = spark.createDataFrame([(i, 0, "".join(map(chr, x))) for i, x in enumerate(letters)], "ord long, copy long, text string")
    held = Counter()
    for r in suffix.SuffixFamily(8)._sampled(docs).where("kind = 0").collect():
        held[r.bucket] += len(suffix.unsqueezed(r.k))
    assert len(held) == 8 and max(held.values()) < 1.3 * sum(held.values()) / 8
