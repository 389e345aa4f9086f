"""Ranked lexical search against a plain scorer."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from tests.conftest import FOLDER
from tests.llm.test_llm_text import DOCS, ODD

from siltgate.llm import lexical, queries

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def plain(docs, asked, top=20):
    """docs: (key, text) rows, asked: distinct (item, text) rows -> Counter of (item, rank, key, score)."""
    held = [(k, Counter(terms(t))) for k, t in docs]
    held = [(k, c) for k, c in held if c]
    n, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    found = Counter()
    for item, text in set(asked):
        scores = []
        for key, c in held:
            m = 75 + (25 * sum(c.values()) * n) // length
            score = sum(times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) *
                        ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m)) for t, times in Counter(terms(text)).items() if c[t])
            if score > 0:
                scores.append((-score, key is None, key))
        for rank, (score, none, key) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:top], 1):
            found[(item, rank, key, -score)] += 1
    return found


def result(df):
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("first", [1, 2, 16])
def test_query_equals_the_plain_scorer(spark, monkeypatch, first):
    monkeypatch.setattr(lexical, "BLOCK_DOCS", 16)
    monkeypatch.setattr(lexical, "FIRST", first)
    docs, asked = (spark.read.parquet(f"{FOLDER}/{t}.parquet").collect() for t in ("documents", "benchmark"))
    found = queries.QUERIES["op11_lexical_search"](spark, FOLDER)
    assert found.columns == ["item_id", "rank", "doc_id", "score"] and dict(found.dtypes)["rank"] == "int"
    assert result(found) == plain([(r.doc_id, r.text) for r in docs], [(r.item_id, r.text) for r in asked])


def test_odd_rows(spark, monkeypatch):
    """Nulls, repeats, ties, long texts, clashing columns, many parts, filter hits by chance, blocks cut by terms."""
    monkeypatch.setattr(lexical, "BLOCK_DOCS", 7)
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 40)
    monkeypatch.setattr(lexical, "SPLIT_BYTES", 50)
    monkeypatch.setattr(lexical, "QUERIES", 2)
    monkeypatch.setattr(lexical, "FILTER_BITS", 8)
    monkeypatch.setattr(lexical, "FIRST", 2)
    rng = np.random.default_rng(3)
    words = ["a", "B", "c1", "Ärger", "日本", "x9", "don", "t", "it", "s"]
    rows = [(i, " ".join(rng.choice(words, rng.integers(0, 12)))) for i in range(80)]
    rows += [*enumerate(ODD, 200), (None, "a b c1"), (None, None), (7, "a b"), (7, "a b"), (8, None), (9, ""), (10, "...")]
    asked = [(i, " ".join(rng.choice(words, 6))) for i in range(9)] + [
        (None, "a c1"), (3, None), (4, ""), (5, "zzz"), (6, "x9 a"), (6, "x9 a"), (1, "b B b ärger Ärger"), (11, "?!")]
    docs = spark.createDataFrame([(k, t, "en", "s", 1, "n", "u", "h") for k, t in rows], DOCS).repartition(3)
    items = spark.createDataFrame([(i, t, 5) for i, t in asked], "item_id long, text string, no long")
    assert result(lexical.search(docs, items)) == plain(rows, asked)
    assert lexical.search(docs.limit(0), items).count() == 0 and lexical.search(docs, items.limit(0)).count() == 0


def test_bounds_skip_work():
    """Pair bounds leave fewer lists to walk than the single maxima, and never change an answer."""
    rng = np.random.default_rng(1)
    docs, impact = [], []
    for _ in range(12):
        docs.append(np.unique(rng.integers(0, 4000, 400)))
        impact.append(rng.integers(1, 100_000, len(docs[-1])))
    block = lexical.Block(pa.array(range(4000)), np.arange(12), np.array([len(d) for d in docs]), np.concatenate(docs),
                          np.concatenate(impact))
    terms = [(i, 5 + i) for i in range(12)]
    total = np.zeros(4000, dtype=np.int64)
    for i, g in terms:
        total[docs[i]] += g * impact[i]
    want = np.lexsort((np.arange(4000), -total))[:20]
    joint = {(i, j): block.front(i, j) for i in range(12) for j in range(i + 1, 12)}
    for (i, j), (x, y) in joint.items():
        both = np.intersect1d(docs[i], docs[j])
        sums = [3 * impact[i][np.searchsorted(docs[i], d)] + 8 * impact[j][np.searchsorted(docs[j], d)] for d in both]
        assert max(sums, default=0) == (3 * x + 8 * y).max(initial=0)
    for pairs in (joint, {}):
        for beat in (0, int(total[want[-1]])):
            at, score = block.search(terms, pairs, beat, 20)
            assert at.tolist() == want.tolist() and score.tolist() == total[want].tolist()
    assert len(block.search(terms, joint, int(total.max()) + 1, 20)[0]) == 0
