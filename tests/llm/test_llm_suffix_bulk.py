"""Windows of many documents at once against loops."""

import numpy as np
import pyarrow as pa

from siltgate.llm import suffix
from siltgate.llm.common import squeezed


def test_windows_of_whole_and_cut_texts(monkeypatch):
    monkeypatch.setattr(suffix, "PIECE", 64)
    texts = ["abcdefghijklmnop" * n for n in (1, 2, 9, 30)]
    lo = [np.array(x) for x in ([0, 3], [5], [0, 60, 90], [1, 62, 63, 300])]
    span = [np.array(x) for x in ([1, 2], [0], [3, 9, 0], [0, 1, 5, 40])]
    batch = pa.record_batch({"ord": pa.array([4, 5, 6, 7]), "copy": pa.array([0, 0, 1, 0]), "text": pa.array(texts),
                             "lo": pa.array([squeezed(x) for x in lo]), "span": pa.array([squeezed(x) for x in span])})
    found = [suffix._windows(p, 3, 8) for p in suffix._windowed(iter([batch]), 8)]
    rows = sorted((o, at, k, c) for e in found for o, at, k, c in zip(e.ord, e.lo, e.k, e.c, strict=True))
    assert [r[:2] for r in rows] == sorted((4 + i, at) for i in range(4) for x, n in zip(lo[i], span[i], strict=True)
                                           for at in range(x, x + n + 1))
    same = {}
    for one, at, k, c in rows:
        same.setdefault(texts[one - 4][at:at + 8], set()).add((k, c))
    assert all(len(x) == 1 for x in same.values()) and len(set.union(*same.values())) == len(same)


def test_smaller_documents_with_colliding_hashes():
    rng = np.random.default_rng(3)
    k, c, ords = (rng.integers(0, n, 400) for n in (60, 3, 50))
    every = suffix.Entries(k, c, ords, np.zeros_like(k), np.arange(400), np.zeros_like(k))
    removed, rest = suffix._smaller_elsewhere(every)
    least = {}
    for x in zip(k, c, ords, strict=True):
        least[x[:2]] = min(least.get(x[:2], 99), x[2])
    want = [i for i in range(400) if ords[i] > least[k[i], c[i]]]
    assert sorted(removed.lo) == want and len(rest) == 400 - len(want)
    assert (np.diff(rest.k) >= 0).all()


def test_order_is_lexsort():
    rng = np.random.default_rng(4)
    for high in (2, 1 << 20, 1 << 62):
        keys = [rng.integers(0, n, 500) for n in (3, high, 40)]
        assert (suffix._order(*keys) == np.lexsort(keys)).all()
    assert len(suffix._order(*(np.empty(0, np.int64),) * 3)) == 0


def test_scan_by_parts_is_scan_of_all():
    rng = np.random.default_rng(6)
    k, c, ords, lo = (rng.integers(0, n, 900) for n in (1 << 32, 3, 40, 10_000))
    k = rng.choice(k[:150], 900)
    c = np.where(rng.random(900) < 0.1, suffix._SEVERAL, c)
    place = np.where(c == suffix._SEVERAL, rng.integers(1, 3, 900), rng.integers(0, 3, 900))
    every = suffix.Entries(k, c, ords, np.zeros_like(k), lo, np.zeros_like(k))
    plain = lambda e: [getattr(e, x).tolist() for x in ("k", "c", "ord", "copy", "lo", "span")]
    for one, whole in zip(suffix.merge_scan(every, place, 20), suffix.merge_scan(every, place, 900), strict=True):
        assert len(one) and plain(one) == plain(whole)


def test_order_of_wide_keys():
    rng = np.random.default_rng(7)
    for _ in range(30):
        wide = rng.integers(-(1 << 63), (1 << 63) - 1, 300)
        keys = [wide, np.append(wide[:150], wide[:150]), rng.integers(-3, 3, 300), rng.choice([-(1 << 63), (1 << 63) - 1], 300)]
        assert (suffix._order(*keys) == np.lexsort(keys)).all()
