"""Token alignment against a plain walk over byte offsets."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.conftest import FOLDER
from tests.llm.test_llm_text import DOCS, ODD

from siltgate.llm import align, queries

TEXTS = [*ODD, None, "", "<s>a</s><|endoftext|> b", "▁x y", "a\r\n\r\n  b\t\tc", " " * 3000 + "x", "x " + "\n" * 600,
         "ЖЁ ж 12 ½ ²", "　\x0b\x0c\x85 a", "it's we'll I'D", "\x00a", "日本語"]


def files():
    import public_tokenizers

    return [public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


def sides(text):
    a, b = (align.tokenizer(p) for p in files())
    ids_a = a.library.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.model.encode(text)
    want = (" " + text).encode()
    if any(b"".join(t.bytes[i] for i in ids) != want for t, ids in ((a, ids_a), (b, ids_b))):
        return [], [], [], []
    return ids_a, ids_b, np.cumsum([len(a.bytes[i]) for i in ids_a]).tolist(), np.cumsum([len(b.bytes[i]) for i in ids_b]).tolist()


def plain(rows):
    """(key, text) rows -> the contract's columns, by offsets alone."""
    seen, found = Counter(), []
    for key, text in rows:
        ids_a, ids_b, end_a, end_b = sides(text) if text else ([], [], [], [])
        common = sorted(set(end_a) & set(end_b))
        groups = defaultdict(lambda: ([], []))
        for side, (ids, ends) in enumerate(((ids_a, end_a), (ids_b, end_b))):
            for i, e in zip(ids, ends, strict=True):
                groups[np.searchsorted(common, e)][side].append(str(i))
        links = []
        j = 0
        for i in range(len(ids_a)):
            low = end_a[i - 1] if i else 0
            while j and (end_b[j - 1] > low):
                j -= 1
            while end_b[j] <= low:
                j += 1
            k = j
            while k < len(ids_b) and (end_b[k - 1] if k else 0) < end_a[i]:
                links.append((ids_a[i], ids_b[k]))
                k += 1
        seen.update(set(links))
        text = ";".join(f"{','.join(x)}|{','.join(y)}" for _, (x, y) in sorted(groups.items()))
        found.append((key, len(ids_a), len(ids_b), len(groups), links, text))
    best = defaultdict(int)
    for (x, _), n in seen.items():
        best[x] = max(best[x], n)
    return [(key, n, m, g, len(links), sum(seen[p] == best[p[0]] for p in links), sum(seen[p] for p in links), text)
            for key, n, m, g, links, text in found]


def digested(rows):
    return Counter((*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in rows)


ends = st.sets(st.integers(1, 60), max_size=40)


@given(ends, ends)
@settings(max_examples=300, deadline=None)
def test_runs_cover_both_sides(x, y):
    a, b = sorted(x | {61}), sorted(y | {61})
    i = j = 0
    common = []
    found, link_a, link_b = align.runs(a, b)
    starts_a, starts_b = [0, *a], [0, *b]
    assert list(zip(link_a, link_b, strict=True)) == [(p, q) for p in range(len(a)) for q in range(len(b))
                                                      if starts_a[p] < b[q] and starts_b[q] < a[p]]
    for p, q, n, m in found:
        assert (p, q) == (i, j)
        if n > 0:
            assert n == m and a[i:i + n] == b[j:j + n]
            common += a[i:i + n]
        else:
            assert a[i - n - 1] == b[j + m - 1] and not set(a[i:i - n - 1]) & set(b[j:j + m - 1])
            common.append(a[i - n - 1])
        i, j = i + abs(n), j + m
    assert (i, j) == (len(a), len(b)) and common == sorted({*a} & {*b})


def test_the_fast_encoder_gives_the_librarys_ids(spark):
    a = align.tokenizer(files()[0])
    texts = [r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("text").collect()]
    for text in [*texts, *(t for t in TEXTS if t)]:
        assert a.encode(text) == a.library.encode(" " + text, add_special_tokens=False).ids


def test_query_equals_the_plain_walk(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    found = queries.QUERIES["op12_token_alignment"](spark, FOLDER)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(map(tuple, found.collect())) == digested(plain([(r.doc_id, r.text) for r in docs]))


@pytest.mark.parametrize("chunk", [1, 200, 4_000_000])
def test_odd_rows(spark, chunk, monkeypatch):
    monkeypatch.setattr(align, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(align, "CHUNKS_MET", 3)
    rows = [*enumerate(TEXTS), (None, "same words"), (None, None), (5, "same words"), (5, "same words")]
    docs = spark.createDataFrame([(k, t, "en", "s", 1, "n", "u", "h") for k, t in rows], DOCS).repartition(3)
    assert Counter(map(tuple, align.align(docs, *files()).collect())) == Counter(plain(rows))
    assert align.align(docs.limit(0), *files()).count() == 0
