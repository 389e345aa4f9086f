"""Packing, token counts, language ID, personal data, the n-gram join and mixing against brute force."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.conftest import FOLDER

from siltgate.llm import components, langid, mixing, ngram_join, pack, private, queries, tokens, wordbpe

DOCS = "doc_id long, text string, lang string, source string, n_chars long, node string, u string, text_hash string"
ODD = ["it's Don't", "<|endoftext|> a", "a<|startoftext|>b", "ÄÖ ß İstanbul Σς", "a\x1cb\xa0c", "e\u0301 x", "日本語 テスト",
       "don''ts 'S ...!? 1234 x9y", "ª º µm ×÷ ÿ", "\u200b", "  \n\t ", "x" * 5000, "a b " * 9000]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def local(documents):
    return documents.toPandas()


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls everywhere, empty and very long texts, repeated rows, columns with clashing names."""
    rows = [(i, t, "en", "s", len(t), "n", "u", "h") for i, t in enumerate(ODD)]
    rows += [(None, "some words of a text", None, None, None, None, None, None), (90, None, "en", "s", None, "n", "u", "h"),
             (91, "", "en", None, 0, None, None, None), (92, "same words here again and again", "en", "s", 1, "n", "u", "h"),
             (92, "same words here again and again", "en", "s", 1, "n", "u", "h")]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


def library(texts):
    tok = wordbpe.tokenizer(queries.word_bpe())
    return [x.ids for x in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_ids_are_the_librarys(local):
    texts = [*local.text, *ODD, None, ""]
    found = [np.frombuffer(b, "<u4").tolist() for b in wordbpe.id_bytes(queries.word_bpe(), texts)]
    assert found == library(texts)


def test_the_cache_may_overflow(local, monkeypatch):
    monkeypatch.setattr(wordbpe, "CACHE_ENTRIES", 50)
    monkeypatch.setattr(wordbpe, "GROUP_CHARS", 2_000)
    cached = wordbpe.PreTokens(queries.word_bpe(), len)
    assert list(wordbpe.encoded(local.text[:40], cached, sum)) == [len(x) for x in library(local.text[:40])]


def test_token_counts(spark, odd, none, local):
    found = queries.QUERIES["op10_token_counts"](spark, FOLDER).toPandas().set_index("doc_id").loc[local.doc_id]
    want = [len(x) for x in library(local.text)]
    assert found.n_tokens.tolist() == want and found.over_limit.tolist() == [n > 2048 for n in want]
    assert found.n_bytes.tolist() == [len(t.encode()) for t in local.text]
    rows = odd.collect()
    want = Counter((r.doc_id, len((r.text or "").encode()), n) for r, n in
                   zip(rows, map(len, library([r.text for r in rows])), strict=True))
    assert Counter(tuple(r)[:3] for r in tokens.count_tokens(odd, queries.word_bpe()).collect()) == want
    assert tokens.count_tokens(none, queries.word_bpe()).count() == 0


def held_packing(found, rows):
    ids = {}
    for (key, _), x in zip(rows, library([t for _, t in rows]), strict=True):
        ids.setdefault(key, np.array([*x, 2], dtype="<u4"))
    copies = Counter(k for k, _ in rows)
    covered = Counter()
    for r in found:
        piece = ids[r.doc_id][r.start:r.start + r.length]
        assert len(piece) == r.length and zlib.crc32(piece.tobytes()) == r.ids_crc32
        assert r.doc_tokens == len(ids[r.doc_id])
        covered[r.doc_id] += r.length
    assert covered == {k: len(ids[k]) * n for k, n in copies.items()}
    ends = Counter()
    for r in sorted(found, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends[r.sequence_id]
        ends[r.sequence_id] += r.length
    assert max(ends.values()) <= pack.MAX_LEN
    return sum(ends.values()) / (pack.MAX_LEN * len(ends))


def test_packing(spark, odd, none, local):
    found = queries.QUERIES["op6_packing"](spark, FOLDER).collect()
    assert held_packing(found, list(zip(local.doc_id, local.text, strict=True))) > 0.95
    held_packing(pack.pack(odd, queries.word_bpe()).collect(), [(r.doc_id, r.text) for r in odd.collect()])
    assert pack.pack(none, queries.word_bpe()).count() == 0


def test_histogram_packing_is_tight_and_small():
    rng = np.random.default_rng(1)
    histogram = dict(Counter(rng.integers(1, 4097, 200_000).tolist()))
    slots = pack.pack_histogram(histogram)
    total = sum(k * n for k, n in histogram.items())
    assert total / (slots.sequences * 4096) > 0.99
    again = pack.pack_histogram({k: n * 1000 for k, n in histogram.items()})
    assert len(again.first) < 3 * len(slots.first) + 20_000
    assert pack.pack_histogram({4096: 3, 1: 5}).sequences == 4 and pack.pack_histogram({}).sequences == 0


def test_language_id(spark, local):
    found = queries.QUERIES["op2_language_id"](spark, FOLDER).toPandas().set_index("doc_id").loc[local.doc_id]
    held = np.array([zlib.crc32(str(i).encode()) % 4 == 2 for i in local.doc_id])
    assert (found.held_out.to_numpy() == held).all()
    assert (found.lang_pred.to_numpy() == local.lang.to_numpy())[held].mean() > 0.97
    assert found.score.between(0, 1).all() and found.lang_rejected.mean() < 0.02


def test_language_id_of_odd_rows(spark, documents, odd, none):
    model = langid.fit(documents)
    found = langid.predict(odd.drop("lang"), model).collect()
    assert len(found) == odd.count()
    for r in found:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters)
        assert letters or (r.lang_score == 0 and r.lang_rejected)
    assert langid.fit(none) is None and langid.fit(odd.withColumn("lang", F.lit(None).cast("string"))) is None
    assert {r.lang_pred for r in langid.predict(odd, None).collect()} == {"und"}
    assert langid.predict(none, model).count() == 0
    assert langid.fold(odd).where("doc_id is null and held_out").count() == 0
    alone = langid.fit(documents.where("lang = 'en'"))
    assert alone.languages == ["en"]


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "card":
        odd = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(x - 9 * (x > 9) for x in odd) % 10 == 0
    return True


def base_of(text):
    spans = [(m.start(), rank, m.end(), kind) for rank, (kind, p) in enumerate(BASE.items())
             for m in re.finditer(p, text or "") if valid(kind, m.group())]
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in sorted(spans))


TRICKY = ["a@b.c_d@e.f x@y.z.w.", "1.2.3.4.5.6.7.8.9 300.1.1.1 001.002.003.0004 1.2.3", "4111 1111-1111  1111 4111111111111111",
          "+1 (234) 555-6789. +49-170-1234567) +1..2 +" + "9" * 30, "é 日本 a.b+c@d-e.fr \U0001f600 10.0.0.255", "x\x01y\x02a@b.de",
          "@@ a@ @b.c a@b a@b. a@.b.c", "1 " * 3000 + "2.2.2.2", "0" * 5000, "a." * 4000 + "@b" + ".c" * 3000,
          "4111111111111111-4111111111111111", "99999999999999999999.1.1.1", "5.5.5.5.5"]


def test_private_data_base_spans(spark, local, odd, none):
    found = queries.QUERIES["op7_private_data"](spark, FOLDER).toPandas().set_index("doc_id").loc[local.doc_id]
    for text, row in zip(local.text, found.itertuples(), strict=True):
        want = base_of(text)
        assert row.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert set(filter(None, want.split(","))) <= set(row.spans.split(","))
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [want.count(f"{k}:") for k in BASE]
    df = spark.createDataFrame(list(enumerate(TRICKY)), "doc_id long, text string")
    for r in private.report(private.find_private(df)).collect():
        assert r.base_sha256 == hashlib.sha256(base_of(TRICKY[r.doc_id]).encode()).hexdigest(), r
    assert private.report(private.find_private(odd)).count() == odd.count()
    assert private.find_private(none).count() == 0


def test_trusted_patterns_name_unseen_identifiers(spark):
    rows = [(i, f"please call him at +1 (234) 555-{1000 + i} today") for i in range(12)]
    rows += [(20, "please call him at 234-555-7777 today"), (21, "the sum is 1234567 units")]
    rows += [(30 + i, f"item no {7000000 + i} in stock") for i in range(12)] + [(50, "item no 10.0.0.1 in stock"), (51, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in private.report(private.find_private(df)).collect()}
    assert found[20].spans == "phone:19:31" and found[20].n_phone == 0
    assert found[21].spans == "" and all(found[30 + i].spans == "" for i in range(12))
    masked = {r.doc_id: r.text for r in private.mask_private(df).collect()}
    assert masked[20] == "please call him at [PHONE] today" and masked[50] == "item no [IP] in stock"
    assert masked[21] == "the sum is 1234567 units" and masked[51] is None and masked[0] == masked[20]


def test_spaced_identifiers_and_patterns_found_in_rounds(spark):
    rows = [(i, f"please call him at +1 (234) 555-{1000 + i} today") for i in range(12)]
    spaced = ["(523) 555-1055", "523 555 1055", "(523) 555 1057", "523.555.1058"]
    rows += [(20 + i, f"please call him at {x} today") for i, x in enumerate(spaced)]
    rows += [(30, "please call him at 523 555 1099, today"), (31, "it weighs 523 555 1066 grams"), (32, "1 " * 40000 + "a")]
    # The new words surround no base match, only what the first round names.
    rows += [(40 + i, f"office line: {x} (main)") for i, x in enumerate(spaced)] + [(50, "office line: 77 555 1234 (main)")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    masked = {r.doc_id: r.text for r in private.mask_private(df).collect()}
    assert [masked[20 + i] for i in range(4)] == ["please call him at [PHONE] today"] * 4
    assert masked[30] == "please call him at [PHONE], today" and masked[31] == dict(rows)[31] and masked[32] == dict(rows)[32]
    assert {masked[i] for i in (40, 41, 42, 43, 50)} == {"office line: [PHONE] (main)"}
    spans = {r.doc_id: r.spans for r in private.report(private.find_private(df)).collect()}
    assert spans[20] == "phone:19:33" and spans[50] == "phone:13:24"


def shingle_set(text, n=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset([tuple(words)]) if 0 < len(words) < n else frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1))


def linked(rows, words=4, percent=85):
    """doc_id -> smallest id, by every pair."""
    sets = [(k, shingle_set(t, words)) for k, t in rows]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, (_, x) in enumerate(sets):
        for b in range(a):
            y = sets[b][1]
            if x and y and 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    root[find(a)] = find(b)
    least = {}
    for i, (k, _) in enumerate(sets):
        least[find(i)] = min(k, least.get(find(i), k))
    return {k: least[find(i)] for i, (k, _) in enumerate(sets)}


def copies(n, words, edits, seed):
    """A group of near copies of one text, with its own number of edited words each."""
    rng = np.random.default_rng(seed)
    base = [f"w{seed}x{i}" for i in range(words)]
    out = []
    for i in range(n):
        own = list(base)
        for at in rng.choice(words, rng.integers(0, edits + 1), replace=False):
            own[at] = f"e{seed}x{i}x{at}"
        out.append(" ".join(own))
    return out


def test_ngram_join(spark, local):
    found = queries.QUERIES["op9_ngram_join"](spark, FOLDER).toPandas().set_index("doc_id").loc[local.doc_id]
    rows = list(zip(local.doc_id, local.text, strict=True))
    assert found.n_shingles.tolist() == [len(shingle_set(t)) for _, t in rows]
    want = linked(rows)
    assert found.component_id.tolist() == [want[k] for k in local.doc_id]


@pytest.mark.parametrize("limits", [{}, {"PAIRED": 2, "BLOCK_ROWS": 16, "BLOCK_MEMBERS": 2_000, "COLUMN_BLOCK": 32}])
def test_ngram_join_of_large_groups_and_shared_passages(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(ngram_join, name, value)
    texts = copies(70, 60, 3, 1) + copies(40, 400, 14, 2) + copies(30, 12, 1, 3) + ["exact copy of one text"] * 25
    passage = " ".join(f"p{i}" for i in range(40))
    texts += [f"{passage} " + " ".join(f"o{i}x{k}" for k in range(i % 12)) for i in range(40)]
    rows = [(int(i), t) for i, t in zip(np.random.default_rng(4).permutation(len(texts)), texts, strict=True)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {r.doc_id: r.component_id for r in ngram_join.join(df).collect()}
    assert found == linked(rows)


def test_ngram_join_of_odd_rows(odd, none):
    found = ngram_join.join(odd).collect()
    assert len(found) == odd.count()
    by_id = {r.doc_id: (r.n_shingles, r.component_id) for r in found}
    assert by_id[None] == (2, None) and by_id[90] == (0, 90) and by_id[91] == (0, 91) and by_id[92] == (3, 92)
    assert ngram_join.join(none).count() == 0
    kept = ngram_join.keep_one(odd)
    assert kept.columns == odd.columns and Counter(r.doc_id for r in kept.collect()) == Counter(set(by_id))
    clash = odd.withColumns({c: F.lit(1) for c in ("key", "rows", "kept_key", "kept_rows", "component_id", "spans")})
    assert ngram_join.keep_one(clash).columns == clash.columns and ngram_join.keep_one(clash).count() == kept.count()


@pytest.mark.parametrize(("words", "percent"), [(5, 80), (2, 50), (1, 99)])
def test_ngram_join_of_other_likeness(spark, words, percent):
    texts = copies(30, 60, 4, 1) + copies(20, 200, 30, 2) + copies(20, 9, 2, 3)
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r.doc_id: r.component_id for r in ngram_join.join(df, words=words, percent=percent).collect()}
    assert found == linked(rows, words, percent)


def test_masked_columns_of_any_name(odd):
    clash = odd.withColumns({c: F.lit("x") for c in ("key", "text_hash", "spans", "mask_key", "mask_spans", "base")})
    found = private.mask_private(clash)
    assert found.columns == clash.columns and found.count() == clash.count()


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7)] + [(200, 201 + i) for i in range(50)]
    found = {r.node: r.component for r in components.components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert found == {i: 0 for i in range(1, 61)} | {101: 100} | {201 + i: 200 for i in range(50)}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def source_tokens(df):
    return {r[0]: r[1] for r in df.groupBy("source").agg(F.sum("mix_tokens")).collect()}


def test_mixing_meets_the_weights(spark):
    rows = [(i, "w " * (5 + i % 7), "hot" if i % 3 else f"s{i % 4}") for i in range(3000)]
    df = spark.createDataFrame([*rows, (None, "a b c", None), (9000, None, "hot"), (9001, "", "empty")],
                               "doc_id long, text string, source string")
    counts = source_tokens(df.withColumn("mix_tokens", mixing.word_count(F.col("text"))))
    found = mixing.mix(df, entropy=0.9, repeats=2.0, block_docs=64).cache()
    got, total = source_tokens(found), sum(n for n in counts.values())
    assert "empty" not in got and got["hot"] < counts["hot"] and got["s0"] > counts["s0"]
    assert all(got[s] <= 2.0 * counts[s] + 1 for s in got) and 0.97 * total < sum(got.values()) <= total
    uses = Counter((r.doc_id, r.mix_epoch) for r in found.collect())
    assert max(uses.values()) == 1
    whole = {r.source: r.n for r in found.where("mix_epoch = 0").groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert whole["s0"] == sum(s == "s0" for _, _, s in rows)
    # Blocks before the last are whole.
    per_block = Counter((r.source, r.mix_block) for r in found.where("source = 'hot'").select("source", "mix_block").collect())
    full = Counter((r.source, r.b) for r in df.where("source = 'hot'").select(
        "source", (mixing.block_draw(F.col("doc_id"), F.md5("text")) % F.lit(-(-sum(s == "hot" for _, _, s in rows) // 64) or 1)).alias(
            "b")).collect())
    assert sum(per_block[k] != full[k] for k in per_block) <= 2
    assert mixing.mix(df.limit(0)).count() == 0
    assert mixing.bisect(lambda s: s <= 37, 0, 100) == 37 and mixing.bisect(lambda s: False, 3, 9) == 3


def test_mixing_uses_rows_without_a_key(spark):
    rows = [(i, f"w {i}", "a") for i in range(1400)] + [(None, f"n {i}", "a") for i in range(400)] + [(None, "same", "a")] * 3
    rows += [(5000 + i, "b b", "b") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mix(df, budget=2400, entropy=0.9, repeats=1.0, block_docs=64)
    used = Counter(r.doc_id is None for r in found.where("source = 'a' and mix_epoch = 0").collect())
    assert 0.15 < used[True] / (used[True] + used[False]) < 0.3 and used[False] < 1400
    import duckdb

    documents = df.toPandas().astype({"doc_id": "Int64"})  # noqa: F841
    want = Counter(duckdb.sql(mixing.mix_sql(0.9, 4.0, 64)).fetchall())
    got = mixing.mix(df, entropy=0.9, repeats=4.0, block_docs=64)
    assert Counter((r.doc_id, r.source, r.mix_tokens, r.mix_epoch, r.mix_block, r.mix_draw) for r in got.collect()) == want
