"""Vector searches, HTML text, URL filters, the SQL of the package and the pipeline."""

import html as references
import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests import crosscheck
from tests.conftest import FOLDER

import __spark_entry__ as entry
import corpus_pipeline
from siltgate.llm import ann, html, langid, mixing, private, queries, topk, urls, vectors
from siltgate.llm.common import stored
from tests.llm.test_llm_text import held_packing, linked


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql_agrees(spark, name):
    con = crosscheck.duck(FOLDER)
    verdict, _, _ = crosscheck.compare(spark, con, FOLDER, name, queries.QUERIES[name], queries.ORACLES[name])
    assert verdict == "match", verdict


def test_every_operator_is_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in names} == set(range(1, 11)) and "pipeline" in entry.queries()


VECTORS = "vec_id long, embedding array<float>, id string, v string"


@pytest.fixture(scope="module")
def odd(spark):
    """Ties, repeated rows, nulls, other lengths, clashing names."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 6)], "a", "b") for i in range(260)]
    rows += [(300, None, "a", None), (400, [1.0, None, 0.0, 0.0, 0.0, 0.0], None, None), (500, [float("nan")] * 6, "", ""),
             (600, [0.0] * 6, "", ""), (700, [1.0, 2.0], "", ""), (701, [2.0, 1.0], "", ""), (800, [], "", ""),
             (None, [1.0] * 6, "", ""), (5, rows[5][1], "a", "b"), (900, [float("inf")] * 6, None, None)]
    return spark.createDataFrame(rows, VECTORS)


def brute(rows, every, k, ints, zero=True):
    seen = [(i, np.floor(1024 * np.array(v, dtype=float)) if ints else np.array(v, dtype=float)) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and (zero or any(v))]
    out = {}
    for i, q in seen:
        if i % every == 0:
            near = sorted((-float(q @ v), j) for j, v in seen if j != i and len(v) == len(q))
            if near[:k]:
                out[i] = [(j, -s) for s, j in near[:k]]
    return out


def by_query(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, float(r.score)))
    return out


@pytest.mark.parametrize("limits", [{}, {"BLOCK_ROWS": 32, "BLOCK_QUERIES": 1}])
def test_exact_topk(odd, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(topk, name, value)
    monkeypatch.setattr(topk, "COLUMNS", 2)
    found = by_query(topk.exact_topk(odd, F.col("vec_id") % 20 == 0))
    assert found == brute([(r.vec_id, r.embedding) for r in odd.collect()], 20, 10, True)
    assert topk.exact_topk(odd.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_topk_of_numbers_beyond_doubles():
    rows = np.array([[2.0 ** 30, 1.0], [2.0 ** 30, 3.0], [-1.0, 5.0]])
    ids, scores = topk.search_block(rows[:1], np.array([0]), rows, np.array([0, 1, 2]), 2)[0]
    assert ids.tolist() == [1, 2] and scores.tolist() == [2 ** 60 + 3, -(2 ** 30) + 5]


def test_nearest_neighbours(spark, odd):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding").collect()
    want = brute([(r.vec_id, r.embedding) for r in rows], 20, 20, False)
    found = by_query(queries.QUERIES["op4_nearest_neighbours"](spark, FOLDER))
    assert found.keys() == want.keys() and {len(x) for x in found.values()} == {20}
    recall = [len({i for i, _ in found[q]} & {i for i, _ in want[q]}) / 20 for q in want]
    assert np.mean(recall) >= 0.9
    scores = {(q, i): s for q, near in brute([(r.vec_id, r.embedding) for r in rows], 20, 10_000, False).items() for i, s in near}
    assert all(abs(s - scores[q, i]) < 1e-12 for q, near in found.items() for i, s in near)


def test_nearest_neighbours_of_odd_rows(odd):
    found = by_query(ann.nearest_neighbours(odd, F.col("vec_id") % 20 == 0))
    rows = list({(r.vec_id, tuple(r.embedding or ())): (r.vec_id, r.embedding) for r in odd.collect()}.values())
    want = brute(rows, 20, 20, False, zero=False)
    want.pop(800, None)
    assert found.keys() == want.keys()
    assert all(len(found[q]) == len(want[q]) for q in want)
    assert np.mean([s >= want[q][-1][1] for q in want for _, s in found[q]]) >= 0.9
    every = {(q, i): s for q, near in brute(rows, 20, 10_000, False, zero=False).items() for i, s in near}
    assert all(abs(s - every[q, i]) < 1e-9 for q in want for i, s in found[q])
    assert ann.nearest_neighbours(odd.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_lists_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 50), monkeypatch.setattr(ann, "BLOCK_QUERIES", 7), monkeypatch.setattr(ann, "SEEDS", 40)
    rng = np.random.default_rng(3)
    data = rng.standard_normal((1500, 24)) + 4 * rng.standard_normal((8, 24))[rng.integers(0, 8, 1500)]
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(data)], "vec_id long, embedding array<double>")
    found = by_query(ann.nearest_neighbours(df, F.col("vec_id") % 20 == 0))
    want = brute(list(enumerate(data)), 20, 20, False)
    assert {len(x) for x in found.values()} == {20}
    assert np.mean([len({i for i, _ in found[q]} & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.9


@pytest.mark.parametrize("dim", [64, 240, 300])
@pytest.mark.parametrize("long", [1.0, 1000.0])
def test_recall_of_the_lists_alone(monkeypatch, dim, long):
    """Few seeds bound the distances and give no answers; one vector may be far longer than all others."""
    monkeypatch.setattr(ann, "SEEDS", 200)
    rng = np.random.default_rng(dim)
    data = rng.standard_normal((6000, dim)) / 2 + rng.standard_normal((60, dim))[rng.integers(0, 60, 6000)]
    data /= np.linalg.norm(data, axis=1, keepdims=True)
    data[17] *= long
    ids = np.arange(6000)
    model = ann.Model(ids, data, float(np.linalg.norm(data, axis=1).max()), 77, 20)
    near, asked = model.nearest(model.lifted(data)), ids[::60]
    bounds = model.limits(asked, data[asked], 20)
    score = data[asked] @ data.T
    score[np.arange(len(asked)), asked] = -np.inf
    want = np.argsort(-score, axis=1)[:, :20]
    hits, walked = 0, 0
    for i, lists in enumerate(model.probes(data[asked], model.probed)):
        found = [ann.scan_list(model, data[asked[i:i + 1]], asked[i:i + 1], bounds[i:i + 1], data[near == x], ids[near == x], 20)
                 for x in lists]
        best = ann.first_k(*(np.concatenate([f[k] for f in found]) for k in range(3)), 20)[1]
        hits += len(set(best.tolist()) & set(want[i].tolist()))
        walked += sum(near[near == x].size for x in lists)
    assert hits / (20 * len(asked)) >= 0.9 and walked < 0.5 * 6000 * len(asked)


def test_whole_vectors_only(odd):
    assert {r.vec_id for r in odd.where(~vectors.whole(F.col("embedding"))).collect()} == {300, 400, 500, 900}


PAGES = "page_id long, url string, html string, host string, rules string, text string"


def test_html_of_the_tables(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").toPandas()
    found = queries.QUERIES["op5_html_text"](spark, FOLDER).toPandas().set_index("page_id").loc[pages.page_id]
    for page, text, n in zip(pages.html, found.text, found.n_chars, strict=True):
        inside = re.search("<article>(.*?)</article>", page, re.S)[1].replace("<br>", " ")
        blocks = [" ".join(references.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?(?:p|h1)>", inside)]
        assert text == "\n".join(filter(None, blocks)) and n == len(text)


PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body class=x><header>Top</header>
<nav><ul><li><a href=/>Home</a><li><a href=/b>B</a></ul></nav><div class="cookie-notice">We use cookies</div>
<article><h1>Head %d &amp; more</h1><p>One  <b>bo</b>ld &lt;x&gt;<br>line<p>Two%s<script>var a = "</p>";</script>
<form><input><button>Go</button></form><aside>Side</aside><div class="share">Share</div><pre>a
 b</pre><section class=comments><p>First!</p></section></article><footer>&copy; F</footer></body></html>"""


def test_html_parts_that_leave(spark):
    want = ["Head %d & more", "One bold <x> line", "Two%s", "a b"]
    rows = [(i, "http://a.example/x", PAGE % (i, f" {i}"), None, "r", "t") for i in range(6)]
    free = "<body><div class=menu>M</div><div id=c{0}>Text {0}<table><tr><td>c1<td>c2</table></div><p>All rights reserved</p>"
    rows += [(10 + i, "http://b.example/", free.format(i), "h", None, None) for i in range(6)]
    rows += [(30, None, "<p>a &#x41;&nbsp;b &am", None, None, None), (31, "x", None, None, None, None), (32, "http://c/", "", "", "", ""),
             (None, "http://c/", "no tags < here <", "", "", ""), (33, "http://c/", "<!-- open", "", "", ""),
             (34, "http://c/", "<div>" * 3000 + "deep", "", "", ""), (35, "http://c/", "<p>a<script>b", "", "", "")]
    rows.append(rows[0])
    df = spark.createDataFrame(rows, PAGES)
    out = html.extract(df).collect()
    assert len(out) == len(rows)
    text = {r.page_id: r.text for r in out}
    for i in range(6):
        assert text[i].split("\n") == [w % i if w.startswith("Head") else w.replace("%s", f" {i}") for w in want]
        assert text[10 + i].split("\n") == [f"Text {i}", "c1", "c2"]
    assert text[30] == "a A b &am" and text[31] == text[32] == text[33] == "" and text[None] == "no tags < here <"
    assert text[34] == "deep" and text[35] == "a"
    assert html.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("mark", ['class="%s" role="navigation"', 'class="%s sidebar"', 'class="%s" id="sidebar"',
                                  'id="sidebar" class="%s zz-%s"'])
def test_long_marks_are_judged_whole(spark, mark):
    many = " ".join(f"md:utility-class-{x}-of-a-long-name" for x in "abcdefghijklmnop")
    menu = f"<div {mark.replace('%s', many)}><a href=/a>menu entry 0</a> <a href=/b>home</a></div>"
    pages = [(i, f"http://h.com/{i}", f"<body>{menu}<div class='{many} text'><p>Own text number {i} of the page</p></div></body>",
              None, None, None) for i in range(8)]
    found = html.extract(spark.createDataFrame(pages, PAGES)).collect()
    assert {r.page_id: r.text for r in found} == {i: f"Own text number {i} of the page" for i in range(8)}
    assert html._key("div", f' class="{many}" role=main').endswith("@main") and len(html._key("p", f" class='{many}'")) < 210


def test_deep_markup_takes_linear_time():
    def seconds(n):
        start = time.perf_counter()
        assert sum(1 for _ in html.walk("<div><p>" * n + "x" + "</p></div>" * n)) > 2 * n
        return time.perf_counter() - start

    seconds(500)
    assert seconds(32_000) < 24 * seconds(4_000) + 0.1


def test_wrappers_align_in_any_order():
    pages = [f"<div><p>{i}</p>" + ("<p>x</p>" if i % 2 else "<h2>y</h2>") + "<p>same</p></div>" for i in range(6)]
    one, parts = html.Wrapper(), [html.Wrapper(), html.Wrapper()]
    for i, page in enumerate(pages):
        one.align(html.Wrapper.of_page(page))
        parts[i % 2].align(html.Wrapper.of_page(page))
    parts[0].align(parts[1])
    plain = lambda w: sorted((n[1], n[2], n[3], n[4] is True) for n in w.nodes)
    assert plain(one) == plain(parts[0])
    node = {n[1]: n for n in one.nodes}
    assert node["p"][3] and node["h2"][2] == 3 < node["div"][2]


def host_texts(pages):
    """The texts of one host's pages, aligned in two orders."""
    found = []
    for order in (pages, pages[::-1]):
        wrapper = html.Wrapper()
        for page in order:
            wrapper.align(html.Wrapper.of_page(page))
        wrapper = html.Wrapper(html.Node.unpacked(html.json.loads(html.json.dumps(wrapper.root.packed()))))
        rules = html.Rules(wrapper.article())
        found.append([rules.text(page) for page in pages])
    assert found[0] == found[1]
    return found[0]


def test_wrappers_keep_the_order_of_equal_tags():
    pages = [f"<div>Menu text of the site</div><h2>Story {i}</h2><div>Words {i}</div>" + ("<ul><li>x</ul>" if i % 2 else "")
             for i in range(6)]
    assert [t.split("\n")[:2] for t in host_texts(pages)] == [[f"Story {i}", f"Words {i}"] for i in range(6)]
    # Another number of groups makes them one repeated group, in one element's siblings too.
    pages.append("<div>a</div><h2>b</h2><div>c</div><h2>d</h2><div>e</div>")
    assert host_texts(pages)[0] == "Menu text of the site\nStory 0\nWords 0"
    assert host_texts(["<section><b>a</b><h2>b</h2><div>c</div><h2>d</h2></section><section><h2>e</h2></section>"] * 2)[0]
    deep = "<div><h2>x</h2></div>" * 3 + "<div>" * 300 + "deep<p>er" + "</div>" * 300 + "<i>end" + "<p>1<h2>2</h2>" * 40
    assert host_texts([deep, "<p>q"])[0].split("\n")[3:7] == ["deep", "er", "end", "1"]


def test_slots_outweigh_a_small_main_element():
    pages = [f"<article><h3>Teaser {i}</h3></article><div><p>{f'long words {i} ' * 30}<p>more {i}</div>" for i in range(6)]
    assert host_texts(pages)[2].split("\n") == ["Teaser 2", " ".join(["long words 2"] * 30), "more 2"]
    pages = [f"<article><h3>Title {i}</h3><p>{f'long words {i} ' * 30}</article><div><p>Other {i}</div>" for i in range(6)]
    assert host_texts(pages)[2].split("\n") == ["Title 2", " ".join(["long words 2"] * 30)]


@pytest.mark.parametrize("around, inside", [
    ('<body class="has-sidebar">', "<article>"), ("<body class=search>", ""), ("<div class=content-sidebar-wrap>", "<main>"),
    ("<div class=page-with-header>", ""), ("<div id=search>", "<article>"), ("<div class=notice>", ""),
    ("", "<article class=category-social>"), ("", '<article class="post tag-notice">'), ("", "<main class=search>")])
def test_names_drop_no_article(around, inside):
    pages = [f"{around}{inside}<h1>Title {i}</h1><p>Words {i}<p>more {i}<div class=share>Share</div>"
             f"<div class=post-share><a>Send {i}</a></div><div class=post-notice>note {i}</div>" for i in range(6)]
    # Without an article element, a page's slots hold the note in a named part too; whole names and link lists leave.
    assert [t.split("\n") for t in host_texts(pages)] == [[f"Title {i}", f"Words {i}", f"more {i}", f"note {i}"]
                                                          for i in range(6)]


def test_copies_are_no_template(spark):
    page = "<div><h1>Title</h1><p>%s</p></div><table><tr><td>cell</table>" % ("The only text " * 20)
    want = "\n".join(["Title", " ".join(["The only text"] * 20), "cell"])
    assert host_texts([page] * 12) == [want] * 12
    # Variants of one page: print and session forms.
    assert host_texts([f"{page}<i>session {i}</i>" for i in range(12)]) == [f"{want} session {i}".replace("cell ", "cell\n")
                                                                         for i in range(12)]
    assert host_texts([f"<div class=page-notice>{page}</div><p>{i}" for i in range(12)])[3] == f"{want}\n3"
    assert host_texts([f"<p>short</p><nav>{i}</nav>" for i in range(12)]) == ["short"] * 12
    # Copies among other pages count once, and text of the template still leaves.
    pages = [f"<h1>Story {i % 3}</h1><div>Shared</div>" for i in range(12)]
    assert host_texts(pages)[1] == "Story 1\nShared"
    assert host_texts(pages + [f"<h1>Story {i}</h1><div>Shared</div>" for i in range(9)])[1] == "Story 1"
    rows = [(i, "http://a/x", page, None, None, None) for i in range(8)]
    assert {r.text for r in html.extract(spark.createDataFrame(rows, PAGES)).collect()} == {want}


def test_wrappers_of_own_names_stay_small(spark, monkeypatch):
    page = '<div class="css-{0}"><article id="post-{0}"><h1>Title {1}</h1><p class=lead>Words {1}</article></div><div class="ad {0}">Buy {1}</div>'
    pages = [page.format("".join(chr(97 + int(c)) for c in f"{i:04}"), i) for i in range(300)]
    rows = [(i, "http://a/x", p, None, None, None) for i, p in enumerate(pages)]
    df = spark.createDataFrame(rows, PAGES)
    given = df.select(F.lit("a").alias("host"), "html")
    keys = html.common_keys(given).collect()
    assert [(r.key_host, r["keys"]) for r in keys] == [("a", ["p.lead"])]
    wrapper = html.infer_wrappers(given.withColumn("keys", F.array(F.lit("p.lead")))).collect()[0].wrapper
    assert html.Node.unpacked(html.json.loads(wrapper)).size() == 6
    want = {i: f"Title {i}\nWords {i}" for i in range(300)}
    assert {r.page_id: r.text for r in html.extract(df).collect()} == want
    # Whatever the names are, the size has a bound, and what is cut from the wrapper is still text.
    monkeypatch.setattr(html, "MAX_NODES", 20)
    whole = html.Wrapper()
    for p in pages:
        whole.align(html.Wrapper.of_page(p))
        assert whole.root.size() <= 20
    rules = html.Rules(whole.article())
    assert [rules.text(p) for p in pages] == list(want.values())


def test_urls(spark):
    rows = [("http://WWW.Example.COM/en/x", "allow", "www.example.com/en/"), ("http://a.example.com/en/", "block", "example.com/en/"),
            ("http://example.com/fr/?q#f", "allow", "com/"), ("x://b.net/fr/a", "block", "net/fr/"), ("x://b.net/frx", "allow", None),
            ("x://com", "allow", None), ("x://com/", "allow", "com/"), ("x://acom/", "allow", None), ("nothing", "allow", None),
            (None, "allow", None), ("", "allow", None), ("x://", "allow", None), ("a://b://net/es/", "allow", None),
            ("x://net?/es/", "allow", None), ("x://.net/es/" + "y" * 100_000, "block", "net/es/")]
    df = spark.createDataFrame([(i, r[0], "h", "k") for i, r in enumerate(rows)] * 2, "page_id long, url string, host string, key string")
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string")
    found = urls.judge_urls(df, rules).collect()
    assert len(found) == 2 * len(rows)
    assert all((r.verdict, r.rule) == rows[r.page_id][1:] for r in found)
    assert {(r.host, r.path) for r in found if r.page_id in (8, 9, 10)} == {("", "")}
    joined = {(r.page_id, r.verdict, r.rule) for r in found}
    spark_max, urls.MAX_BITS = urls.MAX_BITS, 1
    try:
        assert {(r.page_id, r.verdict, r.rule) for r in urls.judge_urls(df, rules).collect()} == joined
    finally:
        urls.MAX_BITS = spark_max
    assert urls.judge_urls(df.limit(0), rules).count() == 0
    assert {r.verdict for r in urls.judge_urls(df, rules.limit(0)).collect()} == {"allow"}


def test_the_cascade_is_exact_for_its_universe(spark, monkeypatch):
    monkeypatch.setattr(urls, "BITS_PER_KEY", 2)
    universe = spark.range(30_000).select(F.concat(F.lit("key"), F.col("id")).alias("key"))
    listed = universe.where("substring(key, 4) % 9 = 0")
    cascade = urls.Cascade(listed, universe)
    assert len(cascade.levels) > 2
    wrong = universe.where(cascade.has(F.col("key")) != (F.expr("substring(key, 4) % 9 = 0")))
    assert wrong.count() == 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before = docs
    texts = {}
    for name, stage in corpus_pipeline.STAGES:
        from siltgate.llm.common import stored

        after = stored(stage(spark, before, FOLDER), name)
        if name != "packing":
            assert after.columns == docs.columns
        if name == "language_id":
            assert after.count() >= 0.98 * before.count()
        if name == "ngram_join":
            assert after.select("doc_id").distinct().count() == after.count() < before.count()
        if name == "private_data":
            assert after.count() == before.count() and after.where("text rlike '[a-z]@mail[0-9]'").count() == 0
            assert after.where("n_chars <> length(text)").count() == 0
        if name == "packing":
            texts = [(r.doc_id, r.text) for r in before.collect()]
        before = after
    assert held_packing(before.collect(), texts) > 0.9
    again = corpus_pipeline.run(spark, FOLDER)
    assert again.columns == before.columns and again.count() == before.count()


def plain_mask(text, spans):
    """Spans replaced by their kind; overlapping ones become one."""
    out, at = "", 0
    for s in spans:
        if s.start >= at:
            out += text[at:s.start] + f"[{private.KINDS[s.rank].upper()}]"
        at = max(at, s.end)
    return out + text[at:]


def test_pipeline_against_plain_python(spark):
    """Every stage on its own input, with null keys and texts, copies, repeated rows and columns of clashing names."""
    import duckdb

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(*r, "x", "y") for r in docs.where("doc_id < 120").collect()]
    long = max((r for r in rows if len(r[1]) < 4000), key=lambda r: len(r[1].split()))
    rows += [(None, rows[0][1], "en", "src1", 10, "x", "y"), (None, "mail me at a.b@c.de, please: 10.0.0.1", "en", None, 1, "x", "y"),
             (500, None, "en", "src1", None, None, None), (501, "", "en", "src1", 0, None, None), (None, None, None, None, None, None, None),
             (502, long[1] + " one more word", "en", "src2", 1, "x", "y"), (503, long[1], None, "src2", 1, "x", "y"),
             (503, long[1], None, "src2", 1, "x", "y"), (504, "1 2 3 ...", "en", "src0", 1, "x", "y")]
    kind = "doc_id long, text string, lang string, source string, n_chars long, spans string, key string"
    before = spark.createDataFrame(rows, kind).repartition(3)
    stages = dict(corpus_pipeline.STAGES)

    def step(name):
        return stored(stages[name](spark, before, FOLDER), name)

    model = langid.fit(before)
    after = step("language_id")
    counts = [(r, langid.subwords(r.text) if r.text else None) for r in before.collect()]
    want = Counter(tuple(r) for r, c in counts if c is not None and model.score(c).max() >= model.threshold)
    assert Counter(map(tuple, after.collect())) == want and after.columns == before.columns
    before = after
    after = step("ngram_join")
    held = before.collect()
    linked_to = linked(list({r.doc_id: (r.doc_id, r.text) for r in held if r.doc_id is not None}.values()), 5, 80)
    want = {tuple(r) for r in held if r.doc_id is not None and linked_to[r.doc_id] == r.doc_id}
    assert Counter(map(tuple, after.where("doc_id is not null").collect())) == Counter(want)
    assert Counter(tuple(r) for r in held if r.doc_id is None) == Counter(map(tuple, after.where("doc_id is null").collect()))
    assert 502 in linked_to and linked_to[502] != 502
    before = after
    after = step("private_data")
    spans = {(r.doc_id, r.text_hash): r.spans for r in private.find_private(before).collect()}
    hashes = before.select("*", F.xxhash64("text").alias("h")).collect()
    texts = [plain_mask(r.text, spans[r.doc_id, r.h]) for r in hashes]
    want = Counter((r.doc_id, t, r.lang, r.source, len(t), r.spans, r.key) for r, t in zip(hashes, texts, strict=True))
    assert Counter(map(tuple, after.collect())) == want and any("[EMAIL]" in t for t in texts)
    before = after
    after = step("mixing")
    documents = before.toPandas().astype({"doc_id": "Int64"})  # noqa: F841
    want = Counter(duckdb.sql(f"SELECT doc_id, source FROM ({mixing.mix_sql()})").fetchall())
    assert Counter((r.doc_id, r.source) for r in after.collect()) == want
    before = after
    found = step("packing")
    assert held_packing(found.collect(), [(r.doc_id, r.text) for r in before.collect()]) > 0.5
    before = spark.createDataFrame([], kind)
    for name in stages:
        before = step(name)
        assert before.count() == 0
