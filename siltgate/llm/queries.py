"""The registered query of each operator, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltgate.llm import mixing

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_bpe() -> str:
    """The tokenizer file of packing and token counts."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.mix(docs).select("doc_id", "source", "mix_tokens", "mix_epoch", "mix_block", "mix_draw")


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltgate.llm import langid

    docs = langid.fold(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    model = langid.fit(docs.where(~F.col("held_out")))
    found = langid.predict(docs.select("doc_id", "held_out", "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"), "lang_rejected")


@query
def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltgate.llm import topk

    return topk.exact_topk(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltgate.llm import ann

    return ann.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltgate.llm import html

    return html.extract(table(spark, sf_dir, "pages"))


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltgate.llm import pack

    return pack.pack(table(spark, sf_dir, "documents"), word_bpe())


@query
def op7_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltgate.llm import private

    return private.report(private.find_private(table(spark, sf_dir, "documents")))


#: Fixed rules of the URL query: host, path, verdict.
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


@query
def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltgate.llm import urls

    listed = F.array(*(F.struct(*(F.lit(x).alias(n) for x, n in zip(rule, ("host", "path", "verdict"), strict=True)))
                       for rule in URL_RULES))
    rules = spark.range(1).select(F.inline(listed))
    return urls.judge_urls(table(spark, sf_dir, "pages"), rules)


@query
def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltgate.llm import ngram_join

    return ngram_join.join(table(spark, sf_dir, "documents"))


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltgate.llm import tokens

    return tokens.count_tokens(table(spark, sf_dir, "documents"), word_bpe())


@query
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltgate.llm import lexical

    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from siltgate.llm import align

    a, b = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    found = align.align(table(spark, sf_dir, "documents"), a, b, digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")


@query
def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltgate.llm import suffix

    found = suffix.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda total, x: total + x["end"] - x["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


ORACLES["op1_mixing"] = mixing.mix_sql()

ORACLES["op3_exact_topk"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
l AS (SELECT vec_id, len(v) AS dim, unnest(v) AS x, unnest(range(len(v))) AS i FROM v),
s AS (SELECT q.vec_id AS query_id, c.vec_id, sum(q.x * c.x)::BIGINT AS score
  FROM l AS q JOIN l AS c ON q.i = c.i AND q.dim = c.dim WHERE q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

_ALPHABET = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_TERMS = f"regexp_extract_all(translate(text, '{_ALPHABET[0]}', '{_ALPHABET[1]}'), " + (
    "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')")
ORACLES["op11_lexical_search"] = f"""
WITH t AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents WHERE text IS NOT NULL),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
n AS (SELECT doc_id, count(*) AS n FROM t GROUP BY ALL),
s AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM n),
m AS (SELECT doc_id, 100 - 25 + ((25 * n * docs) // terms) AS m FROM n, s),
f AS (SELECT doc_id, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM f GROUP BY ALL), s),
p AS (SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN f USING (term) JOIN m USING (doc_id) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM p WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20
"""

_LONGEST_FIRST = sorted(URL_RULES, key=lambda r: (-len(r[0] + r[1]), -len(r[0]), r[2]))
_FITS = [f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN" for h, p, _ in _LONGEST_FIRST]
ORACLES["op8_url_filters"] = f"""
WITH u AS (SELECT page_id, CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN ''
  ELSE substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_ALPHABET[0]}', '{_ALPHABET[1]}') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u)
SELECT page_id, host, path,
  CASE {' '.join(f"{fit} '{h}{p}'" for fit, (h, p, _) in zip(_FITS, _LONGEST_FIRST, strict=True))} END AS rule,
  CASE {' '.join(f"{fit} '{v}'" for fit, (_, _, v) in zip(_FITS, _LONGEST_FIRST, strict=True))} ELSE 'allow' END AS verdict
FROM h
"""
