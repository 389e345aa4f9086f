"""Mixing sources to target weights: temperature mixing, realised as budgeted block permutations.

A source's share of all tokens is raised to an exponent between 0 (all sources alike) and 1 (as they are). The exponent
is bisected to the largest that reaches a target entropy, and up again until no source is repeated more often than the
limit. Each source then gets its budget as whole epochs and one partial epoch: a prefix of a permutation of its blocks.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltgate.llm.common import stored

WORD = "[^\\x20\\x09-\\x0D]+"
#: The exponent is bisected in steps of 1 / STEPS.
STEPS = 4_096
#: Entropy asked for, as a part of the largest possible, and how often a source may be repeated at most.
TARGET_ENTROPY = 0.97
MAX_REPEATS = 4.0
BLOCK_DOCS = 1_024
#: A budget that misses a whole number by no more than this is that number: sums of doubles depend on their order.
ROUNDING = 1e-6


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(*parts: Column) -> Column:
    """A repeatable draw: 60 bits of a digest."""
    return F.substring(F.md5(F.concat_ws("|", *parts)), 1, 15)


def block_draw(doc: Column, tie: Column) -> Column:
    """32 bits of a digest of key and text: its remainder is a row's block. A null key is a word of its own."""
    whole = F.concat_ws("|", F.coalesce(doc.cast("string"), F.lit("null")), F.coalesce(tie, F.lit("")))
    return F.conv(F.substring(F.md5(whole), 25, 8), 16, 10).cast("long")


def bisect(holds: Callable[[int], bool], low: int, high: int) -> int:
    """The largest step in [low, high] for which `holds`, which holds up to some step; low if for none."""
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if holds(middle) else (low, middle - 1)
    return low


def mixture(totals: DataFrame, budget: int, entropy: float, repeats: float) -> int:
    """The exponent in steps. totals: one row per source with its tokens; each probe is one aggregation over it."""
    sums = totals.where("tokens > 0").agg(F.sum("tokens"), F.count("*")).head()
    if not sums[0]:
        return STEPS
    share = F.col("tokens") / F.lit(float(sums[0]))

    def probe(step: int) -> tuple[float, float]:
        raised = F.pow(share, F.lit(step / STEPS))
        whole = F.sum(raised)
        # Entropy of p = r / z is log z - sum(r log r) / z.
        h = F.log(whole) - F.sum(raised * F.log(raised)) / whole
        most = F.max(raised / F.col("tokens")) * F.lit(float(budget)) / whole
        return totals.where("tokens > 0").agg(h, most).head()

    wanted = entropy * math.log(sums[1])
    flattest = bisect(lambda s: probe(s)[0] >= wanted, 0, STEPS)
    # Repetition falls as the exponent rises: the first step within the limit is one past the last beyond it.
    if probe(flattest)[1] <= repeats or probe(STEPS)[1] > repeats:
        return flattest if probe(flattest)[1] <= repeats else STEPS
    return bisect(lambda s: probe(s)[1] > repeats, flattest, STEPS) + 1


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", budget: int | None = None,
        entropy: float = TARGET_ENTROPY, repeats: float = MAX_REPEATS, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """One row per document and epoch it is used in: all columns of docs and mix_tokens, mix_epoch, mix_block, mix_draw.

    Tokens are white-space words, counted over whole texts; the budget is the corpus's own number unless given. Rows of
    a source in the order (mix_epoch, block's draw, mix_draw) are its permutations. A source's budget is its weight's
    part of the whole, rounded down; of its last epoch those documents stay whose running total fits in what is left.
    Null sources are one source; null or empty texts have no tokens and cost nothing; sources without any token
    have weight 0 and leave. Repeated rows and null keys stay rows of their own. Columns of docs must not start
    with mix_.
    """
    # The tie-break goes before the joins, so that they need not carry texts that nobody asks for.
    counted = docs.withColumn("mix_tokens", word_count(F.col(text))).withColumn("mix_tie", F.md5(text))
    counted = counted.withColumn("mix_hash", block_draw(F.col(key), F.col("mix_tie")))
    name = F.struct(F.col(source)).alias("mix_source")  # a struct compares nulls as equal
    slim = stored(counted.select(name, "mix_hash", "mix_tokens"), "mix-tokens")
    totals = stored(slim.groupBy("mix_source").agg(F.sum("mix_tokens").alias("tokens"), F.count("*").alias("docs")),
                    "mix-totals")
    if budget is None:
        budget = totals.agg(F.coalesce(F.sum("tokens"), F.lit(0))).head()[0]
    step = mixture(totals, budget, entropy, repeats)
    share = F.col("tokens") / F.lit(float(max(1, totals.agg(F.sum("tokens")).head()[0] or 0)))
    raised = F.pow(share, F.lit(step / STEPS))
    whole = totals.where("tokens > 0").agg(F.sum(raised)).head()[0] or 1.0
    plan = totals.where("tokens > 0").withColumn(
        "grant", F.floor(F.lit(float(budget)) * raised / F.lit(whole) + ROUNDING).cast("long")).select(
        "mix_source", F.ceil(F.col("docs") / block_docs).alias("blocks"),
        F.expr("`grant` div tokens").alias("epochs"), (F.col("grant") % F.col("tokens")).alias("rest"))
    plan = stored(plan, "mix-plan")

    # The partial epoch: whole blocks in permuted order up to the one in which the budget ends.
    epoch = F.col("epochs").cast("string")
    blocks = slim.join(plan, "mix_source").withColumn("mix_block", F.col("mix_hash") % F.col("blocks"))
    blocks = blocks.groupBy("mix_source", "mix_block", "epochs", "rest").agg(F.sum("mix_tokens").alias("tokens"))
    order = Window.partitionBy("mix_source").orderBy(
        draw(F.lit("block"), epoch, F.col("mix_block").cast("string")), "mix_block")
    blocks = blocks.withColumn("before", F.sum("tokens").over(order) - F.col("tokens"))
    last = blocks.where(F.col("before") <= F.col("rest")).withColumn(
        "left", F.when(F.col("before") + F.col("tokens") > F.col("rest"), F.col("rest") - F.col("before")))
    last = last.select("mix_source", "mix_block", F.col("left").alias("mix_left"), F.lit(True).alias("mix_last"))

    placed = counted.withColumn("mix_source", name).join(plan, "mix_source")
    placed = placed.withColumn("mix_block", F.col("mix_hash") % F.col("blocks")).join(
        last, ["mix_source", "mix_block"], "left")
    columns = [*docs.columns, "mix_tokens", "mix_epoch", "mix_block", "mix_draw"]

    def drawn(df: DataFrame) -> DataFrame:
        return df.withColumn("mix_draw", draw(
            F.col("mix_epoch").cast("string"), F.coalesce(F.col(key).cast("string"), F.lit("null"))))

    # Whole epochs and the partial one's whole blocks need no order; only its cut block is summed up.
    uses = F.sequence(F.lit(0).cast("long"), F.when(
        F.col("mix_last") & F.col("mix_left").isNull(), F.col("epochs")).otherwise(F.col("epochs") - 1))
    whole_uses = F.when((F.col("epochs") > 0) | (F.col("mix_last") & F.col("mix_left").isNull()), uses)
    sure = drawn(placed.withColumn("mix_epoch", F.explode(whole_uses)))
    cut = drawn(placed.where(F.col("mix_left").isNotNull()).withColumn("mix_epoch", F.col("epochs")))
    within = Window.partitionBy("mix_source", "mix_block").orderBy("mix_draw", key, "mix_tie").rowsBetween(
        Window.unboundedPreceding, 0)
    cut = cut.withColumn("mix_used", F.sum("mix_tokens").over(within)).where(F.col("mix_used") <= F.col("mix_left"))
    return sure.select(columns).unionByName(cut.select(columns))


def mix_sql(entropy: float = TARGET_ENTROPY, repeats: float = MAX_REPEATS, block_docs: int = BLOCK_DOCS) -> str:
    """The same mixture of `documents` in DuckDB SQL, with every exponent tried instead of bisected."""
    return f"""
WITH d AS (SELECT doc_id, source, md5(text) AS h, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))
             AS mix_tokens FROM documents),
t AS (SELECT source, sum(mix_tokens)::BIGINT AS tokens, count(*) AS docs FROM d GROUP BY source HAVING sum(mix_tokens) > 0),
g AS (SELECT sum(tokens)::DOUBLE AS budget, count(*) AS k FROM t),
p AS (SELECT s, z, ln(z) - rl / z AS h, most * budget / z AS rep, k FROM (
  SELECT s, sum(r) AS z, sum(r * ln(r)) AS rl, max(r / tokens) AS most FROM (
    SELECT s, tokens, pow(tokens / budget, s / {STEPS}.0) AS r FROM t, g, range(0, {STEPS + 1}) AS x(s)) GROUP BY s), g),
e AS (SELECT coalesce(max(s), 0) AS s FROM p WHERE h >= {entropy} * ln(k)),
c AS (SELECT coalesce(min(p.s), {STEPS}) AS s FROM p, e WHERE p.s >= e.s AND rep <= {repeats}),
w AS (SELECT source, tokens, docs, floor(budget * pow(tokens / budget, p.s / {STEPS}.0) / z + {ROUNDING})::BIGINT AS gr
  FROM t, g, p WHERE p.s = (SELECT s FROM c)),
pl AS (SELECT source, (docs + {block_docs - 1}) // {block_docs} AS blocks, gr // tokens AS epochs, gr % tokens AS rest FROM w),
b AS (SELECT d.*, epochs, rest, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || '|' || coalesce(h, '')), 25, 8))::BIGINT
    % blocks AS mix_block
  FROM d JOIN pl ON d.source IS NOT DISTINCT FROM pl.source),
bt AS (SELECT source, mix_block, epochs, rest, sum(mix_tokens) AS tokens FROM b GROUP BY ALL),
bo AS (SELECT source, mix_block, rest, tokens, sum(tokens) OVER (PARTITION BY source ORDER BY
  substr(md5('block|' || epochs || '|' || mix_block), 1, 15), mix_block) - tokens AS bef FROM bt),
u AS (SELECT b.*, unnest(range(0, epochs + 1)) AS mix_epoch FROM b),
v AS (SELECT u.*, bo.bef, bo.tokens AS block_tokens, substr(md5(mix_epoch || '|' || coalesce(doc_id::VARCHAR, 'null')), 1, 15)
  AS mix_draw FROM u JOIN bo ON u.source IS NOT DISTINCT FROM bo.source AND u.mix_block = bo.mix_block),
x AS (SELECT *, sum(mix_tokens) OVER (PARTITION BY source, mix_block, mix_epoch ORDER BY mix_draw, doc_id, h
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS used FROM v)
SELECT doc_id, source, mix_tokens, mix_epoch, mix_block, mix_draw FROM x
WHERE mix_epoch < epochs OR (bef <= rest AND (bef + block_tokens <= rest OR used <= rest - bef))
"""
