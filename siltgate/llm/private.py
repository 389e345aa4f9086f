"""Personal data: four base patterns, and bootstrapped contextual extraction on top of them.

Base matches are seeds. The words around a seed form lexical patterns; Spark scores the graph of patterns and the
identifier-like tokens they surround in rounds: a pattern is trusted as far as what it surrounds is trusted, a token
as far as its patterns are. Trusted patterns then name identifiers that no base pattern matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltgate.llm.common import stored

#: Kinds in the order in which spans of one start are listed. Fixed values.
KINDS = ("email", "ip", "card", "phone")
#: Marks around matches. In texts they become `?`, which no pattern and no token rule knows.
OPEN, CLOSE = "\x01", "\x02"
_LOCAL, _DOMAIN = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
#: Equal to the base patterns, written so that the matcher neither recurses nor starts inside a run that has failed.
PATTERNS = {
    "email": f"(?:(?<!{_LOCAL})|\\G){_LOCAL}+@{_DOMAIN}+(?:\\.{_DOMAIN}++)++",
    "ip": "(?<![0-9])[0-9]+\\.[0-9]+\\.[0-9]+\\.[0-9]+",
    "card": "(?=[0-9](?:[ -]?[0-9]){11})[0-9](?:[ -]?[0-9])++",
    "phone": "\\+[0-9][ ().0-9-]+[0-9]",
}
#: A cheap look that skips texts without any match.
HINTS = {"email": "@", "ip": "[0-9]\\.[0-9]+\\.[0-9]", "card": "[0-9](?:[ -]?[0-9]){11}", "phone": "\\+[0-9]"}
SPACE = "\\x20\\x09-\\x0D"
#: An identifier-like token has MIN_DIGITS digits, or an @ inside.
MIN_DIGITS, MAX_TOKEN = 7, 64
TOKEN = f"(?<![^{SPACE}])[^{SPACE}0-9@]*+[0-9@][^{SPACE}]*+"
#: Groups of digits joined by single spaces, dots, hyphens or brackets, whole; a group that a letter ends isn't part of it.
GROUP = "[0-9]++(?![A-Za-z@])"
RUN = f"(?<![A-Za-z0-9@])\\+?(?:\\((?=[0-9]+\\)))?{GROUP}(?:(?:[ .-]\\(?|\\)[ .-]?\\(?|\\(){GROUP})++"
CONTEXT_CHARS = 48
#: Rounds of scoring; the distinct seeds or trusted values a pattern needs; the trust from which on a token is named.
ROUNDS, MIN_SEEDS, MIN_TRUST = 3, 4, 0.8

_SPAN = "array<struct<start:int,rank:int,end:int>>"


def _clean(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), OPEN + CLOSE, "??")


def _marked(text: Column, pattern: str, valid, rank: int) -> Column:
    """Spans (start, rank of the kind, end) of the leftmost non-overlapping matches that are valid."""
    parts = F.split(F.regexp_replace(text, F.lit(pattern), F.lit(f"{OPEN}$0{CLOSE}")), OPEN, -1)
    start = F.struct(F.length(F.element_at(parts, 1)).alias("at"), F.array().cast(_SPAN).alias("spans"))

    def step(acc: Column, part: Column) -> Column:
        match = F.substring_index(part, CLOSE, 1)
        span = F.struct(acc["at"].alias("start"), F.lit(rank).alias("rank"), (acc["at"] + F.length(match)).alias("end"))
        return F.struct((acc["at"] + F.length(part) - 1).alias("at"),
                        F.when(valid(match), F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(F.slice(parts, F.lit(2), F.size(parts)), start, step, lambda acc: acc["spans"])


def luhn(number: Column) -> Column:
    """12 to 19 digits whose Luhn sum ends in 0."""
    digits = F.reverse(F.regexp_replace(number, "[^0-9]", ""))

    def add(total: Column, i: Column) -> Column:
        digit = F.coalesce(F.substring(digits, i, F.lit(1)).try_cast("int"), F.lit(0))
        double = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(i % 2 == 0, double).otherwise(digit)

    total = F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1))), F.lit(0), add)
    return F.length(digits).between(12, 19) & (total % 10 == 0)


def _small_parts(address: Column) -> Column:
    return F.forall(F.split(address, "\\."), lambda x: F.length(F.ltrim(x, F.lit("0"))).between(0, 3)
                    & (F.coalesce(F.substring(F.ltrim(x, F.lit("0")), 1, 3).try_cast("int"), F.lit(0)) <= 255))


_VALID = {
    "email": lambda m: F.lit(True),
    "ip": _small_parts,
    "card": luhn,
    "phone": lambda m: F.length(F.regexp_replace(m, "[^0-9]", "")).between(9, 15),
}


def base_spans(text: Column) -> Column:
    """Spans of all kinds in the order of start, then kind."""
    found = [F.when(F.contains(text, F.lit("@")) if kind == "email" else F.rlike(text, F.lit(HINTS[kind])),
                    _marked(text, PATTERNS[kind], _VALID[kind], rank)).otherwise(F.array().cast(_SPAN))
             for rank, kind in enumerate(KINDS)]
    return F.array_sort(F.concat(*found))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _tokens(text: Column) -> Column:
    """Spans of identifier-like tokens, without the punctuation around them, and of runs of digit groups (rank -1)."""
    lead = lambda m: F.length(m) - F.length(F.regexp_replace(m, "^[^A-Za-z0-9+(]+", ""))
    tail = lambda m: F.length(m) - F.length(F.regexp_replace(m, "[^A-Za-z0-9)]+$", ""))
    shaped = lambda m: (F.length(F.regexp_replace(m, "[^0-9]", "")) >= MIN_DIGITS) | m.contains("@")
    found = _marked(text, TOKEN, lambda m: (F.length(m) <= MAX_TOKEN) & shaped(m), -1)
    value = lambda s: F.substring(text, s["start"] + 1, s["end"] - s["start"])
    trimmed = F.transform(found, lambda s: F.struct(
        (s["start"] + lead(value(s))).alias("start"), s["rank"].alias("rank"), (s["end"] - tail(value(s))).alias("end")))
    runs = F.when(F.rlike(text, F.lit("[0-9][ ().-]{1,3}[0-9]")), _marked(
        text, RUN, lambda m: (F.length(m) <= MAX_TOKEN) & shaped(m), -1)).otherwise(F.array().cast(_SPAN))
    return F.array_distinct(F.concat(F.filter(trimmed, lambda s: s["start"] < s["end"]), runs))


def _patterns(text: Column, span: Column) -> Column:
    """The lexical patterns around a span: two words before it, the words on both sides, a label before it."""
    def words(part: Column) -> Column:
        return F.split(F.trim(F.regexp_replace(F.lower(part), f"[{SPACE}]+", " ")), " ")

    size = F.least(span["start"], F.lit(CONTEXT_CHARS))
    before = words(F.substring(text, span["start"] - size + 1, size))
    after = words(F.substring(text, span["end"] + 1, F.lit(CONTEXT_CHARS)))
    last = F.element_at(before, -1)
    return F.array_compact(F.array(
        F.when(F.size(before) > 1, F.concat(F.lit("2 "), F.element_at(before, -2), F.lit(" "), last)),
        F.concat(F.lit("< "), last, F.lit(" > "), F.element_at(after, 1)),
        F.when(F.rlike(last, F.lit("[:=#]$")), F.concat(F.lit("1 "), last))))


def _scores(instances: DataFrame) -> DataFrame:
    """instances: pattern, value, seed (rank or null) -> value and the best rank of each trusted unseen value."""
    ranks = range(len(KINDS))
    edges = instances.groupBy("pattern", "value").agg(F.max("seed").alias("seed"))
    # What fewer values surround than a pattern needs can't be trusted in any round.
    enough = edges.groupBy("pattern").agg(F.count("*").alias("values")).where(F.col("values") >= MIN_SEEDS)
    edges = stored(edges.join(enough, "pattern"), "pii-graph")
    trust = edges.where("false").select("value", *(F.lit(0.0).alias(f"t{k}") for k in ranks))
    for _ in range(ROUNDS):
        own = [F.when(F.col("seed") == k, 1.0).when(F.col("seed").isNotNull(), 0.0).otherwise(
            F.coalesce(f"t{k}", F.lit(0.0))) for k in ranks]
        # Support comes from the seeds and from what the rounds before have named.
        seeds = [F.count(F.when(F.col("seed").isNull() & (F.col(f"t{k}") >= MIN_TRUST) | (F.col("seed") == k), 1)) for k in ranks]
        patterns = edges.join(trust, "value", "left").groupBy("pattern").agg(
            *((F.sum(x) / (F.count("*") + 1)).alias(f"sum{k}") for k, x in zip(ranks, own, strict=True)),
            *(n.alias(f"seeds{k}") for k, n in zip(ranks, seeds, strict=True)))
        patterns = patterns.where(F.greatest(*(F.col(f"seeds{k}") for k in ranks)) >= MIN_SEEDS)
        patterns = patterns.select("pattern", *(F.when(F.col(f"seeds{k}") >= MIN_SEEDS, F.col(f"sum{k}")).otherwise(
            0.0).alias(f"p{k}") for k in ranks))
        # A value is an identifier unless all its patterns are wrong.
        doubt = [(1 - F.exp(F.sum(F.log1p(-F.col(f"p{k}"))))).alias(f"t{k}") for k in ranks]
        trust = stored(edges.where("seed is null").join(patterns, "pattern").groupBy("value").agg(*doubt), "pii-trust")
    best = F.array_max(F.array(*(F.struct(F.col(f"t{k}").alias("t"), F.lit(-k).alias("rank")) for k in ranks)))
    named = trust.withColumn("best", best).where(F.col("best.t") >= MIN_TRUST)
    return named.select("value", (-F.col("best.rank")).alias("rank"))


def find_private(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: key, text_hash, base and spans (arrays of start, rank of the kind, end).

    Base spans are the leftmost non-overlapping matches of each kind; spans holds them and those that trusted patterns
    add outside of them. Null and empty texts have none. Equal rows get equal spans; null keys stay null; an empty
    table gives no rows; other columns are ignored.
    """
    clean = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("text_hash"), _clean(F.col(text)).alias("text"))
    found = clean.withColumn("base", base_spans(F.col("text")))
    free = lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))
    tokens = F.when(F.rlike("text", F.lit("[0-9@]")), _tokens(F.col("text"))).otherwise(F.array().cast(_SPAN))
    found = found.withColumn("tokens", tokens).withColumn("tokens", F.filter("tokens", free))
    instances = F.transform(F.concat("base", "tokens"), lambda s: F.struct(
        s.alias("span"), F.lower(F.substring(F.col("text"), s["start"] + 1, s["end"] - s["start"])).alias("value"),
        _patterns(F.col("text"), s).alias("patterns")))
    found = stored(found.select("key", "text_hash", "base", instances.alias("instances")), "pii-base")
    seen = found.select("key", "text_hash", F.explode("instances").alias("i")).select(
        "key", "text_hash", "i.span", "i.value", "i.patterns",
        F.when(F.col("i.span.rank") >= 0, F.col("i.span.rank")).alias("seed"))
    named = _scores(seen.select(F.explode("patterns").alias("pattern"), "value", "seed"))
    extra = seen.where("seed is null").join(named, "value").groupBy("key", "text_hash").agg(F.collect_set(F.struct(
        F.col("span.start").alias("start"), F.col("rank").alias("rank"), F.col("span.end").alias("end"))).alias("extra"))
    extra = extra.withColumnRenamed("key", "extra_key").withColumnRenamed("text_hash", "extra_hash")
    joined = found.join(extra, F.col("key").eqNullSafe(F.col("extra_key")) & (F.col("text_hash") == F.col("extra_hash")), "left")
    extra = F.coalesce("extra", F.array().cast(_SPAN))
    # A token inside of a named run is part of it.
    whole = F.filter(extra, lambda s: ~F.exists(extra, lambda o: (
        (o["start"] <= s["start"]) & (o["end"] >= s["end"]) & (o["end"] - o["start"] > s["end"] - s["start"]))))
    spans = F.array_sort(F.concat("base", whole))
    return joined.select(F.col("key").alias(key), "text_hash", "base", spans.alias("spans"))


def report(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts of base spans by kind, their digest, and all spans as text."""
    def of(rank: int) -> Column:
        return F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long")

    counts = [of(rank).alias(f"n_{kind}") for rank, kind in enumerate(KINDS)]
    return found.select(key, *counts, F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"))


def mask(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        return F.when(s["start"] >= acc["at"], F.struct(
            s["end"].alias("at"), F.concat(acc["out"], gap, F.element_at(names, s["rank"] + 1)).alias("out"))).otherwise(
            F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out")))

    done = F.aggregate(spans, start, step, lambda acc: F.concat(
        acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def mask_private(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with all found spans masked in the text; a null text stays null; columns of any name stay as they are."""
    found = find_private(docs, key, text).where(F.size("spans") > 0).select(F.col(key).alias("key"), "text_hash", "spans")
    found = found.dropDuplicates(["key", "text_hash"]).alias("m")
    own = F.col(f"d.{text}")
    at = F.col(f"d.{key}").eqNullSafe(F.col("m.key")) & (F.xxhash64(own) == F.col("m.text_hash"))
    masked = F.when(F.col("m.spans").isNull(), own).otherwise(mask(own, F.col("m.spans")))
    return docs.alias("d").join(found, at, "left").select(
        *(masked.alias(c) if c == text else F.col(f"d.{c}") for c in docs.columns))
