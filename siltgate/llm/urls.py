"""URL filters: exact list membership through a cascade of Bloom filters, without a join on the pages.

Level 0 encodes the listed keys, level 1 the keys of the corpus that level 0 takes by mistake, level 2 the listed keys
that level 1 takes by mistake, and so on until a level makes no mistake. Since the corpus's complete key universe takes
part, the walk through the levels is exact for every key of the corpus.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltgate.llm.common import stored

BITS_PER_KEY = 10
HASHES = 4
#: A filter of more bits isn't carried inside the plan; such lists are joined by key instead.
MAX_BITS = 1 << 23
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null url or one without `://`."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def candidate_keys(host: Column, path: Column, labels: int, prefixes: list[int]) -> Column:
    """Every key that could list this url: host suffixes of up to `labels` labels times path prefixes of given lengths."""
    parts = F.split(host, "\\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(parts), F.lit(labels))),
                           lambda n: F.array_join(F.slice(parts, -n, n), "."))
    lengths = F.array_compact(F.array(*(F.when(F.length(path) >= n, F.lit(n)) for n in prefixes)))
    keys = F.flatten(F.transform(suffixes, lambda s: F.transform(
        lengths, lambda n: F.concat(s, F.substring(path, F.lit(1), n)))))
    return F.when(host != "", keys).otherwise(F.array().cast("array<string>"))


def _bit(key: Column, level: int, i: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(level), F.lit(i)), F.lit(bits).cast("long"))


class Bloom:
    """One level: a bit array as a constant of the plan."""

    def __init__(self, keys: DataFrame, count: int, level: int):
        self.level = level
        self.bits = max(64, 1 << math.ceil(math.log2(max(1, count) * BITS_PER_KEY)))
        at = keys.select(F.explode(F.array(*(_bit(F.col("key"), level, i, self.bits) for i in range(HASHES)))).alias("b"))
        words = at.groupBy(F.shiftright("b", 6).cast("int").alias("i")).agg(
            F.bit_or(F.expr("shiftleft(1L, cast(b & 63L as int))")).alias("w"))
        held = {r.i: r.w for r in words.collect()}
        self.words = ",".join(str(held.get(i, 0)) for i in range(self.bits // 64))

    def has(self, key: Column) -> Column:
        words = F.split(F.lit(self.words), ",").cast("array<bigint>")
        tests = [F.getbit(F.get(words, F.shiftright(b, 6).cast("int")), b.bitwiseAND(F.lit(63)).cast("int")) == 1
                 for b in (_bit(key, self.level, i, self.bits) for i in range(HASHES))]
        out = tests[0]
        for test in tests[1:]:
            out = out & test
        return out


class Cascade:
    """Exact membership of `listed` (column key) for every key of `universe` (column key)."""

    def __init__(self, listed: DataFrame, universe: DataFrame):
        listed = listed.distinct()
        ours, count, level = listed, listed.count(), 0
        self.levels: list[Bloom] = []
        theirs = universe
        while count:
            bloom = Bloom(ours, count, level)
            self.levels.append(bloom)
            taken = theirs.where(bloom.has(F.col("key")))
            if level == 0:
                taken = taken.distinct().join(listed, "key", "left_anti")
            ours, theirs = stored(taken, "cascade"), ours
            count, level = ours.count(), level + 1

    def has(self, key: Column) -> Column:
        """Walk: the first level that doesn't take the key decides by its parity."""
        out = F.lit(len(self.levels) % 2 == 1)
        for bloom in reversed(self.levels):
            out = F.when(~bloom.has(key), F.lit(bloom.level % 2 == 1)).otherwise(out)
        return out


def judge_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url") -> DataFrame:
    """One row per page: key, host, path, rule, verdict.

    rules: host, path (from its `/` on), verdict (allow or block). A rule fits its host and all subdomains where the
    url's path starts with the rule's; the longest fitting rule wins (then the longer host, then block). Without a
    fitting rule a url isn't listed, which means allow. Null urls, urls without `://` and empty hosts fit no rule.
    Repeated rows and null keys stay; an empty list allows everything; other columns are ignored.
    """
    rules = rules.where(F.col("host").isNotNull() & F.col("path").isNotNull()).select(
        F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict")
    rules = rules.withColumn("key", F.concat("host", "path"))
    shape = rules.agg(F.max(F.size(F.split("host", "\\.", -1))).alias("labels"),
                      F.collect_set(F.length("path")).alias("prefixes"), F.countDistinct("key").alias("n")).head()
    host, path = host_and_path(F.col(url))
    found = pages.select(F.col(key).alias(key), host.alias("host"), path.alias("path"))
    keyed = found.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), shape.labels or 0,
                                                    sorted(shape.prefixes))
                             if shape.n else F.array().cast("array<string>"))
    if shape.n * BITS_PER_KEY > MAX_BITS:
        return _joined(keyed, rules, key)
    universe = keyed.select(F.explode("keys").alias("key"))
    verdicts = {v: Cascade(rules.where(F.col("verdict") == v).select("key"), universe) for v in ("allow", "block")}

    def hits(verdict: str) -> Column:
        return F.transform(F.filter("keys", verdicts[verdict].has), lambda k: F.struct(
            F.length(k).alias("n"), F.instr(k, "/").alias("host_n"), F.lit(verdict).alias("verdict"), k.alias("rule")))

    best = keyed.withColumn("best", F.array_max(F.concat(hits("allow"), hits("block"))))
    return best.select(key, "host", "path", F.col("best.rule").alias("rule"),
                       F.coalesce("best.verdict", F.lit("allow")).alias("verdict"))


def _joined(keyed: DataFrame, rules: DataFrame, key: str) -> DataFrame:
    """The same for a list too large for the plan: distinct keys of the corpus meet the list, then the pages."""
    best = F.max(F.struct(F.length("key").alias("n"), F.instr("key", "/").alias("host_n"), "verdict",
                          F.col("key").alias("rule"))).alias("best")
    places = keyed.select("host", "path", "keys").distinct()
    hit = places.select("host", "path", F.explode("keys").alias("key")).join(rules.select("key", "verdict"), "key")
    hit = hit.groupBy("host", "path").agg(best)
    return keyed.join(hit, ["host", "path"], "left").select(
        key, "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit("allow")).alias("verdict"))
