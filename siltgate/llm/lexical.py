"""Ranked lexical search by MaxScore with pair bounds.

Documents lie in blocks, each with the inverted lists of the asked terms. For term pairs of the queries a block keeps the
intersection list's joint maxima: the points of (impact, impact) that no other point of the intersection exceeds in both,
so the joint maximum follows for any weights. A query matches its terms into pairs where that saves most; terms whose
combined bound stays below the 20th score found so far are never walked for candidates, and a block whose whole bound
does is skipped. A first round over a share of the blocks gives each query a score to beat.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from siltgate.llm.common import shuffle_width, squeezed, stored, unsqueezed

TOP = 20
#: A block ends with so many documents, or the document that brings it to so many terms.
BLOCK_DOCS, BLOCK_TERMS = 4_096, 4_000_000
#: Text that is split into terms at once.
SPLIT_BYTES = 2_000_000
#: Asked terms are told to the scan as a bit array of this fixed size: a false hit is one list more, never another score.
FILTER_BITS = 1 << 22
#: Queries that are answered together in one task.
QUERIES = 1_024
#: Blocks that share a copy of their queries.
SHARED = 4
#: The share of blocks whose scores the others have to beat.
FIRST = 16
#: Neighbours by weight that a query's term is paired with.
NEAR = 2

_BYTES = np.arange(256)
_IN_TERM = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x41) & (_BYTES <= 0x5A)) | (
    (_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)
_VALUES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)
_VALUES[0x41:0x5B] = _VALUES[0x61:0x7B]
_BASE = 0x9E3779B97F4A7C15 | 3
_MIX = np.uint64(0xC2B2AE3D27D4EB4F)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & (1 << 64) - 1, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def term_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """data: bytes of documents that begin at `starts` -> (document, hash) of every term in order. A-Z count as a-z."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    inside = _IN_TERM[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    starts_here = starts[starts < len(data)]
    first[starts_here] = inside[starts_here]
    before = starts_here[starts_here > 0] - 1
    last[before] = inside[before]
    first, last = np.flatnonzero(first), np.flatnonzero(last)
    # A polynomial's prefix sums: a term's hash is a difference, moved to the same power.
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_VALUES[data] * _powers(_BASE, len(data)), dtype=np.uint64, out=sums[1:])
    hashes = (sums[last + 1] - sums[first]) * _powers(pow(_BASE, -1, 1 << 64), len(data))[first]
    hashes = (hashes ^ (hashes >> np.uint64(31))) * _MIX
    hashes ^= hashes >> np.uint64(29)
    return np.searchsorted(starts, first, side="right") - 1, hashes.view(np.int64)


def _terms(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of runs of texts: the first one's index, and (text within the run, hash) of every term. Null has none."""
    texts = texts.cast(pa.binary())
    lengths = np.array([0 if x is None else x for x in pc.binary_length(texts).to_pylist()], dtype=np.int64)
    at = 0
    while at < len(lengths):
        n = max(1, int(np.searchsorted(np.cumsum(lengths[at:]), SPLIT_BYTES, side="right")))
        run = texts.slice(at, n)
        data = b"".join(x or b"" for x in run.to_pylist())
        yield at, *term_hashes(np.frombuffer(data, np.uint8), np.cumsum(lengths[at:at + n]) - lengths[at:at + n])
        at += n


def query_terms(queries: DataFrame, item: str, text: str) -> DataFrame:
    """queries: item, text -> no (a number per distinct row), item, term, times."""
    rows = queries.select(item, text).distinct().withColumn("no", F.monotonically_increasing_id())
    kind = queries.schema[item].dataType.simpleString()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, of, hashes in _terms(batch.column(2)):
                pairs, times = np.unique(np.stack([of, hashes]), axis=1, return_counts=True)
                of = pa.array(pairs[0] + at)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(of), batch.column(1).take(of), pa.array(pairs[1]), pa.array(times)],
                    ["no", item, "term", "times"])

    return rows.select("no", item, text).mapInArrow(split, f"no long, `{item}` {kind}, term long, times long")


_LISTS = ("n", "terms", "df", "doc", "tf")


def blocks(docs: DataFrame, wanted: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Inverted lists per block: keys, n (terms per document), terms (sorted), df, and per list doc and tf."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)
    key_type = to_arrow_type(docs.schema[key].dataType)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        keys, counts, found = [], [], []
        rows = size = number = 0

        def flush() -> pa.RecordBatch:
            nonlocal keys, counts, found, rows, size, number
            n = np.concatenate(counts)
            doc, hashes = (np.concatenate([f[k] for f in found]) for k in (0, 1))
            terms, at = np.unique(hashes, return_inverse=True)
            lists, tf = np.unique(at * rows + doc, return_counts=True)
            df = np.bincount(lists // rows, minlength=len(terms))
            out = pa.RecordBatch.from_arrays(
                [pa.array([task | number]), pa.array([pa.concat_arrays(keys).to_pylist()], pa.list_(key_type)),
                 pa.array([int((n > 0).sum())]), pa.array([int(n.sum())]),
                 *(pa.array([squeezed(x)], pa.binary()) for x in (n, terms, df, lists % rows, tf))],
                ["block", "keys", "docs", "all_terms", *_LISTS])
            keys, counts, found, rows, size, number = [], [], [], 0, 0, number + 1
            return out

        for batch in batches:
            texts = batch.column(1)
            for at, of, hashes in _terms(texts):
                m = int(of[-1]) + 1 if len(of) else 0
                n = np.bincount(of, minlength=m)
                end = 0
                # A block may end anywhere in a run; documents behind the run's last term have none and match nothing.
                while end < m:
                    full = int(np.searchsorted(np.cumsum(n[end:]), BLOCK_TERMS - size)) + 1
                    take = min(m - end, BLOCK_DOCS - rows, full)
                    low, high = np.searchsorted(of, [end, end + take])
                    hit = shared.value[hashes[low:high] & (FILTER_BITS - 1)]
                    keys.append(batch.column(0).slice(at + end, take))
                    counts.append(n[end:end + take])
                    found.append((of[low:high][hit] - end + rows, hashes[low:high][hit]))
                    rows, end, size = rows + take, end + take, size + high - low
                    if rows >= BLOCK_DOCS or size >= BLOCK_TERMS:
                        yield flush()
        if rows:
            yield flush()

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(build, f"block long, keys array<{kind}>, docs long, all_terms long, " +
                                             ", ".join(f"{c} binary" for c in _LISTS))


class Block:
    """A block's lists: impacts without weights, and the joint maxima of term pairs."""

    def __init__(self, keys: pa.Array, terms: np.ndarray, df: np.ndarray, doc: np.ndarray, impact: np.ndarray):
        self.keys = keys
        self.order = np.array([2**63 - 1 if k is None else k for k in keys.to_pylist()], dtype=np.int64)
        self.number = {t: i for i, t in enumerate(terms.tolist())}
        cuts = np.cumsum(df)[:-1]
        self.docs, self.impacts = np.split(doc, cuts), np.split(impact, cuts)
        self.most = np.maximum.reduceat(impact, np.concatenate([[0], cuts])).tolist() if len(df) else []

    def front(self, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        """Of the documents in both lists the impact pairs that none exceeds in both; empty lists where none has both."""
        a, b = (i, j) if len(self.docs[i]) <= len(self.docs[j]) else (j, i)
        at = np.searchsorted(self.docs[b], self.docs[a])
        at[at == len(self.docs[b])] = 0
        both = self.docs[b][at] == self.docs[a]
        x, y = self.impacts[a][both], self.impacts[b][at[both]]
        order = np.lexsort((-y, -x))
        x, y = x[order], y[order]
        kept = y > np.concatenate([[-1], np.maximum.accumulate(y)[:-1]]) if len(y) else np.empty(0, bool)
        return (x[kept], y[kept]) if a == i else (y[kept], x[kept])

    def search(self, terms: list[tuple[int, int]], joint: dict, beat: int, top: int) -> tuple[np.ndarray, np.ndarray]:
        """terms: (list, weight) -> (document, score) that may be among the best `top`; scores below `beat` are left out."""
        weight = dict(terms)
        alone = {i: g * self.most[i] for i, g in terms}
        gains = []
        for (i, j), (x, y) in joint.items():
            bound = max(alone[i], alone[j], int((x * weight[i] + y * weight[j]).max(initial=0)))
            gains.append((alone[i] + alone[j] - bound, i, j, bound))
        units, free = [], set(alone)
        for gain, i, j, bound in sorted(gains, reverse=True):
            if gain > 0 and i in free and j in free:
                units.append((bound, (i, j)))
                free -= {i, j}
        units = sorted(units + [(alone[i], (i,)) for i in free])
        bounds = np.cumsum([b for b, _ in units])
        if not len(bounds) or bounds[-1] < beat:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        optional = int(np.searchsorted(bounds, beat))
        score = np.zeros(len(self.order), dtype=np.int64)
        for _, lists in units[optional:]:
            for i in lists:
                score[self.docs[i]] += weight[i] * self.impacts[i]
        found = np.flatnonzero(score)
        for k in range(optional, -1, -1):
            # What is counted so far is a lower bound of each score, so the best of it raise the score to beat.
            if len(found) > top:
                beat = max(beat, int(np.partition(score[found], len(found) - top)[len(found) - top]))
            found = found[score[found] + (int(bounds[k - 1]) if k else 0) >= max(beat, 1)]
            for i in units[k - 1][1] if k else ():
                at = np.searchsorted(self.docs[i], found)
                at[at == len(self.docs[i])] = 0
                both = self.docs[i][at] == found
                score[found[both]] += weight[i] * self.impacts[i][at[both]]
        best = np.lexsort((self.order[found], -score[found]))[:top]
        return found[best], score[found[best]]


_INDEX = ("terms", "df", "doc", "impact", "pair_i", "pair_j", "pair_n", "pair_x", "pair_y")


def _by_item(asked: list[dict]) -> dict[int, list[tuple[int, int]]]:
    """asked: no, term, weight -> per query its terms by falling weight."""
    items: dict[int, list[tuple[int, int]]] = {}
    for r in sorted(asked, key=lambda r: (-r["weight"], r["term"])):
        items.setdefault(r["no"], []).append((r["term"], r["weight"]))
    return items


def _near(terms: list[int]) -> Iterator[tuple[int, int]]:
    for k, i in enumerate(terms):
        for j in terms[k + 1:k + 1 + NEAR]:
            yield (i, j) if i < j else (j, i)


def build_index(found: DataFrame, asked: DataFrame, parts: int, spread: int, documents: int, all_terms: int) -> DataFrame:
    """Each block with each part of the queries: the lists of the part's terms with their impacts, and its term pairs' joint maxima."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                n, terms, df, doc, tf = (unsqueezed(batch.column(c)[row].as_py()) for c in _LISTS)
                items = _by_item(batch.column("asked")[row].as_py())
                m = 75 + 25 * n * documents // max(1, all_terms)
                impact = 1_000_000_000 * tf // (1000 * tf + 12 * m[doc])
                mine = np.isin(terms, [t for x in items.values() for t, _ in x])
                rows = np.repeat(mine, df)
                terms, df, doc, impact = terms[mine], df[mine], doc[rows], impact[rows]
                block = Block(batch.column("keys")[row].values, terms, df, doc, impact)
                pairs = sorted({p for x in items.values() for p in _near([
                    block.number[t] for t, _ in x if t in block.number])})
                fronts = [block.front(i, j) for i, j in pairs]
                none = np.empty(0, np.int64)
                parts_of = (terms, df, doc, impact, np.array([i for i, _ in pairs], np.int64),
                            np.array([j for _, j in pairs], np.int64), np.array([len(x) for x, _ in fronts], np.int64),
                            np.concatenate([x for x, _ in fronts] or [none]), np.concatenate([y for _, y in fronts] or [none]))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(row, 1) for c in ("block", "part", "keys")),
                     *(pa.array([squeezed(x)], pa.binary()) for x in parts_of)], ["block", "part", "keys", *_INDEX])

    rows = found.drop("docs", "all_terms").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    keys = found.schema["keys"].dataType.simpleString()
    return _meet(rows, asked, spread).mapInArrow(build, f"block long, part int, keys {keys}, " +
                                           ", ".join(f"{c} binary" for c in _INDEX))


def _meet(rows: DataFrame, asked: DataFrame, spread: int) -> DataFrame:
    """Rows of blocks with their part of the queries, of which `spread` copies are dealt over the tasks, never broadcast."""
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(spread)).cast("int"))
    copies = asked.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    return rows.join(copies.hint("merge"), ["part", "salt"])


def search_index(index: DataFrame, asked: DataFrame, spread: int, key: str, top: int) -> DataFrame:
    """no, key, score: per block what may be among a query's best. asked: part, asked (no, term, weight), beat (no -> score)."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                terms, df, doc, impact, pair_i, pair_j, pair_n, x, y = (
                    unsqueezed(batch.column(c)[row].as_py()) for c in _INDEX)
                block = Block(batch.column("keys")[row].values, terms, df, doc, impact)
                cuts = np.cumsum(pair_n)[:-1]
                joint = dict(zip(zip(pair_i.tolist(), pair_j.tolist(), strict=True),
                                 zip(np.split(x, cuts), np.split(y, cuts), strict=True), strict=False))
                beat = dict(batch.column("beat")[row].as_py() or ())
                no, at, score = [], [], []
                for item, ranked in _by_item(batch.column("asked")[row].as_py()).items():
                    own = [(block.number[t], g) for t, g in ranked if t in block.number]
                    pairs = {p: joint[p] for p in _near([i for i, _ in own])}
                    found, scores = block.search(own, pairs, beat.get(item, 0), top)
                    no.append(np.full(len(found), item))
                    at.append(found)
                    score.append(scores)
                if no:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(no), pa.int64()), block.keys.take(pa.array(np.concatenate(at), pa.int64())),
                         pa.array(np.concatenate(score), pa.int64())], ["no", key, "score"])

    kind = index.schema["keys"].dataType.elementType.simpleString()
    return _meet(index, asked, spread).mapInArrow(search, f"no long, `{key}` {kind}, score long")


def search(docs: DataFrame, queries: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
           item_text: str = "text", top: int = TOP) -> DataFrame:
    """item, rank, key, score: each query's best documents with a score above 0, equal scores by ascending key.

    Every document takes part with its whole text; keys are long, a null key counts as the largest. Null and empty texts
    have no terms and match nothing. Repeated documents are ranked each; equal rows of queries are answered once, and
    rows of one item with different texts are queries of their own. Other columns are ignored; without documents or
    queries there are no rows.
    """
    spark = docs.sparkSession
    terms = stored(query_terms(queries, item, item_text), "query-terms")
    words = terms.select((F.col("term").bitwiseAND(FILTER_BITS - 1)).alias("bit")).distinct()
    wanted = np.zeros(FILTER_BITS, dtype=bool)
    wanted[words.toPandas()["bit"].to_numpy(dtype=np.int64)] = True
    found = stored(blocks(docs, wanted, key, text), "blocks")
    total = found.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("all_terms"), F.lit(0)), F.count("*")).head()
    spread = max(1, min(shuffle_width(spark), total[2] // SHARED))

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one, df in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(unsqueezed(one)), pa.array(unsqueezed(df))], ["term", "df"])

    held = found.select("terms", "df").mapInArrow(lists, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    idf = F.floor(1000 * F.log((2 * F.lit(total[0]) + 2) / (2 * F.col("df") + 1))).cast("long")
    parts = max(1, -(-terms.select("no").distinct().count() // QUERIES))
    part = F.pmod(F.xxhash64("no"), F.lit(parts)).cast("int").alias("part")
    weights = stored(terms.join(held, "term").select(part, "no", "term", (idf * F.col("times")).alias("weight")), "weights")
    asked = weights.groupBy("part").agg(F.collect_list(F.struct("no", "term", "weight")).alias("asked"))
    index = stored(build_index(found, asked, parts, spread, total[0], total[1]), "index")
    best = Window.partitionBy("no").orderBy(F.desc("score"), F.asc_nulls_last(key))
    first = F.pmod(F.xxhash64("block", F.lit(1)), F.lit(FIRST)) == 0
    none = F.lit(None).cast("map<bigint,bigint>")
    early = stored(search_index(index.where(first), asked.withColumn("beat", none), spread, key, top), "early")
    beat = early.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == top).select(part, "no", "score")
    beat = beat.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("no", "score"))).alias("beat"))
    late = search_index(index.where(~first), asked.join(beat, "part", "left"), spread, key, top)
    ranked = early.unionByName(late).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    names = terms.select("no", item).distinct()
    return ranked.join(names, "no").select(item, F.col("rank").cast("int").alias("rank"), key, "score")
