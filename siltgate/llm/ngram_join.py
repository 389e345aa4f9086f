"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix.

Documents of one n-gram set are one row of the matrix. Columns are ordered from rare to common, so that the first
columns of a row, its prefix, decide which rows can reach the threshold at all. Rows that share prefix columns form
blocks; a block's product accumulates overlap counts column block by column block and drops pairs that the sizes and
the remaining columns rule out. What leaves a block is a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltgate.llm.common import discard, stored, stored_in, worker_cache
from siltgate.llm.components import components
from siltgate.llm.urls import BITS_PER_KEY, MAX_BITS, Bloom

#: Words of an n-gram; two documents link where 100 * intersection >= PERCENT * union.
WORDS, PERCENT = 4, 85
#: Counters of n-grams by hash, and those of one shuffled row. They only order columns: any order gives the same links.
COUNTERS, CHUNK = 1 << 21, 1 << 14
#: Levels by how many standard deviations a counter lies from the mean: a few bits of order, finest where prefixes end.
DEVIATIONS = (-1.5, -1.0, -0.5, 0.5, 3.0, 10.0, 50.0)
HASH_BITS = 60
#: Columns with more rows than this compare their rows' prefixes in blocks instead of pair by pair.
PAIRED = 24
#: A block holds about so many set members and so many rows at most.
BLOCK_MEMBERS, BLOCK_ROWS = 150_000, 1_024
COLUMN_BLOCK = 2_048
WORD_CACHE = 300_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class Likeness:
    """What links two documents: n-grams of so many words, and the part of them in percent that both share."""

    words: int = WORDS
    percent: int = PERCENT

    def need(self, size_a, size_b):
        """The smallest intersection with which sets of these sizes link."""
        return -(-self.percent * (size_a + size_b) // (100 + self.percent))

    @property
    def size_step(self) -> float:
        """Step of log size: rows of linked documents lie in one or in neighbouring steps."""
        return math.log(100 / self.percent) + 1e-4


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(self) >= WORD_CACHE:
            self.clear()
        if len(word) <= 64:
            self[word] = value
        return value


def _word_hashes() -> _WordHashes:
    return worker_cache("word hashes", _WordHashes)


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The sorted distinct n-gram hashes (60 bits) of a whole text; a shorter text is one n-gram."""
    found = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not found:
        return np.empty(0, dtype=np.int64)
    known = _word_hashes()
    hashes = np.fromiter(map(known.__getitem__, found), dtype=np.uint64, count=len(found))
    n = min(words, len(found))
    out = np.full(len(found) - n + 1, n, dtype=np.uint64)
    for k in range(n):
        out = (out ^ (out >> np.uint64(31))) * _MIX + hashes[k:len(found) - n + 1 + k]
    out = (out ^ (out >> np.uint64(32))) * _MIX2
    out = (out ^ (out >> np.uint64(29))) >> np.uint64(64 - HASH_BITS)
    return np.unique(out.astype(np.int64))


def column_levels(docs: DataFrame, text: str, like: Likeness) -> np.ndarray:
    """A level per counter over all n-grams: low where few n-grams fall, high where common ones do.

    A document's prefix is its n-grams of the lowest levels; one that several documents have lifts its own counter and
    is rarely among them.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, dtype=np.int64)
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for value in batch.column(0):
                held.append((shingles(value.as_py(), like.words) & (COUNTERS - 1)).astype(np.int32))
                size += len(held[-1])
                if size > COUNTERS // 8:
                    total += np.bincount(np.concatenate(held), minlength=COUNTERS)
                    held, size = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=COUNTERS)
        chunks = [zlib.compress(total[i:i + CHUNK].astype("<i8").tobytes(), 1) for i in range(0, COUNTERS, CHUNK)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(chunks)), pa.int32()), pa.array(chunks, pa.binary())],
                                         ["chunk", "counts"])

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(zlib.decompress(c), dtype="<i8") for c in group["counts"].to_pylist())
        return pa.table({"chunk": group["chunk"][:1], "total": pa.array([int(total.sum())], pa.int64()),
                         "counts": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})

    schema = "chunk int, counts binary"
    sums, folder = stored_in(docs.select(text).mapInArrow(count, schema).groupBy("chunk").applyInArrow(
        add, "chunk int, total long, counts binary"), "counters")
    mean = (sums.agg(F.sum("total")).head()[0] or 0) / COUNTERS

    def level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for packed in batch.column("counts").to_pylist():
                counts = np.frombuffer(zlib.decompress(packed), dtype="<i8")
                levels = np.digitize((counts - mean) / max(1.0, mean ** 0.5), DEVIATIONS)
                found.append(zlib.compress(levels.astype(np.uint8).tobytes(), 1))
            yield pa.RecordBatch.from_arrays([batch.column("chunk"), pa.array(found, pa.binary())], ["chunk", "levels"])

    levels = np.zeros((COUNTERS // CHUNK, CHUNK), dtype=np.uint8)
    # The driver gets levels, a byte a counter and packed: the counters are eight times as large.
    for row in sums.select("chunk", "counts").mapInArrow(level, "chunk int, levels binary").collect():
        levels[row.chunk] = np.frombuffer(zlib.decompress(row.levels), dtype=np.uint8)
    discard(docs.sparkSession, folder)
    return levels.ravel()


def _incidence(docs: DataFrame, key: str, text: str, levels: np.ndarray, like: Likeness) -> DataFrame:
    """Per row of docs: key, n (set size), d1 and d2 (digest of the set), prefix (its first ordered columns)."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, digest, prefix = [], [], []
            for value in batch.column(1):
                grams = shingles(value.as_py(), like.words)
                columns = np.sort((shared.value[grams & (COUNTERS - 1)].astype(np.int64) << HASH_BITS) | grams)
                n.append(len(grams))
                digest.append(np.frombuffer(hashlib.blake2b(grams.tobytes(), digest_size=16).digest(), dtype="<i8"))
                prefix.append(columns[:len(grams) - (-(-like.percent * len(grams) // 100)) + 1] if len(grams) else columns)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array([d[0] for d in digest], pa.int64()),
                 pa.array([d[1] for d in digest], pa.int64()), pa.array(prefix, pa.list_(pa.int64()))],
                [key, "n", "d1", "d2", "prefix"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, n long, d1 long, d2 long, prefix array<long>")


def _candidates(rows: DataFrame, like: Likeness) -> DataFrame:
    """rows: node, n, prefix -> u, v: rows that may link lie in one component of these edges."""
    # Most columns have one row: the shuffle that finds the others carries the row's number alone.
    slim = rows.select("node", F.explode("prefix").alias("column"))
    shared = slim.groupBy("column").agg(F.count("*").alias("df")).where("df > 1")
    sizes = rows.select("node", "n", F.size("prefix").alias("p"), F.element_at("prefix", -1).alias("last"))
    columns = stored(slim.join(shared, "column").join(sizes, "node"), "columns")
    common = columns.where(F.col("df") > PAIRED)
    rare = columns.where(F.col("df") <= PAIRED).select("column", "node", "n")
    a, b = (rare.select("column", *(F.col(c).alias(f"{c}_{x}") for c in ("node", "n"))) for x in "ab")
    sized = (F.col("n_a") * 100 >= F.col("n_b") * like.percent) & (F.col("n_b") * 100 >= F.col("n_a") * like.percent)
    pairs = a.join(b, "column").where((F.col("node_a") < F.col("node_b")) & sized)
    pairs = pairs.groupBy("node_a", "node_b").agg(F.count("*").alias("overlap"))
    # Up to the smaller of the two last prefix columns all common columns are counted, but for h common ones; the rest
    # is at most what that row has beyond its prefix.
    known = sizes.join(common.groupBy("node").agg(F.count("*").alias("h")), "node", "left").fillna(0, ["h"])
    for x in "ab":
        pairs = pairs.join(known.select(*(F.col(c).alias(f"{c}_{x}") for c in known.columns)), f"node_{x}")
    rest_a, rest_b = F.col("n_a") - F.col("p_a"), F.col("n_b") - F.col("p_b")
    rest = F.when(F.col("last_a") < F.col("last_b"), rest_a).when(F.col("last_a") > F.col("last_b"), rest_b).otherwise(
        F.least(rest_a, rest_b))
    least = F.ceil((F.col("n_a") + F.col("n_b")) * like.percent / (100 + like.percent)) - rest
    kept = pairs.where(F.col("overlap") + F.least("h_a", "h_b") >= least).select(
        F.col("node_a").alias("u"), F.col("node_b").alias("v"))
    cells = stored(_cells(common.select("node", "n", F.col("column").alias("component")), like), "cells")
    return kept.unionByName(_prefix_edges(rows, cells, like))


def _prefix_edges(rows: DataFrame, cells: DataFrame, like: Likeness) -> DataFrame:
    """u, v: within each cell a spanning forest of the pairs whose prefixes leave a link possible."""
    def multiply(group: pa.Table) -> pa.Table:
        node, side, component, n = (group[c].to_numpy() for c in ("node", "side", "component", "n"))
        prefix = group["prefix"].combine_chunks()
        starts, columns = prefix.offsets.to_numpy(), prefix.values.to_numpy()
        u, v = [], []
        order = np.lexsort((node, component))
        for own in np.split(order, np.flatnonzero(np.diff(component[order])) + 1):
            sets = [columns[starts[i]:starts[i + 1]] for i in own]
            last, size = np.array([x[-1] for x in sets]), n[own]
            rest = size - np.array([len(x) for x in sets])
            first = last[:, None] < last[None, :]
            equal = last[:, None] == last[None, :]
            unseen = np.where(equal, np.minimum.outer(rest, rest), np.where(first, rest[:, None], rest[None, :]))
            least = like.need(size[:, None], size[None, :])
            possible = np.minimum.outer(size, size) >= least
            label = block_links(sets, np.where(possible, least - unseen, 1 << 40), side[own])
            moved = np.flatnonzero(label != np.arange(len(own)))
            u.append(node[own[moved]])
            v.append(node[own[label[moved]]])
        return pa.table({"u": np.concatenate(u), "v": np.concatenate(v)})

    rows = _only(rows.select("node", "n", "prefix"), cells)
    return rows.join(cells, "node").groupBy("cell").applyInArrow(multiply, "u long, v long")


def _only(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """The rows that may be in a cell: most are in none and need not be shuffled. A long list of nodes takes all rows."""
    nodes = cells.select(F.col("node").alias("key")).distinct()
    count = nodes.count()
    return rows.where(Bloom(nodes, count, 0).has(F.col("node"))) if 0 < count * BITS_PER_KEY <= MAX_BITS else rows


def _cells(inside: DataFrame, like: Likeness) -> DataFrame:
    """inside: node, n, component -> node, component, cell, side: the block products a row takes part in."""
    inside = stored(inside.withColumn("step", F.floor(F.log(F.col("n").cast("double")) / like.size_step).cast("int")), "grouped")
    steps = inside.groupBy("component", "step").agg(F.sum("n").alias("members"), F.count("*").alias("docs"))
    whole = steps.groupBy("component").agg(F.sum("members").alias("members"), F.sum("docs").alias("docs"))
    small = (F.col("members") <= BLOCK_MEMBERS) & (F.col("docs") <= BLOCK_ROWS)
    # Small components share cells; a cell's components are multiplied one by one.
    in_small = whole.where(small)
    total = in_small.agg(F.coalesce(F.sum("members"), F.lit(0))).head()[0]
    packs = max(1, -(-total // BLOCK_MEMBERS))
    tiny = inside.join(in_small.select("component"), "component").select(
        "node", "component", F.concat(F.lit("p"), F.pmod(F.xxhash64("component"), F.lit(packs)).cast("string")).alias("cell"),
        F.lit(0).alias("side"))
    # Large ones: rows of each size step are dealt into blocks, which meet within a step and with the next one.
    parts = steps.join(whole.where(~small).select("component"), "component").select(
        "component", "step", F.greatest(F.ceil(F.col("members") / BLOCK_MEMBERS), F.ceil(F.col("docs") / BLOCK_ROWS)).cast(
            "int").alias("k"))
    large = inside.join(parts, ["component", "step"])
    for name, shift in (("above", -1), ("below", 1)):
        near = parts.select("component", (F.col("step") + shift).alias("step"), F.col("k").alias(name))
        large = large.join(near, ["component", "step"], "left")
    large = large.withColumn("part", F.pmod(F.xxhash64("node"), F.col("k")).cast("int"))
    others = lambda k: F.when(F.col(k) > 0, F.sequence(F.lit(0), F.col(k) - 1)).otherwise(F.array().cast("array<int>"))

    def cell(step, i, step2, j, side):
        return F.struct(F.concat_ws(":", F.col("component").cast("string"), *(
            x.cast("string") for x in (step, i, step2, j))).alias("cell"), side.cast("int").alias("side"))

    step, own = F.col("step"), F.col("part")
    met = F.concat(
        F.transform(others("k"), lambda j: cell(step, F.least(own, j), step, F.greatest(own, j), own > j)),
        F.transform(others("above"), lambda j: cell(step, own, step + 1, j, F.lit(0))),
        F.transform(others("below"), lambda j: cell(step - 1, j, step, own, F.lit(1))))
    large = large.select("node", "component", F.explode(met).alias("c")).select("node", "component", "c.cell", "c.side")
    return tiny.unionByName(large)


def block_links(sets: list[np.ndarray], least: np.ndarray, side: np.ndarray) -> np.ndarray:
    """For each set the smallest index it is connected to by pairs whose overlap reaches `least` within this block.

    side: with both 0 and 1 present only pairs across are looked at. Overlaps accumulate over blocks of columns; after
    each, a row that no pair can bring to its bound any more leaves.
    """
    m = len(sets)
    label = np.arange(m)
    if m < 2:
        return label
    size = np.array([len(s) for s in sets], dtype=np.int64)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(m), size)
    held = count[column] > 1
    row, column = row[held], column[held]
    numbers = np.cumsum(count > 1) - 1
    column = numbers[column]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    left = np.bincount(row, minlength=m)
    pairs = np.minimum.outer(size, size) >= least
    if side.any() and not side.all():
        pairs &= side[:, None] != side[None, :]
    np.fill_diagonal(pairs, False)
    overlap = np.zeros((m, m), dtype=np.float32)
    alive = np.arange(m)
    columns = int(column[-1]) + 1 if len(column) else 0
    for start in range(0, columns, COLUMN_BLOCK):
        low, high = np.searchsorted(column, [start, start + COLUMN_BLOCK])
        at = np.full(m, -1)
        at[alive] = np.arange(len(alive))
        here = at[row[low:high]] >= 0
        block = np.zeros((len(alive), min(COLUMN_BLOCK, columns - start)), dtype=np.float32)
        block[at[row[low:high][here]], column[low:high][here] - start] = 1
        overlap[np.ix_(alive, alive)] += block @ block.T
        left -= np.bincount(row[low:high], minlength=m)
        reach = overlap[np.ix_(alive, alive)] + np.minimum.outer(left[alive], left[alive])
        can = pairs[np.ix_(alive, alive)] & (reach >= least[np.ix_(alive, alive)])
        pairs[np.ix_(alive, alive)] = can
        alive = alive[can.any(axis=1)]
        if not len(alive):
            return label
    linked = pairs & (overlap >= least)
    while True:
        near = np.where(linked, label[None, :], m).min(axis=1)
        new = np.minimum(label, near)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _block_edges(docs: DataFrame, cells: DataFrame, key: str, text: str, like: Likeness) -> DataFrame:
    """u, v: a spanning forest of the links in every cell."""
    rows = docs.select(F.col(key).alias("node"), F.col(text).alias("text"))
    rows = _only(rows, cells)
    rows = rows.join(cells, "node")

    def multiply(group: pa.Table) -> pa.Table:
        nodes, side = group["node"].to_numpy(), group["side"].to_numpy()
        component = group["component"].to_numpy()
        texts = group["text"]
        u, v = [], []
        order = np.lexsort((nodes, component))
        for own in np.split(order, np.flatnonzero(np.diff(component[order])) + 1):
            sets = [shingles(texts[int(i)].as_py(), like.words) for i in own]
            size = np.array([len(x) for x in sets], dtype=np.int64)
            label = block_links(sets, like.need(size[:, None], size[None, :]), side[own])
            moved = np.flatnonzero(label != np.arange(len(own)))
            u.append(nodes[own[moved]])
            v.append(nodes[own[label[moved]]])
        return pa.table({"u": np.concatenate(u), "v": np.concatenate(v)})

    return rows.groupBy("cell").applyInArrow(multiply, "u long, v long")


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per row of docs: key, n_shingles, component_id (the smallest key reachable by links).

    A set is the distinct n-grams of so many words of a whole text, A-Z lower-cased; null texts and texts without words have none
    and link with nothing. Rows with equal sets are linked. Keys are long and meant to be unique; repeated rows count as
    copies. A row without a key links nothing and has a null component. Other columns are ignored.
    """
    like = Likeness(words, percent)
    found = stored(_incidence(docs, key, text, column_levels(docs, text, like), like), "incidence")
    sets = found.where(F.col(key).isNotNull() & (F.col("n") > 0))
    rows = stored(sets.groupBy("d1", "d2").agg(F.min(key).alias("node"), F.max("n").alias("n"),
                                               F.min_by("prefix", key).alias("prefix")), "rows")
    groups = components(_candidates(rows.select("node", "n", "prefix"), like))
    groups = groups.unionByName(groups.select(F.col("component").alias("node"), "component").distinct())
    cells = stored(_cells(rows.select("node", "n").distinct().join(groups, "node"), like), "cells")
    linked = components(_block_edges(docs.where(F.col(text).isNotNull()), cells, key, text, like))
    named = rows.join(linked, "node", "left").select(
        "d1", "d2", F.coalesce("component", "node").alias("component_id"))
    own = F.when(F.col("n") == 0, F.col(key)).otherwise(F.when(F.col(key).isNotNull(), F.col("component_id")))
    return found.drop("prefix").join(named, ["d1", "d2"], "left").select(
        key, F.col("n").alias("n_shingles"), own.alias("component_id"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS,
             percent: int = PERCENT) -> DataFrame:
    """Of each group of linked documents the one of the smallest key; rows without a key stay, repeated rows become one.

    All columns of docs stay as they are, whatever their names.
    """
    found = join(docs, key, text, words, percent)
    kept = stored(found.where(F.col(key) == F.col("component_id")).groupBy(key).agg(F.count("*").alias("rows")), "kept")
    rows = docs.alias("d").join(kept.select(F.col(key).alias("key"), "rows").alias("k"), F.col(f"d.{key}") == F.col("k.key"))
    once, more = (rows.where(F.col("k.rows") == 1).select("d.*"), rows.where(F.col("k.rows") > 1).select("d.*"))
    more = more.dropDuplicates([key])
    return once.unionByName(more).unionByName(docs.where(F.col(key).isNull()))
