"""Packing: documents become pieces of at most one sequence, packed shortest-pack-first over the length histogram.

Lengths are placed longest first; a length goes to the pack with the most room, and packs of one content are one
pattern with a count. Only the histogram (at most one number per length) and the patterns reach the driver; documents
are joined to slots by their rank within their length.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltgate.llm import wordbpe
from siltgate.llm.common import shuffle_width, stored

MAX_LEN = 4_096
END_ID = 2


@dataclass
class Slots:
    """Rows sorted by (length, first rank): ranks from `first` on go to sequences from `sequence` on, at `offset`."""

    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int


def pack_histogram(histogram: dict[int, int], max_len: int = MAX_LEN) -> Slots:
    """Shortest-pack-first over {length: count}.

    Work and output depend on the number of distinct lengths, not on the counts.
    """
    room: dict[int, list[tuple[int, int]]] = {}
    heap: list[int] = []
    rows: list[tuple[int, int, int, int]] = []
    total = 0

    def leave(space: int, first: int, count: int) -> None:
        if space and count:
            if space not in room:
                room[space] = []
                heapq.heappush(heap, -space)
            room[space].append((first, count))

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            if heap and -heap[0] >= length:
                space = -heap[0]
                first, count = room[space].pop()
                if not room[space]:
                    del room[space]
                    heapq.heappop(heap)
                used = min(left, count)
                rows.append((length, rank, first, max_len - space))
                leave(space - length, first, used)
                leave(space, first + used, count - used)
                rank, left = rank + used, left - used
            else:
                each = max_len // length
                packs, each = (left // each, each) if left >= each else (1, left)
                for k in range(each):
                    rows.append((length, rank, total, k * length))
                    rank += packs
                left -= packs * each
                leave(max_len - each * length, total, packs)
                total += packs
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)
    return Slots(table[:, 0].copy(), table[:, 1].copy(), table[:, 2].copy(), table[:, 3].copy(), total)


def encode_pieces(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text",
                  max_len: int = MAX_LEN) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens. Every piece but a document's last is full."""
    end = np.array([END_ID], dtype="<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, start, length, crc, tokens = [], [], [], [], []
            for i, found in enumerate(wordbpe.id_bytes(tokenizer_path, batch.column(1).to_pylist())):
                ids = found + end
                for at in range(0, len(ids), 4 * max_len):
                    piece = ids[at:at + 4 * max_len]
                    row.append(i)
                    start.append(at // 4)
                    length.append(len(piece) // 4)
                    crc.append(zlib.crc32(piece))
                    tokens.append(len(ids) // 4)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())),
                 *(pa.array(x, pa.int64()) for x in (start, length, crc, tokens))],
                [key, "start", "length", "ids_crc32", "doc_tokens"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(
        encode, f"`{key}` {kind}, start long, length long, ids_crc32 long, doc_tokens long")


def pack(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text",
         max_len: int = MAX_LEN) -> DataFrame:
    """Every piece of every document with its place: encode_pieces' columns, sequence_id, offset.

    Null and empty texts are a piece that holds the end id alone. Repeated rows are packed as often as they come, null
    keys like any other; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    found = stored(encode_pieces(docs, tokenizer_path, key, text, max_len), "pieces")
    # Ranks within a length are counted per bucket of its pieces, so no length is one group, however common.
    buckets = max(16, shuffle_width(spark))
    keyed = found.withColumn("bucket", F.pmod(F.xxhash64(key, "start", "ids_crc32"), F.lit(buckets)).cast("int"))
    counts = keyed.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.withColumn("bucket_first", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = pack_histogram(histogram, max_len)
    within = Window.partitionBy("length", "bucket").orderBy(key, "start", "ids_crc32")
    ranked = keyed.withColumn("rank", F.row_number().over(within) - 1).join(firsts, ["length", "bucket"])
    ranked = ranked.select(key, "start", "length", "ids_crc32", "doc_tokens",
                           (F.col("bucket_first") + F.col("rank")).alias("rank"))
    shared = spark.sparkContext.broadcast(slots)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        starts = np.searchsorted(table.length, np.arange(max_len + 2))
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            at = np.empty(len(length), dtype=np.int64)
            order = np.argsort(length, kind="stable")
            cuts = np.flatnonzero(np.diff(length[order])) + 1
            for rows in np.split(order, cuts) if len(order) else []:
                low, high = starts[length[rows[0]]], starts[length[rows[0]] + 1]
                at[rows] = low + np.searchsorted(table.first[low:high], rank[rows], side="right") - 1
            sequence = table.sequence[at] + rank - table.first[at]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in range(5)), pa.array(sequence), pa.array(table.offset[at])],
                [key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    kind = docs.schema[key].dataType.simpleString()
    return ranked.mapInArrow(place, f"`{key}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
                                    "sequence_id long, offset long")
