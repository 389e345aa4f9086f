"""Token counts: a broadcast table of frequent pre-token lengths, misses through worker caches."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltgate.llm import wordbpe

#: Entries of the broadcast table, and of each task's summary it is made from.
FREQUENT = 32_768
PER_TASK = 4_096
#: A task's counter is cut back to its larger counts beyond this size, so its memory is bounded.
COUNTER_ENTRIES = 200_000
OVER_LIMIT = 2_048


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[str] = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            if text:
                counts.update(wordbpe.pieces(text) or ())
                if len(counts) > COUNTER_ENTRIES:
                    counts = Counter(dict(counts.most_common(COUNTER_ENTRIES // 2)))
    top = [(k, n) for k, n in counts.most_common(PER_TASK) if len(k) <= wordbpe.CACHED_CHARS]
    yield pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], ["piece", "n"])


def frequent_pieces(docs: DataFrame, text: str = "text", entries: int = FREQUENT) -> list[str]:
    """The most frequent pre-tokens over all documents, from one bounded summary per task.

    Pre-tokens are never shuffled; at most PER_TASK summary rows leave a task. The choice of entries steers speed only:
    any table gives the same counts.
    """
    parts = docs.select(text).mapInArrow(_summaries, "piece string, n long")
    top = parts.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(entries)
    return [r.piece for r in top.collect()]


def count_tokens(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text",
                 limit: int = OVER_LIMIT) -> DataFrame:
    """One row per input row: key, n_bytes (UTF-8), n_tokens, over_limit.

    The whole text is counted as the tokenizer file gives it, without added special tokens; special strings inside a
    text count as the library counts them. Null and empty texts have 0 bytes and 0 tokens; repeated rows stay repeated;
    a null key stays null; other columns are ignored.
    """
    spark = docs.sparkSession
    pieces = frequent_pieces(docs, text)
    known = wordbpe.PreTokens(tokenizer_path, len)
    known.add(pieces)
    table = spark.sparkContext.broadcast(dict(known))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cached = wordbpe.PreTokens(tokenizer_path, len, table.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            n_bytes = [len((x or "").encode()) for x in texts]
            n_tokens = np.fromiter(wordbpe.encoded(texts, cached, sum), dtype=np.int64, count=len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens), pa.array(n_tokens > limit)],
                [key, "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(count, f"`{key}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
