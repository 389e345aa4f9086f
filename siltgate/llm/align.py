"""Cross-tokenizer alignment: token ends of two tokenizers compared along diagonals, one-to-one runs skipped by probing.

Both tokenizers cut the same bytes. At the current index shift whole stretches of ends are compared, each twice as long
as the last; where a stretch differs, halving finds the end of the run. The irregular group behind it is walked token by
token, which sets the next shift. Links of id pairs are counted corpus-wide: a chunk of documents is one dictionary of
its pairs, pairs meet by their first id, and the counts go back to the chunks that asked.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import cache
from itertools import accumulate
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from siltgate.llm.common import shuffle_width, squeezed, stored, unsqueezed

#: Documents of about so many bytes share a dictionary of pairs; so many dictionaries meet in one task at most.
CHUNK_BYTES, CHUNKS_MET = 4_000_000, 256
#: The pre-token pattern of byte-level vocabularies (a fixed value).
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts with other characters than these, whose classes all libraries share, or with long white space go to the
#: tokenizer's own library.
_OTHER = re.compile("[^\\t\\n\\r -~À-ÖØ-öø-ÿ]|\\s{256}")
_BYTE = re.compile("<0x([0-9A-F]{2})>")


class ByteLevel:
    """A byte-level BPE tokenizer file. Special strings inside texts are plain text."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.library.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        split = spec["pre_tokenizer"]
        if split["type"] != "ByteLevel" or split["add_prefix_space"] or spec["normalizer"]:
            raise ValueError(f"{path} is no plain byte-level tokenizer")
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        letters = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(sorted({*range(256)} - {*shown}))}
        ids = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items()
               if all(c in letters for c in token)}
        self.bytes = [b""] * (max(ids.values()) + 1)
        for token, i in ids.items():
            self.bytes[i] = token
        # Ids of such vocabularies are the ranks of their merges, so the same file drives the faster encoder.
        self.fast = tiktoken.Encoding("byte-level", pat_str=PRE_TOKEN, mergeable_ranks=ids, special_tokens={})

    def encode(self, text: str) -> list[int]:
        text = " " + text
        if _OTHER.search(text):
            return self.library.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


class Pieces:
    """A sentencepiece model that itself puts a space before each text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        self.bytes = [bytes.fromhex(_BYTE.fullmatch(x)[1]) if self.model.is_byte(i) else
                      x.replace("▁", " ").encode() for i, x in enumerate(names)]

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)


@cache
def tokenizer(path: str) -> ByteLevel | Pieces:
    """This worker's tokenizer of a file: .model is sentencepiece, .json byte-level."""
    return Pieces(path) if path.endswith(".model") else ByteLevel(path)


@cache
def _tables(path: str, bar: str = "") -> tuple[list[int], list[str]]:
    """Bytes per id, and ids as text; those of the second side after a bar."""
    found = tokenizer(path).bytes
    return [len(b) for b in found], [f"{bar}{i}" for i in range(len(found))]


def runs(a: list[int], b: list[int]) -> tuple[list[tuple[int, int, int, int]], list[int], list[int]]:
    """a, b: increasing ends of the same bytes -> groups (i, j, n_a, n_b), and the token indices of every overlap.

    n_a > 0: that many one-to-one tokens from i and j on; n_a < 0: one irregular group of -n_a and n_b tokens.
    """
    found, link_a, link_b = [], [], []
    i = j = 0
    n = len(a)
    while i < n:
        first, shift, step = i, j - i, 8
        near = min(n, i + 4)
        while i < near and a[i] == b[j]:
            i += 1
            j += 1
        if near == i < n:
            # The run is longer: compare stretches, each twice as long, then find its end in the one that differs.
            while i < n and a[i:i + step] == b[i + shift:i + shift + step]:
                i += step
                step += step
            if i < n:
                while step > 8:
                    step >>= 1
                    if a[i:i + step] == b[i + shift:i + shift + step]:
                        i += step
                j = i + shift
                while a[i] == b[j]:
                    i += 1
                    j += 1
            else:
                i = n
        j = i + shift
        if i > first:
            found.append((first, first + shift, i - first, i - first))
            link_a += range(first, i)
            link_b += range(first + shift, j)
            if i == n:
                break
        # Within a group no two ends are equal: each step past the smaller end is one more overlap.
        x, y = i, j
        end_a, end_b = a[x], b[y]
        while True:
            link_a.append(x)
            link_b.append(y)
            if end_a < end_b:
                x += 1
                end_a = a[x]
            elif end_b < end_a:
                y += 1
                end_b = b[y]
            else:
                break
        found.append((i, j, i - x - 1, y + 1 - j))
        i, j = x + 1, y + 1
    return found, link_a, link_b


class Alignment:
    """One text: ids of both sides, its groups as text, and the linked token indices. Without tokens all are empty."""

    def __init__(self, text: str | None, a: str, b: str):
        self.a: list[int] = []
        self.b: list[int] = []
        self.groups, self.n_groups, self.n_links = "", 0, 0
        if not text:
            return
        wanted = b" " + text.encode("utf-8", "surrogatepass")
        ids_a, ids_b = tokenizer(a).encode(text), tokenizer(b).encode(text)
        for path, ids in ((a, ids_a), (b, ids_b)):
            table = tokenizer(path).bytes
            if max(ids) >= len(table) or b"".join(map(table.__getitem__, ids)) != wanted:
                return
        self.a, self.b = ids_a, ids_b
        (len_a, name_a), (len_b, name_b) = _tables(a), _tables(b, "|")
        found, link_a, link_b = runs(list(accumulate(map(len_a.__getitem__, ids_a))),
                                     list(accumulate(map(len_b.__getitem__, ids_b))))
        shown_a, shown_b = list(map(name_a.__getitem__, ids_a)), list(map(name_b.__getitem__, ids_b))
        text_of: list[str] = []
        for i, j, n, m in found:
            if n > 0:
                text_of += map(add, shown_a[i:i + n], shown_b[j:j + n])
            else:
                text_of.append(",".join(shown_a[i:i - n]) + ",".join(shown_b[j:j + m]).replace(",|", ","))
        self.groups, self.n_groups, self.n_links = ";".join(text_of), len(text_of), len(link_a)
        self.pairs = (np.array(ids_a, dtype=np.int64)[link_a] << 32) | np.array(ids_b, dtype=np.int64)[link_b]


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
_CHUNK = ("chunk long, keys array<{key}>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
          "groups array<string>, {sizes}")
_PARTS = ("pair_of", "times", "of_doc", "pairs", "docs_of")


def align_chunks(docs: DataFrame, a: str, b: str, key: str = "doc_id", text: str = "text",
                 digest: bool = False) -> DataFrame:
    """One row per chunk of documents: per document its counts and its groups (or their SHA-256), and the chunk's pairs.

    pairs: distinct id pairs; docs_of: documents per pair; of_doc: distinct pairs per document; pair_of and times:
    which pairs these are, and how often linked.
    """
    key_type = to_arrow_type(docs.schema[key].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        keys: list = []
        held: list[tuple[np.ndarray, np.ndarray]] = []
        rows: dict[str, list] = {}
        size = number = 0

        def flush() -> pa.RecordBatch:
            nonlocal number
            every = np.concatenate([p for p, _ in held]) if held else np.empty(0, np.int64)
            pairs, pair_of = np.unique(every, return_inverse=True)
            of_doc = np.array([len(p) for p, _ in held], dtype=np.int64)
            times = np.concatenate([t for _, t in held]) if held else every
            parts = (pair_of, times, of_doc, pairs, np.bincount(pair_of, minlength=len(pairs)))
            number += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([task | (number - 1)], pa.int64()), pa.array([keys], pa.list_(key_type)),
                 *(pa.array([rows[c]], pa.list_(pa.int64())) for c in _COUNTS), pa.array([rows["groups"]], pa.list_(pa.string())),
                 *(pa.array([squeezed(x)], pa.binary()) for x in parts)],
                ["chunk", "keys", *_COUNTS, "groups", *_PARTS])

        for batch in batches:
            for one, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                value = value.as_py()
                found = Alignment(value, a, b)
                keys.append(one)
                for c, x in zip(_COUNTS, (len(found.a), len(found.b), found.n_groups, found.n_links), strict=True):
                    rows.setdefault(c, []).append(x)
                shown = hashlib.sha256(found.groups.encode()).hexdigest() if digest and found.a else found.groups
                rows.setdefault("groups", []).append(shown)
                held.append(np.unique(found.pairs, return_counts=True) if found.a else (np.empty(0, np.int64),) * 2)
                size += len(value or "")
                if size >= CHUNK_BYTES:
                    yield flush()
                    keys, held, rows, size = [], [], {}, 0
        if keys:
            yield flush()

    kind = docs.schema[key].dataType.simpleString()
    sizes = ", ".join(f"{c} binary" for c in _PARTS)
    return docs.select(key, text).mapInArrow(run, _CHUNK.format(key=kind, sizes=sizes))


def _bucket(pairs: np.ndarray, buckets: int) -> np.ndarray:
    return ((pairs >> 32) * 2_654_435_761 >> 7) % buckets


_ASKED = "chunk long, bucket int, salt int, pairs binary, docs_of binary"
_KNOWN = "bucket int, salt int, pairs binary, docs_of binary, best binary"


def _asked(chunks: DataFrame, buckets: int, salts: int) -> DataFrame:
    """A chunk's dictionary in parts by first id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, pairs, docs_of in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                pairs, docs_of = unsqueezed(pairs), unsqueezed(docs_of)
                to = _bucket(pairs, buckets)
                rows = [(k, to == k) for k in np.unique(to).tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk] * len(rows), pa.int64()), pa.array([k for k, _ in rows], pa.int32()),
                     pa.array([(chunk ^ chunk >> 32) % salts] * len(rows), pa.int32()),
                     pa.array([squeezed(pairs[m]) for _, m in rows], pa.binary()),
                     pa.array([squeezed(docs_of[m]) for _, m in rows], pa.binary())],
                    ["chunk", "bucket", "salt", "pairs", "docs_of"])

    return chunks.select("chunk", "pairs", "docs_of").mapInArrow(run, _ASKED)


def _add(group: pa.Table) -> pa.Table:
    """Documents per pair over the rows of a group; best: whether a pair's count is the highest of its first id."""
    every = np.concatenate([unsqueezed(x) for x in group["pairs"].to_pylist()])
    pairs, at = np.unique(every, return_inverse=True)
    total = np.zeros(len(pairs), dtype=np.int64)
    np.add.at(total, at, np.concatenate([unsqueezed(x) for x in group["docs_of"].to_pylist()]))
    first = pairs >> 32
    starts = np.flatnonzero(np.diff(first, prepend=-1))
    highest = np.repeat(np.maximum.reduceat(total, starts), np.diff(starts, append=len(first)))
    best = (total == highest).astype(np.int64)
    return pa.table({"bucket": group["bucket"][:1], "salt": group["salt"][:1], "pairs": pa.array([squeezed(pairs)]),
                     "docs_of": pa.array([squeezed(total)]), "best": pa.array([squeezed(best)])})


def _answer(asked: pa.Table, known: pa.Table) -> pa.Table:
    """Per asking chunk the corpus-wide count and mark of its pairs in this bucket."""
    pairs, docs_of, best = (unsqueezed(known[c][0].as_py()) for c in ("pairs", "docs_of", "best"))
    found = [np.searchsorted(pairs, unsqueezed(x)) for x in asked["pairs"].to_pylist()]
    return pa.table({"chunk": asked["chunk"], "bucket": asked["bucket"],
                     "docs_of": pa.array([squeezed(docs_of[at]) for at in found], pa.binary()),
                     "best": pa.array([squeezed(best[at]) for at in found], pa.binary())})


def align(docs: DataFrame, a: str, b: str, key: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """One row per row of docs: key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups.

    groups names the ids of both sides between common ends, as `a1,a2|b1;a3|b2,b3`; with digest=True only its SHA-256 is
    kept. A pair's count is the number of rows whose tokens link it; n_best counts links whose pair has its first id's
    highest count, count_sum adds the counts of all links. Null and empty texts, and texts that a tokenizer doesn't give
    back byte by byte, have no tokens: zeros and an empty string. Repeated rows stay repeated and count each; a null key
    stays null; other columns are ignored; an empty table gives no rows. One text is aligned in memory.
    """
    chunks = stored(align_chunks(docs, a, b, key, text, digest), "aligned")
    salts = max(1, -(-chunks.count() // CHUNKS_MET))
    buckets = max(64, shuffle_width(docs.sparkSession))
    asked = _asked(chunks, buckets, salts)
    part = asked.select("bucket", "salt", "pairs", "docs_of").groupBy("bucket", "salt").applyInArrow(_add, _KNOWN)
    known = part.groupBy("bucket").applyInArrow(_add, _KNOWN) if salts > 1 else part
    known = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    answers = asked.drop("docs_of").groupBy("bucket", "salt").cogroup(known.groupBy("bucket", "salt")).applyInArrow(
        _answer, "chunk long, bucket int, docs_of binary, best binary")

    def finish(chunk: pa.Table, told: pa.Table) -> pa.Table:
        keys, groups = (chunk[c].combine_chunks().flatten() for c in ("keys", "groups"))
        pair_of, times, of_doc, pairs = (unsqueezed(chunk[c][0].as_py()) for c in _PARTS[:-1])
        count, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
        to = _bucket(pairs, buckets)
        for k, x, y in zip(*(told[c].to_pylist() for c in ("bucket", "docs_of", "best")), strict=True):
            count[to == k], best[to == k] = unsqueezed(x), unsqueezed(y)
        doc = np.repeat(np.arange(len(of_doc)), of_doc)
        sums = []
        for each in (best, count):
            total = np.zeros(len(of_doc), dtype=np.int64)
            np.add.at(total, doc, each[pair_of] * times)
            sums.append(pa.array(total))
        return pa.table([keys, *(chunk[c].combine_chunks().flatten() for c in _COUNTS), *sums, groups],
                        [key, *_COUNTS, "n_best", "count_sum", "groups"])

    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
    return chunks.drop("docs_of").groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(finish, schema)
