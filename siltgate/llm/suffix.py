"""Repeated passages by a logarithmic family of sparse suffix arrays.

A text's sampled suffixes are those at the smallest K-gram of some window of LENGTH bytes: equal windows sample the same
place, so every match of LENGTH bytes meets at one. A batch's suffixes are sorted by their K-gram and then by their whole
context (all windows that sample the suffix); neighbours of one context match over all of it. A batch is merge-scanned
against the levels before it, and levels of equal size become one, so n batches keep log n levels. Where one K-gram has
different contexts, a match may end inside; the windows of those suffixes alone are compared one by one.

The order is by hash (K-gram 32 bits and those of the bucket, context 48 bits, windows as many): no text travels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from siltgate.llm.common import discard, squeezed, stored_in, unsqueezed
from siltgate.llm.urls import BITS_PER_KEY, MAX_BITS, Bloom

LENGTH = 50
#: Batches of a whole table; a level of n batches is merged with the next level of n.
BATCHES = 4
#: Suffixes per bucket of the suffix order, about; a sampled suffix stands for about so many bytes.
BUCKET_SUFFIXES, SAMPLED = 120_000, 15
#: Every task and bucket sends a row to every bucket, so beyond FEW buckets they get larger instead of more, up to so many
#: times as large; what lies in one is worked on by parts of about BUCKET_SUFFIXES.
FEW, LARGER = 512, 8
#: Bytes that are sampled in one go, and those whose suffixes a task sorts before it sends them on.
PIECE, SORTED = 1 << 17, 4_000_000
LAST_KEY = 2**63 - 1
#: Stands for a K-gram of several contexts, all of which have been sent to the comparison by windows.
_SEVERAL = 1 << 48

_RANDOM = np.random.default_rng(13).integers(1, 1 << 63, 512, dtype=np.uint64)
_LETTER, _ODD = _RANDOM[:256], _RANDOM[256:] | np.uint64(1)
_S29, _S32 = np.uint64(29), np.uint64(32)


def _mixed(h: np.ndarray, k: int) -> np.ndarray:
    h = (h ^ (h >> _S32)) * _ODD[k]
    return (h ^ (h >> _S29)) * _ODD[k + 1]


class Hashes:
    """Hashes of all substrings of given lengths, by doubling."""

    def __init__(self, data: np.ndarray):
        self.of = {1: _LETTER[data]}

    def __call__(self, length: int) -> np.ndarray:
        """One per start; as many as fit."""
        if length not in self.of:
            half = 1 << (length - 1).bit_length() - 1
            h, shift = self(half), length - half
            self.of[length] = (h[:len(h) - shift] ^ (h[:len(h) - shift] >> _S29)) * _ODD[half.bit_length()] + h[shift:]
        return self.of[length]


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every `width` neighbours."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = np.minimum(values[:-step], values[step:])
        done += step
    return values


def samples(data: np.ndarray, ends: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """data: pieces that end at `ends` -> per sampled suffix: K-gram hash, context hash, first window, windows beyond it."""
    n = len(data) - length + 1
    if n <= 0:
        return (np.empty(0, np.uint64),) * 2 + (np.empty(0, np.int64),) * 2
    k = length * 2 // 5
    whole = np.ones(n, dtype=bool)
    cut = (ends[:, None] - np.arange(1, length)).ravel()
    whole[cut[(cut >= 0) & (cut < n)]] = False
    hashes = Hashes(data)
    grams, windows = _mixed(hashes(k), 40), hashes(length)
    del hashes
    low = np.uint64((1 << 21) - 1)
    least = _least((grams & ~low) | np.arange(len(grams), dtype=np.uint64), length - k + 1)
    window = np.flatnonzero(whole)
    at = (least[window] & low).astype(np.int64)
    new = np.ones(len(at), dtype=bool)
    new[1:] = (at[1:] != at[:-1]) | (window[1:] != window[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at))[:len(first)] - 1
    at, lo, hi = at[first], window[first], window[last]
    where = ((hi - lo) * length + at - lo).astype(np.uint64)
    context = _mixed(_mixed(windows[lo] + where, 44) * _ODD[50] + windows[hi], 46) >> np.uint64(16)
    return grams[at], context, lo, hi - lo


def _buckets(n: int, each: int) -> int:
    """How many buckets (a power of two) n entries get: of `each` about; beyond FEW buckets, of LARGER * BUCKET_SUFFIXES at most."""
    return max(min(1 << (n // each).bit_length(), FEW), 1 << (n // (LARGER * BUCKET_SUFFIXES)).bit_length())


def _order(*keys: np.ndarray) -> np.ndarray:
    """What np.lexsort(keys) gives: sorted by as many bits, from the last key on, as fit one number; then ties alone by the next."""
    n = len(keys[-1])
    todo = []
    for key in (np.arange(n), *keys):
        low = int(key.min(initial=key[0])) if n else 0
        todo.append((key.view(np.uint64) - np.uint64(low & 0xFFFFFFFFFFFFFFFF), (int(key.max(initial=low)) - low).bit_length()))
    order, some = np.arange(n), np.arange(n)
    place = some
    run, bits = np.zeros(n, dtype=np.uint64), 0
    while len(some):
        packed = run
        while todo and bits < 64:
            key, width = todo.pop()
            take = min(width, 64 - bits)
            if take:
                packed = (packed << np.uint64(take) if bits else 0) | (key[some] >> np.uint64(width - take))
                bits += take
            if take < width:
                todo.append((key & np.uint64((1 << width - take) - 1), width - take))
        by = np.argsort(packed)
        some, packed = some[by], packed[by]
        order[place] = some
        new = np.ones(len(some), dtype=bool)
        new[1:] = packed[1:] != packed[:-1]
        tied = ~new
        tied[:-1] |= tied[1:]
        if not todo:
            break
        some, place, run = some[tied], place[tied], np.cumsum(new[tied], dtype=np.uint64)
        bits = int(run[-1]).bit_length() if len(run) else 0
    return order


_ROW = "kind byte, bucket int, k binary, c binary, ord binary, copy binary, lo binary, span binary"
_COLUMNS = ("k", "c", "ord", "copy", "lo", "span")
#: Kinds of rows: suffixes by bucket of their order; by bucket of their document what is removed, what is to compare.
SUFFIX, REMOVED, COMPARE = 0, 1, 2


class Entries:
    """Suffixes or windows as columns: k (bucket and K-gram), c (context), ord, copy, lo, span."""

    def __init__(self, *columns: np.ndarray):
        self.k, self.c, self.ord, self.copy, self.lo, self.span = columns

    def take(self, at: np.ndarray) -> Entries:
        return Entries(*(getattr(self, c)[at] for c in _COLUMNS))

    def __len__(self) -> int:
        return len(self.k)

    def rows(self, kind: int, documents: int) -> pa.RecordBatch:
        """Packed rows, one per bucket: sorted as they are for suffixes, by document in so many buckets for the other kinds."""
        if kind == SUFFIX:
            entries, bucket = self, self.k >> 32
        else:
            bucket = (_mixed(self.ord.view(np.uint64), 60) % np.uint64(documents)).astype(np.int64)
            order = _order(self.lo, self.copy, self.ord, bucket)
            entries, bucket = self.take(order), bucket[order]
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
        bounds = list(zip(cuts.tolist(), np.append(cuts[1:], len(bucket)).tolist(), strict=False))
        columns = []
        for c in _COLUMNS:
            values = getattr(entries, c)
            values = values & 0xFFFFFFFF if c == "k" else values
            blank = kind != SUFFIX and c in ("k", "c")
            columns.append(pa.array([None if blank else squeezed(values[x:y]) for x, y in bounds], pa.binary()))
        return pa.RecordBatch.from_arrays(
            [pa.array([kind] * len(cuts), pa.int8()), pa.array(bucket[cuts].astype(np.int32)), *columns],
            ["kind", "bucket", *_COLUMNS])


def _read(table: pa.Table, k: bool = True) -> tuple[Entries, list[int]]:
    """The entries of packed rows, and how many each row has."""
    columns, sizes = {}, []
    for c in _COLUMNS if k else _COLUMNS[2:]:
        parts = [unsqueezed(x.as_py()) for x in table[c]]
        columns[c], sizes = np.concatenate(parts), [len(x) for x in parts]
    columns = {"k": columns["lo"], "c": columns["lo"]} | columns
    return Entries(*(columns[c] for c in _COLUMNS)), sizes


def _together(parts: list[Entries]) -> Entries:
    return parts[0] if len(parts) == 1 else Entries(*(np.concatenate([getattr(x, c) for x in parts]) for c in _COLUMNS))


def _parts(hashes: np.ndarray, bits: int, size: int) -> Iterator[np.ndarray | slice]:
    """Places of hashes of so many bits, about `size` at a time: equal ones together, parts in rising order."""
    count = (len(hashes) // (2 * size)).bit_length()
    if not count:
        yield slice(None)
        return
    part = (hashes >> hashes.dtype.type(bits - count)) & hashes.dtype.type((1 << count) - 1)
    for i in range(1 << count):
        yield np.flatnonzero(part == i)


def merge_scan(entries: Entries, place: np.ndarray, size: int = BUCKET_SUFFIXES) -> tuple[Entries, Entries, Entries]:
    """Sort a bucket's suffixes, about `size` at a time, and read neighbours -> (those a smaller document has whole, those to compare by windows, the new level).

    place: 0 of the batch, 1 of a level that becomes part of the new one, 2 of a level that stays. Of a K-gram of one
    context a level keeps one suffix of its first document, of several contexts a mark; what has a mark was sent before.
    """
    found = []
    for at in _parts(entries.k, 32, size):
        part, own = entries.take(at), place[at]
        order = _order(part.ord, part.c, part.k)
        found.append(_scanned(part.take(order), own[order]))
    return tuple(map(_together, zip(*found, strict=True)))


def _scanned(entries: Entries, place: np.ndarray) -> tuple[Entries, Entries, Entries]:
    """merge_scan of sorted suffixes."""
    if not len(entries):
        return entries, entries, entries
    gram = np.diff(entries.k, prepend=entries.k[0] - 1) != 0
    context = gram | (np.diff(entries.c, prepend=-1) != 0)
    mark = entries.c == _SEVERAL
    group = np.cumsum(gram) - 1
    first = entries.ord[context][np.cumsum(context) - 1]
    removed = ~mark & (entries.ord > first)
    marked = np.bincount(group, mark) > 0
    several = marked | (np.bincount(group, context & ~mark) > 1)
    sent = np.bincount(group, mark & (place > 0)) > 0
    compare = ~mark & ~removed & several[group] & ~((place > 0) & sent[group])
    stays = np.bincount(group, (place == 2) & (mark | ~several[group])) > 0
    fresh = (np.bincount(group, place < 2) > 0) & ~stays
    level = entries.take(np.flatnonzero(gram & fresh[group]))
    marks = several[fresh]
    level.c = np.where(marks, _SEVERAL, level.c)
    for c in ("ord", "copy", "lo", "span"):
        setattr(level, c, np.where(marks, 0, getattr(level, c)))
    own = removed & (place == 0)
    return entries.take(own), entries.take(compare), level


class SuffixFamily:
    """The levels so far, largest first, each as rows by bucket; batches come in rising order of their documents."""

    def __init__(self, buckets: int, length: int = LENGTH, documents: int | None = None):
        self.buckets, self.length, self.documents = buckets, length, documents or buckets
        self.levels: list[tuple[int, DataFrame, str]] = []
        self.folders: list[str] = []

    def _sampled(self, docs: DataFrame) -> DataFrame:
        """docs: ord, copy, text -> a task's suffixes, each K-gram's contexts merged before they leave it."""
        buckets, length, documents = self.buckets, self.length, self.documents
        shift = np.uint64(64 - (buckets - 1).bit_length()) if buckets > 1 else None

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[tuple] = []
            size = 0

            def flush() -> Iterator[pa.RecordBatch]:
                grams, context, lo, span, ords, copies = (np.concatenate(x) for x in zip(*held, strict=True))
                # What is sampled is what has small hashes, so those don't deal it evenly.
                bucket = (_mixed(grams, 48) >> shift).astype(np.int64) if shift is not None else np.zeros(len(grams), np.int64)
                k = (bucket << 32) | (grams & np.uint64(0xFFFFFFFF)).astype(np.int64)
                every = Entries(k, context.astype(np.int64), ords, copies, lo, span)
                held.clear()
                every = every.take(_order(every.ord, every.c, every.k))
                removed, compare, level = _scanned(every, np.zeros(len(k), dtype=np.int8))
                # What stays of a document that has its own context again must stay as often: another may be smaller.
                rest = _repeated_within(every, level)
                for kind, rows in ((SUFFIX, rest), (REMOVED, removed), (COMPARE, compare)):
                    if len(rows):
                        yield rows.rows(kind, documents)

            for pieces in _pieces(batches, length):
                data = np.frombuffer(b"".join(x for *_, x in pieces), np.uint8)
                ends = np.cumsum([len(x) for *_, x in pieces])
                grams, context, lo, span = samples(data, ends, length)
                at = np.searchsorted(ends, lo, side="right")
                starts = np.array([offset for _, _, offset, _ in pieces]) - np.concatenate([[0], ends[:-1]])
                held.append((grams, context, lo + starts[at], span, np.array([x[0] for x in pieces], np.int64)[at],
                             np.array([x[1] for x in pieces], np.int64)[at]))
                size += len(data)
                if size >= SORTED:
                    yield from flush()
                    held, size = [], 0
            if held:
                yield from flush()

        return docs.select("ord", "copy", "text").mapInArrow(run, _ROW)

    def add(self, docs: DataFrame, last: bool = False) -> DataFrame:
        """Rows REMOVED and COMPARE of a batch. With `last` the levels are not kept up for further batches."""
        merged = 0
        size = 1
        while merged < len(self.levels) and self.levels[-1 - merged][0] == size:
            merged, size = merged + 1, size * 2
        rows = self._sampled(docs).withColumn("place", F.lit(0))
        for i, (_, level, _) in enumerate(reversed(self.levels)):
            rows = rows.unionByName(level.withColumn("place", F.lit(1 if i < merged else 2)))
        documents = self.documents

        def scan(group: pa.Table) -> pa.Table:
            # What a task has settled by itself passes through.
            suffix = np.array(group["kind"].to_numpy() == SUFFIX)
            done = group.filter(pa.array(~suffix)).drop_columns(["place"])
            group = group.filter(pa.array(suffix))
            if not group.num_rows:
                return done
            entries, sizes = _read(group)
            place = np.repeat(group["place"].to_numpy(), sizes)
            entries.k |= int(group["bucket"][0].as_py()) << 32
            removed, compare, level = merge_scan(entries, place, BUCKET_SUFFIXES)
            out = [x.rows(kind, documents) for kind, x in ((SUFFIX, level), (REMOVED, removed), (COMPARE, compare))
                   if len(x) and not (last and kind == SUFFIX)]
            return pa.concat_tables([done, *(pa.Table.from_batches([x]).cast(done.schema) for x in out)])

        found, folder = stored_in(rows.groupBy("bucket").applyInArrow(scan, _ROW), "level", "kind")
        self.folders.append(folder)
        # Levels that are part of the new one, and all of them behind the last batch, are read no more.
        kept = [] if last else self.levels[:len(self.levels) - merged]
        discard(docs.sparkSession, *(f for _, _, f in self.levels[len(kept):]))
        self.levels = kept + [(size, found.where(F.col("kind") == SUFFIX), f"{folder}/kind={SUFFIX}")]
        return found.where(F.col("kind") != SUFFIX)


def _repeated_within(every: Entries, level: Entries) -> Entries:
    """The level of a task with all (sorted) suffixes of the first document of a context instead of one; marks stay as they are."""
    at = np.searchsorted(level.k, every.k)
    own = (level.c[at] == every.c) & (level.ord[at] == every.ord)
    marks = np.flatnonzero(level.c == _SEVERAL)
    both = [np.concatenate([getattr(level, c)[marks], getattr(every, c)[own]]) for c in _COLUMNS]
    return Entries(*(x[np.argsort(both[0], kind="stable")] for x in both))


def _pieces(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[list[tuple[int, int, int, bytes]]]:
    """(ord, copy, offset, bytes): texts whole, or cut so that every window lies in one piece; together two PIECEs at most."""
    held: list[tuple[int, int, int, bytes]] = []
    size = 0
    for batch in batches:
        texts = batch.column(2).cast(pa.binary())
        for one, copy, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts, strict=True):
            text = text.as_py() or b""
            for offset in range(0, len(text) - length + 1, PIECE):
                piece = text[offset:offset + PIECE + length - 1]
                if size + len(piece) > 2 * PIECE and held:
                    yield held
                    held, size = [], 0
                held.append((one, copy, offset, piece))
                size += len(piece)
    if held:
        yield held


def _united(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted intervals without overlaps; those that touch become one."""
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.ones(len(lo), dtype=bool)
    new[1:] = lo[1:] > hi[:-1]
    return lo[new], hi[np.append(np.flatnonzero(new)[1:], len(lo)) - 1] if len(lo) else hi


def _per_document(values: np.ndarray, doc: np.ndarray, count: int) -> pa.Array:
    """Rising documents' values as one binary a document, empty without values."""
    cuts = np.cumsum(np.bincount(doc, minlength=count))[:-1]
    return pa.array([squeezed(x) if len(x) else b"" for x in np.split(values, cuts)], pa.binary())


def _values(data: bytes) -> np.ndarray:
    return unsqueezed(data) if data else np.empty(0, dtype=np.int64)


def by_document(found: DataFrame, length: int = LENGTH) -> DataFrame:
    """Rows REMOVED and COMPARE -> ord, copy, starts, ends (removed), lo, span (to compare and not removed already), windows."""
    def gather(group: pa.Table) -> pa.Table:
        entries, sizes = _read(group, k=False)
        compare = np.repeat(group["kind"].to_numpy() == COMPARE, sizes)
        parts = _parts(_mixed(entries.ord.view(np.uint64), 60), 64, BUCKET_SUFFIXES)
        return pa.concat_tables([some(entries.take(at), compare[at]) for at in parts if isinstance(at, slice) or len(at)])

    def some(entries: Entries, compare: np.ndarray) -> pa.Table:
        order = _order(entries.lo, entries.copy, entries.ord)
        entries = entries.take(order)
        new = np.ones(len(entries), dtype=bool)
        new[1:] = (np.diff(entries.ord) != 0) | (np.diff(entries.copy) != 0)
        doc = np.cumsum(new) - 1
        # All documents at once: each has a stretch of its own.
        lo, left = entries.lo, compare[order]
        hi = lo + entries.span + length
        stretch = int(hi.max()) + 1
        starts, ends = _united((lo + doc * stretch)[~left], (hi + doc * stretch)[~left])
        if len(starts):
            inside = np.searchsorted(starts, lo + doc * stretch, side="right") - 1
            left &= (inside < 0) | (hi + doc * stretch > ends[inside])
        cut, rest, count = starts // stretch, doc[left], int(doc[-1]) + 1
        some = pa.array(np.bincount(rest, minlength=count) > 0)
        return pa.table({
            "ord": entries.ord[new], "copy": entries.copy[new], "starts": _per_document(starts % stretch, cut, count),
            "ends": _per_document(ends - cut * stretch, cut, count),
            "lo": pc.if_else(some, _per_document(lo[left], rest, count), pa.scalar(None, pa.binary())),
            "span": _per_document(entries.span[left], rest, count),
            "windows": np.bincount(rest, entries.span[left] + 1, count).astype(np.int64)})

    return found.groupBy("bucket").applyInArrow(
        gather, "ord long, copy long, starts binary, ends binary, lo binary, span binary, windows long")


def _touched(docs: DataFrame, rows: DataFrame):
    """A condition that holds for every document of `rows` and few others; None where their number is beyond a filter."""
    keys = rows.select(F.col("ord").alias("key")).distinct()
    count = keys.count()
    return Bloom(keys, max(1, count), 0).has(F.col("ord")) if count * BITS_PER_KEY <= MAX_BITS else None


def compare_windows(docs: DataFrame, rows: DataFrame, documents: int, length: int = LENGTH) -> tuple[DataFrame, list[str]]:
    """Rows REMOVED: of the windows in rows' suffixes those that a smaller document has. And the folders they lie in."""
    touched = _touched(docs, rows)
    texts = (docs if touched is None else docs.where(touched)).select("ord", "copy", "text")
    buckets = _buckets(rows.agg(F.coalesce(F.sum("windows"), F.lit(0))).head()[0], 4 * BUCKET_SUFFIXES)
    bits = (buckets - 1).bit_length()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Entries] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            removed, rest = _smaller_elsewhere(_together(held))
            for kind, part in ((SUFFIX, rest), (REMOVED, removed)):
                if len(part):
                    yield part.rows(kind, documents)

        for pieces in _windowed(batches, length):
            held.append(_windows(pieces, bits, length))
            size += len(held[-1])
            if size >= SORTED // 8:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    def scan(group: pa.Table) -> pa.Table:
        # What a task has settled by itself passes through.
        suffix = np.array(group["kind"].to_numpy() == SUFFIX)
        done = group.filter(pa.array(~suffix))
        group = group.filter(pa.array(suffix))
        if not group.num_rows:
            return done
        entries = _read(group)[0]
        removed = _together([_smaller_elsewhere(entries.take(at))[0] for at in _parts(entries.k, 32, BUCKET_SUFFIXES)])
        return pa.concat_tables([done, pa.Table.from_batches([removed.rows(REMOVED, documents)]).cast(done.schema)]) if len(
            removed) else done

    sent = texts.join(rows.select("ord", "copy", "lo", "span"), ["ord", "copy"]).mapInArrow(run, _ROW)
    met, folder = stored_in(sent.groupBy("bucket").applyInArrow(scan, _ROW), "met")
    return met, [folder]


def _spread(lo: np.ndarray, size: np.ndarray) -> np.ndarray:
    """lo, lo + 1, ... for each of the places, `size` numbers of it."""
    return np.repeat(lo - np.cumsum(size) + size, size) + np.arange(size.sum())


def _windowed(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[list[tuple]]:
    """(ord, copy, offset, bytes, lo in the piece, span): texts whole, or cut as by _pieces; together two PIECEs at most."""
    held: list[tuple] = []
    size = 0
    for batch in batches:
        columns = (batch.column(c) for c in ("ord", "copy", "text", "lo", "span"))
        for one, copy, text, lo, span in zip(*(c.cast(pa.binary()) if c.type == pa.string() else c for c in columns),
                                             strict=True):
            one, copy, text, lo, span = one.as_py(), copy.as_py(), text.as_py(), _values(lo.as_py()), _values(span.as_py())
            if len(text) < PIECE + length:
                parts = [(one, copy, 0, text, lo, span)]
            else:
                at, parts = _spread(lo, span + 1), []
                for offset in range(0, len(text) - length + 1, PIECE):
                    own = at[(at >= offset) & (at < offset + PIECE)] - offset
                    if len(own):
                        parts.append((one, copy, offset, text[offset:offset + PIECE + length - 1], own, np.zeros_like(own)))
            for part in parts:
                if size + len(part[3]) > 2 * PIECE and held:
                    yield held
                    held, size = [], 0
                held.append(part)
                size += len(part[3])
    if held:
        yield held


def _windows(pieces: list[tuple], bits: int, length: int) -> Entries:
    """The windows of places in pieces, one by one."""
    ords, copies, offsets = (np.array([p[i] for p in pieces], np.int64) for i in range(3))
    sizes = np.array([len(p[3]) for p in pieces])
    starts, span = np.cumsum(sizes) - sizes, np.concatenate([p[5] for p in pieces])
    piece = np.repeat(np.arange(len(pieces)), [len(p[4]) for p in pieces])
    at, piece = _spread(np.concatenate([p[4] for p in pieces]) + starts[piece], span + 1), np.repeat(piece, span + 1)
    hashes = Hashes(np.frombuffer(b"".join(p[3] for p in pieces), np.uint8))(length)[at]
    one, two = _mixed(hashes, 70), _mixed(hashes, 80)
    bucket = (one >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(at), np.int64)
    k = (bucket << 32) | (one & np.uint64(0xFFFFFFFF)).astype(np.int64)
    return Entries(k, (two >> np.uint64(16)).astype(np.int64), ords[piece], copies[piece],
                   at + (offsets - starts)[piece], np.zeros_like(at))


def _smaller_elsewhere(entries: Entries) -> tuple[Entries, Entries]:
    """(entries that a smaller document has too, the others), equal ones side by side."""
    if not len(entries):
        return entries, entries
    order = np.argsort(entries.k)
    k, c = entries.k[order], entries.c[order]
    new = np.ones(len(k), dtype=bool)
    new[1:] = k[1:] != k[:-1]
    other = ~new
    other[1:] &= c[1:] != c[:-1]
    if other.any():
        # Few have another window's k, and only those are sorted by c.
        run = np.cumsum(new) - 1
        at = np.flatnonzero((np.bincount(run, other) > 0)[run])
        order[at] = order[at][np.lexsort((c[at], k[at]))]
        c = entries.c[order]
        new[1:] |= c[1:] != c[:-1]
    ords = entries.ord[order]
    later = ords > np.minimum.reduceat(ords, np.flatnonzero(new))[np.cumsum(new) - 1]
    return entries.take(order[later]), entries.take(order[~later])


def _identified(docs: DataFrame, key: str, text: str) -> DataFrame:
    """docs with ord (a null key is the largest) and copy: 0, or a hash of the text where rows share a key."""
    docs = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    twice = docs.where("key is not null").groupBy("key").count().where("count > 1").select("key", F.lit(True).alias("twice"))
    mixed = F.col("key").isNull()
    if not twice.isEmpty():
        docs = docs.join(twice, "key", "left")
        mixed = mixed | F.col("twice").isNotNull()
    return docs.select("key", "text", F.coalesce("key", F.lit(LAST_KEY)).alias("ord"),
                       F.when(mixed, F.xxhash64("text")).otherwise(F.lit(0).cast("long")).alias("copy"))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH,
                   batches: int = BATCHES) -> DataFrame:
    """One row per row of docs: key, n_bytes, removed (array of start, end in UTF-8 bytes), kept (binary, what is left).

    A byte is removed if some `length` bytes that cover it also start in a document of a smaller key; all is judged on
    the input. Null and empty texts have 0 bytes; texts shorter than `length` keep all. Keys are long; a null key is
    larger than all others, and rows of one key, or of none, take nothing from each other. Repeated rows stay repeated.
    Other columns are ignored; an empty table gives no rows.
    """
    rows = _identified(docs, key, text)
    shares = [i / batches for i in range(1, batches)]
    size, cuts = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)),
                          F.percentile_approx(key, shares, 1000) if shares else F.array()).head()
    suffixes = int(size) // SAMPLED
    buckets = _buckets(suffixes, 2 * BUCKET_SUFFIXES)
    # Few suffixes are removed or compared, and what is known of them by document takes less memory.
    documents = max(_buckets(suffixes // 4, 2 * BUCKET_SUFFIXES), min(buckets, 16))
    family = SuffixFamily(buckets, length, documents)
    edges = [None, *sorted(set(cuts or ())), None]
    found: list[DataFrame] = []
    for low, high in zip(edges, edges[1:], strict=False):
        part = rows.where(F.lit(True) if low is None else (F.col("key") > low) | F.col("key").isNull())
        part = part.where(F.lit(True) if high is None else F.col("key") <= high)
        found.append(family.add(part, last=high is None))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    per, folder = stored_in(by_document(every, length), "repeats")
    discard(docs.sparkSession, *(f"{f}/kind={COMPARE}" for f in family.folders))
    windows, folders = compare_windows(rows, per.where(F.col("lo").isNotNull()), documents, length)
    discard(docs.sparkSession, folder)
    every = every.where(F.col("kind") == REMOVED).unionByName(windows)
    cuts, _ = stored_in(by_document(every, length).select("ord", "copy", "starts", "ends"), "cuts")
    discard(docs.sparkSession, *family.folders, *folders)
    key_type = to_arrow_type(docs.schema[key].dataType)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, kept, n_bytes = [], [], []
            for text, starts, ends in zip(batch.column("text").cast(pa.binary()), *(
                    batch.column(c) for c in ("starts", "ends")), strict=True):
                text, starts, ends = text.as_py(), starts.as_py(), ends.as_py()
                spans = [] if starts is None else list(zip(_values(starts).tolist(), _values(ends).tolist(), strict=True))
                removed.append([{"start": x, "end": y} for x, y in spans])
                edges = [0, *(e for span in spans for e in span), len(text)]
                kept.append(b"".join(text[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True)))
                n_bytes.append(len(text))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").cast(key_type), pa.array(n_bytes, pa.int64()), pa.array(removed, span),
                 pa.array(kept, pa.binary())], [key, "n_bytes", "removed", "kept"])

    kind = docs.schema[key].dataType.simpleString()
    spans = "array<struct<start:bigint,end:bigint>>"
    touched = _touched(rows, cuts)
    joined = (rows if touched is None else rows.where(touched)).join(cuts, ["ord", "copy"], "left")
    out = joined.select("key", "text", "starts", "ends").mapInArrow(
        cut, f"`{key}` {kind}, n_bytes long, removed {spans}, kept binary")
    if touched is None:
        return out
    whole = rows.where(~touched).select(
        F.col("key").alias(key), F.octet_length("text").cast("long").alias("n_bytes"), F.array().cast(spans).alias("removed"),
        F.encode("text", "UTF-8").alias("kept"))
    return out.unionByName(whole)
