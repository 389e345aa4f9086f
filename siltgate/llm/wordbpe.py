"""Encode texts with a word-level BPE tokenizer file through a cache of pre-tokens.

The tokenizer lower-cases, composes characters (NFC) and splits into pre-tokens, each encoded alone. For texts of the
characters below, all of which have one form and one class, the same split is one pattern; other texts, and those with
special strings, go to the library whole. The ids always come from the library; only its answers are kept.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import numpy as np

from siltgate.llm.common import worker_cache

#: ASCII without control characters other than white space, and the letters of Latin-1.
_OTHER = re.compile("[^\\t\\n\\r -~À-ÖØ-öø-ÿ]")
_PRE_TOKEN = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-z0-9ß-öø-ÿ]+")
_SPECIAL = "<|"
#: Pre-tokens kept per worker; a full cache starts anew. Longer ones than CACHED_CHARS are never kept.
CACHE_ENTRIES = 400_000
CACHED_CHARS = 64
#: Texts are taken together up to this many characters, so that their unseen pre-tokens are encoded in one call.
GROUP_CHARS = 4_000_000
#: Pre-tokens of one call.
CALL = 16_384


def pieces(text: str) -> list[str] | None:
    """The pre-tokens of a text; None where only the library may split it."""
    if _SPECIAL in text or _OTHER.search(text):
        return None
    return _PRE_TOKEN.findall(text.lower())


@cache
def tokenizer(path: str):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


class PreTokens(dict):
    """pre-token -> what `keep` makes of its ids. `known` answers first and is never dropped."""

    def __init__(self, path: str, keep: Callable[[np.ndarray], object], known: dict[str, object] | None = None):
        super().__init__()
        self.path, self.keep, self.known = path, keep, known or {}

    def add(self, wanted: Iterable[str]) -> None:
        """Encode what is missing, many pre-tokens a call."""
        wanted = set(wanted)
        missing = list(wanted - self.keys())
        if len(self) + len(missing) > CACHE_ENTRIES:
            self.clear()
            missing = list(wanted)
        for piece in missing:
            if piece in self.known:
                self[piece] = self.known[piece]
        missing = [p for p in missing if p not in self]
        for at in range(0, len(missing), CALL):
            part = missing[at:at + CALL]
            found = tokenizer(self.path).encode(" ".join(part), add_special_tokens=False)
            ids, word = np.array(found.ids, dtype="<u4"), np.array(found.word_ids)
            cuts = np.searchsorted(word, np.arange(len(part) + 1))
            for i, piece in enumerate(part):
                self[piece] = self.keep(ids[cuts[i]:cuts[i + 1]])

    def trim(self) -> None:
        for piece in [p for p in self if len(p) > CACHED_CHARS]:
            del self[piece]


def encoded(texts: Iterable[str | None], cached: PreTokens, join: Callable) -> Iterator:
    """For each text `join` of its pre-tokens' values, in order; null counts as empty."""
    group: list[list[str] | str] = []
    size = 0

    def flush() -> Iterator:
        cached.add(p for x in group if isinstance(x, list) for p in x)
        for x in group:
            if isinstance(x, list):
                yield join(map(cached.__getitem__, x))
            else:
                ids = tokenizer(cached.path).encode(x, add_special_tokens=False).ids
                yield join([cached.keep(np.array(ids, dtype="<u4"))])
        cached.trim()

    for text in texts:
        split = pieces(text) if text else []
        group.append(text if split is None else split)
        size += len(text or "")
        if size > GROUP_CHARS:
            yield from flush()
            group, size = [], 0
    yield from flush()


def ids_cache(path: str) -> PreTokens:
    """This worker's cache of ids, as little-endian unsigned 32-bit bytes."""
    return worker_cache(f"ids {path}", lambda: PreTokens(path, lambda ids: ids.tobytes()))


def id_bytes(path: str, texts: Iterable[str | None]) -> Iterator[bytes]:
    """The ids of each whole text, four bytes each."""
    return encoded(texts, ids_cache(path), b"".join)
