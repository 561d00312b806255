"""Byte-level BPE ids and counts by pre-token, exactly as the library gives them.

The library cuts a text into pre-tokens and encodes each by itself, so ids of a
text are the ids of its pre-tokens in order. Pre-tokens repeat, so a worker
keeps those it has met. Texts are cut here by the public split pattern with
explicit character classes; they are exact for the characters in ``_SAFE``.
A text with any other character goes to the library whole.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache

from tokenizers import Tokenizer
from tokenizers.models import BPE

from .common import release_memory

# Letters and numbers among the safe characters: ASCII, Latin-1 and the Latin,
# Greek and Cyrillic letters on which all Unicode versions since 5.0 agree.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ȳΈ-ΊΎ-ΡΣ-ώЀ-ҁҊ-ԓ"
_NUMBERS = "0-9²³¹¼-¾"
_SPACES = r"\t\n\x0b\x0c\r\x20"
_OTHERS = r"!-/:-@\[-`{-~¡-©«¬®-±´¶-¸»¿×÷‐-‧€"
_UNSAFE = re.compile(f"[^{_LETTERS}{_NUMBERS}{_SPACES}{_OTHERS}]")
_SPLIT = re.compile(
    f"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^{_SPACES}{_LETTERS}{_NUMBERS}]+"
    f"|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+"
)
# entries in a generation of a worker's cache
CACHE_ENTRIES = 150_000


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level BPE uses for each byte: itself
    where printable, else the next free letter from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


_LETTER_OF = _byte_letters()


def split_safe(text: str) -> list[str] | None:
    """Pre-tokens of a text, or None where the library has to cut it."""
    return None if _UNSAFE.search(text) else _SPLIT.findall(text)


class _Cache(dict):
    """pre-token -> value, made at the first lookup. Two generations: when the
    young one is full it becomes the old one, whose entries move back at their
    next use, so frequent ones stay and at most twice ``limit`` are held."""

    def __init__(self, make, limit: int = CACHE_ENTRIES):
        super().__init__()
        self._make, self._limit, self._old = make, limit, {}

    def __missing__(self, key: str):
        value = self._old.get(key)
        if value is None:
            value = self._make(key)
        if len(key) <= 256:
            if len(self) >= self._limit:
                self._old = dict(self)
                self.clear()
            self[key] = value
        return value


    def forget(self) -> None:
        self._old = {}
        self.clear()


class _Tiered(dict):
    """A fixed table in front of a cache."""

    def __init__(self, table: dict, cache: _Cache):
        super().__init__(table)
        self._cache = cache

    def __missing__(self, key: str):
        return self._cache[key]


class BpeEncoder:
    """Encoder of one worker, with caches of ids and of counts."""

    def __init__(self, path: str):
        self._tok = Tokenizer.from_file(path)
        self._tok.no_truncation()
        self._tok.no_padding()
        self._model = self._tok.model
        self._specials = [t.content for t in self._tok.get_added_tokens_decoder().values()]
        # only the small part is read as JSON: the whole one holds the vocabulary
        pre = json.loads(self._tok.pre_tokenizer.__getstate__()) if self._tok.pre_tokenizer else {}
        # other tokenizers cut texts otherwise: their texts go to the library whole
        self._by_pieces = (
            isinstance(self._model, BPE)
            and (pre.get("type"), pre.get("add_prefix_space"), pre.get("use_regex")) == ("ByteLevel", False, True)
            and self._tok.normalizer is None
        )
        self._ids = _Cache(self._ids_of)
        self._cached_counts = _Cache(self._count_of)

    def _library(self, text: str) -> list[int]:
        return self._tok.encode(text, add_special_tokens=False).ids

    def _piece(self, piece: str) -> list:
        return self._model.tokenize(piece.encode("utf-8").decode("latin-1").translate(_LETTER_OF))

    def _ids_of(self, piece: str) -> bytes:
        return array("I", [t.id for t in self._piece(piece)]).tobytes()

    def _count_of(self, piece: str) -> int:
        return len(self._piece(piece))

    def _split(self, text: str) -> list[str] | None:
        if not self._by_pieces or any(s in text for s in self._specials):
            return None
        return split_safe(text)

    def ids(self, text: str) -> bytes:
        """The text's ids as little-endian unsigned 32-bit integers."""
        pre = self._split(text)
        if pre is None:
            return array("I", self._library(text)).tobytes()
        return b"".join(map(self._ids.__getitem__, pre))

    def forget(self) -> None:
        """Empty the caches: a worker waits for its next task without them."""
        self._ids.forget()
        self._cached_counts.forget()
        release_memory()

    def tiers(self, frequent: dict[str, int]) -> dict[str, int]:
        """Lookup of counts: the given table first, then the worker's cache."""
        return _Tiered(frequent, self._cached_counts)

    def count(self, text: str, lookup: dict[str, int] | None = None) -> int:
        """The number of the text's ids; ``lookup``: from ``tiers``."""
        pre = self._split(text)
        if pre is None:
            return len(self._library(text))
        return sum(map((self._cached_counts if lookup is None else lookup).__getitem__, pre))


@lru_cache(maxsize=2)
def worker_encoder(path: str) -> BpeEncoder:
    """The worker's encoder of one file (reading it takes longer than a task's
    start); tasks empty its caches when they end."""
    return BpeEncoder(path)
