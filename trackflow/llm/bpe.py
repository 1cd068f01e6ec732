"""Byte-level BPE, encoding and decoding.

A word's symbols form a doubly linked list; a heap holds the merges that its neighbours allow, ordered by rank and then
by place. An entry whose symbols have changed since is stale and skipped. Decoding concatenates vocabulary strings.
"""

from __future__ import annotations

import heapq
import json
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackflow.llm.work import map_rows

# The public pattern of byte-level BPE.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHED = 200_000
CACHED_CHARS = 32
LIBRARY_CHARS = 400
#: White space other than single spaces and newlines between words; a text with any of these is split by the pattern.
UNEVEN = ("  ", "\n\n", " \n", "\n ", "\0", *map(chr, [*range(9, 10), *range(11, 14), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def merged(ids: list[int], ranks: dict[int, int], made: list[int]) -> list[int]:
    """Apply the merges to a word's symbols, lowest rank first, leftmost first among equals."""
    n = len(ids)
    rank_at = [ranks.get(a << 32 | b, -1) for a, b in zip(ids, ids[1:])]  # of the pair that begins here; -1: none
    rank_at.append(-1)
    heap = [r << 32 | i for i, r in enumerate(rank_at) if r >= 0]
    heapq.heapify(heap)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    pop, push, rank = heapq.heappop, heapq.heappush, ranks.get
    while heap:
        entry = pop(heap)
        i, r = entry & 0xFFFFFFFF, entry >> 32
        if rank_at[i] != r:
            continue  # stale: this pair has changed
        j = after[i]
        new = ids[i] = made[r]
        ids[j] = rank_at[j] = -1
        k = after[i] = after[j]
        r = -1
        if k < n:
            before[k] = i
            r = rank(new << 32 | ids[k], -1)
            if r >= 0:
                push(heap, r << 32 | i)
        rank_at[i] = r
        h = before[i]
        if h >= 0:
            r = rank_at[h] = rank(ids[h] << 32 | new, -1)
            if r >= 0:
                push(heap, r << 32 | h)
    return [x for x in ids if x >= 0]


class Cache(dict):
    """Results of a function; the older half goes when it is full, which changes no result."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, key: str) -> bytes:
        found = self.older.get(key)
        if found is None:
            found = self.make(key)
        if len(key) <= CACHED_CHARS:
            if len(self) >= CACHED:
                self.older = dict(self)
                self.clear()
            self[key] = found
        return found


class ByteBpe:
    """A vocabulary file in the JSON form of public tokenizers; special strings in a text become their own id.

    With ``library``, words that the cache lacks are merged by the tiktoken library, where ids are in the order of the ranks.
    """

    def __init__(self, path: str, library: bool = False):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        symbols = byte_symbols()
        ranks: dict[int, int] = {}
        made: list[int] = []
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            ranks[vocab[a] << 32 | vocab[b]] = rank
            made.append(vocab[a + b])
        first = [vocab[s] for s in symbols]
        self.words = Cache(lambda word: array("I", merged([first[b] for b in word.encode()], ranks, made)).tobytes())
        value = {s: b for b, s in enumerate(symbols)}
        self.strings = [b""] * (1 + max(*vocab.values(), *self.special.values()))
        for s, i in vocab.items():
            self.strings[i] = bytes(value[c] for c in s) if all(c in value for c in s) else s.encode()
        for s, i in self.special.items():
            self.strings[i] = s.encode()
        self.widths = np.array([len(s) for s in self.strings], dtype=np.int64)
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.find = regex.compile(WORDS).findall
        self.chunks = Cache(self.by_pattern)
        if library and all(a < b for a, b in zip(made, made[1:])) and max(first) < made[0]:
            plain = {b: i for i, b in enumerate(self.strings) if b and i not in self.special.values()}
            self.merges = tiktoken.Encoding("words", pat_str=WORDS, mergeable_ranks=plain, special_tokens={})
            self.chunks = Cache(self.by_library)

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.split is None or not any(s in text for s in self.special):
            return self.plain(text)
        parts = self.split.split(text)
        return b"".join(array("I", [self.special[p]]).tobytes() if p in self.special else self.plain(p) for p in parts if p)

    def by_pattern(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, self.find(text)))

    def by_library(self, text: str) -> bytes:
        if len(text) > LIBRARY_CHARS:  # a word may be very long: the heap takes it in good time
            return self.by_pattern(text)
        return array("I", self.merges.encode_ordinary(text)).tobytes()

    def plain(self, text: str) -> bytes:
        """Ids of a text without special strings. Between single spaces and newlines, no word of the pattern crosses a space."""
        if text[0] in " \n" or text[-1] in " \n" or any(x in text for x in UNEVEN):
            return self.by_pattern(text)
        chunks = text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")
        return b"".join(map(self.chunks.__getitem__, chunks))

    def decode_bytes(self, ids: bytes) -> bytes:
        return b"".join(map(self.strings.__getitem__, memoryview(ids).cast("I")))

    def decode(self, ids: bytes) -> str:
        return self.decode_bytes(ids).decode("utf-8", errors="replace")


@lru_cache(maxsize=4)
def tokenizer(path: str, library: bool = False) -> ByteBpe:
    """One per worker process."""
    return ByteBpe(path, library)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False, library: bool = False) -> DataFrame:
    """Encode every whole text; returns the id, ``ids`` (binary, little-endian unsigned 32-bit) and, on request, ``decoded``.

    ``library`` leaves the merges to a library, for callers that only need the ids; they are the same. Null and empty texts give empty ids. Every input row gives one output row, repeated ids and rows included; other
    columns are not read, whatever their names. An empty table gives an empty table of the same columns.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def fn(keys: list, texts: list) -> list:
        bpe = tokenizer(path, library)
        ids = [bpe.encode(t) for t in texts]
        return [keys, ids, *([[bpe.decode(x) for x in ids]] if decoded else [])]

    schema = f"`{id_col}` {id_type}, ids binary" + (", decoded string" if decoded else "")
    return map_rows(docs.select(F.col(id_col), F.col(text_col)), fn, schema)


def n_tokens(ids: str = "ids"):
    """Number of tokens in a binary column of ids."""
    return (F.octet_length(ids) / 4).cast("long")
