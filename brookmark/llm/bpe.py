"""Byte-level BPE encoding and decoding by two tiers of lookup.

Tier one is a minimal perfect hash over the vocabulary: a pre-token that is a token as a whole is
resolved by two hashes and one comparison. Tier two merges the rest: the bytes of the pre-token form
a linked list, a heap holds the ranks of the adjacent pairs, and the lowest rank is merged first
(the leftmost among equals), which takes n log n steps however long the pre-token is.

Documents are mapped where they lie, without a shuffle. Vocabulary tables are a few MB, whatever the
input, and are loaded once per Python worker. Null texts are empty; empty texts have no tokens and
decode to nothing. Repeated rows are encoded each.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain
from sys import getsizeof

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from brookmark.llm.text import raw, sliced

_hash = xxhash.xxh3_64_intdigest


class PerfectHash:
    """Minimal perfect hash by hash and displace: n keys on n slots, one seed per bucket."""

    def __init__(self, keys: list[bytes], per_bucket: int = 4):
        n = len(keys)
        self.size, self.width = n, max(1, -(-n // per_bucket))
        self.seeds = np.zeros(self.width, np.int32)
        self.slots: list[int] = [-1] * n  # index of the key in each slot
        buckets: list[list[int]] = [[] for _ in range(self.width)]
        for i, key in enumerate(keys):
            buckets[_hash(key) % self.width].append(i)
        free = [True] * n
        for b in sorted(range(self.width), key=lambda b: -len(buckets[b])):
            seed = 1
            while buckets[b]:
                places = [_hash(keys[i], seed) % n for i in buckets[b]]
                if len(set(places)) == len(places) and all(free[p] for p in places):
                    break
                seed += 1
            self.seeds[b] = seed
            for i, p in zip(buckets[b], places if buckets[b] else ()):
                free[p], self.slots[p] = False, i

    def slot(self, key: bytes) -> int:
        return _hash(key, int(self.seeds[_hash(key) % self.width])) % self.size


class Vocabulary:
    """Ranks of byte strings, looked up through a perfect hash."""

    def __init__(self, ranks: dict[bytes, int]):
        keys = list(ranks)
        self.hash = PerfectHash(keys) if keys else None
        order = self.hash.slots if keys else []
        self.keys = [keys[i] for i in order]
        self.ids = [ranks[k] for k in self.keys]
        self.ranks = ranks
        self.two = [ranks.get(bytes((a, b)), -1) for a in range(256) for b in range(256)]
        self.pieces = {rank: key for key, rank in ranks.items()}
        self.longest = max(map(len, keys), default=0)

    @classmethod
    def parse(cls, data: bytes) -> Vocabulary:
        """From lines of a base64 token and its rank."""
        pairs = (line.split() for line in data.splitlines() if line.strip())
        return cls({base64.b64decode(token): int(rank) for token, rank in pairs})

    def rank(self, token: bytes) -> int | None:
        if self.hash is None or len(token) > self.longest:
            return None
        slot = self.hash.slot(token)
        return self.ids[slot] if self.keys[slot] == token else None

    def merge(self, token: bytes) -> list[int]:
        """Tier two: merge adjacent parts by the lowest rank until none is left.

        Parts are linked by where they end: the part after the one at i begins at ``ends[i]``. A heap
        entry is rank * n + position; it is stale once the pair at that position has another rank.
        """
        n, rank_of = len(token), self.ranks.get
        ends, before = list(range(1, n + 1)), list(range(-1, n))
        pair = [self.two[a << 8 | b] for a, b in zip(token, token[1:])]
        pair.append(-1)
        heap = [rank * n + i for i, rank in enumerate(pair) if rank >= 0]
        heapify(heap)
        while heap:
            rank, i = divmod(heappop(heap), n)
            if pair[i] != rank:
                continue
            j = ends[i]
            ends[i] = end = ends[j]
            pair[j] = pair[i] = -1
            before[end] = i
            if end < n and (rank := rank_of(token[i : ends[end]])) is not None:
                pair[i] = rank
                heappush(heap, rank * n + i)
            left = before[i]
            if left >= 0:
                rank = rank_of(token[left:end])
                pair[left] = -1 if rank is None else rank
                if rank is not None:
                    heappush(heap, rank * n + left)
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[token[i : ends[i]]])
            i = ends[i]
        return ids

    def encode_token(self, token: bytes) -> tuple[int, ...]:
        whole = self.rank(token)
        return (whole,) if whole is not None else tuple(self.merge(token))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))


class Encoder:
    """Splits texts into pre-tokens and encodes them.

    Pre-tokens that are met again are remembered, in two generations of at most ``remember`` bytes each, whatever
    the input: when the young one is nearly full it becomes the old one, and what is met again moves back to the
    young one. What is met for the first time leaves only a mark, since most pre-tokens are never met again.
    """

    MARKS = 1 << 22  # bytes; one that two pre-tokens share lets the second in early, which costs room only
    SLOT = 60  # bytes of a dict's entry

    def __init__(self, vocabulary: Vocabulary, pattern: str, remember: int = 24_000_000):
        # \s is spelt out: this library would also take the four ASCII separators as white space
        spaces = pattern.replace(r"[^\s\p{L}\p{N}]", r"[^\p{White_Space}\p{L}\p{N}]")
        spaces = spaces.replace(r"\s", r"\p{White_Space}").replace(r"(?!\S)", r"(?!\P{White_Space})")
        self.vocabulary, self.split = vocabulary, regex.compile(spaces).findall
        self.remember, self.young, self.old = remember, {}, {}
        self.size, self.marks = 0, bytearray(self.MARKS)

    def encode(self, text: str) -> list[int]:
        if self.size > self.remember * 15 // 16:
            self.old, self.young, self.size, self.marks = self.young, {}, 0, bytearray(self.MARKS)
        young, old, marks = self.young, self.old, self.marks
        tokens, passing = self.split(text), []
        for token in set(tokens).difference(young):
            ids, mark = old.get(token), hash(token) % self.MARKS
            known = ids is not None or marks[mark]
            marks[mark] = 1
            young[token] = ids = self.vocabulary.encode_token(token.encode("utf-8")) if ids is None else ids
            size = getsizeof(token) + getsizeof(ids) + self.SLOT if known else 0
            if known and self.size + size <= self.remember:
                self.size += size
            else:
                passing.append(token)
        found = list(chain.from_iterable(map(young.__getitem__, tokens)))
        for token in passing:
            del young[token]
        if len(passing) > len(young):  # a dict keeps the room of what left it
            self.young = dict(young)
        return found


@lru_cache(maxsize=2)
def encoder_for(data: bytes, pattern: str) -> Encoder:
    return Encoder(Vocabulary.parse(data), pattern)


#: What `encode` can add to a row, with its type.
OUTPUTS = {
    "ids": "array<int>", "decoded": "binary", "n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string",
}


def encode(
    docs: DataFrame, vocabulary: bytes, pattern: str, add: tuple[str, ...] = ("ids", "decoded"), rows: int = 500
) -> DataFrame:
    """All rows and columns with the outputs named in ``add``, which replace columns of those names.

    Texts are always encoded and decoded again; digests are of the ids in decimal, joined by commas, and
    of the decoded bytes. ``vocabulary`` is the content of a rank file, read on the driver (under 1 MB
    for 50,000 tokens) and sent with the tasks.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    plain = docs.drop(*add)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(shared.value, pattern)
        for batch in sliced(batches, rows):
            made: dict[str, list] = {name: [] for name in add}
            for text in raw(batch.column("text")):
                ids = encoder.encode((text or b"").decode("utf-8"))
                back = encoder.vocabulary.decode(ids)
                for name, column in made.items():
                    column.append(_output(name, ids, back))
            columns = [_ids_column(c) if n == "ids" else pa.array(c, _ARROW[n]) for n, c in made.items()]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *add])

    schema = ", ".join([*(f"`{n}` {t}" for n, t in plain.dtypes), *(f"{n} {OUTPUTS[n]}" for n in add)])
    return plain.mapInArrow(run, schema)


_ARROW = {"decoded": pa.binary(), "n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}


def _output(name: str, ids: list[int], back: bytes):
    if name == "n_tokens":
        return len(ids)
    if name == "ids_sha256":
        return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    if name == "decoded_sha256":
        return hashlib.sha256(back).hexdigest()
    return ids if name == "ids" else back


def _ids_column(ids: list[list[int]]) -> pa.Array:
    ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
    flat = np.fromiter(chain.from_iterable(ids), np.int32, int(ends[-1]))
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
