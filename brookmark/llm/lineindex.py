"""Line dedup that can be undone: exact reference counts, fronted by sharded cuckoo filters.

``postings`` is the exact table: one row per document and line key. Counts per key come from it,
so inserting documents appends rows and deleting documents takes theirs away again, and every
decision can be recomputed as if a deleted document had never been there. Keys held by enough
documents are *heavy*. One cuckoo filter per shard of heavy keys stands before the exact table: a
line is looked up there only if its shard's filter knows it, which spares the join for nearly all
lines. An insertion or a deletion counts only the keys of its documents again: the entries are scanned for
them, neither sorted nor rewritten, and keys that cross the threshold go into or out of the filters of
their shards. The number of shards stays that of the first build, so after a corpus has grown many times over it should
be built again; until then its filters grow.

A key is named by a 128-bit hash of the stripped, lower-cased line. Null and empty texts are one
empty line. Repeated rows of one ``doc_id`` count once per key and lose the same lines. Rows without
a ``doc_id`` neither count nor lose lines.
"""

from __future__ import annotations

from collections.abc import Iterator
from copy import copy

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brookmark.llm.text import batch_of, map_batches, packed, partitions_of, raw, staged, unpack

_wide = xxhash.xxh3_128_digest


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """128-bit key of a line, or None where it is too short to count."""
    held = line.strip()
    if len(held) < min_chars:
        return None
    held = held.lower()
    if len(held) < 4 * min_chars and len(held.decode("utf-8", "replace")) < min_chars:
        return None
    return _wide(held)


class CuckooFilter:
    """Cuckoo filter over 64-bit keys: buckets of four 16-bit fingerprints, two buckets a key."""

    SLOTS = 4

    def __init__(self, buckets: int, table: np.ndarray | None = None):
        assert buckets and buckets & (buckets - 1) == 0, "a power of two"
        self.buckets = buckets
        self.table = np.zeros((buckets, self.SLOTS), np.uint16) if table is None else table

    @classmethod
    def of(cls, keys: np.ndarray) -> CuckooFilter:
        """Filter that holds all keys; it grows until they fit."""
        buckets = 1 << max(2, int(np.ceil(np.log2(max(1, len(keys)) / (0.8 * cls.SLOTS)))))
        while True:
            made = cls(buckets)
            if all(made.insert(k) for k in keys):
                return made
            buckets *= 2

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys = keys.astype(np.uint64)
        mark = ((keys >> np.uint64(48)) & np.uint64(0xFFFF)).astype(np.uint16)
        mark = np.where(mark == 0, np.uint16(1), mark)
        first = (keys & np.uint64(self.buckets - 1)).astype(np.int64)
        return mark, first, self._other(first, mark)

    def _other(self, place, mark):
        """The second bucket follows from the first and the fingerprint alone, both ways round."""
        return np.bitwise_xor(place, (mark.astype(np.int64) * 0x5BD1) & (self.buckets - 1))

    def insert(self, key: int) -> bool:
        mark, first, second = (x[0] for x in self._places(np.array([key], np.uint64)))
        for place in (first, second):
            free = np.flatnonzero(self.table[place] == 0)
            if len(free):
                self.table[place, free[0]] = mark
                return True
        place, moves = second, []
        for turn in range(500):
            slot = turn % self.SLOTS
            moves.append((place, slot))
            mark, self.table[place, slot] = self.table[place, slot], mark
            place = int(self._other(np.int64(place), np.uint16(mark)))
            free = np.flatnonzero(self.table[place] == 0)
            if len(free):
                self.table[place, free[0]] = mark
                return True
        for place, slot in reversed(moves):  # leave the filter as it was
            mark, self.table[place, slot] = self.table[place, slot], mark
        return False

    def delete(self, key: int) -> bool:
        """Take one copy of a key out; the caller must know that it is in."""
        mark, first, second = (x[0] for x in self._places(np.array([key], np.uint64)))
        for place in (first, second):
            at = np.flatnonzero(self.table[place] == mark)
            if len(at):
                self.table[place, at[0]] = 0
                return True
        return False

    def contains(self, keys: np.ndarray) -> np.ndarray:
        mark, first, second = self._places(keys)
        wanted = mark[:, None]
        return (self.table[first] == wanted).any(1) | (self.table[second] == wanted).any(1)

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        table = np.frombuffer(data, np.uint16).reshape(-1, cls.SLOTS).copy()
        return cls(len(table), table)


def postings(docs: DataFrame, min_chars: int = 40) -> DataFrame:
    """The exact table's rows: (hi, lo, doc_id), once per document and key."""
    kind = dict(docs.dtypes)["doc_id"]

    def keys(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, found = [], []
        for i, text in enumerate(raw(batch.column("text"))):
            if text:
                own = {k for k in (line_key(line, min_chars) for line in text.split(b"\n")) if k}
                found.extend(own)
                rows.extend([i] * len(own))
        pairs = np.frombuffer(b"".join(found), ">i8").reshape(-1, 2).astype(np.int64)
        return batch_of(hi=pairs[:, 0], lo=pairs[:, 1], doc_id=batch.column("doc_id").take(pa.array(rows, pa.int64())))

    named = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text")
    return map_batches(named, keys, f"hi long, lo long, doc_id {kind}")


def _heavy(entries: DataFrame, min_docs: int) -> DataFrame:
    counted = entries.groupBy("hi", "lo").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc"))
    return counted.where(F.col("n_docs") >= min_docs)


class LineIndex:
    """Reference counts and filters of a set of documents.

    The state is frames in the shared folder that never change; an update gives another index that shares most of them: ``entries`` (hi, lo, doc_id), ``counts``
    (hi, lo, n_docs, last_doc) of heavy keys, and ``filters`` (shard, filter).
    """

    #: Updates after which entries and counts, layered until then, are written as a whole.
    LAYERS = 8

    def __init__(self, entries: DataFrame, min_docs: int, min_chars: int, keys_per_shard: int = 1 << 16):
        self.entries, self.min_docs, self.min_chars = entries, min_docs, min_chars
        self.keys_per_shard, self.layers = keys_per_shard, 0
        self.counts = staged(_heavy(entries, min_docs))
        self.shards = max(1, -(-self.counts.count() // keys_per_shard))
        self.filters = staged(self._filters(self.counts))

    @classmethod
    def of(cls, docs: DataFrame, min_docs: int = 5, min_chars: int = 40) -> LineIndex:
        return cls(staged(postings(docs, min_chars).distinct()), min_docs, min_chars)

    def insert(self, docs: DataFrame) -> LineIndex:
        """The index with more documents; a document's line that is already in is not counted again."""
        row = ["hi", "lo", "doc_id"]
        batch = staged(postings(docs, self.min_chars).distinct())
        fresh = staged(batch.join(self.entries.join(batch, row, "left_semi"), row, "left_anti"))
        return self._changed(self.entries.unionByName(fresh), fresh)

    def delete(self, doc_ids: DataFrame) -> LineIndex:
        """The index as if these documents had never been inserted."""
        gone = staged(doc_ids.select("doc_id").where("doc_id is not null").distinct())
        lost = staged(self.entries.join(gone, "doc_id", "left_semi").select("hi", "lo", "doc_id"))
        return self._changed(self.entries.join(gone, "doc_id", "left_anti").select("hi", "lo", "doc_id"), lost)

    def _changed(self, entries: DataFrame, moved: DataFrame) -> LineIndex:
        """The index over other entries, which differ from these in the keys of ``moved`` only.

        The keys are few beside the entries, so they are what travels: the entries are scanned for them. Keys whose
        count crosses the threshold go into or out of their shards' filters; the other filters stay.
        """
        key = ["hi", "lo"]
        keys = staged(moved.select(*key).distinct())
        now = staged(_heavy(entries.join(keys, key, "left_semi"), self.min_docs))
        before = staged(self.counts.join(keys, key, "left_semi"))
        made = copy(self)
        made.entries, made.counts = entries, self.counts.join(keys, key, "left_anti").unionByName(now)
        made.layers = self.layers + 1
        if made.layers >= self.LAYERS:
            made.entries, made.counts, made.layers = staged(made.entries), staged(made.counts), 0
        came = now.join(before, key, "left_anti").select(self._shard().alias("shard"), "lo", F.lit(True).alias("comes"))
        went = before.join(now, key, "left_anti").select(self._shard().alias("shard"), "lo", F.lit(False).alias("comes"))
        made.filters = self._updated(staged(came.unionByName(went)), made.counts)
        return made

    def _updated(self, changes: DataFrame, counts: DataFrame) -> DataFrame:
        """All filters after ``changes``; a filter that has no room left is built again from its shard's keys."""

        def update(key: tuple[pa.Scalar, ...], held: pa.Table, rows: pa.Table) -> pa.Table:
            shard, told = key[0].as_py(), None
            if held.num_rows:
                own = CuckooFilter.from_bytes(held.column("filter")[0].as_py())
                comes = rows.column("comes").to_numpy().astype(bool)
                low = rows.column("lo").to_numpy().view(np.uint64)
                whole = all([own.delete(k) for k in low[~comes]]) and all(own.insert(k) for k in low[comes])
                told = own.to_bytes() if whole else None
            return pa.table({"shard": pa.array([shard], pa.int32()), "filter": pa.array([told], pa.binary())})

        touched = changes.select("shard").distinct()
        stored = self.filters.join(touched, "shard", "left_semi").select("shard", "filter")
        updated = staged(stored.groupBy("shard").cogroup(changes.groupBy("shard")).applyInArrow(update, "shard int, filter binary"))
        full = updated.where("filter is null").select("shard")
        again = self._filters(counts.withColumn("shard", self._shard()).join(full, "shard", "left_semi"))
        kept = self.filters.join(touched, "shard", "left_anti").select("shard", "filter")
        return staged(kept.unionByName(updated.where("filter is not null")).unionByName(again))

    def _filters(self, counts: DataFrame) -> DataFrame:
        """One filter per shard of heavy keys; keys are distinct and hashed, so shards are even."""

        def build(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
            held = CuckooFilter.of(rows.column("lo").to_numpy().view(np.uint64))
            return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "filter": pa.array([held.to_bytes()], pa.binary())})

        return counts.select(self._shard().alias("shard"), "lo").groupBy("shard").applyInArrow(
            build, "shard int, filter binary"
        )

    def _shard(self):
        return F.pmod(F.col("hi"), F.lit(self.shards)).cast("int")

    def losses(self) -> DataFrame:
        """(doc_id, keys): the keys whose lines a document loses, as one binary of 16-byte keys."""
        known = self._known()
        lost = known.join(self.counts, ["hi", "lo"]).where(F.col("doc_id") < F.col("last_doc"))
        return lost.groupBy("doc_id").agg(F.collect_list(F.struct("hi", "lo")).alias("keys"))

    def _known(self) -> DataFrame:
        """Entries that pass their shard's filter.

        A shard's filter is sent ahead of its entries to every task that has some: entries of a
        shard are salted over several tasks, and the filter is the first row of each. A task
        streams, holding one filter at a time.
        """
        spark = self.entries.sparkSession
        salts = max(1, -(-partitions_of(spark) // self.shards))
        kind = dict(self.entries.dtypes)["doc_id"]
        lines = self.entries.select(
            self._shard().alias("shard"), F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int").alias("salt"),
            "hi", "lo", "doc_id", F.lit(None).cast("binary").alias("filter"),
        )
        heads = self.filters.select(
            "shard", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"),
            F.lit(None).cast("long").alias("hi"), F.lit(None).cast("long").alias("lo"),
            F.lit(None).cast(kind).alias("doc_id"), "filter",
        )
        dealt = heads.unionByName(lines).repartition("shard", "salt").sortWithinPartitions(
            "shard", "salt", F.col("filter").isNull()
        )

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at, held = None, None
            for batch in batches:
                shard = batch.column("shard").to_numpy(zero_copy_only=False).astype(np.int64)
                salt = batch.column("salt").to_numpy(zero_copy_only=False).astype(np.int64)
                group = shard * (salts + 1) + salt
                is_head = batch.column("filter").is_valid().to_numpy(zero_copy_only=False)
                keep = np.zeros(batch.num_rows, bool)
                low = batch.column("lo").fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64)
                cuts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
                for start, end in zip(cuts, [*cuts[1:], len(group)]):
                    if group[start] != at:
                        at, held = group[start], None
                    while start < end and is_head[start]:
                        held = CuckooFilter.from_bytes(batch.column("filter")[int(start)].as_py())
                        start += 1
                    if held is not None:
                        keep[start:end] = held.contains(low[start:end])
                rows = pa.array(np.flatnonzero(keep))
                yield batch_of(**{c: batch.column(c).take(rows) for c in ("hi", "lo", "doc_id")})

        return dealt.mapInArrow(probe, f"hi long, lo long, doc_id {kind}")


def drop_lines(docs: DataFrame, index: LineIndex) -> DataFrame:
    """Texts without the lines that the index takes from their documents.

    A row for each row, with its other columns; ``text`` is what stays, ``n_lines`` (before dropping)
    and ``n_dropped`` are added, in place of columns of those names.
    """
    min_chars = index.min_chars
    others = [c for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    lost = index.losses().select(F.col("doc_id").alias("__of"), F.col("keys").alias("__keys"))
    joined = packed(docs, *others, name="__packed").join(lost, F.col("doc_id") == F.col("__of"), "left").drop("__of")

    def drop(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, lines, dropped = [], [], []
        for text, keys in zip(unpack(batch.column("__packed")), batch.column("__keys").to_pylist()):
            parts = (text or b"").split(b"\n")
            lines.append(len(parts))
            if keys:
                gone = {np.array([k["hi"], k["lo"]], ">i8").tobytes() for k in keys}
                kept = [p for p in parts if line_key(p, min_chars) not in gone]
            else:
                kept = parts
            dropped.append(len(parts) - len(kept))
            texts.append(b"\n".join(kept))
        made = [pa.array(texts, pa.binary()).cast(pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())]
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in others), *made], names=[*others, "text", "n_lines", "n_dropped"]
        )

    kinds = dict(docs.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in others) + ", text string, n_lines long, n_dropped long"
    return map_batches(joined, drop, schema)


def dedup_lines(docs: DataFrame, min_docs: int = 5, min_chars: int = 40) -> DataFrame:
    """Drop each line that enough documents share everywhere but in the last document that holds it."""
    return drop_lines(docs, LineIndex.of(docs, min_docs, min_chars))
