"""Substring dedup by suffix automata: words covered by a window that occurs elsewhere are removed.

Every document is a reference for every other one, so an automaton of all of them cannot be broadcast.
Shards are cut so that equal windows always meet in one of them, and each shard's automaton is built
in the task that its passages are sent to:

1. A scan cuts each document into passages. A window's anchor is its smallest 8-gram by hash, so equal
   windows have equal anchors; a passage is the words under consecutive windows with one anchor. Only
   hashes leave the scan, one row per passage (about 14 windows; periodic text gives one long passage).
2. Passages are counted per anchor and hash, summed in each task before the shuffle, so a passage that many
   documents share is one row there. Equal passages are repeats as a whole. Where one anchor stands in
   different passages, or several times in one, one passage of each kind is fetched.
3. Shards of fetched passages get a generalised suffix automaton with occurrence counts. Each passage
   is streamed through it: where the matching statistic reaches the window and the matched state
   occurs twice or more, the window is repeated. Maximal runs of such windows are the spans.
4. An anchor whose different passages have more than ``shard`` words together is never gathered: the tasks that
   hold its texts count its windows by their hashes, distinct ones once a batch, which is exact too.

Documents are identified by a 64-bit hash of id and text: repeated rows are occurrences of their own, so all
their windows are repeats. Null texts are empty; texts shorter than a window lose nothing.
Hashes of words, anchors and passages have 64 bits; a false repeat takes an equal anchor and an equal
passage hash at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmark.llm.text import batch_of, map_batches, raw, rolling, signed, staged, unpack, word_hashes

ANCHOR = 8


def doc_keys(ids: pa.Array, texts: list[bytes | None]) -> np.ndarray:
    """64-bit names of documents, from id and text."""
    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(t or b"", digest(str(i).encode())) for i, t in zip(ids.to_pylist(), texts)], np.uint64).view(np.int64)


def cut(h: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first window, number of windows, and whether the anchor stands there more than once, of
    each passage of a text's word hashes."""
    windows = len(h) - window + 1
    if windows <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, int), np.zeros(0, int), np.zeros(0, bool)
    grams = rolling(h, min(ANCHOR, window))
    span = len(grams) - windows + 1  # grams in a window
    low, at, reach = grams, np.arange(len(grams)), 1
    while reach < span:
        step = min(reach, span - reach)
        a, b = low[:-step], low[step:]
        take = b < a
        low, at = np.where(take, b, a), np.where(take, at[step:], at[:-step])
        reach += step
    starts = np.flatnonzero(np.r_[True, low[1:] != low[:-1]])
    ends = np.r_[starts[1:], windows]
    # windows repeat within a passage only if its leftmost anchor moves
    return low[starts], starts, ends - starts, at[ends - 1] != at[starts]


def passages(docs: DataFrame, window: int) -> DataFrame:
    """(anchor, passage, doc, start, windows, again): one row per passage."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = raw(batch.column("text"))
        keys = doc_keys(batch.column("doc_id"), texts)
        out = [[], [], [], [], [], []]
        digest = xxhash.xxh3_64_intdigest
        for key, text in zip(keys, texts):
            h = word_hashes((text or b"").split())
            anchors, starts, windows, again = cut(h, window)
            if not len(anchors):
                continue
            data, ends = h.tobytes(), 8 * (starts + windows + window - 1)
            own = [digest(data[a:b]) for a, b in zip((8 * starts).tolist(), ends.tolist())]
            for column, value in zip(out, (anchors, np.array(own, np.uint64), np.full(len(starts), key), starts, windows, again)):
                column.append(value)
        made = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in out]
        return batch_of(
            anchor=made[0].view(np.int64), passage=made[1].view(np.int64), doc=made[2],
            start=made[3].astype(np.int32), windows=made[4].astype(np.int32), again=made[5].astype(bool),
        )

    return map_batches(docs.select("doc_id", "text"), run, "anchor long, passage long, doc long, start int, windows int, again boolean")


def kinds_of(rows: DataFrame) -> DataFrame:
    """(anchor, passage, times, doc, start, windows, again): the different passages, with one place of each."""
    # equal passages are equally long; both firsts come from the same row
    return rows.groupBy("anchor", "passage").agg(
        F.count(F.lit(1)).alias("times"), F.first("doc").alias("doc"), F.first("start").alias("start"),
        F.max("windows").alias("windows"), F.max("again").alias("again"),
    )


def asked_of(kinds: DataFrame, window: int, shard: int) -> DataFrame:
    """(doc, anchor, start, windows, same, wide): passages whose windows must be compared one by one."""
    words = F.sum(F.col("windows").cast("long") + (window - 1))
    anchors = (
        kinds.groupBy(F.col("anchor").alias("of")).agg(F.count(F.lit(1)).alias("kinds"), words.alias("words"), F.max("again").alias("some"))
        .where((F.col("kinds") > 1) | F.col("some"))
    )
    met = kinds.join(anchors, F.col("anchor") == F.col("of"))
    return met.where((F.col("kinds") > 1) | (F.col("again") & (F.col("times") == 1))).select(
        "doc", "anchor", "start", "windows", (F.col("times") > 1).alias("same"), (F.col("words") > shard).alias("wide")
    )


class SuffixAutomaton:
    """Generalised suffix automaton of word sequences, with how often each state's strings occur."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def add(self, words, weight: int = 1) -> None:
        """Add a sequence that occurs ``weight`` times."""
        nexts, link, length, count = self.next, self.link, self.length, self.count
        last = 0
        for word in words:
            q = nexts[last].get(word)
            if q is not None and length[q] == length[last] + 1:
                last = q
                count[last] += weight
                continue
            if q is None:
                new = len(nexts)
                nexts.append({})
                length.append(length[last] + 1)
                link.append(0)
                count.append(weight)
                p = last
                while p >= 0 and word not in nexts[p]:
                    nexts[p][word] = new
                    p = link[p]
                last = new
                if p < 0:
                    continue
                q = nexts[p][word]
                if length[q] == length[p] + 1:
                    link[new] = q
                    continue
            else:  # the string is known as a part of longer ones only
                new, p = None, last
            clone = len(nexts)
            nexts.append(dict(nexts[q]))
            length.append(length[p] + 1)
            link.append(link[q])
            count.append(0)
            link[q] = clone
            while p >= 0 and nexts[p].get(word) == q:
                nexts[p][word] = clone
                p = link[p]
            if new is None:
                last = clone
                count[clone] += weight
            else:
                link[new] = clone

    def close(self) -> None:
        """Carry the counts from longer strings to their suffixes; nothing is added afterwards."""
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.count[self.link[state]] += self.count[state]

    def repeats(self, words, window: int) -> list[int]:
        """Positions of the windows that occur twice or more, by matching statistics up to a window."""
        nexts, link, length, count = self.next, self.link, self.length, self.count
        found, state, matched = [], 0, 0
        for end, word in enumerate(words, 1):
            while state and word not in nexts[state]:
                state = link[state]
                matched = length[state]
            if word in nexts[state]:
                state = nexts[state][word]
                matched += 1
            while length[link[state]] >= window if state else False:
                state = link[state]
            matched = min(matched, length[state])
            if matched >= window and count[state] >= 2:
                found.append(end - window)
        return found


def judge(fetched: DataFrame, window: int, shard: int) -> DataFrame:
    """(doc, start, windows): repeated windows of passages of different kinds, by automata of at most about
    twice ``shard`` words.

    ``fetched`` has anchor, doc, start, same and words (bytes); no anchor has more than ``shard`` words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, at = 0, None

        def spans_of() -> pa.RecordBatch:
            automaton = SuffixAutomaton()
            for _, _, same, words in held:
                automaton.add(words, 2 if same else 1)
            automaton.close()
            out = ([], [], [])
            for doc, start, same, words in held:
                if same:
                    continue  # known as a whole
                for first, n in runs(automaton.repeats(words, window)):
                    for column, value in zip(out, (doc, start + first, n)):
                        column.append(value)
            return batch_of(doc=pa.array(out[0], pa.int64()), start=pa.array(out[1], pa.int32()), windows=pa.array(out[2], pa.int32()))

        for batch in batches:
            for anchor, *row, words in zip(*(batch.column(c).to_pylist() for c in ("anchor", "doc", "start", "same", "words"))):
                if anchor != at:
                    at = anchor
                    if size >= shard:
                        yield spans_of()
                        held, size = [], 0
                held.append((*row, words.split(b" ")))
                size += len(held[-1][-1])
        if held:
            yield spans_of()

    dealt = fetched.select("anchor", "doc", "start", "same", "words").repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(run, "doc long, start int, windows int")


def count_windows(wide: DataFrame) -> DataFrame:
    """(doc, start, windows): repeated windows of passages given by their windows' hashes (``pieces``)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column("pieces")
        weight = np.repeat(np.where(batch.column("same").to_numpy(zero_copy_only=False), 2, 1), lists.value_lengths().to_numpy())
        pieces, which = np.unique(lists.flatten().to_numpy(), return_inverse=True)
        return batch_of(piece=pieces, times=np.bincount(which, weight, len(pieces)).astype(np.int64))

    counted = map_batches(wide.select("same", "pieces"), run, "piece long, times long")
    often = counted.groupBy("piece").agg(F.sum("times").alias("times")).where("times >= 2").select("piece")
    each = wide.where(~F.col("same")).select("doc", "start", F.posexplode("pieces").alias("at", "piece"))
    return each.join(often, "piece", "left_semi").select("doc", (F.col("start") + F.col("at")).alias("start"), F.lit(1).alias("windows"))


def runs(positions: list[int]) -> list[tuple[int, int]]:
    """Maximal runs of consecutive positions as (first, length)."""
    at = np.asarray(positions, int)
    if not len(at):
        return []
    begins = np.flatnonzero(np.r_[True, at[1:] != at[:-1] + 1])
    return list(zip(at[begins].tolist(), np.diff(np.r_[begins, len(at)]).tolist()))


def keyed(docs: DataFrame) -> DataFrame:
    """(doc, doc_id, packed) for joins by the documents' names."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = raw(batch.column("text"))
        squeeze = zstandard.ZstdCompressor(level=3).compress
        data = [None if t is None else squeeze(t) for t in texts]
        return batch_of(doc=doc_keys(batch.column("doc_id"), texts), doc_id=batch.column("doc_id"), packed=pa.array(data, pa.binary()))

    return map_batches(docs.select("doc_id", "text"), run, f"doc long, doc_id {kind}, packed binary")


def spans(docs: DataFrame, window: int = 35, shard: int = 40_000) -> DataFrame:
    """(doc, spans): per document the passages of repeated windows, as (start, windows)."""
    rows = passages(docs, window)  # worked out twice, which takes less than storing it
    kinds = staged(kinds_of(rows))
    asked = asked_of(kinds, window, shard).withColumnRenamed("doc", "of").groupBy("of").agg(
        F.collect_list(F.struct("anchor", "start", "windows", "same", "wide")).alias("asks")
    )

    def fetch(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = ([], [], [], [], [], [])
        for doc, text, asks in zip(batch.column("doc").to_pylist(), unpack(batch.column("packed")), batch.column("asks").to_pylist()):
            words = (text or b"").split()
            for ask in asks:
                first = ask["start"]
                own = words[first : first + ask["windows"] + window - 1]
                part, pieces = (None, signed(rolling(word_hashes(own), window))) if ask["wide"] else (b" ".join(own), None)
                for column, value in zip(out, (ask["anchor"], doc, first, ask["same"], part, pieces)):
                    column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.list_(pa.int64()))
        names = ("anchor", "doc", "start", "same", "words", "pieces")
        return batch_of(**{c: pa.array(v, k) for c, v, k in zip(names, out, kinds)})

    texts = keyed(docs).join(asked, F.col("doc") == F.col("of")).select("doc", "packed", "asks")
    fetched = staged(map_batches(texts, fetch, "anchor long, doc long, start int, same boolean, words binary, pieces array<long>"))
    whole = rows.join(kinds.where("times > 1").select("anchor", "passage"), ["anchor", "passage"], "left_semi")
    found = (
        whole.select("doc", "start", "windows")
        .unionByName(judge(fetched.where("words is not null"), window, shard))
        .unionByName(count_windows(fetched.where("pieces is not null")))
    )
    return found.groupBy("doc").agg(F.collect_set(F.struct("start", "windows")).alias("spans"))


def remove_repeats(docs: DataFrame, window: int = 35, shard: int = 40_000) -> DataFrame:
    """Every row's ``doc_id``, ``n_words``, ``removed`` (spans of words as [start, end)) and ``text``, the
    words that stay joined by one space."""
    found = spans(docs, window, shard).withColumnRenamed("doc", "of")
    joined = keyed(docs).join(found, F.col("doc") == F.col("of"), "left").select("doc_id", "packed", "spans")
    kind = dict(docs.dtypes)["doc_id"]

    def cut_out(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, sizes, removed = [], [], []
        for text, own in zip(unpack(batch.column("packed")), batch.column("spans").to_pylist()):
            words = (text or b"").split()
            edge = np.zeros(len(words) + 1, np.int64)
            for span in own or ():
                edge[span["start"]] += 1
                edge[span["start"] + span["windows"] + window - 1] -= 1
            gone = np.cumsum(edge)[:-1] > 0
            removed.append([{"start": a, "end": a + n} for a, n in runs(np.flatnonzero(gone))])
            sizes.append(len(words))
            texts.append(b" ".join(w for w, g in zip(words, gone.tolist()) if not g) if own else b" ".join(words))
        span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return batch_of(
            doc_id=batch.column("doc_id"), n_words=pa.array(sizes, pa.int64()), removed=pa.array(removed, span_type),
            text=pa.array(texts, pa.binary()).cast(pa.string()),
        )

    return map_batches(joined, cut_out, f"doc_id {kind}, n_words long, removed array<struct<start: long, end: long>>, text string")
