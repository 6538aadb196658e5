"""Brown class-based bigram model: exchange clustering, class transitions and word emissions.

1. A scan counts all words, which gives the frequent ones (``share`` of all tokens or more, so at most 1 / share of
   them), and a second one counts all their bigrams. Exchange clustering assigns them to ``classes`` classes: each word in turn goes where the
   likelihood of the class bigrams gains most, until a sweep moves none or ``sweeps`` (8) are done.
2. Documents are dealt to blocks by hash. Per block one row for each distinct word gives its training count and how
   often each frequent class stands before and behind it. Sums over blocks give exact counts of all words and the class
   that all their neighbours speak for most: the exchange step for all other words. Both go back to the blocks a word stands in.
   No task ever holds more vocabulary than its own block has, whatever the corpus, nor more of its tokens than a chunk.
3. Blocks are read a second time, with their words' counts and classes beside them. A document gives
   its class bigrams and the sums of the logarithms that do not depend on totals; the
   transition table (a few hundred rows, from all training documents) completes the scores.

Classes: frequent, rarer ones of the same kinds, words without evidence, words met once, and the end.
Words met once in training stand for unknown ones, and by Good and Turing's estimate there are as many of these as
of those: their class deals its mass evenly to the words met once and to as many words never met, so an unknown
word is as improbable as one met once. Thus the model is a distribution over the training words and as many
unknown words as were met once.

Words are named by 64-bit hashes. Null and empty texts have the end token only. Repeated rows are scored each, and
learned from each. Rows with a null ``doc_id`` are scored, not learned from. No count depends on how the input is
split. Without training rows all words are unknown.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookmark.llm.text import batch_of, packed, raw, signed, staged, unpack, unpack_each, word_hashes

END = np.uint64(0)


def tokens_of(text: bytes | None) -> np.ndarray:
    """Hashes of the lower-cased words and the end."""
    h = word_hashes((text or b"").lower().split())
    h[h == END] = np.uint64(1)
    return np.append(h, END)


def _chunks(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[np.ndarray]:
    """Tokens of whole documents, about ``chunk`` at a time."""
    held, size = [], 0
    for batch in batches:
        for text in raw(batch.column("text")):
            held.append(tokens_of(text))
            size += len(held[-1])
            if size >= chunk:
                yield np.concatenate(held)
                held, size = [], 0
    if held:
        yield np.concatenate(held)


def word_counts(docs: DataFrame, chunk: int = 2_000_000) -> DataFrame:
    """(word, n): exact counts of all words of training documents, the end included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens in _chunks(batches, chunk):
            words, times = np.unique(tokens, return_counts=True)
            yield batch_of(word=signed(words), n=times.astype(np.int64))

    return docs.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_bigrams(docs: DataFrame, words: np.ndarray, chunk: int = 2_000_000) -> DataFrame:
    """(a, b, n): exact counts of all bigrams of ``words`` (sorted hashes), by their places there.

    A document starts after an end. Counts are summed over chunks, then over tasks.
    """
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = shared.value
        for tokens in _chunks(batches, chunk):
            tokens = np.r_[END, tokens]
            at = np.minimum(np.searchsorted(names, tokens), len(names) - 1)
            at = np.where(names[at] == tokens, at, -1)
            code, n = np.unique((at[:-1] * len(names) + at[1:])[(at[:-1] >= 0) & (at[1:] >= 0)], return_counts=True)
            yield batch_of(a=code // len(names), b=code % len(names), n=n.astype(np.int64))

    return docs.select("text").mapInArrow(run, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


def exchange(size: int, a: np.ndarray, b: np.ndarray, n: np.ndarray, classes: int, sweeps: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Class of each of ``size`` words (most frequent first) and the class bigram counts, after at most ``sweeps``
    sweeps over the words."""
    cls = np.arange(size) % classes
    n = n.astype(float)
    out_order, in_order = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
    out_at, in_at = np.searchsorted(a[out_order], np.arange(size + 1)), np.searchsorted(b[in_order], np.arange(size + 1))
    table = np.zeros((classes, classes))
    np.add.at(table, (cls[a], cls[b]), n)

    def gain(x):
        return x * np.log(np.maximum(x, 1.0))

    for _ in range(sweeps):
        moved = 0
        for w in range(size):
            o, i = out_order[out_at[w] : out_at[w + 1]], in_order[in_at[w] : in_at[w + 1]]
            own = n[o][b[o] == w].sum()
            o, i = o[b[o] != w], i[a[i] != w]
            to = np.bincount(cls[b[o]], n[o], classes)
            by = np.bincount(cls[a[i]], n[i], classes)
            old = cls[w]
            table[old] -= to
            table[:, old] -= by
            table[old, old] -= own
            rows, columns, corner = table.sum(1), table.sum(0), np.diag(table)
            along = gain(table + to) - gain(table)
            across = gain(table + by[:, None]) - gain(table)
            change = (
                along.sum(1) - np.diag(along) + across.sum(0) - np.diag(across)
                + gain(corner + to + by + own) - gain(corner)
                - gain(rows + to.sum() + own) + gain(rows) - gain(columns + by.sum() + own) + gain(columns)
            )
            new = int(np.argmax(change)) if change.max() > change[old] + 1e-9 else int(old)
            moved += new != old
            cls[w] = new
            table[new] += to
            table[:, new] += by
            table[new, new] += own
        if not moved:
            break
    return cls, table


def cluster(docs: DataFrame, share: float, classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted hashes of the frequent words (the end included), their classes, and the class bigrams."""
    counted = staged(word_counts(docs))
    total = counted.agg(F.sum("n")).first()[0] or 0
    rows = sorted(((r["n"], r["word"]) for r in counted.where(F.col("n") >= share * total).collect()), reverse=True)  # at most 1 / share rows
    words = np.array([w for _, w in rows], np.int64).view(np.uint64)
    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(0, int), np.zeros((classes, classes))
    order = np.argsort(words)
    pairs = frequent_bigrams(docs, words[order]).toArrow()
    a, b = (order[pairs.column(c).to_numpy()] for c in "ab")
    fixed = np.lexsort((b, a))
    cls, table = exchange(len(words), a[fixed], b[fixed], pairs.column("n").to_numpy()[fixed], classes)
    return words[order], cls[order], table


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """Rows of one block after the other, of batches sorted by block."""
    at, held = None, []
    for batch in batches:
        blocks = batch.column("block").to_numpy()
        starts = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]]) if len(blocks) else []
        for start, end in zip(starts, [*starts[1:], len(blocks)]):
            if blocks[start] != at:
                if held:
                    yield at, held
                at, held = int(blocks[start]), []
            held.append(batch.slice(start, end - start))
    if held:
        yield at, held


def _sums(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and the sum of each one's numbers."""
    order = np.argsort(code, kind="stable")
    code, n = code[order], n[order]
    starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    return code[starts], np.add.reduceat(n, starts)


def _learned(parts: list[pa.RecordBatch], chunk: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Tokens of whole documents, about ``chunk`` at a time, and which are learned from; an end stands before them."""
    texts, learn, size = [np.array([END])], [False], 0  # any document starts after an end
    for part in parts:
        for text, use in zip(unpack_each(part.column("packed")), part.column("learn").to_pylist()):
            texts.append(tokens_of(text))
            learn.append(use)
            size += len(texts[-1])
            if size >= chunk:
                yield np.concatenate(texts), np.repeat(np.array(learn, bool), [len(t) for t in texts])
                texts, learn, size = [np.array([END])], [False], 0
    yield np.concatenate(texts), np.repeat(np.array(learn, bool), [len(t) for t in texts])


def block_words(blocks: DataFrame, frequent, classes: int, chunk: int = 250_000, rows: int = 20_000) -> DataFrame:
    """(block, word, n, known, near): each distinct word of a block with its training count there.

    ``known`` is a frequent word's class. For the others ``near`` counts the frequent classes beside
    them in training documents: 128 x count + class, and 64 more for the class that comes behind.
    A block's tokens are counted ``chunk`` by ``chunk``; only the counts of its distinct words are held as a whole.
    """
    shared = blocks.sparkSession.sparkContext.broadcast(frequent[:2])

    def counted(tokens: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct words, their training counts, and the codes (place of the word x 128 + class) with theirs."""
        names, cls = shared.value
        words, at = np.unique(tokens, return_inverse=True)
        kind = np.full(len(words), -1)
        if len(names):
            place = np.minimum(np.searchsorted(names, words), len(names) - 1)
            kind = np.where(names[place] == words, cls[place], -1)
        near = kind[at]
        use = train & (near < 0) & (tokens != END)
        found = []
        for word, other, on, side in ((at[1:], near[:-1], use[1:], 0), (at[:-1], near[1:], use[:-1], 64)):
            on = on & (other >= 0)
            found.append(word[on] * 128 + other[on] + side)
        code, times = np.unique(np.concatenate(found), return_counts=True)
        return words, np.bincount(at[train], minlength=len(words)).astype(np.int64), code, times.astype(np.int64)

    def merged(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        words, n = _sums(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
        codes = [np.searchsorted(words, own)[code // 128] * 128 + code % 128 for own, _, code, _ in parts]
        code, times = np.concatenate(codes), np.concatenate([p[3] for p in parts])
        return words, n, *(_sums(code, times) if len(code) else (code, times))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, cls = shared.value
        for block, parts in _by_block(batches):
            done, held = [], 0
            for tokens, train in _learned(parts, chunk):
                done.append(counted(tokens, train))
                held += len(done[-1][0]) + len(done[-1][2])
                if len(done) > 1 and held > 2 * (len(done[0][0]) + len(done[0][2])) + chunk:
                    done = [merged(done)]
                    held = len(done[0][0]) + len(done[0][2])
            del parts
            words, n, code, times = merged(done)
            kind = np.full(len(words), -1)
            if len(names):
                place = np.minimum(np.searchsorted(names, words), len(names) - 1)
                kind = np.where(names[place] == words, cls[place], -1)
            ends = np.searchsorted(code // 128, np.arange(len(words) + 1))
            near = times * 128 + code % 128
            for at in range(0, len(words), rows):
                to = min(at + rows, len(words))
                yield batch_of(
                    block=np.full(to - at, block, np.int64), word=signed(words[at:to]), n=n[at:to], known=kind[at:to].astype(np.int16),
                    near=pa.ListArray.from_arrays(pa.array((ends[at : to + 1] - ends[at]).astype(np.int32)), pa.array(near[ends[at] : ends[to]], pa.int64())),
                )

    return blocks.mapInArrow(run, "block long, word long, n long, known short, near array<long>")


def word_classes(local: DataFrame, table: np.ndarray, classes: int) -> DataFrame:
    """(block, word, n, kind, first) from the rows of ``block_words``: counts, and the class that all
    blocks' neighbours speak for, are of the whole corpus; ``first`` marks one block of a training word.

    Logarithms are rounded to whole multiples of 2**-16, so that sums are exact in any order.
    """
    smooth = table + 0.5
    before = np.rint(np.log(smooth / smooth.sum(1, keepdims=True)) * 65536)  # class given the one before
    behind = np.rint(np.log(smooth.T / smooth.sum(0)[:, None]) * 65536)  # class given the one behind
    law = np.zeros((128, classes))
    law[:classes], law[64 : 64 + classes] = before, behind
    # one row per word and block: a word's rows are at most as many as there are blocks
    dealt = local.repartition("word").sortWithinPartitions("word", "block")

    def settled(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        word, n, block, known = (rows.column(c).to_numpy() for c in ("word", "n", "block", "known"))
        starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        at = np.cumsum(np.r_[True, word[1:] != word[:-1]]) - 1
        k = len(starts)
        total = np.add.reduceat(n, starts)
        near = rows.column("near").combine_chunks()
        code = near.flatten().to_numpy()
        owner = np.repeat(at, near.value_lengths().to_numpy())
        counts = np.bincount(owner * 128 + code % 128, code // 128, k * 128).reshape(k, 128)
        evidence = counts @ law
        spoken = evidence.max(1) > evidence.min(1)
        kind = np.where(spoken, classes + evidence.argmax(1), 2 * classes)
        kind = np.where(total == 1, 2 * classes + 1, kind)
        kind = np.where(known[starts] >= 0, known[starts], kind)
        holds = np.flatnonzero(n > 0)
        first = np.zeros(len(n), bool)
        first[holds[np.unique(at[holds], return_index=True)[1]]] = True
        return batch_of(block=block, word=word, n=total[at], kind=kind[at].astype(np.int16), first=first)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            word = batch.column("word").to_numpy()
            # the last word may go on in the next batch
            last = int(np.searchsorted(word, word[-1]))
            if last and size + last >= 20_000:
                yield settled(pa.Table.from_batches([*held, batch.slice(0, last)]))
                held, size = [], 0
                batch = batch.slice(last)
            held.append(batch)
            size += batch.num_rows
        if held:
            yield settled(pa.Table.from_batches(held))

    return dealt.mapInArrow(run, "block long, word long, n long, kind short, first boolean")


def _blocked(docs: DataFrame, n_blocks: int, learn: Column) -> DataFrame:
    """Documents with their block (by hash) and whether they are learned from, packed for a shuffle."""
    named = docs.select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)).alias("block"), F.coalesce(learn, F.lit(False)).alias("learn"), "doc_id", "text"
    )
    return packed(named, "block", "learn", "doc_id")


def profiles(docs: DataFrame, words: DataFrame, classes: int) -> DataFrame:
    """Per document what its score is made of; ``words`` has block, word, n, kind and first.

    Rows with null ``codes`` tell how many distinct training words a block is the first to hold.
    """
    kind = dict(docs.dtypes)["doc_id"]
    blank = {"learn": "boolean", "doc_id": kind, "packed": "binary"}
    heads = words.where("n > 0").select("block", F.lit(0).alias("sort"), *[F.lit(None).cast(t).alias(c) for c, t in blank.items()], "word", "n", "kind", "first")
    texts = docs.select("block", F.lit(1).alias("sort"), *blank, *[F.lit(None).cast("long").alias(c) for c in ("word", "n")], F.lit(None).cast("short").alias("kind"), F.lit(None).cast("boolean").alias("first"))
    dealt = heads.unionByName(texts).repartition("block").sortWithinPartitions("block", "sort")
    once, end, none = 2 * classes + 1, 2 * classes + 2, 2 * classes
    total = 2 * classes + 3

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def empty(first_words: int, like: pa.DataType) -> pa.RecordBatch:
            return batch_of(
                doc_id=pa.nulls(1, like), learn=pa.nulls(1, pa.bool_()), n_tokens=pa.array([first_words], pa.int64()),
                n_known=pa.nulls(1, pa.int64()), n_once=pa.nulls(1, pa.int64()), base=pa.nulls(1, pa.float64()),
                emission=pa.nulls(1, pa.float64()), codes=pa.nulls(1, pa.list_(pa.int16())), times=pa.nulls(1, pa.list_(pa.int32())),
            )

        at, parts, table = None, [], None
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            starts = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]]) if len(blocks) else []
            for start, stop in zip(starts, [*starts[1:], len(blocks)]):
                rows = batch.slice(start, stop - start)
                if blocks[start] != at:
                    at, parts, table = blocks[start], [], None
                is_head = rows.column("sort").to_numpy() == 0
                n_heads = int(is_head.sum())
                if n_heads:
                    head = rows.slice(0, n_heads)
                    parts.append([head.column(c).to_numpy() for c in ("word", "n", "kind")])
                    yield empty(int(head.column("first").to_numpy(zero_copy_only=False).astype(bool).sum()), batch.column("doc_id").type)
                if n_heads < rows.num_rows:
                    if table is None:
                        table = _table(parts, classes)
                        parts = []
                    yield score_parts(rows.slice(n_heads), table)

    def score_parts(rows: pa.RecordBatch, table) -> pa.RecordBatch:
        names, counts, kinds = table
        out: dict[str, list] = {c: [] for c in ("n_tokens", "n_known", "n_once", "base", "emission", "codes", "times")}
        for text in unpack(rows.column("packed")):
            h = tokens_of(text)
            n, kind = np.zeros(len(h), np.int64), np.full(len(h), once)
            if len(names):
                place = np.minimum(np.searchsorted(names, h), len(names) - 1)
                known = names[place] == h
                n[known], kind[known] = counts[place[known]], kinds[place[known]]
            kind[-1] = end
            code, times = np.unique(np.r_[end, kind[:-1]] * total + kind, return_counts=True)
            plain = n[:-1][n[:-1] > 1]
            for column, value in zip(out.values(), (
                len(h), int((n > 0).sum()), int((n[:-1] == 1).sum()), float(np.log10(n + 0.5).sum()),
                float(np.log10(plain).sum()), code.astype(np.int16), times.astype(np.int32),
            )):
                column.append(value)
        types = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.int16()), pa.list_(pa.int32()))
        return batch_of(
            doc_id=rows.column("doc_id"), learn=rows.column("learn"), **{c: pa.array(v, t) for (c, v), t in zip(out.items(), types)}
        )

    def _table(parts, classes: int):
        if not parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        word, n, kinds = (np.concatenate(x) for x in zip(*parts))
        word = word.view(np.uint64)
        order = np.argsort(word)
        return word[order], n[order], kinds[order].astype(np.int64)

    return dealt.mapInArrow(
        run, f"doc_id {kind}, learn boolean, n_tokens long, n_known long, n_once long, base double, emission double, codes array<short>, times array<int>"
    )


def score(
    docs: DataFrame, learn: Column, classes: int = 16, share: float = 1e-4, block_chars: int = 40_000_000
) -> DataFrame:
    """``doc_id``, ``learn``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` and ``perplexity``.

    ``learn`` tells which rows are learned from. Scores are log10 probabilities of the whole text.
    """
    assert 2 <= classes <= 64
    docs = docs.select("doc_id", "text")
    frequent = cluster(docs.where(learn), share, classes)
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = _blocked(docs, max(1, -(-chars // block_chars)), learn)
    dealt = blocks.repartition("block").sortWithinPartitions("block")
    local = block_words(dealt, frequent, classes)
    words = word_classes(local, frequent[2], classes)
    made = staged(profiles(blocks, words, classes))
    rows = made.where("codes is not null")
    distinct = made.where("codes is null").agg(F.sum("n_tokens")).first()[0] or 0
    train = made.where("codes is not null and learn")
    total = train.agg(F.sum("n_tokens")).first()[0] or 0
    # at most the square of the number of classes
    moves = train.select(F.explode(F.arrays_zip("codes", "times")).alias("m")).groupBy("m.codes").agg(F.sum("m.times").alias("n")).collect()
    size = 2 * classes + 3
    table = np.zeros(size * size)
    for row in moves:
        table[row["codes"]] = row["n"]
    law, once = transition_law(table.reshape(size, size), classes)
    weights = F.array(*[F.lit(float(x)) for x in law.ravel()])
    moved = F.aggregate(
        F.zip_with("codes", "times", lambda c, n: F.get(weights, c.cast("int")) * n), F.lit(0.0), lambda x, y: x + y
    )
    rare = F.col("n_once") + F.col("n_tokens") - F.col("n_known")  # words met once or never
    base = F.col("base") - F.col("n_tokens") * F.lit(float(np.log10(total + 0.5 * (distinct + 1))))
    full = moved + F.col("emission") + rare * F.lit(once)
    return rows.select(
        "doc_id", "learn", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), base.alias("base_score"), full.alias("score"),
        F.pow(F.lit(10.0), -full / F.col("n_tokens")).alias("perplexity"),
    )


def transition_law(table: np.ndarray, classes: int, weight: float = 1.0) -> tuple[np.ndarray, float]:
    """log10 of a class given the one before, less log10 of the class's size where its words' counts
    complete the emission; and log10 of the emission of a word met once, or never."""
    size = table.sum(0)
    prior = (size + 0.5) / (size + 0.5).sum()
    law = np.log10((table + weight * prior) / (table.sum(1, keepdims=True) + weight))
    law[:, : 2 * classes + 1] -= np.log10(np.maximum(size[: 2 * classes + 1], 1))
    return law, float(np.log10(0.5 / max(1.0, size[2 * classes + 1])))
