"""Phrase collocations, counted on a prefix-free parse of the corpus.

1. A scan cuts every piece of text into chunks. A new chunk starts wherever the hash of the next ``most`` - 1 words
   is 0 modulo ``spacing``, and each chunk runs ``most`` - 1 words into the next one. Where a chunk starts depends on
   the words there alone, so repeated text gives the same chunks however it is aligned, and the distinct
   chunks with their frequencies (the dictionary and the parse, as in prefix-free parsing) stand for all text.
2. A phrase belongs to the chunk that its first word belongs to, and the words a chunk shares with the next one
   belong to the next; so each occurrence is counted once. Phrases are counted in distinct chunks, weighted by the
   chunk's frequency, and summed by Spark.
3. Lengths are counted in turn: a phrase is only looked at if both its parts without the first and without the
   last word may be frequent, by a bit map of the frequent ones of the length before. The map has 16 bits a
   phrase and at most ``map_bits``; what it lets through in vain is counted and then dropped, so counts are exact.
4. Candidates meet the counts of their parts by joins; Spark keeps the first ``top`` of a language in each task
   before the shuffle, so no language is gathered.

Pieces are parted by ``[.,;:!?\\x0A-\\x0D]``, words by space and tab, A-Z are lower-cased. Null texts have no
words, a null language is ``und``. Ids are not read, so repeated rows count as often as they stand there. An
empty table gives no rows. Only ``text`` and ``lang`` are read, so further columns do no harm. Counts are exact
below 2**53 within a task and 2**63 in all.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brookmark.llm.text import LOWER, UPPER, batch_of, map_batches, mix, raw, rolling, small_batches, staged, word_hashes

#: Lower-cases, turns all that parts pieces into line ends and tabs into spaces (fixed values of the contract).
_ENDS = ".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans((UPPER + "\t" + _ENDS).encode(), (LOWER + " " + "\n" * len(_ENDS)).encode())
#: Words a task works on at a time.
_AT_ONCE = 1_000_000


def chunks(texts: list[bytes | None], most: int, spacing: int) -> Iterator[tuple[int, int, bytes]]:
    """(row, owned words, words) of every chunk of the texts; shared words follow the owned ones."""
    words: list[bytes] = []
    firsts, rows = [], []
    for row, text in enumerate(texts):
        for piece in (text or b"").translate(_TABLE).split(b"\n"):
            own = piece.split()
            if own:
                firsts.append(len(words))
                rows.append(row)
                words.extend(own)
    if not words:
        return
    shared = most - 1
    begins = np.zeros(len(words), bool)
    if shared:
        triggers = rolling(word_hashes(words), shared) % np.uint64(spacing) == 0
        begins[: len(triggers)] = triggers
    else:
        begins[:] = True
    firsts = np.array(firsts)
    ends = np.r_[firsts[1:], len(words)]
    for back in range(1, max(shared, 1)):  # a trigger that would cross the end of its piece is none
        begins[np.maximum(ends - back, 0)] = False
    begins[firsts] = True
    starts = np.flatnonzero(begins)
    piece = np.searchsorted(firsts, starts, "right") - 1
    own_end = np.r_[starts[1:], len(words)]
    all_end = np.minimum(own_end + shared, ends[piece])
    for a, b, c, p in zip(starts.tolist(), own_end.tolist(), all_end.tolist(), piece.tolist()):
        yield rows[p], b - a, b" ".join(words[a:c])


def parse(docs: DataFrame, most: int = 4, spacing: int = 12) -> DataFrame:
    """(lang, own, words, times): distinct chunks, how many of their words they own, and how often they occur."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs = raw(batch.column("lang"))
        seen = Counter((langs[row], own, words) for row, own, words in chunks(raw(batch.column("text")), most, spacing))
        lang, own, words = zip(*seen) if seen else ((), (), ())
        return batch_of(
            lang=pa.array(lang, pa.binary()).cast(pa.string()), own=pa.array(own, pa.int32()),
            words=pa.array(words, pa.binary()).cast(pa.string()), times=pa.array(seen.values(), pa.int64()),
        )

    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    found = map_batches(rows, run, "lang string, own int, words string, times long")
    return found.groupBy("lang", "own", "words").agg(F.sum("times").alias("times"))


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches put together until they hold about a million words."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += pc.sum(batch.column("own")).as_py() or 0
        if size >= _AT_ONCE:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _one(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


class FrequentMap:
    """Bits of the hashes of frequent phrases; phrases that are not in it are not frequent."""

    def __init__(self, bits: int, data: np.ndarray):
        self.bits, self.data = bits, data

    def has(self, keys: np.ndarray) -> np.ndarray:
        slot = keys >> np.uint64(64 - self.bits)
        return (self.data[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0


def phrase_keys(langs: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n words (given by hashes) with the language that stands at its first word."""
    runs = rolling(h, n)
    return mix(langs[: len(runs)], runs)


def _coded(column: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Codes, distinct values and their hashes of a string column."""
    coded = column.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary, word_hashes(raw(coded.dictionary))


def frequent_map(frequent: DataFrame, n: int, map_bits: int = 30, block_bits: int = 16) -> FrequentMap:
    """Bit map of phrases of n words; the driver puts together blocks of 8 kB, 2**map_bits bits at most."""
    rows = frequent.count()
    bits = min(max((16 * rows).bit_length(), block_bits), map_bits)

    def slots(batch: pa.RecordBatch) -> pa.RecordBatch:
        _, langs, lang_hashes = _coded(batch.column("lang"))
        codes = pc.index_in(batch.column("lang"), langs).to_numpy(zero_copy_only=False)
        flat = pc.split_pattern(batch.column("phrase"), " ").flatten()
        h = word_hashes(raw(flat))
        at = np.arange(batch.num_rows) * n
        keys = mix(lang_hashes[codes], rolling(h, n)[at])
        slot = (keys >> np.uint64(64 - bits)).astype(np.int64)
        return batch_of(block=slot >> block_bits, at=(slot & ((1 << block_bits) - 1)).astype(np.int32))

    def fill(batch: pa.RecordBatch) -> pa.RecordBatch:
        blocks = []
        for ats in batch.column("ats"):
            own = np.zeros(1 << block_bits, np.uint8)
            own[ats.values.to_numpy()] = 1
            blocks.append(np.packbits(own, bitorder="little").tobytes())
        return batch_of(block=batch.column("block"), data=pa.array(blocks, pa.binary()))

    placed = map_batches(frequent.select("lang", "phrase"), slots, "block long, at int")
    # a block has 2**block_bits different places at most
    dense = placed.groupBy("block").agg(F.collect_set("at").alias("ats"))
    data = np.zeros(1 << (bits - 3), np.uint8)
    step = 1 << (block_bits - 3)
    for r in map_batches(dense, fill, "block long, data binary").toLocalIterator():
        data[r["block"] * step : (r["block"] + 1) * step] = np.frombuffer(r["data"], np.uint8)
    return FrequentMap(bits, data)


def count_phrases(parsed: DataFrame, n: int, most: int, before: FrequentMap | None = None) -> DataFrame:
    """(lang, phrase, f): exact counts of phrases of n words whose two longest parts may be frequent."""
    shared = parsed.sparkSession.sparkContext.broadcast(before) if before else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _gathered(batches):
            lang_codes, langs, lang_hashes = _coded(_one(table.column("lang")))
            lists = pc.split_pattern(_one(table.column("words")), " ")
            size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            codes, vocabulary, hashes = _coded(lists.flatten())
            own = _one(table.column("own")).to_numpy().astype(np.int64)
            times = _one(table.column("times")).to_numpy()
            usable = np.maximum(np.minimum(own, size - n + 1), 0)  # owned words that start a phrase of n
            first = np.cumsum(size) - size
            chunk = np.repeat(np.arange(len(size)), usable)
            at = np.arange(len(chunk)) - np.repeat(np.cumsum(usable) - usable, usable) + first[chunk]
            if shared is not None and len(at):
                keys = phrase_keys(np.repeat(lang_hashes[lang_codes], size), hashes[codes], n - 1)
                likely = shared.value.has(keys)
                keep = likely[at] & likely[at + 1]
                at, chunk = at[keep], chunk[keep]
            if not len(at):
                continue
            # exact numbers of the phrases: that of a phrase and its next word together
            number = lang_codes[chunk] * len(vocabulary) + codes[at]
            for j in range(1, n):
                number = np.unique(number, return_inverse=True)[1] * len(vocabulary) + codes[at + j]
            _, where, which = np.unique(number, return_index=True, return_inverse=True)
            total = np.bincount(which, times[chunk]).astype(np.int64)
            words = [vocabulary.take(pa.array(codes[at[where] + j])) for j in range(n)]
            yield batch_of(
                lang=langs.take(pa.array(lang_codes[chunk[where]])),
                phrase=pc.binary_join_element_wise(*words, " ") if n > 1 else words[0], f=pa.array(total),
            )

    found = parsed.select("lang", "own", "words", "times").mapInArrow(run, "lang string, phrase string, f long")
    return found.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def frequent_phrases(parsed: DataFrame, most: int, least: int, map_bits: int = 30) -> list[DataFrame]:
    """Stored (lang, phrase, f) of the phrases of 1 to ``most`` words with at least ``least`` occurrences."""
    found: list[DataFrame] = []
    for n in range(1, most + 1):
        before = frequent_map(found[-1], n - 1, map_bits) if found else None
        found.append(staged(count_phrases(parsed, n, most, before).where(F.col("f") >= least)))
    return found


def collocations(docs: DataFrame, most: int = 4, least: int = 30, top: int = 2000, cover: int = 80,
                 spacing: int = 12, map_bits: int = 30) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the best phrases of 2 to ``most`` words of each language.

    ``a`` is a phrase's count, ``l`` and ``r`` those of its two parts at the cut with the lowest score,
    floor(2000000 * a / (l + r)); the first of equal cuts counts. A phrase of which ``cover`` per cent or more
    stand inside one longer candidate is dropped.
    """
    small_batches(docs.sparkSession)
    parsed = staged(parse(docs, most, spacing))
    words = parsed.groupBy("lang").agg(F.sum(F.col("own") * F.col("times")).alias("n"))
    by_length = frequent_phrases(parsed, most, least, map_bits)
    parts = _together(by_length[:-1]).withColumnRenamed("phrase", "part")
    longer = [df.withColumn("size", F.lit(n)) for n, df in enumerate(by_length, 1) if n > 1]
    candidates = _together(longer).withColumnRenamed("f", "a")

    cut = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cut = cut.select(
        "*", F.expr("substring_index(phrase, ' ', k)").alias("left_part"), F.expr("substring_index(phrase, ' ', k - size)").alias("right_part")
    )
    left = parts.select("lang", F.col("part").alias("left_part"), F.col("f").alias("l"))
    right = parts.select("lang", F.col("part").alias("right_part"), F.col("f").alias("r"))
    scored = cut.join(left, ["lang", "left_part"]).join(right, ["lang", "right_part"]).withColumn(
        "score", F.expr("(2000000 * cast(a as decimal(19,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    )
    lowest = scored.groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))

    inner = F.expr("flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1), i -> array_join(slice(split(phrase, ' '), i, m), ' '))))")
    covered = (
        candidates.where("size > 2").select("lang", F.explode(inner).alias("phrase"), "a")
        .groupBy("lang", "phrase").agg(F.max("a").alias("cover"))
    )
    free = lowest.join(covered, ["lang", "phrase"], "left").where(
        F.col("cover").isNull() | (F.col("cover").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * cover)
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = free.select("lang", "phrase", "a", "best.*").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _together(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


def oracle_sql(most: int = 4, least: int = 30, top: int = 2000, cover: int = 80) -> str:
    lower = f"translate(coalesce(text, ''), '{UPPER}' || chr(9), '{LOWER}' || ' ')"
    return rf"""
with pieces as (
  select lang, list_filter(string_split(p, ' '), lambda x: x <> '') as w
  from (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array({lower}, '[.,;:!?\x0A-\x0D]')) as p from documents)
), starts as (select lang, w, unnest(range(1, len(w) + 1)) as i from pieces),
spans as (
  select lang, m, array_to_string(w[i : i + m - 1], ' ') as phrase from starts, range(1, {most + 1}) as t(m) where i + m - 1 <= len(w)
), counts as (select lang, m, phrase, lang || chr(31) || phrase as key, count(*) as f from spans group by all),
totals as (select lang, sum(f)::bigint as n from counts where m = 1 group by lang),
cands as (select lang, m, phrase, string_split(phrase, ' ') as w, f as a from counts where m > 1 and f >= {least}),
cuts as (
  select c.*, k, x.f as l, y.f as r, (2000000::hugeint * c.a // (x.f::hugeint + y.f))::bigint as score
  from (select *, lang || chr(31) || array_to_string(w[1:k], ' ') as lp, lang || chr(31) || array_to_string(w[k + 1:], ' ') as rp from cands, range(1, {most}) as t(k) where k < m) c
  join counts x on x.key = c.lp join counts y on y.key = c.rp
), best as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1),
inner_ones as (
  select lang, array_to_string(w[i : i + s - 1], ' ') as phrase, max(a) as cover
  from cands, range(2, {most}) as t(s), range(1, {most}) as u(i) where s < m and i + s - 1 <= m group by 1, 2
), free as (
  select b.* from best b left join inner_ones o on o.lang = b.lang and o.phrase = b.phrase
  where o.cover is null or 100 * o.cover < {cover} * b.a
), ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from free)
select ranked.lang, rank, phrase, a, l, r, n, score from ranked join totals on ranked.lang = totals.lang where rank <= {top}
"""
