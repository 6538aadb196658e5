"""Benchmark decontamination on DataFrame functions alone.

Benchmark texts become a set of hashed word n-grams; their bytes are counted first, and only a set of
up to ``broadcast_bytes`` is broadcast (beyond it Spark joins by shuffle). Every window of every document is hashed where it
is scanned and looked up in that set; the few hits are then verified word by word against the
benchmark's own words, so hash collisions never mark anything.

Words are runs of ASCII letters and digits and of anything beyond ASCII, A-Z lower-cased. An item with
fewer words than a window is one window of its own length. Null and empty texts have no words:
such documents have no hits, such items no windows. Repeated document rows are judged each on its own
text, whatever their ids: hits are gathered under a hash of id and text. Items with the same text each count.
Further columns of any name stay, but for the three that are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookmark.llm.text import CARRIED, ascii_lower, carried, restored, staged

#: What parts words (fixed value of the contract).
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Lower-cased words of a text; null has none."""
    parts = F.split(ascii_lower(F.coalesce(text, F.lit(""))), _BETWEEN)
    return F.array_remove(parts, "")


def _windows(words: Column, n: int) -> Column:
    """The windows of n words in order, as hashes."""
    last = F.size(words) - n
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(words, i + 1, n)))


def benchmark_grams(benchmark: DataFrame, window: int = 10) -> DataFrame:
    """(n, hash, gram, item_id): every window of every item with its words."""
    items = benchmark.select("item_id", words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    n = F.least(F.size("words"), F.lit(window))
    start = F.explode(F.sequence(F.lit(1), F.size("words") - F.col("n") + 1))
    grams = items.withColumn("n", n).select("item_id", "n", "words", start.alias("at"))
    return (
        grams.select("item_id", "n", F.slice("words", F.col("at"), F.col("n")).alias("gram"))
        .distinct()
        .withColumn("hash", F.xxhash64("gram"))
    )


def _row_key(ident: str = "doc_id") -> Column:
    """Hash of a row's id and text: equal rows have equal hits, others are kept apart."""
    return F.xxhash64(ident, F.col(ident).isNull(), "text")


def _hits(docs: DataFrame, grams: DataFrame, lengths: list[int], broadcast: bool) -> DataFrame:
    """(row_key, found): the distinct (position, n, hash) of a row that look like benchmark windows."""
    words = docs.select(_row_key().alias("row_key"), words_of(F.col("text")).alias("words"))
    # all lengths in one pass, so a text is read and split once
    each = F.inline(F.array(*[F.struct(F.lit(n).alias("n"), _windows(F.col("words"), n).alias("hashes")) for n in lengths]))
    scan = words.select("row_key", each).select("row_key", "n", F.posexplode("hashes").alias("at", "hash"))
    wanted = grams.select("n", "hash").distinct()
    hit = scan.join(F.broadcast(wanted) if broadcast else wanted, ["n", "hash"])
    return hit.groupBy("row_key").agg(F.collect_set(F.struct("at", "n", "hash")).alias("found"))


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, broadcast_bytes: int = 64_000_000
) -> DataFrame:
    """Every document with what it shares with the benchmark.

    Adds ``n_words``, ``hit_words`` (sorted positions of words inside a benchmark window) and ``items``
    (sorted ids, as strings, of the items whose windows occur); other columns stay, those of the same
    names are replaced.
    """
    # the benchmark's windows, stored once; they are broadcast only where their bytes are few
    grams = staged(benchmark_grams(benchmark, window))
    size = F.sum(F.length(F.array_join("gram", " ")) * 4 + F.length(F.col("item_id").cast("string")) * 4 + 64)  # 4 bytes a character at most
    by_length = {r["n"]: r["bytes"] for r in grams.groupBy("n").agg(size.alias("bytes")).collect()}  # `window` rows at most
    plain = docs.drop("n_words", "hit_words", "items")
    if not by_length:
        return plain.withColumns({
            "n_words": F.size(words_of(F.col("text"))).cast("long"),
            "hit_words": F.array().cast("array<int>"), "items": F.array().cast("array<string>"),
        })
    small = sum(by_length.values()) <= broadcast_bytes
    seen = _hits(docs, grams, sorted(by_length), small)

    # what a found window would have to read, and whose it is
    whose = grams.groupBy("hash", "n", "gram").agg(F.collect_set(F.col("item_id").cast("string")).alias("ids"))
    whose = F.broadcast(whose) if small else whose
    claims = (
        seen.select("row_key", F.explode("found").alias("f")).select("row_key", "f.*")
        .join(whose, ["hash", "n"])
        .groupBy("row_key").agg(F.collect_list(F.struct("at", "n", "gram", "ids")).alias("claims"))
        .withColumnRenamed("row_key", "of")
    )
    rest = carried(plain, "text").withColumn("row_key", _row_key(f"{CARRIED}.doc_id"))
    joined = rest.join(claims, F.col("row_key") == F.col("of"), "left")
    split = joined.withColumn("words", words_of(F.col("text")))
    true = F.filter(F.col("claims"), lambda c: F.slice(F.col("words"), c["at"] + 1, c["n"]) == c["gram"])
    verified = split.withColumn("claims", F.coalesce(true, F.filter(F.col("claims"), lambda c: F.lit(False))))
    inside = F.flatten(F.transform("claims", lambda c: F.sequence(c["at"], c["at"] + c["n"] - 1)))
    return verified.select(
        *[F.col(c) if c == "text" else F.col(f"{CARRIED}.`{c}`").alias(c) for c in plain.columns],
        F.size("words").cast("long").alias("n_words"),
        F.coalesce(F.array_sort(F.array_distinct(inside)), F.array().cast("array<int>")).alias("hit_words"),
        F.coalesce(
            F.array_sort(F.array_distinct(F.flatten(F.transform("claims", lambda c: c["ids"])))),
            F.array().cast("array<string>"),
        ).alias("items"),
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Documents that share no window with the benchmark, with the columns they came with."""
    slim = carried(docs, "doc_id", "text")
    judged = contamination(slim, benchmark, window)
    return restored(judged.where(F.size("hit_words") == 0), docs, "doc_id", "text")


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """All documents, with the words inside benchmark windows and what stands before each cut out.

    Text between words stays as it is, except before a removed word.
    """
    judged = contamination(carried(docs, "doc_id", "text"), benchmark, window)
    between, word = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*", r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    pieces = F.regexp_extract_all(F.col("text"), F.lit(f"({between}{word})"), 1)
    tail = F.regexp_extract(F.col("text"), f"({between})$", 1)
    left = F.filter(pieces, lambda piece, i: ~F.array_contains(F.col("hit_words"), i))
    clean = F.when(F.size("hit_words") == 0, F.col("text")).otherwise(F.concat(F.array_join(left, ""), tail))
    return restored(judged.withColumn("text", clean), docs, "doc_id", "text")
