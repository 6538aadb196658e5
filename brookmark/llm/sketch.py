"""Document fingerprints: bottom-k sketches of shingle hashes, on DataFrame functions alone.

A sketch holds the ``k`` smallest distinct hashes of a text's word shingles, ascending. The hash of a
shingle is the first 16 hex digits of its MD5, so any engine gives the same fingerprint. The sketch of a
union is the ``k`` smallest of both sketches, so parts can be sketched apart and merged in any order.

Words are runs of anything but ``[\\x20\\x09-\\x0D]``, A-Z lower-cased. A text with fewer words than a
shingle is one shingle; null, empty and blank texts have an empty sketch. Two empty sketches are alike
(1.0), an empty and another one are not (0.0). Columns beside those asked for are never read, so extra
columns of any name do no harm.

``with_next`` puts each row beside its follower by ``doc_id``. Rows with equal ids follow the hash of their
text, rows without an id come last, in the same way; which of two rows equal in both comes first makes no
difference. Rows are dealt by quantiles of the id, so neighbours meet in one task after a single shuffle of
the texts; an id that spans several quantiles is spread over as many tasks by the hash of the text. Only the
quantiles come to the driver, and only the first row of each part is sent a second time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brookmark.llm.text import LOWER, UPPER, partitions_of

SIZE = 128
#: Hex digits of a hash in a sketch.
DIGITS = 16


def words_of(text: Column) -> Column:
    plain = F.translate(F.coalesce(text, F.lit("")), UPPER + "\t\n\x0b\x0c\r", LOWER + "     ")
    return F.array_remove(F.split(plain, " "), "")


def shingle_hashes(text: Column, words: int = 5) -> Column:
    """Hashes of all shingles in order; a text with no words has none."""

    def of(own: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(own) - words, F.lit(0)))
        # concat_ws passes over the nulls that stand behind the last word
        shingle = lambda i: F.concat_ws(" ", *[F.get(own, i + j) for j in range(words)])
        hashed = F.transform(starts, lambda i: F.substring(F.md5(shingle(i)), 1, DIGITS))
        return F.when(F.size(own) > 0, hashed).otherwise(F.array().cast("array<string>"))

    # bound as a lambda's variable, the words are split once and not once a shingle
    return F.transform(F.array(words_of(text)), of)[0]


def smallest(hashes: Column, k: int = SIZE) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def sketch(text: Column, k: int = SIZE, words: int = 5) -> Column:
    return smallest(shingle_hashes(text, words), k)


def merge(a: Column, b: Column, k: int = SIZE) -> Column:
    """Sketch of the union of two sketched sets."""
    return smallest(F.concat(a, b), k)


def resemblance(a: Column, b: Column, k: int = SIZE) -> Column:
    """Estimated share of the union's shingles that both have; exact where the union has at most k."""

    def share(union: Column) -> Column:
        both = F.array_intersect(F.array_intersect(union, a), b)
        return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(F.size(both) / F.size(union))

    return F.transform(F.array(merge(a, b, k)), share)[0]


def distinct_count(own: Column, k: int = SIZE) -> Column:
    """Estimated number of distinct shingles; exact below k.

    The k-th smallest of N even hashes stands at about k / N of their range.
    """
    last = F.element_at(own, -1)
    # the leading 13 digits are 52 bits, which a double holds exactly
    place = (F.conv(F.substring(last, 1, 13), 16, 10).cast("double") + 1.0) / F.lit(float(1 << 52))
    return F.when(F.size(own) < k, F.size(own).cast("double")).otherwise(F.lit(k - 1.0) / place)


def containment(a: Column, b: Column, k: int = SIZE) -> Column:
    """Estimated share of a's shingles that b has too; an empty a is contained in all."""
    common = resemblance(a, b, k) * distinct_count(merge(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(common / distinct_count(a, k), F.lit(1.0)))


def merged(sketches: DataFrame, by: str, column: str = "sketch", k: int = SIZE) -> DataFrame:
    """(by, column): one sketch per group, from the sketches of its rows.

    Equal hashes are counted once and each task sends at most k hashes of a group, so no group is gathered.
    """
    each = sketches.select(F.col(by), F.explode(column).alias("__hash")).distinct()
    low = each.withColumn("__rank", F.row_number().over(Window.partitionBy(by).orderBy("__hash"))).where(F.col("__rank") <= k)
    found = low.groupBy(by).agg(F.sort_array(F.collect_list("__hash")).alias(column))
    groups = sketches.select(F.col(by).alias("__by")).distinct()
    joined = groups.join(found, F.col(by).eqNullSafe(F.col("__by")), "left")
    return joined.select(F.col("__by").alias(by), F.coalesce(column, F.array().cast("array<string>")).alias(column))


def _count_below(cuts: Column, steps: list[int], value: Column, or_equal: bool) -> Column:
    """How many of the ascending cuts are below a value, by halving steps."""

    def go(at: Column, step: Column) -> Column:
        cut = F.get(cuts, at + step - 1)
        return F.when(cut <= value if or_equal else cut < value, at + step).otherwise(at)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), go)


def _dealt(docs: DataFrame, parts: int) -> DataFrame:
    """(doc_id, tie, text, part): parts ascend with the id, then with the hash of the text."""
    shares = [i / parts for i in range(1, parts)]
    found = docs.agg(F.percentile_approx("doc_id", shares, 10 * parts)).first()[0] if shares else None
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    place = F.col("tie") / F.lit(float(1 << 64)) + 0.5
    cuts = sorted(found or [])
    steps = [1 << b for b in reversed(range(len(cuts).bit_length()))] or [1]
    listed = F.array(*[F.lit(c) for c in cuts]) if cuts else F.array().cast("array<long>")
    low, high = (_count_below(listed, steps, F.col("doc_id"), e) for e in (False, True))
    spread = rows.withColumns({"low": low, "high": high})
    within = F.least(F.floor(place * (F.col("high") - F.col("low") + 1)), F.col("high") - F.col("low"))
    last = F.lit(len(cuts) + 1) + F.least(F.floor(place * parts), F.lit(parts - 1))
    part = F.when(F.col("doc_id").isNull(), last).otherwise(F.col("low") + within).cast("int")
    return spread.select("doc_id", "tie", "text", part.alias("part"))


def with_next(docs: DataFrame, parts: int | None = None, derived=lambda text: {}) -> DataFrame:
    """(doc_id, text, next_text) of every row; the last row's follower is the first one.

    ``derived`` gives named columns of a text. They are worked out once a row, after the shuffle, and appear as
    ``name`` and ``next_name``.
    """
    rows = _dealt(docs, parts or partitions_of(docs.sparkSession))
    # first row of each part: two numbers a part, which follow nothing in their own part
    heads = rows.groupBy("part").agg(F.min(F.struct("doc_id", "tie")).alias("head"))
    order = Window.orderBy("part")
    ring = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.lag("part").over(order), F.last("part").over(ring))
    heads = heads.select("head.*", before.alias("before")).withColumnsRenamed({"doc_id": "head_id", "tie": "head_tie"})
    is_head = F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("tie") == F.col("head_tie"))
    copies = rows.join(F.broadcast(heads), is_head).groupBy("before").agg(F.first("text").alias("text"))
    own = rows.select("part", "doc_id", "tie", "text", F.lit(False).alias("copy"))
    none = F.lit(None)
    sent = copies.select(
        F.col("before").alias("part"), none.cast(docs.schema["doc_id"].dataType).alias("doc_id"), none.cast("long").alias("tie"),
        "text", F.lit(True).alias("copy"),
    )
    met = own.unionByName(sent).repartition("part")
    more = derived(F.col("text"))
    met = met.withColumns(more) if more else met
    line = Window.partitionBy("part").orderBy("copy", F.col("doc_id").asc_nulls_last(), "tie")
    names = ["text", *more]
    followed = met.withColumns({f"next_{n}": F.lead(n).over(line) for n in names})
    return followed.where(~F.col("copy")).select("doc_id", *names, *[f"next_{n}" for n in names])


def edited(text: Column, other: Column) -> Column:
    """A text whose second half is replaced by as much of the start of another one."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(other, F.lit(1), half))


def fingerprint(own: Column) -> Column:
    """A sketch as one string, 16 digits a hash."""
    return F.array_join(own, "")


def compare_edits(docs: DataFrame, k: int = SIZE, words: int = 5, parts: int | None = None) -> DataFrame:
    """(doc_id, text, edited, sketch, edited_sketch, next_sketch) of every row."""
    pairs = with_next(docs, parts, lambda text: {"sketch": sketch(text, k, words)})
    changed = pairs.withColumn("edited", edited(F.col("text"), F.col("next_text")))
    return changed.select("doc_id", "text", "edited", "sketch", sketch(F.col("edited"), k, words).alias("edited_sketch"), "next_sketch")


def oracle_sql(k: int = SIZE, words: int = 5) -> str:
    plain = f"translate({{}}, '{UPPER}' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '{LOWER}' || '     ')"
    own = f"list_filter(string_split({plain}, ' '), lambda x: x <> '')"

    def sketched(text: str) -> str:
        n = f"list_transform([{own.format(text)}], lambda w: case when len(w) = 0 then [] else list_transform(range(1, greatest(len(w) - {words - 1}, 1) + 1), lambda i: md5(array_to_string(w[i : i + {words - 1}], ' '))[1:{DIGITS}]) end)[1]"
        return f"list_sort(list_distinct({n}))[1:{k}]"

    def alike(a: str, b: str) -> str:
        union = f"list_sort(list_distinct(list_concat({a}, {b})))[1:{k}]"
        both = f"list_intersect(list_intersect({union}, {a}), {b})"
        return f"case when len({union}) = 0 then 1.0::double else len({both})::double / len({union}) end"

    return f"""
with d as (select doc_id, coalesce(text, '') as text from documents),
pairs as (
  select *, coalesce(lead(text) over (order by doc_id), first_value(text) over (order by doc_id)) as next_text from d
), changed as (
  select *, substr(text, 1, length(text) - length(text) // 2) || substr(next_text, 1, length(text) // 2) as edited from pairs
), sketched as (
  select doc_id, text, edited, {sketched('text')} as s, {sketched('edited')} as e from changed
), along as (
  select *, coalesce(lead(s) over (order by doc_id), first_value(s) over (order by doc_id)) as x from sketched
)
select doc_id, cast(length(text) as bigint) as n_chars, sha256(edited) as edited_sha256, array_to_string(s, '') as fingerprint,
       array_to_string(e, '') as edited_fingerprint, {alike('s', 'e')} as near_edited, {alike('s', 'x')} as near_next
from along
"""
