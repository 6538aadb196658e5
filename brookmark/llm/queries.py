"""Registered queries of the operators here, as their contracts fix the columns, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from brookmark.llm import (
    automata, bpe, brown, crf, decontaminate, lineindex, linkgraph, phrases, prefixtree, rules, sketch, toolcalls, whitening,
)
from brookmark.llm.text import fold_of, read

RANKS = "byte_bpe_multi_50k.tiktoken"


def sha_of(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judge(read(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.col("quality").alias("posterior"),
    )


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    field = crf.learn(docs, labels.where(fold_of(F.col("doc_id")) != 0))
    return crf.score(docs, field).select(
        "doc_id", (fold_of(F.col("doc_id")) == 0).alias("held_out"), "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).cast("int").alias("predicted"),
    )


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkgraph.judge(read(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op4_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = toolcalls.dialogue_calls(read(spark, sf_dir, "conversations"))
    linked = toolcalls.link(calls, results, toolcalls.ASK).select(
        "conv_id", "call_id", F.lit(False).alias("orphan"), "depth", "answered", "valid", sha_of(F.col("json")).alias("json_sha256")
    )
    orphans = toolcalls.first_of(toolcalls.orphans(calls, results), "content").select(
        "conv_id", "call_id", F.lit(True).alias("orphan"), F.lit(None).cast("long").alias("depth"), F.lit(None).cast("boolean").alias("answered"),
        F.lit(None).cast("boolean").alias("valid"), sha_of(F.col("content")).alias("json_sha256"),
    )
    return linked.unionByName(orphans)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = automata.remove_repeats(read(spark, sf_dir, "documents"))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda total, span: total + span["end"] - span["start"])
    return cut.select("doc_id", "n_words", gone.alias("n_removed"), sha_of(F.col("text")).alias("kept_sha256"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = lineindex.dedup_lines(read(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_lines", "n_dropped", sha_of(F.col("text")).alias("kept_sha256"))


def rank_file(name: str = RANKS) -> bytes:
    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    digests = ("n_tokens", "ids_sha256", "decoded_sha256")
    return bpe.encode(docs, rank_file(), public_tokenizers.PATTERN, digests).drop("text")


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = brown.score(read(spark, sf_dir, "documents"), fold_of(F.col("doc_id")) != 1)
    return scored.select(
        "doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"
    )


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtree.classes(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontaminate.contamination(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    return judged.select(
        "doc_id", "n_words", F.size("hit_words").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        sha_of(F.array_join("items", ",")).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"),
    )


def op11_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sketch.compare_edits(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    own, changed, after = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return found.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), sha_of(F.col("edited")).alias("edited_sha256"),
        sketch.fingerprint(own).alias("fingerprint"), sketch.fingerprint(changed).alias("edited_fingerprint"),
        sketch.resemblance(own, changed).alias("near_edited"), sketch.resemblance(own, after).alias("near_next"),
    )


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(read(spark, sf_dir, "embeddings"))
    return white.withColumn("deviation", F.expr("try_cast(deviation as long)"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_url_filters": op3_url_filters,
    "op4_tool_calls": op4_tool_calls,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_line_dedup": op6_line_dedup,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_ngram_jaccard_join": op9_ngram_jaccard_join,
    "op10_decontamination": op10_decontamination,
    "op11_document_fingerprints": op11_document_fingerprints,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_embedding_whitening": op13_embedding_whitening,
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP5 = r"""
with d as (
  select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents
), windows as (
  select doc_id, i, sha256(array_to_string(w[i : i + 34], ' ')) as h from d, unnest(range(1, len(w) - 33)) as t(i) where len(w) >= 35
), hits as (select doc_id, i from (select *, count(*) over (partition by h) as n from windows) where n > 1),
gone as (select distinct doc_id, p from hits, unnest(range(i, i + 35)) as t(p)),
words as (select doc_id, p, w[p] as word from d, unnest(range(1, len(w) + 1)) as t(p))
select d.doc_id, cast(len(d.w) as bigint) as n_words, coalesce(x.n, 0) as n_removed, sha256(coalesce(x.kept, '')) as kept_sha256
from d left join (
  select words.doc_id, count(gone.p) as n, string_agg(word, ' ' order by words.p) filter (where gone.p is null) as kept
  from words left join gone on words.doc_id = gone.doc_id and words.p = gone.p group by words.doc_id
) x on d.doc_id = x.doc_id
"""

_OP6 = f"""
with lines as (
  select doc_id, i, list_extract(parts, i) as line, len(parts) as n
  from (select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents), unnest(range(1, len(parts) + 1)) as t(i)
), keyed as (
  select *, {_LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} as key from lines
), heavy as (
  select key, max(doc_id) as last_doc from keyed where length(key) >= 40
  group by key having count(distinct doc_id) >= 5
), judged as (
  select k.doc_id, k.i, k.line, h.key is not null and k.doc_id < h.last_doc as gone from keyed k left join heavy h on k.key = h.key
)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '')) as kept_sha256
from judged group by doc_id
"""

_OP9 = rf"""
with recursive d as (
  select doc_id, list_filter(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents
), grams as (
  select distinct doc_id, array_to_string(w[i : i + least(len(w), 5) - 1], ' ') as g
  from d, unnest(range(1, len(w) - least(len(w), 5) + 2)) as t(i) where len(w) > 0
), sizes as (select doc_id, count(*) as n from grams group by doc_id),
common as (
  select a.doc_id as x, b.doc_id as y, count(*) as o from grams a join grams b on a.g = b.g and a.doc_id <> b.doc_id group by all
), links as (
  select x, y from common join sizes p on p.doc_id = x join sizes q on q.doc_id = y where 100 * o >= 80 * (p.n + q.n - o)
), reach as (
  select doc_id as x, doc_id as y from d union select r.x, l.y from reach r join links l on r.y = l.x
)
select d.doc_id, coalesce(s.n, 0) as n_shingles, r.component_id
from d left join sizes s on d.doc_id = s.doc_id join (select x, min(y) as component_id from reach group by x) r on r.x = d.doc_id
"""

_OP10 = r"""
with d as (
  select doc_id, list_filter(regexp_split_to_array(LOW_TEXT, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from documents
), b as (
  select item_id, list_filter(regexp_split_to_array(LOW_TEXT, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from benchmark
), grams as (
  select distinct item_id, n, array_to_string(w[i : i + n - 1], ' ') as gram
  from (select *, least(len(w), 10) as n from b where len(w) > 0), unnest(range(1, len(w) - n + 2)) as t(i)
), lengths as (select distinct n from grams),
windows as (
  select doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') as gram
  from d, lengths, unnest(range(1, len(w) - n + 2)) as t(i) where len(w) >= n
), hits as (select w.doc_id, w.i, w.n, g.item_id from windows w join grams g on w.n = g.n and w.gram = g.gram),
words as (select doc_id, count(distinct p) as n_hit from hits, unnest(range(i, i + n)) as t(p) group by doc_id),
items as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as ids
  from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by doc_id
)
select d.doc_id, cast(len(d.w) as bigint) as n_words, coalesce(words.n_hit, 0) as n_hit, coalesce(items.n_items, 0) as n_items,
       sha256(coalesce(items.ids, '')) as items_sha256, coalesce(words.n_hit, 0) > 0 as contaminated
from d left join words on d.doc_id = words.doc_id left join items on d.doc_id = items.doc_id
""".replace("LOW_TEXT", _LOWER.format("coalesce(text, '')"))

_OP4 = """
with held as (
  select conv_id, turn, role, coalesce(text, '') as text from conversations where conv_id is not null and turn is not null
), calls as (
  select conv_id, turn, min(json_object('chars', length(text), 'text', text, 'turn', turn)) as args,
         arg_min(length(text), json_object('chars', length(text), 'text', text, 'turn', turn)) as chars, max(length(text)) as most
  from held where role = 'user' group by conv_id, turn
), answers as (
  select conv_id, turn, min(text) as content from held where role <> 'user' group by conv_id, turn
), runs as (
  select *, turn // 2 - row_number() over (partition by conv_id, turn % 2 order by turn) as run from calls
), deep as (
  select *, row_number() over same - 1 as place, lead(most) over same as next from runs
  window same as (partition by conv_id, turn % 2, run order by turn)
), cycles as (
  select *, max(case when place = 0 and next > chars then 1 else 0 end) over (partition by conv_id, turn % 2, run) as stuck from deep
)
select d.conv_id, concat(d.conv_id, '-', d.turn) as call_id, false as orphan, case when stuck = 0 then place end as depth,
       a.content is not null as answered, chars between 1 and 300 as valid,
       sha256(concat('{"arguments":', d.args, ',"id":"', d.conv_id, '-', d.turn, '","name":"ask","result":',
                     coalesce(cast(to_json(a.content) as varchar), 'null'), '}')) as json_sha256
from cycles d left join answers a on d.conv_id = a.conv_id and a.turn = d.turn + 1
union all
select a.conv_id, concat(a.conv_id, '-', a.turn - 1), true, null, null, null, sha256(a.content)
from answers a anti join calls c on a.conv_id = c.conv_id and a.turn = c.turn + 1
"""

ORACLE = {
    "op3_url_filters": linkgraph.oracle_sql(), "op4_tool_calls": _OP4, "op5_substring_dedup": _OP5, "op6_line_dedup": _OP6,
    "op9_ngram_jaccard_join": _OP9, "op10_decontamination": _OP10, "op11_document_fingerprints": sketch.oracle_sql(),
    "op12_phrase_collocations": phrases.oracle_sql(),
}
