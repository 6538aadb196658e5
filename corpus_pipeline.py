"""From raw documents to token ids: five stages, each over all that the one before it kept.

Each stage takes (spark, docs, sf_dir) and returns a frame, which is stored and read again as the
next one's documents. All but the last return the columns of documents; where a stage changes a
text, ``n_chars`` follows. Stages inherit the defined results of their operators for nulls, empty and
repeated rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brookmark.llm import bpe, crf, decontaminate, lineindex, prefixtree
from brookmark.llm.queries import rank_file
from brookmark.llm.text import carried, fold_of, read, restored, small_batches, staged


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field does not reject."""
    labels = read(spark, sf_dir, "labels").where(fold_of(F.col("doc_id")) != 0)
    return crf.keep_good(docs, labels)


def shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many share."""
    small_batches(spark)
    cut = restored(lineindex.dedup_lines(carried(docs, "doc_id", "text")), docs, "doc_id", "text")
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    small_batches(spark)
    return prefixtree.keep_one(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window with the benchmark."""
    return decontaminate.remove_contaminated(docs, read(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the texts, and the digest of what they decode to."""
    small_batches(spark)
    added = ("n_tokens", "ids", "decoded_sha256")
    return bpe.encode(docs, rank_file(), public_tokenizers.PATTERN, added).select("doc_id", "lang", "source", *added)


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", shared_lines),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_leaks),
    ("byte-level BPE", token_ids),
]

#: The first stage is a fitted model, which SQL does not express; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
