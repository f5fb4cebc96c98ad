"""The corpus pipeline: five stages over ``documents``, each written as Parquet for the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandmill.llm import language_id
from strandmill.llm.common import shared_dir, table
from strandmill.llm.decontamination import without_leaks
from strandmill.llm.line_dedup import line_dedup
from strandmill.llm.ngram_join import ngram_join
from strandmill.llm.packing import best_fit_packing


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: null, empty, or without a letter. Ambiguous ones stay. Where
    no row has a language to learn from, none is known and all go. As in all stages but the last, the columns of documents
    are kept and further ones go; repeated rows stay; an empty table gives no row."""
    model = language_id.train(docs.where(~language_id.held_out("doc_id")))
    return language_id.predict(docs, model, keep=["text", "lang", "source", "n_chars"]).where(F.col("lang_pred") != language_id.UNDETERMINED).select("doc_id", "text", "lang", "source", "n_chars")


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out lines that match an earlier one; n_chars follows the text. No document goes; null
    texts stay null, with a null n_chars."""
    return line_dedup(docs).withColumn("n_chars", F.length("text").cast("long")).select("doc_id", "text", "lang", "source", "n_chars")


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of smallest id of each component of linked documents. Documents without
    an id stay and link nothing."""
    kept = ngram_join(docs.where("doc_id is not null")).where("doc_id = component_id").select("doc_id").distinct()
    return docs.join(kept, "doc_id", "left_semi").unionByName(docs.where("doc_id is null"))


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item. Null and empty texts hold none; without items every
    document stays."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences: see :func:`best_fit_packing`. Null and empty texts
    are one piece of one token."""
    return best_fit_packing(docs)


STAGES = [
    ("language_id", known_language),
    ("line_dedup", distinct_lines),
    ("ngram_join", one_of_near_copies),
    ("decontamination", uncontaminated),
    ("packing", packed),
]

#: SQL cannot express the stages; tests/llm compares them with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    base = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
