"""A training corpus from the table of documents, in five stages.

Each stage takes the session, all documents that the stage before kept and the table folder; its result is written as Parquet and
reread as the next one's documents.  Texts, languages, copies, benchmark passages and source weights are each judged on what
is left then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakefold.llm import decontaminate, language_id, line_dedup, mixing, ngram_join
from lakefold.llm.common import table, written
from lakefold.llm.oracle import PIPELINE


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, whose language cannot be told, go; all others stay."""
    return language_id.keep_known(docs, language_id.fit(docs.select("doc_id", "text", "lang")))


def first_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a document with a smaller id has go; documents stay, also those left empty."""
    kept = line_dedup.dedup_lines(docs).drop("n_lines", "n_dropped")
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return ngram_join.first_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, numbered by ``copy``."""
    return mixing.mix(docs)


STAGES = [
    ("language_id", known_language),
    ("line_dedup", first_lines),
    ("ngram_join", one_of_each),
    ("decontaminate", without_benchmark),
    ("mix", mixed),
]

# The first stage rejects texts without a letter only, so SQL can express its decision as well.
ORACLE_SQL = PIPELINE


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
