"""From documents to token ids: five stages over the whole corpus.

Each stage is a function of (spark, docs, sf_dir); its result is written as
Parquet into the shared folder and read again as the next one's ``docs``. All
stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowlab.llm import bpe, mil, mixing, rules, simhash
from flowlab.llm.common import stored, table
from flowlab.llm.queries import tokenizer_file
from flowlab.session import ship_package, small_batches


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    ship_package(spark)
    small_batches(spark)
    return mil.accepted(docs, table(spark, sf_dir, "labels"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the threshold table rejects go."""
    return rules.passing(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    ship_package(spark)
    small_batches(spark)
    return simhash.one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their target shares: a row per dealt piece, the
    words of a document in one drawn block, in the order of the shards."""
    ship_package(spark)
    small_batches(spark)
    return mixing.mixed_documents(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text of every row."""
    ship_package(spark)
    small_batches(spark)
    return bpe.digests(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("encoding", encoding),
]

#: SQL expresses neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
