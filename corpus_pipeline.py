"""From raw documents to shards of token sequences: five stages over the table ``documents``.

Each stage takes what its predecessor kept. The last one returns shards, the others documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from citypulse.llm import decontaminate, materialise, mixing, simhash, toxicity
from citypulse.llm.common import materialised, table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of severity grade 0; the model is fitted on those of ``docs`` that have labels."""
    return toxicity.accepted(docs, table(spark, sf_dir, "labels"))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component the document with the smallest doc_id."""
    return simhash.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no item of ``benchmark``."""
    return decontaminate.clean(docs, decontaminate.index_of(table(spark, sf_dir, "benchmark")))


def at_target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mixed(docs)


def as_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences in training order."""
    return materialise.shards(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("mixing", at_target_weights),
    ("token_shards", as_shards),
]

#: SQL has neither the tokeniser nor the hash of the fingerprints; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialised(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
