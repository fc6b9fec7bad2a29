"""The queries of the training-data operators: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citypulse.llm import (
    collocations,
    decontaminate,
    license_scan,
    line_dedup,
    line_frequency,
    materialise,
    mixing,
    periodic,
    pii,
    preference,
    simhash,
    toxicity,
    vafile,
)
from citypulse.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation against itself with its neighbour's last answer; masks as start:end,..."""
    talks = preference.conversations(table(spark, sf_dir, "conversations"))
    pairs = preference.formatted(preference.with_swapped_answers(talks))

    def written(mask: str) -> Column:
        return F.array_join(F.transform(mask, lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias(mask)

    return pairs.select(
        "conv_id", "prompt", "prompt_turns", "chosen_completion", "rejected_completion",
        written("chosen_mask"), written("rejected_mask"), "usable",
    )


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_dedup.deduplicated(docs).select("doc_id", "text", "removed_lines")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = decontaminate.index_of(table(spark, sf_dir, "benchmark"))
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), index)


def op7_vafile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.top_k(table(spark, sf_dir, "embeddings"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, toxicity.graded(table(spark, sf_dir, "labels")))
    scored = toxicity.severity(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", "expected_severity", "grade", (F.col("grade") > 0).alias("toxic"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op10_materialise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise.shards(table(spark, sf_dir, "documents"))


def op11_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's source is its host."""
    return line_frequency.verdicts(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.periodic_runs(table(spark, sf_dir, "documents"), change=periodic.planted)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_preference,
        op2_pii,
        op3_licenses,
        op4_simhash,
        op5_line_dedup,
        op6_decontaminate,
        op7_vafile,
        op8_toxicity,
        op9_mixing,
        op10_materialise,
        op11_line_frequency,
        op12_collocations,
        op13_periodic,
    )
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)
