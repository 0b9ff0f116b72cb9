"""A training corpus from documents: quality classifier, quality rules, near-duplicates, decontamination, mixing.

STAGES lists the stages; run() applies them in order, each to what the stage before it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reelspark.llm import decontam, pfair_mix, quality_gbt, quality_qda, simhash_pivot
from reelspark.llm._common import materialize, ship, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the discriminant rejects go; it learns from the labelled rows of the source tables."""
    ship(spark)
    model = quality_qda.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality_qda.keep_documents(docs, model)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the boosted trees reject go."""
    ship(spark)
    forest = quality_gbt.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality_gbt.keep_documents(docs, forest)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates stays: of fingerprints within the radius, or of common segments."""
    ship(spark)
    return simhash_pivot.keep_representatives(docs, similar=simhash_pivot.SIMILAR)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    ship(spark)
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document gets its block, slot and position in the mixture of the target weights."""
    ship(spark)
    return pfair_mix.mix(docs, pfair_mix.WEIGHTS, columns=tuple(docs.columns))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
]

#: Trained models, fingerprints and a schedule: SQL can't express them. Tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
