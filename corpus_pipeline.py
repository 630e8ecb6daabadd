"""The corpus pipeline: five operators of spendlens.llm, one after the other, over all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spendlens.llm import decontamination, mixing, ngram_join, quality_rules, substring_dedup
from spendlens.llm.components import written


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; lines above the limit go from the others."""
    return quality_rules.keep_good(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 80 % of their word 5-grams the one with the least doc_id stays."""
    return ngram_join.one_of_each(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 20 words and more that occur earlier go; a text is its kept words."""
    return substring_dedup.remove_repeats(docs).select(*docs.columns)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontamination.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often the mix takes each document."""
    return mixing.digest(docs)


STAGES = [
    ("quality rules", good),
    ("n-gram Jaccard join", one_of_each),
    ("substring dedup", without_repeats),
    ("benchmark decontamination", uncontaminated),
    ("mixing sources", mixed),
]

#: The pairs of the join, the windows of the dedup and the draws of the mix are not SQL; the stages
#: have brute-force tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
