"""One query for each operator of this folder, over the whole given tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (
    chat_format,
    collocations,
    decontamination,
    hard_negatives,
    html_extraction,
    license_scan,
    lm_score,
    mixing,
    ngram_join,
    quality_classifier,
    quality_rules,
    substring_dedup,
    suffix_dedup,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.digest(_table(spark, sf_dir, "pages"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.digest(_table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(_table(spark, sf_dir, "documents"))


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.digest(_table(spark, sf_dir, "documents"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(_table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.digest(_table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(_table(spark, sf_dir, "documents"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.digest(_table(spark, sf_dir, "conversations"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(_table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.digest(_table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.digest(_table(spark, sf_dir, "embeddings"))


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_html_extraction,
        op2_license_scan,
        op3_suffix_dedup,
        op4_lm_score,
        op5_substring_dedup,
        op6_decontamination,
        op7_quality_rules,
        op8_mixing,
        op9_chat_format,
        op10_ngram_join,
        op11_collocations,
        op12_hard_negatives,
        op13_quality_classifier,
    )
}

SQL = {
    "op2_license_scan": license_scan.SQL,
    "op7_quality_rules": quality_rules.SQL,
    "op11_collocations": collocations.SQL,
    "op12_hard_negatives": hard_negatives.SQL,
}
