"""Report files: one JSON object or array per line, gzip by extension, damaged lines tolerated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.functions.columns import strip


class UnreadableReport(RuntimeError):
    """A report file held more damaged lines than records."""


def _is_array(line: Column) -> Column:
    return line.startswith("[")


def classify(lines: DataFrame, column: str = "line") -> DataFrame:
    """Drop blank lines; add `well_formed` and the number of records the line holds."""
    line = F.col(column)
    return (
        lines.withColumn(column, strip(column))
        .filter(line != "")
        .withColumn("well_formed", F.try_parse_json(line).isNotNull())
        .withColumn(
            "records",
            F.when(~F.col("well_formed"), 0)
            .when(_is_array(line), F.json_array_length(line))
            .otherwise(1),
        )
    )


def parse_records(lines: DataFrame, schema: str, column: str = "line") -> DataFrame:
    """One `record` struct per JSON object; a line may hold one object or an array of them.

    A field of the wrong type becomes NULL and its siblings stay; an unparseable line yields no row.
    """
    line = F.col(column)
    as_array = F.when(_is_array(strip(column)), line).otherwise(
        F.concat(F.lit("["), line, F.lit("]"))
    )
    records = F.explode(F.from_json(as_array, f"array<{schema}>"))
    return lines.withColumn("record", records).drop(column).filter(F.col("record").isNotNull())


def report_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("line")
    )


def report_quality(spark: SparkSession, path: str) -> DataFrame:
    """Per file: non-blank lines, damaged lines, records, and whether the file is mostly damaged."""
    return (
        classify(report_lines(spark, path))
        .groupBy("file")
        .agg(
            F.count("*").alias("lines"),
            F.count_if(~F.col("well_formed")).alias("malformed"),
            F.sum("records").cast("bigint").alias("records"),
        )
        .withColumn("unreadable", F.col("malformed") > F.col("records"))
    )


def read_report(spark: SparkSession, path: str, schema: str, strict: bool = True) -> DataFrame:
    """Records of the report files under a path. Strict reading rejects mostly damaged files."""
    if strict:
        bad = report_quality(spark, path).filter("unreadable").limit(5).collect()
        if bad:
            files = ", ".join(row.file for row in bad)
            raise UnreadableReport(f"More damaged lines than records in: {files}")
    lines = report_lines(spark, path).filter(strip("line") != "")
    return parse_records(lines, schema).select("record.*")
