"""Raw zone: untouched payloads, filed by date before anything is transformed.

Written layout: ``{dataset}/dt=YYYY-MM-DD/org=NAME/stamp=YYYYMMDDTHHMMSSZ/part-*``, one JSON record
per line, so that a big organisation's day is many splits and not one long line.
Also read: the flat layout ``{dataset}/dt=YYYY-MM-DD/{dataset}_{org}_{stamp}.json`` that holds one
JSON array per file. A re-run adds files; readers take the latest stamp.

Billing is filed under the last day of its window, so a day may lie in any later folder. Beside the
datasets an index (`_usage_dates`) keeps which days each billing file holds; a read of some days opens
only the folders that hold one of them, and those with a file that the index does not know yet.
"""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens import fixed_values as V
from spendlens.functions.columns import safe_segment
from spendlens.schemas import RAW
from spendlens.session import broadcast_if_small
from spendlens.sources.reports import parse_records


def write_raw(df: DataFrame, root: str, dataset: str, stamp: str) -> None:
    """Append payloads. `df` has `dt` (date), `org` and `value` (the JSON text of one record)."""
    (
        df.select(
            "value",
            F.col("dt").cast("date").alias("dt"),
            safe_segment("org").alias("org"),
            F.lit(stamp).alias("stamp"),
        )
        .write.mode("append")
        .partitionBy("dt", "org", "stamp")
        .text(f"{root}/{dataset}")
    )
    if dataset == V.DATASETS["premium_requests"]:
        index_usage_dates(df.sparkSession, root)


def _places(dataset: str, flat: bool, path: Column) -> list[Column]:
    if not flat:
        return [F.col("dt"), F.col("org"), F.col("stamp")]
    name = rf"/{dataset}_([^/]*)_(\d{{8}}T\d{{6}}Z)\.json[^/]*$"
    return [
        F.col("dt"),
        F.regexp_extract(path, name, 1).alias("org"),
        F.regexp_extract(path, name, 2).alias("stamp"),
    ]


def _in_window(df: DataFrame, since: date | None, until: date | None) -> DataFrame:
    if since is not None:
        df = df.filter(F.col("dt") >= F.lit(since).cast("date"))
    if until is not None:
        df = df.filter(F.col("dt") <= F.lit(until).cast("date"))
    return df


def _partition_schema(flat: bool) -> str:
    return "dt date" if flat else "dt date, org string, stamp string"


def raw_lines(
    spark: SparkSession,
    root: str,
    dataset: str,
    since: date | None = None,
    until: date | None = None,
    flat: bool = False,
) -> DataFrame:
    """dt, org, stamp, line of every archived file in the window. Other dates are not listed in."""
    df = spark.read.schema(f"value string, {_partition_schema(flat)}").text(f"{root}/{dataset}")
    return _in_window(df, since, until).select(
        *_places(dataset, flat, F.col("_metadata.file_path")), F.col("value").alias("line")
    )


def raw_files(
    spark: SparkSession,
    root: str,
    dataset: str,
    since: date | None = None,
    until: date | None = None,
    flat: bool = False,
) -> DataFrame:
    """dt, org, stamp, path of the archived files, from the listing alone (no content is read)."""
    schema = (
        "path string, modificationTime timestamp, length bigint, content binary, "
        + _partition_schema(flat)
    )
    df = spark.read.format("binaryFile").schema(schema).load(f"{root}/{dataset}")
    return _in_window(df, since, until).select(
        *_places(dataset, flat, F.col("path")), "path"
    )


def read_raw(
    spark: SparkSession,
    root: str,
    dataset: str,
    since: date | None = None,
    until: date | None = None,
    flat: bool = False,
    latest_per: tuple[str, ...] = ("dt", "org"),
) -> DataFrame:
    """dt, org, stamp, line of the latest run per (dt, org); earlier runs are superseded.

    Seats describe the present, so they are read with ``latest_per=("org",)``.
    """
    newest = F.struct(*(c for c in ("dt", "stamp") if c not in latest_per))
    latest = (
        raw_files(spark, root, dataset, since, until, flat)
        .groupBy(*latest_per)
        .agg(F.max(newest).alias("newest"))
        .select(*latest_per, "newest.*")
    )
    lines = raw_lines(spark, root, dataset, since, until, flat)
    keys = ["dt", "org", "stamp"]
    return lines.join(broadcast_if_small(latest), keys, "left_semi")


def read_records(
    spark: SparkSession,
    root: str,
    kind: str,
    since: date | None = None,
    until: date | None = None,
    flat: bool = False,
) -> DataFrame:
    """Typed records of one dataset with their `org`."""
    latest_per = ("org",) if kind == "seats" else ("dt", "org")
    lines = read_raw(spark, root, V.DATASETS[kind], since, until, flat, latest_per)
    return parse_records(lines, RAW[kind]).select("org", "record.*")


# ------------------------------------------------------------------ billing


def _as_array(line: str) -> Column:
    """One record or an array of them, as the text of an array."""
    return F.when(F.trim(line).startswith("["), F.col(line)).otherwise(
        F.concat(F.lit("["), F.col(line), F.lit("]"))
    )


def _usage_date(period: str) -> Column:
    return F.to_date(F.substring(period, 1, 10))


_INDEX_SCHEMA = "dt date, file string, usage_date date"


def usage_date_index(spark: SparkSession, root: str) -> DataFrame:
    """dt, file, usage_date: the days that each indexed billing file holds, null for records without."""
    path = f"{root}/_usage_dates/{V.DATASETS['premium_requests']}"
    try:
        return spark.read.schema(_INDEX_SCHEMA).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _INDEX_SCHEMA)


def _billing_files(spark: SparkSession, root: str, since: date | None, flat: bool) -> DataFrame:
    """dt, file of the billing files, from the listing alone."""
    schema = f"path string, modificationTime timestamp, length bigint, content binary, {_partition_schema(flat)}"
    files = spark.read.format("binaryFile").schema(schema).load(f"{root}/{V.DATASETS['premium_requests']}")
    return _in_window(files, since, None).select("dt", F.col("_metadata.file_path").alias("file"))


def index_usage_dates(spark: SparkSession, root: str, flat: bool = False) -> None:
    """Index the billing files that the index does not know: those just written, or an older archive.
    A failure before this leaves files unknown, which readers open whatever they hold."""
    indexed = usage_date_index(spark, root).select("dt", "file").distinct()
    unknown = _billing_files(spark, root, None, flat).join(indexed, ["dt", "file"], "left_anti")
    folders = [r.dt for r in unknown.select("dt").distinct().collect()]
    if not folders:
        return
    name = V.DATASETS["premium_requests"]
    text = spark.read.schema(f"value string, {_partition_schema(flat)}").text(f"{root}/{name}")
    lines = text.filter(F.col("dt").isin(folders)).select("dt", F.col("_metadata.file_path").alias("file"), "value")
    records = F.from_json(_as_array("value"), "array<struct<period: string>>")
    days = (
        lines.join(unknown, ["dt", "file"], "left_semi")
        .select("dt", "file", F.explode_outer(records).alias("record"))
        .select("dt", "file", _usage_date("record.period").alias("usage_date"))
        .distinct()
    )
    days.hint("rebalance").write.mode("append").parquet(f"{root}/_usage_dates/{name}")


def billing_folders(
    spark: SparkSession, root: str, since: date | None = None, until: date | None = None, flat: bool = False
) -> list[date]:
    """The folders that can hold billing of these days: a list no longer than the calendar."""
    index = usage_date_index(spark, root)
    files = _billing_files(spark, root, since, flat)
    unknown = files.join(index.select("dt", "file").distinct(), ["dt", "file"], "left_anti")
    held = index
    if since is not None:
        held = held.filter(F.col("usage_date") >= F.lit(since).cast("date"))
    if until is not None:
        held = held.filter(F.col("usage_date") <= F.lit(until).cast("date"))
    return sorted(r.dt for r in unknown.select("dt").union(held.select("dt")).distinct().collect())


def billing_records(lines: DataFrame) -> DataFrame:
    """org, user_login, usage_date, payload from billing lines; the latest stamp of each wins.

    Whole windows are filed under their last day, so the usage date is the record's own period.
    The superseded copies are folded before the shuffle, so many copies of one day cost one row
    per input split.
    """
    both = _as_array("line")
    typed = F.from_json(both, f"array<{RAW['premium_requests']}>")
    text = F.from_json(both, f"array<{RAW['premium_requests_text']}>")
    records = (
        lines.select("org", "stamp", F.explode(F.arrays_zip(typed.alias("typed"), text.alias("text"))).alias("r"))
        .filter("r.typed is not null")
        .select(
            "org",
            "stamp",
            F.col("r.typed.user_login").alias("user_login"),
            _usage_date("r.typed.period").alias("usage_date"),
            F.struct(
                F.arrays_zip(
                    F.col("r.typed.payload.usageItems").alias("item"),
                    F.col("r.text.payload.usageItems.netAmount").alias("net_text"),
                ).alias("usageItems")
            ).alias("payload"),
        )
    )
    return (
        records.groupBy("org", "user_login", "usage_date")
        .agg(F.max_by("payload", "stamp").alias("payload"))
    )


def read_billing_archive(
    spark: SparkSession,
    root: str,
    since: date | None = None,
    until: date | None = None,
    flat: bool = False,
) -> DataFrame:
    """Billing payloads per (org, user, usage date) from all runs that hold a day of the window."""
    lines = raw_lines(spark, root, V.DATASETS["premium_requests"], since, None, flat)
    if since is not None or until is not None:
        lines = lines.filter(F.col("dt").isin(billing_folders(spark, root, since, until, flat)))
    records = billing_records(lines)
    if since is not None:
        records = records.filter(F.col("usage_date") >= F.lit(since).cast("date"))
    if until is not None:
        records = records.filter(F.col("usage_date") <= F.lit(until).cast("date"))
    return records


def expired_raw_partitions(
    spark: SparkSession,
    root: str,
    as_of: date,
    retain_days: int = V.RETAIN_DAYS,
    datasets: tuple[str, ...] = tuple(V.DATASETS.values()),
    flat: bool = False,
) -> DataFrame:
    """dataset, dt, files of the partitions that are past retention."""
    cutoff = F.date_sub(F.lit(as_of).cast("date"), retain_days)
    parts = None
    for dataset in datasets:
        files = raw_files(spark, root, dataset, flat=flat).select(
            F.lit(dataset).alias("dataset"), "dt"
        )
        parts = files if parts is None else parts.unionByName(files)
    return (
        parts.filter(F.col("dt") < cutoff)
        .groupBy("dataset", "dt")
        .agg(F.count("*").alias("files"))
    )
