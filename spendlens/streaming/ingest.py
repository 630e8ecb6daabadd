"""Incremental ingestion: what newly archived files touch is loaded again from the archive.

A batch only says which places changed. Their content is read from the archive itself, where the
latest run of each file is known, so files may arrive in any order and in any number of batches, and
a batch that runs twice changes nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens import fixed_values as V
from spendlens.operators.staging import DATASETS
from spendlens.plans.load import load_all
from spendlens.schemas import RAW
from spendlens.sources.derive import kept
from spendlens.sources.raw import billing_records, read_billing_archive, read_raw
from spendlens.sources.reports import parse_records
from spendlens.sources.tables import Warehouse

#: dataset, dt, org and stamp in the path of a file: in folders, or (flat) in its name.
_FOLDERS = r"/([^/]+)/dt=([^/]+)/org=([^/]+)/stamp=([^/]+)/[^/]+$"
_FLAT = r"/([^/]+)/dt=([^/]+)/\1_([^/]*)_(\d{8}T\d{6}Z)\.json[^/]*$"


def read_archive_stream(
    spark: SparkSession, root: str, files_per_batch: int | None = None, flat: bool = False
) -> DataFrame:
    """dataset, dt, org, stamp, line of every file that lands in the raw zone. A file whose path is
    not of the layout fails the batch."""
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    path = F.col("_metadata.file_path")
    part = [F.regexp_extract(path, _FLAT if flat else _FOLDERS, i) for i in range(1, 5)]
    unknown = F.raise_error(F.concat(F.lit("Not a path of the raw zone: "), path)).cast("string")
    return reader.load(root).select(
        F.when(part[0] == "", unknown).otherwise(part[0]).alias("dataset"),
        *(p.alias(name) for p, name in zip(part[1:], ("dt", "org", "stamp"), strict=True)),
        F.col("value").alias("line"),
    )


def touched_datasets(
    spark: SparkSession, root: str, lines: DataFrame, flat: bool = False, scratch: str | None = None
) -> dict[str, DataFrame]:
    """Staging rows of everything that the lines of a batch touch, as the whole archive has it. With a scratch
    folder activity records, read by three staging tables, and the bills' keys, read twice, are parsed once."""

    def of(kind: str) -> DataFrame:
        return lines.filter(F.col("dataset") == V.DATASETS[kind]).drop("dataset")

    records = {}
    for kind, keys in (("user_activity", ["dt", "org"]), ("user_teams", ["dt", "org"]), ("seats", ["org"])):
        places = of(kind).select(F.col("dt").cast("date").alias("dt"), "org", "stamp").distinct()
        span = places.agg(F.min("dt").alias("lo"), F.max("dt").alias("hi")).first()
        if span.lo is None:
            continue
        window = (None, None) if kind == "seats" else (span.lo, span.hi)
        whole = read_raw(spark, root, V.DATASETS[kind], *window, flat, tuple(keys))
        whole = whole.join(places.select(*keys).distinct(), keys, "left_semi")
        records[kind] = parse_records(whole, RAW[kind]).select("org", "record.*")
    if scratch and "user_activity" in records:
        records["user_activity"] = kept(records["user_activity"], f"{scratch}/records")
    bills = billing_records(of("premium_requests")).select("org", "user_login", "usage_date")
    if scratch:
        bills = kept(bills, f"{scratch}/bills")
    span = bills.agg(F.min("usage_date").alias("lo"), F.max("usage_date").alias("hi")).first()
    if span.lo is not None:
        whole = read_billing_archive(spark, root, span.lo, span.hi, flat)
        records["premium_requests"] = whole.join(bills, bills.columns, "left_semi")
    return {name: d.flatten(records[d.raw]) for name, d in DATASETS.items() if d.raw in records}


def stream_ingest(
    spark: SparkSession,
    raw_root: str,
    warehouse_root: str,
    checkpoint: str,
    files_per_batch: int | None = None,
    period: str = "day",
    flat: bool = False,
    **load_options,
):
    """Start a query that loads everything that has landed and then stops.

    A batch may hold activity without seats, so reconciliation only warns here; billing that finds no
    place is kept in `billing_orphans`.
    """
    wh = Warehouse(spark, warehouse_root, period)

    def upsert_batch(batch: DataFrame, batch_id: int) -> None:
        # the files are read once, and the load plans on the batch session with its adaptive rules
        run_id = f"batch-{batch_id}-{uuid.uuid4().hex[:8]}"
        landed = wh.run_path(run_id, "lines")
        batch.write.mode("overwrite").partitionBy("dataset").parquet(landed)
        schema = "dt string, org string, stamp string, line string, dataset string"
        lines = spark.read.schema(schema).parquet(landed)
        datasets = touched_datasets(spark, raw_root, lines, flat, wh.run_path(run_id, "touched"))
        if datasets:
            load_all(wh, datasets, strict=False, run_id=run_id, **load_options)

    return (
        read_archive_stream(spark, raw_root, files_per_batch, flat)
        .writeStream.foreachBatch(upsert_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
