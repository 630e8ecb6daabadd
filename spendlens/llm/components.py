"""Connected components of an edge list, by tables that are folded on both sides."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.session import new_folder


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows through a table in the shared folder: lineage ends there, and any executor can read them."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def files_for(rows: int, each: int) -> int:
    """How many files so many rows make; small tables in hundreds of files cost more than their rows."""
    return max(4, rows // each)


def components(edges: DataFrame) -> DataFrame:
    """node, component (its least node) of an edge list src, dst of longs; no cap on size or rounds.

    Every round replaces each node's label by the least label around it and then by that label's own
    label, so chains halve; it ends when no label moves. Edges of one node are folded to a minimum
    before they meet, so a hub costs one partial row per task. An edge list without rows gives none.
    """
    spark: SparkSession = edges.sparkSession
    both = written(
        edges.select("src", "dst").union(edges.select(F.col("dst"), F.col("src"))).filter("src <> dst").distinct(),
        "edges",
    )
    files = files_for(both.count(), 200_000)
    labels = written(
        both.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("m")).select(
            "node", F.least("node", "m").alias("component")
        ).coalesce(files),
        "labels",
    )
    while True:
        around = (
            both.join(labels, both["dst"] == labels["node"])
            .groupBy(F.col("src").alias("at"))
            .agg(F.min("component").alias("near"))
        )
        nearer = labels.join(around, labels["node"] == around["at"]).select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("near")
        )
        heads = labels.select(F.col("node").alias("head"), F.col("component").alias("of_head"))
        new = written(
            nearer.join(heads, F.col("near") == F.col("head"), "left").select(
                "node", "old", F.least("near", F.coalesce("of_head", "near")).alias("component")
            ).coalesce(files),
            "labels",
        )
        labels = new.select("node", "component")
        if not new.filter("component <> old").limit(1).count():
            return labels
