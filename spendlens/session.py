"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows of a counted table up to which joins may broadcast it.
BROADCAST_ROWS = 200_000


def build_session(master: str | None = None, app: str = "spendlens", **conf) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        # call-site capture per expression costs more than small plans themselves
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder. One is made only for a local master (tests): on a cluster every
    executor would write to its own disk."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors share.")
        configured = tempfile.mkdtemp(prefix="spendlens-")
        spark.sparkContext.setCheckpointDir(configured)
        configured = spark.sparkContext.getCheckpointDir()
    return configured.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint when a count proves the side small; otherwise Spark shuffles and AQE decides."""
    small = df.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(df) if small else df
