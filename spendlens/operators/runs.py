"""Run log: append-only state changes, read as the latest state per run."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens import fixed_values as V
from spendlens.schemas import RUN_LOG

_COUNTS = (
    "rows_user_day", "rows_user_ide", "rows_model_feature", "rows_premium_requests", "rows_seats",
)


def safe_error(exc: BaseException) -> str:
    """The kind of error only: its text can hold hosts, paths and credentials."""
    return f"{type(exc).__name__} - see the job log for detail"


def log_entry(
    spark: SparkSession,
    run_id: str,
    logged_at: str,
    started_at: str,
    status: str,
    since: date | None = None,
    until: date | None = None,
    trigger_source: str = "timer",
    counts: dict[str, int] | None = None,
    message: str | None = None,
) -> DataFrame:
    """One state change of a run as a row of the run log."""
    done = status in (V.SUCCEEDED, V.FAILED)
    values = {
        "run_id": run_id,
        "logged_at": logged_at,
        "started_at": started_at,
        "completed_at": logged_at if done else None,
        "since_date": None if since is None else str(since),
        "until_date": None if until is None else str(until),
        "trigger_source": trigger_source,
        "status": status,
        **{c: (counts or {}).get(c, 0) if done else None for c in _COUNTS},
        "message": message,
    }
    schema = RUN_LOG["ingestion_run"]
    return spark.range(1).select(
        *(F.lit(values[f.name]).cast(f.dataType).alias(f.name) for f in schema.fields)
    )


def orphan_rows(orphans: DataFrame, run_id: str, logged_at: str) -> DataFrame:
    """Billing rows without a place as rows of `billing_orphans`."""
    return orphans.select(
        F.lit(run_id).alias("run_id"),
        F.lit(logged_at).cast("timestamp_ntz").alias("logged_at"),
        "usage_date", "user_login", "org_login", "product", "sku", "model_name", "net_amount",
        F.array_join("missing", ",").alias("missing"),
    )


def run_state(
    run_log: DataFrame, as_of: str, stale_after_minutes: int = V.STALE_AFTER_MINUTES
) -> DataFrame:
    """Latest state per run; a run that has been going for too long counts as abandoned."""
    names = [c for c in run_log.columns if c not in ("run_id", "logged_at")]
    latest = run_log.groupBy("run_id").agg(
        F.max_by(F.struct(*names), "logged_at").alias("s")
    )
    now = F.lit(str(as_of)).cast("timestamp_ntz")
    states = latest.select("run_id", "s.*")
    stale = (F.col("status") == V.RUNNING) & (
        F.col("started_at") < now - F.expr(f"interval {stale_after_minutes} minutes")
    )
    return states.withColumns(
        {
            "status": F.when(stale, V.ABANDONED).otherwise(F.col("status")),
            "completed_at": F.when(stale, now).otherwise(F.col("completed_at")),
            "message": F.when(stale, "Abandoned: ran too long without completing.").otherwise(
                F.col("message")
            ),
        }
    )


def recent_runs(states: DataFrame, n: int = 5) -> DataFrame:
    return (
        states.select(
            "run_id", "completed_at", "since_date", "until_date", "trigger_source", "status",
            "rows_user_day", "rows_user_ide", "rows_premium_requests", "message", "started_at",
        )
        .orderBy(F.desc("started_at"), F.desc("run_id"))
        .limit(n)
        .drop("started_at")
    )


def ingestion_stalled(states: DataFrame, as_of: str, hours: int = V.STALLED_HOURS) -> DataFrame:
    """One row: whether no run has succeeded inside the window."""
    now = F.lit(str(as_of)).cast("timestamp_ntz")
    recent = (F.col("status") == V.SUCCEEDED) & F.col("completed_at").between(
        now - F.expr(f"interval {hours} hours"), now
    )
    return states.agg((F.count_if(recent) < 1).alias("stalled"))
