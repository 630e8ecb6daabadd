"""Loads: stage, merge dimensions, load facts, rebuild shares, reconcile, publish.

Each step is written before the next one reads it, so no plan grows with the number of steps and a
lost executor repeats one step at most. Nothing is published unless the reconciliation passes.
"""

from __future__ import annotations

import logging
import uuid
from datetime import UTC, date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens import fixed_values as V
from spendlens.functions.columns import to_date_key
from spendlens.operators import allocate, dimensions, distinct_users, facts, quality, runs
from spendlens.operators.staging import DATASETS, stage_typed, with_keys
from spendlens.schemas import DIMENSIONS, FACT_KEYS, STAGING
from spendlens.sources import raw
from spendlens.sources.tables import COMPRESSION, Tables, Warehouse, deal_days, rows_by_day, write_all

LOGGER = logging.getLogger(__name__)


# ------------------------------------------------------------------ windows


def reload_window(until: date, trailing_days: int = V.RELOAD_TRAILING_DAYS) -> tuple[date, date]:
    """The days a daily run loads again, both ends included: late corrections overwrite."""
    return until - timedelta(days=trailing_days), until


def backfill_window(
    as_of: date,
    since: date | None = None,
    until: date | None = None,
    default_days: int = V.BACKFILL_DAYS,
) -> tuple[date, date]:
    """A window of complete days of the past, of any length: loads are partitioned by day."""
    last_complete = as_of - timedelta(days=1)
    last = last_complete if until is None else until
    first = last - timedelta(days=default_days) if since is None else since
    if not first <= last <= last_complete:
        raise ValueError(f"{first} to {last} is not a window of days before {as_of}.")
    return first, last


def in_window(datasets: dict[str, DataFrame], since: date, until: date) -> dict[str, DataFrame]:
    """The dated datasets cut to a window; seats describe the present and pass whole."""

    def cut(df: DataFrame) -> DataFrame:
        name = next((c for c in ("activity_date", "usage_date") if c in df.columns), None)
        if name is None:
            return df
        return df.filter(F.col(name).between(F.lit(str(since)).cast("date"), F.lit(str(until)).cast("date")))

    return {name: cut(df) for name, df in datasets.items()}


# ------------------------------------------------------------------ sources


def datasets_from_raw(
    spark: SparkSession,
    root: str,
    since: date | None = None,
    until: date | None = None,
    flat: bool = False,
    scratch: str | None = None,
) -> dict[str, DataFrame]:
    """Replay: the archive's window through the flatteners, latest run of each file.

    Three staging tables come from the activity records; with a scratch folder these are parsed
    once and kept there in columns instead of being parsed three times.
    """
    records = {
        kind: raw.read_records(spark, root, kind, None if kind == "seats" else since, until, flat)
        for kind in ("user_activity", "user_teams", "seats")
    }
    records["premium_requests"] = raw.read_billing_archive(spark, root, since, until, flat)
    if scratch:
        parsed = records["user_activity"]
        parsed.write.mode("overwrite").options(**COMPRESSION).parquet(scratch)
        records["user_activity"] = spark.read.schema(parsed.schema).parquet(scratch)
    return {name: d.flatten(records[d.raw]) for name, d in DATASETS.items()}


# ------------------------------------------------------------------ the load


def _utc_now() -> str:
    return datetime.now(UTC).strftime("%Y-%m-%d %H:%M:%S")


def load_all(
    wh: Warehouse,
    datasets: dict[str, DataFrame],
    strict: bool = True,
    loaded_at: str | None = None,
    basis: tuple[str, ...] = ("interactions", "generations"),
    fallback: str | None = "equal",
    replace_window: tuple[date, date] | None = None,
    cost_centers: DataFrame | None = None,
    run_id: str | None = None,
) -> dict[str, int]:
    """Load datasets into the warehouse, all or nothing, and return the reconciliation counts.
    Billing rows that a non-strict load cannot place are kept in `billing_orphans`.

    Loading the same data again changes nothing but `loaded_at`; corrected rows overwrite; rows the
    source withdrew stay unless `replace_window` (first and last day) empties those days first, days
    without any new row included.
    """
    run_id = run_id or uuid.uuid4().hex
    loaded_at = loaded_at or _utc_now()
    stored = wh.tables(new=True)

    plans = stage_typed(datasets)
    write_all(
        lambda n=name, d=df: wh.write_run(run_id, f"stg_{n}", d) for name, df in plans.items()
    )
    staged = {n: with_keys(wh.read_run(run_id, f"stg_{n}", STAGING[n]), n) for n in STAGING}

    def merge_dimension(name: str) -> None:
        def keep(new_rows: DataFrame) -> DataFrame:
            wh.write_run(run_id, f"new_{name}", new_rows)
            return wh.read_run(run_id, f"new_{name}", new_rows.schema)

        merged = dimensions.MERGES[name](staged, stored[name], keep)
        if name == "dim_user" and cost_centers is not None:
            merged = dimensions.set_cost_center(merged, cost_centers)
        wh.write_run(run_id, name, merged)

    write_all(lambda n=name: merge_dimension(n) for name in dimensions.MERGES)
    dims = _checked(wh, run_id, staged, {name: wh.read_run(run_id, name) for name in DIMENSIONS})

    counts: dict[str, int] = {}

    def reconcile() -> None:
        """Runs beside the fact loads: they write to this run's folders, which nothing publishes if it fails."""
        counts.update(quality.reconcile(staged, dims).first().asDict())
        for warning in quality.check_load(counts, strict):
            LOGGER.warning(warning)

    emptied = [] if replace_window is None else wh.periods_between(*map(to_date_key, replace_window))
    touched: dict[str, list[int] | None] = {}

    def load_fact(table: str) -> None:
        rows, keys = staged[_SOURCE[table]], FACT_KEYS[table]
        days = rows_by_day(rows)
        touched[table] = sorted({*wh.periods(days), *emptied})
        target = wh.in_periods(stored[table], touched[table])
        if target.isEmpty() and facts.near_grain(rows, keys):
            grain = facts.LOADS[table](
                staged, dims, lambda df: deal_days(df.withColumn(wh.partition, wh.period()), keys, days)
            )
            wh.write_run(run_id, table, facts.stamp(grain, table, loaded_at), dealt=True)
            return
        source = facts.stamp(facts.LOADS[table](staged, dims), table, loaded_at)
        if replace_window is not None:
            target = target.filter(~F.col("date_key").between(*map(to_date_key, replace_window)))
        merge = facts.insert_only if table == "fact_user_team_day" else facts.upsert
        wh.write_run(run_id, table, merge(target, source, keys))

    def load_editors() -> None:
        """The shares only need the editors' own fact, so they do not wait for the others."""
        load_fact("fact_user_ide_day")
        shared = _rebuild_shares(
            wh, run_id, stored, staged, touched["fact_user_ide_day"], loaded_at, basis, fallback, replace_window
        )
        if shared is not None:
            touched["fact_user_ide_share"] = shared

    others = [t for t in facts.LOADS if t != "fact_user_ide_day"]
    write_all([reconcile, load_editors, *(lambda t=table: load_fact(t) for table in others)])
    touched["fact_spend_shares"] = _share_spend(wh, run_id, stored, touched, loaded_at)
    touched |= _mark_users(wh, run_id, stored, touched, dims["dim_user"])
    lost = quality.orphans(staged["premium_requests"], dims, "premium_requests")
    if counts["orphaned_billing"]:
        wh.write_run(run_id, "billing_orphans", runs.orphan_rows(lost, run_id, loaded_at))
        touched["billing_orphans"] = None
    wh.publish(run_id, {**dict.fromkeys(DIMENSIONS), **touched})
    wh.end_run(run_id)
    return counts


_SOURCE = {
    "fact_premium_requests": "premium_requests",
    "fact_user_day": "user_day",
    "fact_user_ide_day": "user_ide",
    "fact_user_model_feature_day": "user_model_feature",
    "fact_user_team_day": "user_teams",
}


def _checked(wh: Warehouse, run_id: str, staged: dict[str, DataFrame], dims: dict[str, DataFrame]) -> dimensions.Checked:
    """The dimensions with what each dataset lacks in them, for the facts, the reconciliation and the orphans."""
    lists: list[tuple[DataFrame, dict[str, DataFrame]]] = []

    def check(dataset: str) -> None:
        def keep(keys: DataFrame) -> DataFrame:
            wh.write_run(run_id, f"lacking_{dataset}", keys)
            return wh.read_run(run_id, f"lacking_{dataset}", keys.schema)

        lists.append((staged[dataset], dimensions.list_lacking(staged[dataset], dims, facts.CHECKED[dataset], keep)))

    write_all(lambda d=dataset: check(d) for dataset in facts.CHECKED)
    return dimensions.Checked(dims, lists)


def _rebuild_shares(
    wh: Warehouse, run_id: str, stored: Tables, staged, touched: list[int], loaded_at: str, basis, fallback, window
) -> list[int] | None:
    """Write this run's shares of the user-days with staged editors, and of the emptied days, into the
    partitions that the run's editor facts replace; other user-days of these keep theirs, and other
    partitions are not read. Without such a partition the stored shares stay as they are."""
    if not touched:
        return None
    editors = wh.read_run(run_id, "fact_user_ide_day")
    kept = wh.in_periods(stored.fact_user_ide_share, touched)
    groups = staged["user_ide"].select(*allocate.USER_DAY)
    if window is not None:
        in_window = F.col("date_key").between(*map(to_date_key, window))
        groups = groups.union(editors.filter(in_window).select(*allocate.USER_DAY))
        kept = kept.filter(~in_window)
    if wh.in_periods(stored.fact_user_ide_day, touched).isEmpty() and kept.isEmpty():
        # every editor of the run's facts was staged by it
        dealt = deal_days(editors, allocate.USER_DAY, rows_by_day(editors))
        shares = allocate.ide_share(dealt, basis=basis, fallback=fallback, dealt=True)
        wh.write_run(run_id, "fact_user_ide_share", facts.stamp(shares, "fact_user_ide_share", loaded_at), dealt=True)
        return touched
    groups = groups.distinct()
    kept = kept.join(groups, allocate.USER_DAY, "left_anti")
    changed = editors.join(groups, allocate.USER_DAY, "left_semi")
    shares = allocate.ide_share(changed, basis=basis, fallback=fallback)
    shares = facts.stamp(shares, "fact_user_ide_share", loaded_at)
    wh.write_run(run_id, "new_shares", shares)
    shares = wh.read_run(run_id, "new_shares", shares.schema)
    wh.write_run(run_id, "fact_user_ide_share", kept.select(*shares.columns).unionByName(shares))
    return touched


def _current(
    wh: Warehouse, run_id: str, stored: Tables, touched: dict[str, list[int]], table: str, periods: list[int]
) -> DataFrame:
    """A fact in these periods, as the run leaves it."""
    rest = wh.in_periods(stored[table], [p for p in periods if p not in touched.get(table, ())])
    return rest if table not in touched else wh.read_run(run_id, table).unionByName(rest)


def _mark_users(
    wh: Warehouse, run_id: str, stored: Tables, touched: dict[str, list[int]], users: DataFrame
) -> dict[str, list[int]]:
    """Bitmaps of the users of all periods in which the run wrote billing or editors."""
    sources = distinct_users.SOURCES.values()
    periods = sorted({p for table in sources for p in touched.get(table, ())})
    found = {table: _current(wh, run_id, stored, touched, table, periods) for table in sources}
    return distinct_users.rewrite(wh, run_id, found, users, periods)


def rebuild_bitmaps(wh: Warehouse, run_id: str, since=None, until=None) -> None:
    """Store the bitmaps of the periods of a window, or of all: for a star schema that was loaded without."""
    T = wh.tables()
    found = {t: T[t] for t in distinct_users.SOURCES.values()}
    days = [allocate.between(fact, since, until).select("date_key") for fact in found.values()]
    periods = wh.periods(reduce(DataFrame.union, days))
    found = {t: wh.in_periods(fact, periods) for t, fact in found.items()}
    publish = distinct_users.rewrite(wh, run_id, found, T.dim_user, periods)
    if publish:
        wh.publish(run_id, publish)


def _share_spend(
    wh: Warehouse, run_id: str, stored: Tables, touched: dict[str, list[int]], loaded_at: str
) -> list[int]:
    """Put the shares beside the billing rows of all partitions in which the run wrote billing, editor
    shares or features; return these partitions."""
    sources = ("fact_premium_requests", "fact_user_ide_share", "fact_user_model_feature_day")
    periods = sorted({p for table in sources for p in touched.get(table, ())})

    billing, editors, used = (_current(wh, run_id, stored, touched, table, periods) for table in sources)
    rows = facts.stamp(allocate.with_shares(billing, editors, used), "fact_spend_shares", loaded_at)
    wh.write_run(run_id, "fact_spend_shares", rows, dealt=True)
    return periods


def rebuild_shares(wh: Warehouse, since, until, run_id: str, loaded_at: str | None = None,
                   basis=("interactions", "generations"), fallback: str | None = "equal") -> None:
    """Recompute stored shares of a window, for instance after changing the weighting."""
    T, loaded_at = wh.tables(), loaded_at or _utc_now()
    shares = allocate.ide_share(T.fact_user_ide_day, since, until, basis, fallback)
    shares = facts.stamp(shares, "fact_user_ide_share", loaded_at)
    editors = allocate.between(T.fact_user_ide_day, since, until)
    periods = wh.periods(editors.select("date_key").union(
        allocate.between(T.fact_user_ide_share, since, until).select("date_key")
    ))
    outside = ~F.col("date_key").between(to_date_key(since), to_date_key(until))
    kept = wh.in_periods(T.fact_user_ide_share, periods).filter(outside)
    wh.write_run(run_id, "fact_user_ide_share", kept.select(*shares.columns).unionByName(shares))
    touched = {"fact_user_ide_share": periods}
    touched["fact_spend_shares"] = _share_spend(wh, run_id, T, touched, loaded_at)
    wh.publish(run_id, touched)
    wh.end_run(run_id)


def reload(wh: Warehouse, datasets, until: date, trailing_days=V.RELOAD_TRAILING_DAYS, **options):
    """Load the trailing window again."""
    return load_all(wh, in_window(datasets, *reload_window(until, trailing_days)), **options)


def run_ingestion(
    wh: Warehouse,
    raw_root: str,
    since: date,
    until: date,
    trigger_source: str = "timer",
    strict: bool = True,
    flat: bool = False,
    replace_window: bool = False,
    orgs: tuple[str, ...] = (),
) -> dict[str, int]:
    """One logged run: replay the archive's window into the warehouse. Each of the named
    organisations must have a usable seat in a strict run; `replace_window` also takes back what
    the source withdrew from these days."""
    run_id, started = uuid.uuid4().hex, _utc_now()

    def log(status: str, counts=None, message=None) -> None:
        entry = runs.log_entry(
            wh.spark, run_id, _utc_now() if status != V.RUNNING else started, started, status,
            since, until, trigger_source, counts, message,
        )
        wh.append("ingestion_run", entry)

    log(V.RUNNING)
    try:
        scratch = wh.run_path(run_id, "records")
        datasets = datasets_from_raw(wh.spark, raw_root, since, until, flat, scratch)
        if orgs:
            asked = wh.spark.createDataFrame([(o,) for o in orgs], "org_login string")
            bare = quality.seat_guard(datasets["seats"], asked, strict)
            some = [r.org_login for r in bare.limit(quality.EXAMPLES).collect()]
            if some:
                LOGGER.warning("no usable seat in, for example: %s", ", ".join(some))
        window = (since, until) if replace_window else None
        counts = load_all(wh, datasets, strict, run_id=run_id, replace_window=window)
    except Exception as exc:
        log(V.FAILED, message=runs.safe_error(exc))
        raise
    log(V.SUCCEEDED, counts)
    return counts
