"""Privacy operators: row restriction, erasure, retention, pseudonyms."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens import fixed_values as V
from spendlens.functions import columns as C
from spendlens.operators import distinct_users
from spendlens.operators.allocate import between
from spendlens.schemas import FACTS
from spendlens.sources.tables import Tables, Warehouse

BILLING_FACTS = ("fact_premium_requests", "fact_spend_shares")


# ------------------------------------------------------------------ restriction


def restrict(
    dim_user: DataFrame, access: DataFrame, principal: str | None = None, is_admin: bool = False
) -> DataFrame:
    """Users a principal may see: all for an admin or a '*' grant, else those of a granted cost
    center and the principal's own row."""
    if is_admin:
        return dim_user
    who = F.current_user() if principal is None else F.lit(principal)
    grants = (
        access.filter(C.norm("principal_name") == C.norm(who))
        .select(C.norm("cost_center").alias("_center"))
        .distinct()
    )
    everything = grants.filter("_center = '*'").agg((F.count("*") > 0).alias("any")).scalar()
    marked = dim_user.join(
        grants.withColumn("_granted", F.lit(True)), C.norm("cost_center") == F.col("_center"), "left"
    )
    own = F.col("user_key") == C.norm(who)
    return marked.filter(everything | own | F.col("_granted").isNotNull()).select(*dim_user.columns)


def restricted(
    T: Tables, access: DataFrame | None = None, principal: str | None = None, is_admin: bool = False
) -> Tables:
    """The star schema as one principal sees it, by the stored grants unless others are given. Facts
    are cut to the visible users as well, so that totals that show no user are restricted too."""
    if is_admin:
        return T
    access = T.report_access if access is None else access
    return T.restricted(restrict(T.dim_user, access, principal))


def restrict_report(df: DataFrame, manager_map: DataFrame, email: str) -> DataFrame:
    """Rows of the cost centers that the map gives to this manager."""
    mine = manager_map.filter(C.norm("email") == C.norm(F.lit(email))).select(
        C.norm("cost_center").alias("_center")
    )
    return df.join(mine, C.norm(df["cost_center"]) == F.col("_center"), "left_semi")


# ------------------------------------------------------------------ erasure


def _key(login: str) -> str:
    return login.rstrip(" ").lower()


def _rows(df: DataFrame):
    return df.agg(F.count("*").alias("n")).scalar()


def erasure_preview(T, login: str) -> DataFrame:
    """What an erasure would remove; no row for an unknown user."""
    mine = F.col("user_key") == _key(login)
    return T.dim_user.filter(mine).select(
        _rows(T.fact_premium_requests.filter(mine)).alias("billing_rows"),
        _rows(T.fact_user_day.filter(mine)).alias("activity_rows"),
        _rows(T.fact_user_ide_day.filter(mine)).alias("ide_rows"),
    )


def erase_user(dim_user: DataFrame, login: str) -> DataFrame:
    """The user's row without its identity: history keeps a number, not a person."""
    mine = F.col("user_key") == _key(login)
    alias = F.concat(F.lit("erased-"), F.col("user_sk").cast("string"))
    blank = {
        name: F.when(~mine, F.col(name))
        for name in ("external_user_id", "team_name", "cost_center", "last_activity_editor")
    }
    return dim_user.withColumns(
        {
            **blank,
            "user_login": F.when(mine, alias).otherwise(F.col("user_login")),
            "user_key": F.when(mine, alias).otherwise(F.col("user_key")),
            "is_active": F.when(mine, False).otherwise(F.col("is_active")),
        }
    )


def _without(
    wh: Warehouse, run_id: str, table: str, fact: DataFrame, condition, matching: DataFrame | None = None
) -> dict[str, list[int]]:
    """Write the partitions that hold matching rows without them; what to publish for that."""
    periods = wh.periods(fact.filter(condition) if matching is None else matching)
    if not periods:
        return {}
    wh.write_run(run_id, table, wh.in_periods(fact, periods).filter(~condition))
    return {table: periods}


def _rewritten(wh: Warehouse, run_id: str, table: str, rows: DataFrame, gone, touched) -> dict[str, list[int] | None]:
    """Write a small table without the rows that go, if there are any; what to publish for that."""
    if rows.filter(gone).isEmpty():
        return {}
    wh.write_run(run_id, table, rows.filter(F.coalesce(~gone, F.lit(True))))
    return {table: touched}


def _unshared(wh: Warehouse, run_id: str, spend: DataFrame, old, matching: DataFrame) -> dict[str, list[int]]:
    """Billing that stays forgets the editors and features of the days whose activity goes."""
    periods = wh.periods(matching.filter("editors is not null or features is not null"))
    if not periods:
        return {}
    bare = {c: F.when(~old, F.col(c)) for c in ("editors", "features")}
    wh.write_run(run_id, "fact_spend_shares", wh.in_periods(spend, periods).withColumns(bare))
    return {"fact_spend_shares": periods}


def forget_user(wh: Warehouse, login: str, run_id: str, confirm: bool = False) -> DataFrame:
    """Preview, or erase: the user's rows leave all facts, the orphaned billing and the grants in one
    step, and only the partitions they are in are rewritten. The raw archive has to be cleaned separately, and the files of the version
    before go with the publication after the next."""
    T = wh.tables()
    preview = erasure_preview(T, login)
    if not confirm:
        return preview
    result = wh.spark.createDataFrame(preview.collect(), preview.schema)
    mine = F.col("user_key") == _key(login)
    wh.write_run(run_id, "dim_user", erase_user(T.dim_user, login))
    publish: dict[str, list[int] | None] = {"dim_user": None}
    for table in FACTS:
        publish |= _without(wh, run_id, table, T[table], mine)
    seen = {table: publish.get(table) or [] for table in distinct_users.SOURCES.values()}
    periods = sorted({p for own in seen.values() for p in own})
    left = {table: wh.in_periods(T[table], periods).filter(~mine) for table in seen}
    publish |= distinct_users.rewrite(wh, run_id, left, T.dim_user, periods)
    publish |= _rewritten(wh, run_id, "billing_orphans", T.billing_orphans, C.norm("user_login") == _key(login), [])
    publish |= _rewritten(wh, run_id, "report_access", T.report_access, C.norm("principal_name") == _key(login), None)
    wh.publish(run_id, publish)
    wh.end_run(run_id)
    return result


# ------------------------------------------------------------------ retention


def cutoff_date(as_of: date, retain_days: int = V.RETAIN_DAYS) -> date:
    return as_of - timedelta(days=retain_days)


def purge_preview(T, as_of: date, retain_days: int = V.RETAIN_DAYS) -> DataFrame:
    cutoff = cutoff_date(as_of, retain_days)
    last = cutoff - timedelta(days=1)
    return T.dim_date.sparkSession.range(1).select(
        F.lit(str(cutoff)).cast("date").alias("cutoff_date"),
        _rows(between(T.fact_user_day, until=last)).alias("activity_rows"),
        _rows(between(T.fact_user_ide_day, until=last)).alias("ide_rows"),
        _rows(between(T.fact_premium_requests, until=last)).alias("billing_rows"),
    )


def purge(
    wh: Warehouse,
    as_of: date,
    run_id: str,
    retain_days: int = V.RETAIN_DAYS,
    include_billing: bool = False,
    confirm: bool = False,
) -> DataFrame:
    """Preview, or drop the days before the cutoff; billing is kept unless it is asked for."""
    T = wh.tables()
    preview = purge_preview(T, as_of, retain_days)
    if not confirm:
        return preview
    result = wh.spark.createDataFrame(preview.collect(), preview.schema)
    last = cutoff_date(as_of, retain_days) - timedelta(days=1)
    old = F.col("date_key") <= C.to_date_key(last)
    publish: dict[str, list[int] | None] = {}
    for table in FACTS:
        if include_billing or table not in BILLING_FACTS:
            publish |= _without(wh, run_id, table, T[table], old, between(T[table], until=last))
    unmarked = old if include_billing else old & (F.col("source") != "billing")
    publish |= _without(wh, run_id, "user_bitmaps", T.user_bitmaps, unmarked)
    if include_billing:
        before = F.col("usage_date") <= F.lit(str(last)).cast("date")
        publish |= _rewritten(wh, run_id, "billing_orphans", T.billing_orphans, before, [])
    else:
        publish |= _unshared(wh, run_id, T.fact_spend_shares, old, between(T.fact_spend_shares, until=last))
    if publish:
        wh.publish(run_id, publish)
    wh.end_run(run_id)
    return result


# ------------------------------------------------------------------ pseudonyms


def pseudonymise(df: DataFrame, login: str, amounts: tuple[str, ...] = ()) -> DataFrame:
    """Replace logins by a stable code and amounts by whether there is one."""
    shown = {a: F.when(F.col(a).isNotNull(), "present").otherwise("absent") for a in amounts}
    return df.withColumns({login: C.pseudonym(login), **shown})
