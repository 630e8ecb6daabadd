"""Distinct users of any window, from stored bitmaps.

A load keeps, per day, source and organisation, which users were there: bitmaps over the dimension's
dense `user_sk`, 32,768 users in each. They merge by OR, so a window over a year reads a bitmap per day
and bucket instead of a year of facts, and its count is exact, as a count of distinct users over the
facts would be. Bitmaps name no user, so what a restricted reader counts is built from the facts that
the reader may see.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.operators.allocate import between
from spendlens.sources.tables import PERIODS, Tables, Warehouse, deal_days, grouped_by, rows_by_day

#: Source of a bitmap -> the fact whose users it holds.
SOURCES = {"billing": "fact_premium_requests", "activity": "fact_user_ide_day"}
_GRAIN = ("date_key", "source", "org_key")


def build(facts: dict[str, DataFrame], dim_user: DataFrame, days: dict[int, int] | None = None) -> DataFrame:
    """Bitmaps of the users in the facts (by source). What moves is a user's place in a bitmap; each bitmap
    is then made in one task. Parts of it, merged later, would each be 4 KB with a few users in it. With the
    rows of each day the places move to the parts in which the bitmaps are stored."""
    stored = PERIODS["month"]
    month = [stored] if days is not None and all(stored in fact.columns for fact in facts.values()) else []
    parts = [
        fact.select(*month, "date_key", F.lit(source).alias("source"), "org_key", "user_key")
        for source, fact in facts.items()
    ]
    numbered = reduce(DataFrame.unionByName, parts).join(dim_user.select("user_key", "user_sk"), "user_key")
    places = numbered.select(
        *month,
        *_GRAIN,
        F.bitmap_bucket_number("user_sk").alias("bucket"),
        F.bitmap_bit_position("user_sk").cast("int").alias("place"),
    )
    grain = [*_GRAIN, "bucket"]
    if days is None:
        placed = places.repartition(*grain)
    else:
        placed = deal_days(places, grain, days)
        grain = grouped_by(placed, grain)
    return placed.groupBy(*grain).agg(F.bitmap_construct_agg(F.col("place").cast("bigint")).alias("users"))


def bitmaps(T: Tables) -> DataFrame:
    """The stored bitmaps, or those of what a restricted reader sees."""
    if not T.is_restricted:
        return T.user_bitmaps
    return build({source: T[fact] for source, fact in SOURCES.items()}, T.dim_user)


def distinct_users(T: Tables, by=(), source: str = "billing", since=None, until=None) -> DataFrame:
    """users per `by` (usage_date, year_month, org_login; none for one row) in a window of days."""
    from spendlens.plans.views import attach

    if source not in SOURCES:
        raise ValueError(f"A source is one of {', '.join(SOURCES)}, not {source}.")
    rows = attach(between(bitmaps(T), since, until).filter(F.col("source") == source), T, by)
    merged = rows.groupBy(*by, "bucket").agg(F.bitmap_or_agg("users").alias("users"))
    return merged.groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count("users")), F.lit(0)).alias("users"))


def rewrite(wh: Warehouse, run_id: str, facts: dict[str, DataFrame], dim_user: DataFrame, periods: list[int]) -> dict:
    """Write the bitmaps of whole periods anew, from facts (by table) that hold these; what to publish for that."""
    if not periods:
        return {}
    days = rows_by_day(*facts.values())
    wh.write_run(run_id, "user_bitmaps", build({s: facts[t] for s, t in SOURCES.items()}, dim_user, days), dealt=True)
    return {"user_bitmaps": periods}
