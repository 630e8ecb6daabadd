"""Report measures as named aggregates; the filter context is explicit in the arguments.

`by` names report columns; only the dimensions they need are joined. Additive measures run on fact
rows, whose sums equal those of the views.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendlens import fixed_values as V
from spendlens.functions import columns as C
from spendlens.operators.allocate import between
from spendlens.plans.views import allocated_totals, attach, exact_rows

ATTRIBUTION_DISCLAIMER = (
    "Dollars per user and per model are exact. The split by editor and feature is modelled from "
    "each user's own daily activity, because activity by editor and by model and feature is "
    "reported separately. Treat that split as an estimate, not as an audit record."
)


def _sum(name: str, decimal: str = C.TOTAL) -> Column:
    return F.sum(name).cast(decimal)


def _sum_where(condition: Column) -> Column:
    return F.sum(F.when(condition, F.col("allocated_net_amount"))).cast(C.ALLOCATED_TOTAL)


EXACT = {
    "total_spend": lambda: _sum("net_amount"),
    "gross_spend": lambda: _sum("gross_amount"),
    "discount": lambda: _sum("discount_amount"),
    "premium_requests": lambda: _sum("net_quantity"),
    "active_users": lambda: F.countDistinct("user_key"),
    "models_used": lambda: F.countDistinct("model_key"),
    "spend_per_active_user": lambda: C.ratio(_sum("net_amount"), F.countDistinct("user_key")),
    "cost_per_premium_request": lambda: C.ratio(_sum("net_amount"), _sum("net_quantity")),
}

ALLOCATED = {
    "total_spend_allocated": lambda: _sum("allocated_net_amount", C.ALLOCATED_TOTAL),
    "allocated_requests": lambda: _sum("allocated_quantity", C.ALLOCATED_TOTAL),
    "unallocated_spend": lambda: _sum_where(F.col("attribution_quality") == V.EXACT_UNALLOCATED),
    "unallocated_pct": lambda: C.ratio(
        _sum_where(F.col("attribution_quality") == V.EXACT_UNALLOCATED),
        _sum("allocated_net_amount", C.ALLOCATED_TOTAL),
    ),
    "equal_split_fallback_pct": lambda: C.ratio(
        _sum_where(F.col("weight_basis") == V.EQUAL_SPLIT),
        _sum("allocated_net_amount", C.ALLOCATED_TOTAL),
    ),
}

ENGAGEMENT = {
    "interactions": lambda: F.sum("user_initiated_interaction_count"),
    "code_generations": lambda: F.sum("code_generation_activity_count"),
    "code_acceptances": lambda: F.sum("code_acceptance_activity_count"),
    "acceptance_rate": lambda: C.ratio(
        F.sum("code_acceptance_activity_count"), F.sum("code_generation_activity_count")
    ),
    "active_users_activity": lambda: F.countDistinct("user_key"),
    "lines_added": lambda: F.sum("loc_added_sum"),
    "lines_deleted": lambda: F.sum("loc_deleted_sum"),
}


def _where(df: DataFrame, filters: dict | None) -> DataFrame:
    return reduce(lambda d, f: d.filter(F.col(f[0]) == f[1]), (filters or {}).items(), df)


def _evaluate(df: DataFrame, measures: dict[str, Callable[[], Column]], names, by) -> DataFrame:
    chosen = [measures[n]().alias(n) for n in (names or measures)]
    return df.groupBy(*by).agg(*chosen)


def exact_measures(T, by=(), names=None, filters: dict | None = None, since=None, until=None):
    rows = exact_rows(T, {*by, *(filters or {})}, since, until)
    return _evaluate(_where(rows, filters), EXACT, names, by)


def allocated_measures(T, by=(), names=None, filters: dict | None = None, since=None, until=None):
    rows = allocated_totals(T, {*by, *(filters or {})}, since, until)
    return _evaluate(_where(rows, filters), ALLOCATED, names, by)


def engagement_measures(T, by=(), names=None, filters: dict | None = None, since=None, until=None):
    rows = attach(between(T.fact_user_ide_day, since, until), T, {*by, *(filters or {})})
    return _evaluate(_where(rows, filters), ENGAGEMENT, names, by)


def editor_share(T, by=("editor_family",), filters: dict | None = None, since=None, until=None):
    """Part of each editor family in the spend of its context without the editor filter."""
    spend = allocated_measures(T, by, ["total_spend_allocated"], filters, since, until)
    context = [c for c in by if c != "editor_family"]
    # at most one row per editor family and context is left here
    whole = F.sum("total_spend_allocated").over(Window.partitionBy(*context))
    return spend.withColumn("editor_share_pct", C.ratio(F.col("total_spend_allocated"), whole))


# ------------------------------------------------------------------ time


def _daily(T, by, since, until) -> DataFrame:
    rows = exact_rows(T, {*by, "usage_date"}, since, until)
    return rows.groupBy(*by, "usage_date").agg(_sum("net_amount").alias("spend"))


def _last(T, since, until) -> Column:
    """The last data day, from the billing fact's partition column."""
    key = between(T.fact_premium_requests, since, until).agg(
        F.to_date(F.max("date_key").cast("string"), "yyyyMMdd").alias("last")
    )
    return key.scalar()


def spend_over_time(T, by=(), since=None, until=None) -> DataFrame:
    """Per day without gaps, from a group's first day to the last data day: spend, month to date,
    the day a month before, trailing 30 days, and the monthly run rate.

    Facts are folded to one row per day and group. Each such row is then stretched to the day before
    the next one, so the days in between need no calendar join, and all windows share one shuffle.
    """
    group = Window.partitionBy(*by).orderBy("usage_date")
    end = F.coalesce(F.date_sub(F.lead("usage_date").over(group), 1), _last(T, since, until))
    days = _daily(T, by, since, until).withColumn("_end", end).select(
        *by, "usage_date", "spend", F.explode(F.sequence("usage_date", "_end")).alias("_day")
    )
    # booked is NULL on days without billing; spend is zero there
    booked = F.when(F.col("_day") == F.col("usage_date"), F.col("spend"))
    series = days.select(*by, F.col("_day").alias("usage_date"), booked.alias("booked")).withColumn(
        "spend", F.coalesce("booked", F.lit(0).cast(C.TOTAL))
    )
    back = F.datediff("usage_date", F.add_months("usage_date", -1))
    month_ago = F.lit(None)
    for n in (28, 29, 30, 31):
        month_ago = F.when(back == n, F.lag("booked", n).over(group)).otherwise(month_ago)
    in_month = Window.partitionBy(*by, F.date_format("usage_date", "yyyy-MM")).orderBy("usage_date")
    rolling = F.sum("spend").over(group.rowsBetween(-(V.ROLLING_DAYS - 1), Window.currentRow))
    return series.select(
        *by,
        "usage_date",
        "spend",
        F.sum("spend").over(in_month).cast(C.TOTAL).alias("spend_mtd"),
        month_ago.cast(C.TOTAL).alias("spend_last_month"),
        rolling.cast(C.TOTAL).alias("spend_rolling_30d"),
    ).withColumn(
        "run_rate_monthly",
        F.col("spend_rolling_30d").cast("double") / V.ROLLING_DAYS * V.DAYS_IN_MONTH,
    )


def month_over_month(T, by=(), since=None, until=None) -> DataFrame:
    """Per month without gaps: spend, spend of the month before, and the relative change."""
    rows = exact_rows(T, {*by, "year_month"}, since, until)
    monthly = rows.groupBy(*by, "year_month").agg(_sum("net_amount").alias("spend"))
    monthly = monthly.withColumn("_start", F.to_date(F.concat("year_month", F.lit("-01"))))
    group = Window.partitionBy(*by).orderBy("_start")
    end = F.coalesce(F.add_months(F.lead("_start").over(group), -1), F.trunc(_last(T, since, until), "MM"))
    step = F.expr("interval 1 month")
    months = monthly.withColumn("_end", end).select(
        *by, "_start", "spend", F.explode(F.sequence("_start", "_end", step)).alias("_month")
    )
    spend = F.when(F.col("_month") == F.col("_start"), F.col("spend"))
    series = months.select(
        *by,
        F.date_format("_month", "yyyy-MM").alias("year_month"),
        F.coalesce(spend, F.lit(0).cast(C.TOTAL)).alias("spend"),
    )
    before = F.lag("spend").over(Window.partitionBy(*by).orderBy("year_month"))
    return series.withColumn("spend_last_month", before).withColumn(
        "spend_mom_pct",
        C.ratio(F.col("spend") - F.col("spend_last_month"), F.col("spend_last_month")),
    )


# ------------------------------------------------------------------ seats and freshness


def seat_measures(idle: DataFrame, by=()) -> DataFrame:
    """Idle seats and what they spent, over the idle-seat view."""
    return idle.groupBy(*by).agg(
        F.count("*").alias("idle_seats"),
        _sum("net_amount_30d").alias("idle_seat_spend_30d"),
    )


def freshness_measures(T, as_of) -> DataFrame:
    latest = T.newest("fact_premium_requests").agg(
        F.to_date(F.max("date_key").cast("string"), "yyyyMMdd").alias("latest")
    )
    return latest.select(
        F.concat(F.lit("Data through "), F.date_format("latest", "yyyy-MM-dd")).alias(
            "data_freshness"
        ),
        F.datediff(F.lit(str(as_of)[:10]).cast("date"), "latest").alias("days_since_refresh"),
        F.lit(ATTRIBUTION_DISCLAIMER).alias("attribution_disclaimer"),
    )
