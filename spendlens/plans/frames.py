"""Report pages: the frames behind each visual."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendlens.functions import columns as C
from spendlens.operators.allocate import between
from spendlens.plans import measures as M
from spendlens.plans.views import allocated_rows, allocated_totals, attach, inactive_seats


# ------------------------------------------------------------------ executive summary


def spend_by(T, column: str, since=None, until=None) -> DataFrame:
    """Exact spend by date, model or cost center."""
    return M.exact_measures(T, [column], ["total_spend"], since=since, until=until)


def kpi_cards(T, since=None, until=None) -> DataFrame:
    """Total, active users, spend per active user, and the run rate of the last data day."""
    cards = M.exact_measures(
        T, (), ["total_spend", "active_users", "spend_per_active_user"], since=since, until=until
    )
    series = M.spend_over_time(T, (), since, until)
    last = series.agg(F.max_by("run_rate_monthly", "usage_date").alias("run_rate_monthly"))
    return cards.withColumn("run_rate_monthly", last.scalar())


# ------------------------------------------------------------------ spend by user


def user_table(T, filters: dict | None = None, since=None, until=None) -> DataFrame:
    """Spend, requests and unit cost per user, sliced by month, cost center or model."""
    return M.exact_measures(
        T,
        ["user_login", "team_name"],
        ["total_spend", "premium_requests", "cost_per_premium_request"],
        filters,
        since,
        until,
    )


# ------------------------------------------------------------------ user detail


def detail_matrix(T, login: str | None = None, since=None, until=None) -> DataFrame:
    """Model -> editor family -> feature with subtotals; `level` 3 is a leaf and 0 the grand total.

    The editor share of a cell is its part in the same cell without the editor filter.
    """
    key = None if login is None else login.rstrip(" ").lower()
    path = ["model_name", "editor_family", "feature"]
    rows = allocated_totals(T, path, since, until, key)
    rolled = rows.rollup(*path).agg(
        F.sum("allocated_net_amount").cast(C.ALLOCATED_TOTAL).alias("total_spend_allocated"),
        F.sum("allocated_quantity").cast(C.ALLOCATED_TOTAL).alias("allocated_requests"),
        (3 - F.grouping("model_name") - F.grouping("editor_family") - F.grouping("feature"))
        .cast("int")
        .alias("level"),
    )
    # one row per editor family is left in each of these partitions
    whole = F.sum("total_spend_allocated").over(Window.partitionBy("level", "model_name", "feature"))
    return rolled.withColumn("editor_share_pct", C.ratio(F.col("total_spend_allocated"), whole))


def detail_cards(T, login: str, since=None, until=None) -> DataFrame:
    key = login.rstrip(" ").lower()
    exact = between(T.fact_premium_requests, since, until, key).agg(M.EXACT["total_spend"]())
    return allocated_totals(T, (), since, until, key).agg(
        exact.scalar().alias("total_spend"),
        M.ALLOCATED["unallocated_pct"]().alias("unallocated_pct"),
        M.ALLOCATED["equal_split_fallback_pct"]().alias("equal_split_fallback_pct"),
        F.lit(M.ATTRIBUTION_DISCLAIMER).alias("attribution_disclaimer"),
    )


# ------------------------------------------------------------------ optimisation


def idle_seat_table(T, as_of) -> DataFrame:
    return inactive_seats(T, as_of).select("user_login", "days_since_activity", "net_amount_30d")


def acceptance_by_editor_family(T, since=None, until=None) -> DataFrame:
    return M.engagement_measures(T, ["editor_family"], ["acceptance_rate"], since=since, until=until)


def interactions_by_feature_group(T, since=None, until=None) -> DataFrame:
    grain = between(T.fact_user_model_feature_day, since, until).groupBy("feature_key").agg(
        F.sum("user_initiated_interaction_count").alias("n")
    )
    return (
        attach(grain, T, ["feature_group"])
        .groupBy("feature_group")
        .agg(F.sum("n").alias("interactions"))
    )


# ------------------------------------------------------------------ date model


def date_model(T, since=None, until=None) -> DataFrame:
    """Every calendar day with the totals of four separate facts. Each is folded to one row per day
    before it meets the calendar, so the facts never meet each other."""

    def per_day(df: DataFrame, **aggregates) -> DataFrame:
        return df.groupBy("date_key").agg(*(a.alias(n) for n, a in aggregates.items()))

    exact = per_day(
        between(T.fact_premium_requests, since, until), spend_exact=M.EXACT["total_spend"]()
    )
    split = per_day(
        allocated_rows(T, (), since, until), spend_allocated=M.ALLOCATED["total_spend_allocated"]()
    )
    editors = per_day(
        between(T.fact_user_ide_day, since, until),
        editor_interactions=F.sum("user_initiated_interaction_count"),
    )
    features = per_day(
        between(T.fact_user_model_feature_day, since, until),
        feature_interactions=F.sum("user_initiated_interaction_count"),
    )
    spine = between(T.dim_date, since, until).select("date_key", "date", "year_month")
    for frame in (exact, split, editors, features):
        spine = spine.join(frame, "date_key", "left")
    return spine.drop("date_key")
