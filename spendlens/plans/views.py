"""Reporting views over the star schema: functions from tables to a DataFrame.

`attach` joins only the dimensions whose columns are asked for, so a report pays for what it shows.
Windows and users are pushed to the facts' partition column and sort column, ahead of every join.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens import fixed_values as V
from spendlens.functions import columns as C
from spendlens.operators.allocate import between, billing_rows, fan_out
from spendlens.schemas import DIMENSION_KEYS

# dimension -> report column -> dimension column
LABELS = {
    "dim_date": {"usage_date": "date", "activity_date": "date", "year_month": "year_month"},
    "dim_user": {"user_login": "user_login", "team_name": "team_name", "cost_center": "cost_center"},
    "dim_org": {"org_login": "org_login"},
    "dim_model": {"model_name": "model_name"},
    "dim_product": {"product": "product", "sku": "sku"},
    "dim_editor": {"editor_name": "editor_name", "editor_family": "editor_family"},
    "dim_feature": {"feature": "feature", "feature_group": "feature_group"},
    "dim_team": {"team_slug": "team_slug"},
}


def attach(df: DataFrame, T, columns, how: str = "inner") -> DataFrame:
    """Add the named report columns by joining their dimensions on the keys `df` carries."""
    for name, labels in LABELS.items():
        wanted = [c for c in labels if c in columns]
        if not wanted:
            continue
        key = DIMENSION_KEYS[name]
        side = T[name].select(key, *(F.col(labels[c]).alias(c) for c in wanted))
        if name == "dim_date" or T.small(name):
            side = F.broadcast(side)  # no longer than the calendar, or counted when it was stored
        df = df.join(side, key, how)
    return df


def chargeback(cost_center="cost_center", team_name="team_name"):
    """Who pays: the cost center, else the team, else nobody in particular."""
    return F.coalesce(C.as_column(cost_center), C.as_column(team_name), F.lit(V.UNASSIGNED))


def exact_rows(T, columns, since=None, until=None, user_key: str | None = None) -> DataFrame:
    """Billing facts with the named labels; its sums are the sums of the exact view."""
    return attach(between(T.fact_premium_requests, since, until, user_key), T, columns)


ALLOCATED_COLUMNS = [
    "usage_date", "year_month", "user_login", "team_name", "cost_center", "org_login",
    "model_name", "product", "sku", "editor_name", "editor_family", "feature", "feature_group",
    "ide_share", "feature_share", "weight_basis", "allocated_net_amount",
    "allocated_gross_amount", "allocated_quantity", "attribution_quality",
]


def allocated_rows(T, columns, since=None, until=None, user_key: str | None = None) -> DataFrame:
    """Allocated rows with the named labels; missing editors and features are labelled as such.

    Labels of the billing side are joined before the rows are fanned out, while they are few.
    """
    billing = billing_rows(T, since, until, user_key)
    billing = attach(billing, T, [c for c in columns if c not in _OPTIONAL])
    return _with_optional(fan_out(billing), T, columns)


_OPTIONAL = {"editor_name", "editor_family", "feature", "feature_group"}


def _with_optional(rows: DataFrame, T, columns) -> DataFrame:
    rows = attach(rows, T, [c for c in columns if c in _OPTIONAL], "left")
    for name in sorted(_OPTIONAL.intersection(columns)):
        text = V.UNATTRIBUTED if name in ("editor_name", "feature") else V.UNATTRIBUTED_LABEL
        rows = rows.withColumn(name, F.coalesce(name, F.lit(text)))
    return rows


def allocated_totals(T, columns, since=None, until=None, user_key: str | None = None) -> DataFrame:
    """Sums of the allocated rows by the keys behind the named labels, quality and basis, labelled
    after they are folded: what a report sums further, without a label on every row."""
    keys = [DIMENSION_KEYS[n] for n, labels in LABELS.items() if any(c in labels for c in columns)]
    amounts = ("allocated_net_amount", "allocated_gross_amount", "allocated_quantity")
    rows = fan_out(billing_rows(T, since, until, user_key))
    rows = rows.groupBy(*keys, "attribution_quality", "weight_basis").agg(*(F.sum(a).alias(a) for a in amounts))
    rows = attach(rows, T, [c for c in columns if c not in _OPTIONAL])
    return _with_optional(rows, T, columns)


def spend_by_user_model_editor(T, since=None, until=None, login: str | None = None) -> DataFrame:
    """Headline view: exact spend split over editors and features."""
    key = None if login is None else login.rstrip(" ").lower()
    return allocated_rows(T, ALLOCATED_COLUMNS, since, until, key).select(*ALLOCATED_COLUMNS)


def spend_by_user_model(T, since=None, until=None, login: str | None = None) -> DataFrame:
    """Exact spend per day, user, organisation, model and sku; products are summed away."""
    key = None if login is None else login.rstrip(" ").lower()
    billing = attach(between(T.fact_premium_requests, since, until, key), T, ["sku"])
    grain = billing.groupBy("date_key", "user_key", "org_key", "model_key", C.norm("sku").alias("_sku")).agg(
        F.min("sku").alias("sku"),
        F.sum("net_quantity").cast(C.TOTAL).alias("quantity"),
        F.sum("gross_amount").cast(C.TOTAL).alias("gross_amount"),
        F.sum("discount_amount").cast(C.TOTAL).alias("discount_amount"),
        F.sum("net_amount").cast(C.TOTAL).alias("net_amount"),
    )
    labels = [
        "usage_date", "year_month", "user_login", "team_name", "cost_center", "org_login",
        "model_name",
    ]
    return attach(grain, T, labels).select(
        *labels, "sku", "quantity", "gross_amount", "discount_amount", "net_amount"
    )


def monthly_spend_by_team(T, since=None, until=None) -> DataFrame:
    """Chargeback per month, cost center, organisation and model.

    Rows are folded to one per user first, so counting users is counting rows.
    """
    billing = attach(between(T.fact_premium_requests, since, until), T, ["year_month"])
    per_user = billing.groupBy("year_month", "user_key", "org_key", "model_key").agg(
        F.sum("net_amount").alias("net_amount")
    )
    per_user = attach(per_user, T, ["team_name", "cost_center"]).withColumn("payer", chargeback())
    grain = per_user.groupBy("year_month", C.norm("payer").alias("_payer"), "org_key", "model_key").agg(
        F.min("payer").alias("cost_center"),
        F.count("*").alias("active_users"),
        F.sum("net_amount").cast(C.TOTAL).alias("net_amount"),
    )
    return attach(grain, T, ["org_login", "model_name"]).select(
        "year_month", "cost_center", "org_login", "model_name", "active_users", "net_amount"
    )


def editor_mix(T, since=None, until=None) -> DataFrame:
    """Activity per day, organisation and editor. The fact has one row per user there, so rows
    are users."""
    grain = between(T.fact_user_ide_day, since, until).groupBy("date_key", "org_key", "editor_key").agg(
        F.count("*").alias("active_users"),
        F.sum("user_initiated_interaction_count").alias("interactions"),
        F.sum("code_generation_activity_count").alias("generations"),
        F.sum("code_acceptance_activity_count").alias("acceptances"),
        F.sum("loc_added_sum").alias("loc_added"),
        F.sum("loc_deleted_sum").alias("loc_deleted"),
    )
    labels = ["activity_date", "year_month", "org_login", "editor_name", "editor_family"]
    acceptance = F.when(
        F.col("generations") > 0,
        (
            F.col("acceptances").cast("decimal(20,1)") / F.col("generations").cast("decimal(20,0)")
        ).cast("decimal(9,4)"),
    )
    return attach(grain, T, labels).select(
        *labels, "active_users", "interactions", "generations", "acceptances", "loc_added",
        "loc_deleted", acceptance.alias("acceptance_rate"),
    )


def model_feature_mix(T, since=None, until=None) -> DataFrame:
    """Activity per day, organisation, user, model and feature: the fact's own grain, labelled."""
    labels = [
        "activity_date", "year_month", "org_login", "user_login", "model_name", "feature",
        "feature_group",
    ]
    return attach(between(T.fact_user_model_feature_day, since, until), T, labels).select(
        *labels,
        F.col("user_initiated_interaction_count").alias("interactions"),
        F.col("code_generation_activity_count").alias("generations"),
        F.col("code_acceptance_activity_count").alias("acceptances"),
    )


def spend_by_team(T, since=None, until=None, by_org: bool = False) -> DataFrame:
    """Spend of each team's members. A member of two teams counts in both.

    Memberships are not tied to an organisation unless `by_org` asks for it.
    """
    billing = between(T.fact_premium_requests, since, until).groupBy(
        "date_key", "user_key", "org_key", "model_key"
    ).agg(F.sum("net_amount").alias("net_amount"))
    membership = between(T.fact_user_team_day, since, until).select(
        "date_key", "user_key", "team_key"
    )
    teams = T.dim_team.select("team_key", "team_slug", *(["org_key"] if by_org else []))
    on = ["date_key", "user_key", *(["org_key"] if by_org else [])]
    rows = attach(billing.join(membership.join(teams, "team_key"), on), T, ["year_month"])
    per_user = rows.groupBy(
        "year_month", "org_key", C.norm("team_slug").alias("_team"), "model_key", "user_key"
    ).agg(F.min("team_slug").alias("team_slug"), F.sum("net_amount").alias("net_amount"))
    grain = per_user.groupBy("year_month", "org_key", "_team", "model_key").agg(
        F.min("team_slug").alias("team_slug"),
        F.count("*").alias("active_users"),
        F.sum("net_amount").cast(C.TOTAL).alias("net_amount"),
    )
    return attach(grain, T, ["org_login", "model_name"]).select(
        "year_month", "org_login", "team_slug", "model_name", "active_users", "net_amount"
    )


def inactive_seats(T, as_of, idle_days: int = V.IDLE_DAYS, seats_only: bool = False) -> DataFrame:
    """Active users without activity in the last days, with what they spent all the same.

    Anyone ever seen counts unless `seats_only` keeps users that hold a seat.
    """
    now = F.lit(str(as_of)).cast("timestamp_ntz")
    since = date.fromisoformat(str(as_of)[:10]) - timedelta(days=idle_days)
    spend = (
        between(T.fact_premium_requests, since)
        .groupBy("user_key")
        .agg(F.sum("net_amount").cast(C.TOTAL).alias("spent"))
    )
    last = F.col("last_activity_at")
    idle = T.dim_user.filter("is_active").filter(
        last.isNull() | (last < now - F.expr(f"interval {idle_days} days"))
    )
    if seats_only:
        idle = idle.filter("plan_type is not null or seat_created_at is not null")
    return idle.join(spend, "user_key", "left").select(
        "user_login",
        "team_name",
        "plan_type",
        "last_activity_at",
        F.datediff(F.lit(str(as_of)[:10]).cast("date"), last.cast("date")).alias(
            "days_since_activity"
        ),
        F.coalesce("spent", F.lit(0).cast(C.TOTAL)).alias("net_amount_30d"),
    )


VIEWS = {
    "vw_spend_by_user_model_editor": spend_by_user_model_editor,
    "vw_spend_by_user_model": spend_by_user_model,
    "vw_monthly_spend_by_team": monthly_spend_by_team,
    "vw_editor_mix": editor_mix,
    "vw_model_feature_mix": model_feature_mix,
    "vw_spend_by_team": spend_by_team,
}


def register_views(T, as_of) -> None:
    """Temporary views under their report names, and the tables, for ad-hoc SQL."""
    for name in (*DIMENSION_KEYS, "fact_premium_requests", "fact_user_day", "fact_user_ide_day",
                 "fact_user_model_feature_day", "fact_user_team_day", "fact_user_ide_share",
                 "fact_spend_shares", "ingestion_run"):
        T[name].createOrReplaceTempView(name)
    for name, view in VIEWS.items():
        view(T).createOrReplaceTempView(name)
    inactive_seats(T, as_of).createOrReplaceTempView("vw_inactive_seats")


def date_table(T) -> DataFrame:
    """The reports' date table: typed and in date order."""
    return T.dim_date.orderBy("date")
