"""Parameterised spend questions. The clock is always the `as_of` argument."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendlens import fixed_values as V
from spendlens.functions import columns as C
from spendlens.operators.allocate import allocate, between
from spendlens.plans import views
from spendlens.plans.views import attach, chargeback


# ------------------------------------------------------------------ arguments


@dataclass(frozen=True)
class DateWindow:
    """Days from first to last, both included."""

    first: date
    last: date

    def __post_init__(self):
        if self.last < self.first:
            raise ValueError(f"A window from {self.first} to {self.last} holds no day.")

    def __iter__(self):
        return iter((self.first, self.last))

    @classmethod
    def ending(cls, last: date, days_before: int = V.DEFAULT_WINDOW_DAYS) -> DateWindow:
        return cls(last - timedelta(days=days_before), last)


def resolve_window(as_of: date, since: date | None = None, until: date | None = None) -> DateWindow:
    """The asked window; an open end is the day of asking, an open start follows from the end."""
    last = as_of if until is None else until
    return DateWindow.ending(last) if since is None else DateWindow(since, last)


def row_limit(limit: int | None) -> int | None:
    """How many rows to give: as asked, or all. An interface may have a ceiling, a question has none."""
    if limit is not None and limit < 1:
        raise ValueError(f"A limit must be positive, not {limit}.")
    return limit


def login_key(login: str) -> str:
    return login.rstrip(" ").lower()


def _total(name: str, decimal: str = C.TOTAL):
    return F.sum(name).cast(decimal)


def _total_or_zero(name: str):
    return F.coalesce(_total(name), F.lit(0).cast(C.TOTAL))


# ------------------------------------------------------------------ questions


def user_breakdown(T, login: str, since, until) -> DataFrame:
    """One user's spend by model, editor family and feature, biggest first."""
    rows = allocate(T, since, until, login_key(login))
    grain = rows.groupBy("model_key", "editor_key", "feature_key", "attribution_quality").agg(
        F.sum("allocated_net_amount").alias("spend"), F.sum("allocated_quantity").alias("requests")
    )
    grain = attach(grain, T, ["model_name"])
    grain = attach(grain, T, ["editor_family", "feature"], "left").withColumns(
        {
            "editor_family": F.coalesce("editor_family", F.lit(V.UNATTRIBUTED_LABEL)),
            "feature": F.coalesce("feature", F.lit(V.UNATTRIBUTED)),
        }
    )
    keys = ["model_name", "editor_family", "feature", "attribution_quality"]
    return (
        grain.groupBy(*keys)
        .agg(
            _total("spend", C.ALLOCATED_TOTAL).alias("spend"),
            _total("requests", C.ALLOCATED_TOTAL).alias("requests"),
        )
        .filter("spend > 0")
        .orderBy(F.desc("spend"), *keys)
    )


def user_exact_total(T, login: str, since, until) -> DataFrame:
    """The same user's exact total; always one row."""
    billing = between(T.fact_premium_requests, since, until, login_key(login))
    return billing.agg(
        _total_or_zero("net_amount").alias("net_amount"),
        _total_or_zero("net_quantity").alias("quantity"),
        F.countDistinct("model_key").alias("models_used"),
    )


def top_spenders(T, since, until, limit: int | None = V.DEFAULT_LIMIT) -> DataFrame:
    """Users by spend, biggest first: as many as asked, all for None."""
    billing = between(T.fact_premium_requests, since, until)
    per_user = billing.groupBy("user_key").agg(_total("net_amount").alias("spend"))
    ranked = (
        attach(per_user, T, ["user_login", "team_name", "cost_center"])
        .select("user_login", "team_name", "cost_center", "spend")
        .orderBy(F.desc("spend"), "user_login")
    )
    return ranked if row_limit(limit) is None else ranked.limit(limit)


def _team_rows(T, team: str, since, until) -> DataFrame:
    members = T.dim_user.filter(C.norm(chargeback()) == login_key(team)).select(
        "user_key", "user_login"
    )
    billing = between(T.fact_premium_requests, since, until)
    per_user = billing.groupBy("user_key", "model_key").agg(F.sum("net_amount").alias("spend"))
    return per_user.join(members, "user_key")


def team_breakdown(T, team: str, since, until) -> DataFrame:
    """Spend of a cost center or team by user and model, biggest first."""
    rows = attach(_team_rows(T, team, since, until), T, ["model_name"])
    return rows.select("user_login", "model_name", F.col("spend").cast(C.TOTAL).alias("spend")).orderBy(
        F.desc("spend"), "user_login", "model_name"
    )


def team_total(T, team: str, since, until) -> DataFrame:
    return _team_rows(T, team, since, until).agg(_total_or_zero("spend").alias("total"))


def summary(T, since, until) -> DataFrame:
    """Totals of the window; always one row. Folded by user and model before counting them."""
    grain = between(T.fact_premium_requests, since, until).groupBy("user_key", "model_key").agg(
        F.sum("net_amount").alias("net_amount"), F.sum("net_quantity").alias("net_quantity")
    )
    return grain.agg(
        _total_or_zero("net_amount").alias("total_spend"),
        F.countDistinct("user_key").alias("active_users"),
        F.countDistinct("model_key").alias("models_used"),
        _total_or_zero("net_quantity").alias("total_requests"),
    )


def editor_spend(T, since, until) -> DataFrame:
    """Allocated spend by editor family and feature, biggest first."""
    grain = allocate(T, since, until).groupBy("editor_key", "feature_key").agg(
        F.sum("allocated_net_amount").alias("spend")
    )
    labelled = attach(grain, T, ["editor_family", "feature"], "left").select(
        F.coalesce("editor_family", F.lit(V.UNATTRIBUTED_LABEL)).alias("editor_family"),
        F.coalesce("feature", F.lit(V.UNATTRIBUTED)).alias("feature"),
        "spend",
    )
    return (
        labelled.groupBy("editor_family", "feature")
        .agg(_total("spend", C.ALLOCATED_TOTAL).alias("spend"))
        .filter("spend > 0")
        .orderBy(F.desc("spend"), "editor_family", "feature")
    )


def _latest(fact: DataFrame) -> DataFrame:
    """Latest day of a fact, from its newest partition."""
    return fact.agg(F.to_date(F.max("date_key").cast("string"), "yyyyMMdd").alias("latest_date"))


def data_freshness(T) -> DataFrame:
    succeeded = T.ingestion_run.filter(F.col("status") == V.SUCCEEDED)
    return T.dim_date.sparkSession.range(1).select(
        _latest(T.newest("fact_premium_requests")).scalar().alias("latest_billing_date"),
        _latest(T.newest("fact_user_day")).scalar().alias("latest_activity_date"),
        succeeded.agg(F.max("completed_at")).scalar().alias("last_successful_run"),
    )


def freshness_by_fact(T) -> DataFrame:
    parts = [
        _latest(T.newest(table)).select(F.lit(name).alias("fact"), "latest_date")
        for name, table in (
            ("premium_requests", "fact_premium_requests"),
            ("user_day", "fact_user_day"),
            ("user_ide", "fact_user_ide_day"),
        )
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def weight_basis_counts(T) -> DataFrame:
    return T.fact_user_ide_share.groupBy("weight_basis").agg(F.count("*").alias("rows"))


# ------------------------------------------------------------------ ad-hoc headline queries


def month_of_user(T, login: str, year_month: str) -> DataFrame:
    """A month of the headline view for one user."""
    since, until = _month(year_month)
    keys = ["user_login", "model_name", "editor_family", "feature"]
    return (
        views.spend_by_user_model_editor(T, since, until, login)
        .groupBy(*keys)
        .agg(_total("allocated_net_amount", C.ALLOCATED_TOTAL).alias("spend"))
        .orderBy(F.desc("spend"), *keys)
    )


def month_exact(T, year_month: str) -> DataFrame:
    """A month of exact spend by user and model."""
    since, until = _month(year_month)
    grain = between(T.fact_premium_requests, since, until).groupBy("user_key", "model_key").agg(
        _total("net_amount").alias("spend")
    )
    return (
        attach(grain, T, ["user_login", "model_name"])
        .select("user_login", "model_name", "spend")
        .orderBy(F.desc("spend"), "user_login", "model_name")
    )


def idle_seats_by_age(T, as_of) -> DataFrame:
    return views.inactive_seats(T, as_of).orderBy(
        F.col("days_since_activity").desc_nulls_last(), "user_login"
    )


def _month(year_month: str) -> tuple[date, date]:
    year, month = (int(x) for x in year_month.split("-"))
    first = date(year, month, 1)
    following = date(year + month // 12, month % 12 + 1, 1)
    return first, following - timedelta(days=1)


# ------------------------------------------------------------------ result blocks


def _rest(parts: DataFrame, shown: DataFrame) -> DataFrame:
    """What a cut list leaves out, if anything; the lines and this add up to all parts."""
    left = parts.agg(F.coalesce(F.sum("spend"), F.lit(0)).alias("spend")).withColumn(
        "shown", shown.agg(F.coalesce(F.sum("spend"), F.lit(0))).scalar()
    )
    return left.select((F.col("spend") - F.col("shown")).alias("spend")).filter("spend <> 0")


def _block(total: DataFrame | None, rows: DataFrame, order: list, rest: DataFrame | None = None) -> DataFrame:
    """position, name, value: an optional total line, then a short list that is already cut, and
    optionally what the list leaves out."""
    numbered = rows.withColumn("position", F.row_number().over(Window.orderBy(*order)))
    block = numbered.select("position", "name", "value")
    if rest is not None:
        last = F.lit(2**31 - 1).alias("position")
        block = block.unionByName(rest.select(last, F.lit("Other").alias("name"), C.money_text("spend").alias("value")))
    if total is not None:
        block = total.select(F.lit(0).alias("position"), "name", "value").unionByName(block)
    return block


def user_report(T, login: str, as_of: date, n: int = V.REPORT_ROWS, with_rest: bool = False) -> DataFrame:
    """Exact total and the biggest parts; nothing when nothing was spent."""
    since, until = resolve_window(as_of)
    exact = user_exact_total(T, login, since, until).filter("net_amount != 0")
    total = exact.select(
        F.lit("Total (exact)").alias("name"), C.money_text("net_amount").alias("value")
    )
    keys = ["model_name", "editor_family", "feature", "attribution_quality"]
    every = user_breakdown(T, login, since, until).filter(exact.select(F.lit(True)).scalar())
    parts = every.limit(n)
    rows = parts.select(
        F.concat_ws(" · ", "model_name", "editor_family", "feature").alias("name"),
        C.money_text("spend").alias("value"), "spend", *keys,
    )
    return _block(total, rows, [F.desc("spend"), *keys], _rest(every, parts) if with_rest else None)


def team_report(T, team: str, as_of: date, n: int = V.TEAM_REPORT_ROWS, with_rest: bool = False) -> DataFrame:
    since, until = resolve_window(as_of)
    total = _team_rows(T, team, since, until).agg(_total("spend").alias("spend")).filter(
        "spend is not null"
    )
    every = team_breakdown(T, team, since, until)
    rows = every.limit(n).select(
        F.concat_ws(" · ", "user_login", "model_name").alias("name"),
        C.money_text("spend").alias("value"), "spend", "user_login", "model_name",
    )
    return _block(
        total.select(F.lit("Total").alias("name"), C.money_text("spend").alias("value")),
        rows,
        [F.desc("spend"), "user_login", "model_name"],
        _rest(every, every.limit(n)) if with_rest else None,
    )


def top_report(T, as_of: date, limit: int = V.TOP_REPORT_ROWS) -> DataFrame:
    since, until = resolve_window(as_of)
    rows = top_spenders(T, since, until, limit).select(
        F.col("user_login").alias("name"), C.money_text("spend").alias("value"), "spend"
    )
    return _block(None, rows, [F.desc("spend"), "name"])


def summary_report(T, as_of: date) -> DataFrame:
    since, until = resolve_window(as_of)
    lines = F.array(
        *(
            F.struct(F.lit(i).alias("position"), F.lit(name).alias("name"), value.alias("value"))
            for i, (name, value) in enumerate(
                (
                    ("Total spend", C.money_text("total_spend")),
                    ("Active users", F.col("active_users").cast("string")),
                    ("Models used", F.col("models_used").cast("string")),
                    ("Premium requests", F.format_number("total_requests", 0)),
                ),
                start=1,
            )
        )
    )
    return summary(T, since, until).select(F.inline(lines))
