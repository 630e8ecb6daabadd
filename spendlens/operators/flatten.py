"""Nested records to staging rows. The editor and model arrays are siblings, never crossed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlens import fixed_values as V
from spendlens.functions import columns as C


def _org(org) -> Column:
    """An organisation name for all rows, or the record's own column when none is given."""
    return F.col("org") if org is None else F.lit(org)


def _identified(df: DataFrame) -> DataFrame:
    return df.filter(C.present("day") & C.present("user_login"))


def _counts(prefix: str = "") -> list[Column]:
    return [C.count(f"{prefix}{name}").alias(name) for name in V.COUNTS]


def flatten_user_day(df: DataFrame, org: str | None = None) -> DataFrame:
    """One row per user and day."""
    return _identified(df).select(
        C.day("day").alias("activity_date"),
        "user_login",
        F.coalesce("user_id", F.lit(0)).alias("user_id"),
        _org(org).alias("org_login"),
        C.text_or("organization_id", "").alias("organization_id"),
        C.text_or("enterprise_id", "").alias("enterprise_id"),
        C.money("ai_credits_used").alias("ai_credits_used"),
        C.text_or("ai_adoption_phase.phase", V.NO_PHASE).alias("adoption_phase"),
        C.count("ai_adoption_phase.phase_number", "int").alias("adoption_phase_number"),
        *(C.flag(raw).alias(name) for name, raw in V.FLAGS.items()),
        *_counts(),
    )


def flatten_user_ide(df: DataFrame, org: str | None = None) -> DataFrame:
    """One row per user, day and editor."""
    entries = _identified(df).select(
        C.day("day").alias("activity_date"),
        "user_login",
        _org(org).alias("org_login"),
        F.explode("totals_by_ide").alias("e"),
    )
    return entries.select(
        "activity_date",
        "user_login",
        "org_login",
        C.label("e.ide", V.UNKNOWN).alias("ide"),
        C.ide_family(C.text_or("e.ide", V.UNKNOWN)).alias("ide_family"),
        C.text_or("e.last_known_ide_version.ide_version", "").alias("last_known_ide_version"),
        C.text_or("e.last_known_plugin_version.plugin_version", "").alias(
            "last_known_plugin_version"
        ),
        *_counts("e."),
    )


def flatten_user_model_feature(df: DataFrame, org: str | None = None) -> DataFrame:
    """One row per user, day, model and feature."""
    entries = _identified(df).select(
        C.day("day").alias("activity_date"),
        "user_login",
        _org(org).alias("org_login"),
        F.explode("totals_by_model_feature").alias("e"),
    )
    return entries.select(
        "activity_date",
        "user_login",
        "org_login",
        C.label("e.model", V.UNKNOWN).alias("model_name"),
        C.label("e.feature", V.OTHERS).alias("feature"),
        *_counts("e."),
    )


def flatten_user_teams(df: DataFrame, org: str | None = None) -> DataFrame:
    """One row per membership."""
    return _identified(df).select(
        C.day("day").alias("activity_date"),
        "user_login",
        F.coalesce("user_id", F.lit(0)).alias("user_id"),
        _org(org).alias("org_login"),
        F.coalesce("team_id", F.lit(0)).alias("team_id"),
        C.text_or("slug", "").alias("team_slug"),
    )


def flatten_premium_requests(df: DataFrame, org: str | None = None) -> DataFrame:
    """One row per billed item of (org, user_login, usage_date, payload) rows.

    An absent net amount is gross minus discount; an empty one is zero.
    """
    items = df.select(
        "usage_date",
        "user_login",
        _org(org).alias("org_login"),
        F.explode("payload.usageItems").alias("u"),
    ).select("usage_date", "user_login", "org_login", "u.item.*", "u.net_text")
    items = items.select(
        "usage_date",
        "user_login",
        "org_login",
        C.text_or("product", "").alias("product"),
        C.text_or("sku", "").alias("sku"),
        C.label("model", V.UNKNOWN).alias("model_name"),
        C.text_or("unitType", "").alias("unit_type"),
        C.money("pricePerUnit", C.RATE).alias("price_per_unit"),
        C.money("grossQuantity").alias("gross_quantity"),
        C.money("discountQuantity").alias("discount_quantity"),
        C.money("netQuantity").alias("net_quantity"),
        F.coalesce("grossAmount", F.lit(0).cast("decimal(38,18)")).alias("_gross"),
        F.coalesce("discountAmount", F.lit(0).cast("decimal(38,18)")).alias("_discount"),
        "netAmount",
        "net_text",
    )
    net = F.when(F.col("net_text").isNull(), F.col("_gross") - F.col("_discount")).otherwise(
        C.money("netAmount", "decimal(38,18)")
    )
    return items.select(
        *items.columns[:-4],
        C.money("_gross").alias("gross_amount"),
        C.money("_discount").alias("discount_amount"),
        C.money(net).alias("net_amount"),
    )


def flatten_seats(df: DataFrame, org: str | None = None) -> DataFrame:
    """One row per seat; a seat without an assignee keeps a blank login."""
    return df.select(
        C.text_or("assignee.login", "").alias("user_login"),
        F.coalesce("assignee.id", F.lit(0)).alias("user_id"),
        _org(org).alias("org_login"),
        C.text_or("assigning_team.name", "").alias("team_name"),
        C.text_or("plan_type", "").alias("plan_type"),
        C.utc_time("created_at").alias("created_at"),
        C.utc_time("last_activity_at").alias("last_activity_at"),
        C.text_or("last_activity_editor", "").alias("last_activity_editor"),
        C.day(F.nullif("pending_cancellation_date", F.lit(""))).alias("pending_cancellation_date"),
    )
