"""The derived events domain rendered back into raw payloads, filed the way two runs would file them.

The first run covers the first half of the month with figures that the second run corrects; the
second run files its own trailing window again. Readers must end up with the second run's figures
where it has any.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.fixed_values import COUNTS, DATASETS, FLAGS
from spendlens.sources import derive
from spendlens.sources.raw import write_raw

FIRST = ("20240115T020000Z", "2024-01-01", "2024-01-14")
SECOND = ("20240131T020000Z", "2024-01-08", "2024-01-30")

_ID = ["activity_date", "user_login", "org_login"]


def _sums():
    return [F.sum(c).alias(c) for c in COUNTS]


def _entries(df: DataFrame, name: str, dims: list[str], entry) -> DataFrame:
    """One array of entries per user and day; entries are totals, so arrays stay short."""
    totals = df.groupBy(*_ID, *dims).agg(*_sums())
    return totals.groupBy(*_ID).agg(F.collect_list(entry).alias(name))


def activity_records(ev: DataFrame, credit_factor: int) -> DataFrame:
    """dt, org, value: one nested record per user and day."""
    per_day = derive.events_user_day(ev).groupBy(*_ID, "user_id", "organization_id", "enterprise_id").agg(
        (F.sum("ai_credits_used") * credit_factor).alias("ai_credits_used"),
        F.max("adoption_phase").alias("phase"),
        F.max("adoption_phase_number").alias("phase_number"),
        *(F.max(name).alias(raw) for name, raw in FLAGS.items() if name in ("used_agent", "used_chat", "used_cli")),
        *_sums(),
    )
    shouted = F.pmod(F.length("user_login"), F.lit(2)) == 0
    ides = _entries(
        derive.events_user_ide(ev),
        "totals_by_ide",
        ["ide"],
        F.struct(
            F.when(shouted, F.concat(F.lit(" "), F.upper("ide"), F.lit("\t"))).otherwise(F.col("ide")).alias("ide"),
            *COUNTS,
            F.struct(F.lit("1.0").alias("ide_version")).alias("last_known_ide_version"),
        ),
    )
    features = _entries(
        derive.events_user_model_feature(ev),
        "totals_by_model_feature",
        ["model_name", "feature"],
        F.struct(F.upper("model_name").alias("model"), "feature", *COUNTS),
    )
    records = per_day.join(ides, _ID, "left").join(features, _ID, "left")
    value = F.to_json(
        F.struct(
            F.concat(F.col("activity_date").cast("string"), F.lit("T00:00:00Z")).alias("day"),
            "user_id",
            "user_login",
            "organization_id",
            "enterprise_id",
            "ai_credits_used",
            *COUNTS,
            *(raw for name, raw in FLAGS.items() if name in ("used_agent", "used_chat", "used_cli")),
            F.struct("phase", "phase_number").alias("ai_adoption_phase"),
            "totals_by_ide",
            "totals_by_model_feature",
        )
    )
    return records.select(F.col("activity_date").alias("dt"), F.col("org_login").alias("org"), value.alias("value"))


def team_records(ev: DataFrame) -> DataFrame:
    value = F.to_json(
        F.struct(
            F.col("activity_date").cast("string").alias("day"),
            "user_id",
            "user_login",
            "team_id",
            F.col("team_slug").alias("slug"),
        )
    )
    return derive.events_user_teams(ev).select(
        F.col("activity_date").alias("dt"), F.col("org_login").alias("org"), value.alias("value")
    )


def billing_records(ev: DataFrame, dt: str, factor: int) -> DataFrame:
    """All billed days of a run, filed under its last day. Half the items leave out the net."""
    items = (
        derive.events_premium_requests(ev)
        .groupBy("usage_date", "user_login", "org_login", "product", "sku", "model_name", "unit_type")
        .agg(
            F.max("price_per_unit").alias("pricePerUnit"),
            F.sum("gross_quantity").alias("grossQuantity"),
            F.sum("net_quantity").alias("netQuantity"),
            (F.sum("gross_amount") * factor).alias("grossAmount"),
            (F.sum("discount_amount") * factor).alias("discountAmount"),
            (F.sum("net_amount") * factor).alias("net"),
        )
    )
    item = F.struct(
        "product", "sku", F.upper("model_name").alias("model"), F.col("unit_type").alias("unitType"),
        "pricePerUnit", "grossQuantity", "netQuantity", "grossAmount", "discountAmount",
        F.when(F.col("sku") == "sku1", F.col("net")).alias("netAmount"),
    )
    days = items.groupBy("usage_date", "user_login", "org_login").agg(
        F.collect_list(item).alias("usageItems")
    )
    value = F.to_json(
        F.struct(
            "user_login",
            F.col("usage_date").cast("string").alias("period"),
            F.struct("usageItems").alias("payload"),
        )
    )
    return days.select(F.lit(dt).cast("date").alias("dt"), F.col("org_login").alias("org"), value.alias("value"))


def seat_records(ev: DataFrame, dt: str, plan: str | None) -> DataFrame:
    zulu = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    value = F.to_json(
        F.struct(
            F.struct(F.col("user_login").alias("login"), F.col("user_id").alias("id")).alias("assignee"),
            F.when(F.col("team_name") != "", F.struct(F.col("team_name").alias("name"))).alias("assigning_team"),
            (F.col("plan_type") if plan is None else F.lit(plan)).alias("plan_type"),
            F.date_format("created_at", zulu).alias("created_at"),
            F.date_format("last_activity_at", zulu).alias("last_activity_at"),
            "last_activity_editor",
        )
    )
    return derive.events_seats(ev).select(
        F.lit(dt).cast("date").alias("dt"), F.col("org_login").alias("org"), value.alias("value")
    )


def render_archive(spark: SparkSession, sf_dir: str, root: str) -> str:
    """Write both runs into a raw zone and return its root."""
    ev = derive.events(spark, sf_dir)
    for (stamp, since, until), factor, plan in ((FIRST, 2, "old"), (SECOND, 1, None)):
        window = ev.filter(F.col("d").between(F.lit(since).cast("date"), F.lit(until).cast("date")))
        write_raw(activity_records(window, factor), root, DATASETS["user_activity"], stamp)
        write_raw(team_records(window), root, DATASETS["user_teams"], stamp)
        write_raw(billing_records(window, until, factor), root, DATASETS["premium_requests"], stamp)
        write_raw(seat_records(ev, until, plan), root, DATASETS["seats"], stamp)
    return root


def render_report(spark: SparkSession, sf_dir: str, path: str) -> str:
    """Every event as a report line: some blank, some cut off, some as arrays of two records."""
    record = "to_json(struct(event_id as id, k as interactions, user_id))"
    line = F.expr(
        f"case when k = 0 then '  ' when k = 1 then '{{\"id\": ' "
        f"when k < 10 then concat('[', {record}, ',', {record}, ']') else {record} end"
    )
    derive.events(spark, sf_dir).select(line.alias("value")).write.option("compression", "gzip").text(path)
    return path
