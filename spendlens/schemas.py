"""Declared schemas: raw records, staging tables and the star schema. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T
from pyspark.sql.types import StructType

from spendlens.fixed_values import COUNTS, FLAGS

# Raw records. Counts are read as double so that 3.9 truncates instead of vanishing; money is read
# as a wide decimal so that no digit passes through floating point; flags are read as text so that
# true, 1 and "yes" are all recognised; identifiers are read as bigint.
_RAW_COUNTS = ", ".join(f"{c}: double" for c in COUNTS)
_RAW_MONEY = "decimal(38,18)"

IDE_ENTRY = (
    f"struct<ide: string, {_RAW_COUNTS}, "
    "last_known_ide_version: struct<ide_version: string>, "
    "last_known_plugin_version: struct<plugin: string, plugin_version: string>>"
)
MODEL_FEATURE_ENTRY = f"struct<model: string, feature: string, {_RAW_COUNTS}>"
BILLING_ITEM = (
    "struct<product: string, sku: string, model: string, unitType: string, "
    f"pricePerUnit: {_RAW_MONEY}, grossQuantity: {_RAW_MONEY}, discountQuantity: {_RAW_MONEY}, "
    f"netQuantity: {_RAW_MONEY}, grossAmount: {_RAW_MONEY}, discountAmount: {_RAW_MONEY}, "
    f"netAmount: {_RAW_MONEY}>"
)

RAW = {
    "user_activity": (
        "struct<day: string, user_id: bigint, user_login: string, enterprise_id: string, "
        f"organization_id: string, ai_credits_used: {_RAW_MONEY}, {_RAW_COUNTS}, "
        + ", ".join(f"{raw}: string" for raw in FLAGS.values())
        + ", ai_adoption_phase: struct<phase: string, phase_number: double>, "
        f"totals_by_ide: array<{IDE_ENTRY}>, "
        f"totals_by_model_feature: array<{MODEL_FEATURE_ENTRY}>>"
    ),
    "user_teams": (
        "struct<day: string, user_id: bigint, user_login: string, team_id: bigint, slug: string>"
    ),
    "premium_requests": (
        "struct<user_login: string, period: string, "
        f"payload: struct<usageItems: array<{BILLING_ITEM}>>>"
    ),
    # Same rows, one field as text: an empty netAmount and an absent one mean different things.
    "premium_requests_text": (
        "struct<payload: struct<usageItems: array<struct<netAmount: string>>>>"
    ),
    "seats": (
        "struct<assignee: struct<login: string, id: bigint>, assigning_team: struct<name: string>, "
        "plan_type: string, created_at: string, last_activity_at: string, "
        "last_activity_editor: string, pending_cancellation_date: string>"
    ),
}

_COUNT_COLUMNS = [f"{c} bigint" for c in COUNTS]


_TYPES = {
    "binary": T.BinaryType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "decimal(18,4)": T.DecimalType(18, 4),
    "decimal(18,6)": T.DecimalType(18, 6),
    "decimal(9,8)": T.DecimalType(9, 8),
    "decimal(18,8)": T.DecimalType(18, 8),
}


def _ddl(*columns: str) -> StructType:
    """A schema from "name type" texts; unlike the built-in parser it needs no running session."""
    pairs = (c.split(" ", 1) for c in columns)
    return StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


_TYPES["editor_shares"] = T.ArrayType(_ddl("editor_key string", "share decimal(9,8)", "weight_basis string"))
_TYPES["feature_shares"] = T.ArrayType(_ddl("feature_key string", "share decimal(18,8)"))

STAGING = {
    "user_day": _ddl(
        "activity_date date", "user_login string", "user_id bigint", "org_login string",
        "organization_id string", "enterprise_id string", "ai_credits_used decimal(18,4)",
        "adoption_phase string", "adoption_phase_number int",
        *(f"{f} boolean" for f in FLAGS), *_COUNT_COLUMNS,
    ),
    "user_ide": _ddl(
        "activity_date date", "user_login string", "org_login string", "ide string",
        "ide_family string", "last_known_ide_version string", "last_known_plugin_version string",
        *_COUNT_COLUMNS,
    ),
    "user_model_feature": _ddl(
        "activity_date date", "user_login string", "org_login string", "model_name string",
        "feature string", *_COUNT_COLUMNS,
    ),
    "user_teams": _ddl(
        "activity_date date", "user_login string", "user_id bigint", "org_login string",
        "team_id bigint", "team_slug string",
    ),
    "premium_requests": _ddl(
        "usage_date date", "user_login string", "org_login string", "product string", "sku string",
        "model_name string", "unit_type string", "price_per_unit decimal(18,6)",
        "gross_quantity decimal(18,4)", "discount_quantity decimal(18,4)",
        "net_quantity decimal(18,4)", "gross_amount decimal(18,4)",
        "discount_amount decimal(18,4)", "net_amount decimal(18,4)",
    ),
    "seats": _ddl(
        "user_login string", "user_id bigint", "org_login string", "team_name string",
        "plan_type string", "created_at timestamp_ntz", "last_activity_at timestamp_ntz",
        "last_activity_editor string", "pending_cancellation_date date",
    ),
}

# Star schema. `*_key` is the normalised natural key that facts and dimensions join on: facts get
# it from their own row, so a load needs no lookup. `*_sk` is the stable integer of a dimension row.
DIMENSIONS = {
    "dim_date": _ddl(
        "date_key int", "date date", "year int", "month int", "day int", "month_name string",
        "year_month string", "day_of_week int", "is_weekend boolean",
    ),
    "dim_org": _ddl("org_sk bigint", "org_key string", "org_login string"),
    "dim_user": _ddl(
        "user_sk bigint", "user_key string", "user_login string", "external_user_id bigint",
        "team_name string", "cost_center string", "plan_type string",
        "seat_created_at timestamp_ntz", "last_activity_at timestamp_ntz",
        "last_activity_editor string", "is_active boolean",
    ),
    "dim_model": _ddl(
        "model_sk bigint", "model_key string", "model_name string", "is_custom_model boolean",
    ),
    "dim_product": _ddl(
        "product_sk bigint", "product_key string", "product string", "sku string",
        "unit_type string",
    ),
    "dim_editor": _ddl(
        "editor_sk bigint", "editor_key string", "editor_name string", "editor_family string",
    ),
    "dim_feature": _ddl(
        "feature_sk bigint", "feature_key string", "feature string", "feature_group string",
    ),
    "dim_team": _ddl(
        "team_sk bigint", "team_key string", "team_id bigint", "team_slug string",
        "org_key string",
    ),
}

_GRAIN = ("date_key int", "user_key string", "org_key string")
_FACT_COUNTS = (
    "user_initiated_interaction_count bigint", "code_generation_activity_count bigint",
    "code_acceptance_activity_count bigint",
)

FACTS = {
    "fact_premium_requests": _ddl(
        *_GRAIN, "model_key string", "product_key string", "net_quantity decimal(18,4)",
        "gross_quantity decimal(18,4)", "price_per_unit decimal(18,6)",
        "gross_amount decimal(18,4)", "discount_amount decimal(18,4)",
        "net_amount decimal(18,4)", "loaded_at timestamp_ntz",
    ),
    "fact_user_day": _ddl(
        *_GRAIN, "ai_credits_used decimal(18,4)", "adoption_phase string",
        "adoption_phase_number int", *(f"{f} boolean" for f in FLAGS), *_FACT_COUNTS,
        "loc_suggested_to_add_sum bigint", "loc_added_sum bigint", "loc_deleted_sum bigint",
        "loaded_at timestamp_ntz",
    ),
    "fact_user_ide_day": _ddl(
        *_GRAIN, "editor_key string", "last_known_ide_version string",
        "last_known_plugin_version string", *_FACT_COUNTS, "loc_added_sum bigint",
        "loc_deleted_sum bigint", "loaded_at timestamp_ntz",
    ),
    "fact_user_model_feature_day": _ddl(
        *_GRAIN, "model_key string", "feature_key string", *_FACT_COUNTS,
        "loaded_at timestamp_ntz",
    ),
    "fact_user_team_day": _ddl(
        "date_key int", "user_key string", "team_key string", "loaded_at timestamp_ntz",
    ),
    # billing with the shares of its user-day beside it, so that splitting spend joins nothing
    "fact_spend_shares": _ddl(
        *_GRAIN, "model_key string", "product_key string", "net_quantity decimal(18,4)",
        "gross_amount decimal(18,4)", "net_amount decimal(18,4)",
        "editors editor_shares", "features feature_shares",
        "loaded_at timestamp_ntz",
    ),
    "fact_user_ide_share": _ddl(
        *_GRAIN, "editor_key string", "share decimal(9,8)", "weight_basis string",
        "loaded_at timestamp_ntz",
    ),
}

FACT_KEYS = {
    "fact_premium_requests": ["date_key", "user_key", "org_key", "model_key", "product_key"],
    "fact_user_day": ["date_key", "user_key", "org_key"],
    "fact_user_ide_day": ["date_key", "user_key", "org_key", "editor_key"],
    "fact_user_model_feature_day": ["date_key", "user_key", "org_key", "model_key", "feature_key"],
    "fact_user_team_day": ["date_key", "user_key", "team_key"],
    "fact_spend_shares": ["date_key", "user_key", "org_key", "model_key", "product_key"],
    "fact_user_ide_share": ["date_key", "user_key", "org_key", "editor_key"],
}

# Which users were there, day by day: 32,768 of them a bitmap, by their number.
BITMAPS = {
    "user_bitmaps": _ddl("date_key int", "source string", "org_key string", "bucket bigint", "users binary"),
}

# What is stored by day or month, and the rows that share a file.
STORED_KEYS = {**FACT_KEYS, "user_bitmaps": ["date_key", "source", "org_key", "bucket"]}
PERIODIC = {**FACTS, **BITMAPS}

DIMENSION_KEYS = {
    "dim_date": "date_key", "dim_org": "org_key", "dim_user": "user_key",
    "dim_model": "model_key", "dim_product": "product_key", "dim_editor": "editor_key",
    "dim_feature": "feature_key", "dim_team": "team_key",
}

# One row per state change of a run; the latest row of a run_id is its state.
RUN_LOG = {
    "ingestion_run": _ddl(
        "run_id string", "logged_at timestamp_ntz", "started_at timestamp_ntz",
        "completed_at timestamp_ntz", "since_date date", "until_date date",
        "trigger_source string", "status string", "rows_user_day bigint",
        "rows_user_ide bigint", "rows_model_feature bigint", "rows_premium_requests bigint",
        "rows_seats bigint", "message string",
    ),
}

# Billing rows that a load could not place, with the dimensions they miss; every load adds its own.
ADDED = {
    "billing_orphans": _ddl(
        "run_id string", "logged_at timestamp_ntz", "usage_date date", "user_login string",
        "org_login string", "product string", "sku string", "model_name string",
        "net_amount decimal(18,4)", "missing string",
    ),
}

# Who may see which cost center; '*' stands for all.
GRANTS = {"report_access": _ddl("principal_name string", "cost_center string")}

TABLES = {**DIMENSIONS, **PERIODIC, **RUN_LOG, **ADDED, **GRANTS}
