"""Fact loads: aggregate staging rows to the fact's grain, keep rows whose dimensions exist, upsert.

Aggregating first means that the shuffle carries one partial row per key and input split, whatever
the skew, and that the dimension checks see grain rows instead of staging rows. Rows that are nearly at the
grain, without a heavy key, may be dealt over the fact's ranges first: one exchange folds and stores them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from spendlens.fixed_values import FLAGS
from spendlens.functions import columns as C
from spendlens.operators import dimensions
from spendlens.operators.allocate import crowds, heavy_groups
from spendlens.operators.dimensions import as_is
from spendlens.schemas import DIMENSION_KEYS, FACT_KEYS, FACTS
from spendlens.sources.tables import PERIODS, grouped_by

# How staging rows are dealt before they are folded; as they are, partial folds move.
Deal = Callable[[DataFrame], DataFrame]

#: The dimensions that the rows of a dataset must have, besides the calendar.
CHECKED = {
    "user_day": ("dim_org", "dim_user"),
    "user_ide": ("dim_org", "dim_editor", "dim_user"),
    "user_model_feature": ("dim_org", "dim_model", "dim_feature", "dim_user"),
    "user_teams": ("dim_team", "dim_user"),
    "premium_requests": ("dim_org", "dim_model", "dim_product", "dim_user"),
}

_COUNT_NAMES = (
    "user_initiated_interaction_count",
    "code_generation_activity_count",
    "code_acceptance_activity_count",
)


def _sums(*names: str) -> list[Column]:
    return [F.sum(n).alias(n) for n in names]


def _money_sum(name: str) -> Column:
    return F.sum(F.coalesce(name, F.lit(0).cast(C.MONEY))).cast(C.MONEY).alias(name)


def _with_dimensions(df: DataFrame, staged: DataFrame, dims, *names: str) -> DataFrame:
    """Rows whose key exists in each dimension. The calendar is bounded and always broadcast; of the
    others the few keys that they lack are, so no dimension makes the rows move."""
    calendar = dims["dim_date"].select("date_key")
    df = df.join(F.broadcast(calendar), "date_key", "left_semi")
    for name, keys in dimensions.lacking(staged, dims, names).items():
        key = DIMENSION_KEYS[name]
        df = df.filter(F.col(key).isNotNull()).join(keys, key, "left_anti")
    return df


def _folded(rows: DataFrame, table: str) -> GroupedData:
    """Rows grouped to the fact's grain; rows that were dealt by days, in their part."""
    return rows.groupBy(*grouped_by(rows, FACT_KEYS[table]))


def load_premium_requests(staged: dict[str, DataFrame], dims, deal: Deal = as_is) -> DataFrame:
    grain = _folded(deal(staged["premium_requests"]), "fact_premium_requests").agg(
        _money_sum("net_quantity"),
        _money_sum("gross_quantity"),
        F.max(F.coalesce("price_per_unit", F.lit(0).cast(C.RATE))).alias("price_per_unit"),
        _money_sum("gross_amount"),
        _money_sum("discount_amount"),
        _money_sum("net_amount"),
    )
    return _with_dimensions(grain, staged["premium_requests"], dims, *CHECKED["premium_requests"])


def load_user_day(staged: dict[str, DataFrame], dims, deal: Deal = as_is) -> DataFrame:
    grain = _folded(deal(staged["user_day"]), "fact_user_day").agg(
        _money_sum("ai_credits_used"),
        F.max("adoption_phase").alias("adoption_phase"),
        F.max("adoption_phase_number").alias("adoption_phase_number"),
        *(F.max(f).alias(f) for f in FLAGS),
        *_sums(*_COUNT_NAMES, "loc_suggested_to_add_sum", "loc_added_sum", "loc_deleted_sum"),
    )
    return _with_dimensions(grain, staged["user_day"], dims, *CHECKED["user_day"])


def load_user_ide_day(staged: dict[str, DataFrame], dims, deal: Deal = as_is) -> DataFrame:
    grain = _folded(deal(staged["user_ide"]), "fact_user_ide_day").agg(
        F.max("last_known_ide_version").alias("last_known_ide_version"),
        F.max("last_known_plugin_version").alias("last_known_plugin_version"),
        *_sums(*_COUNT_NAMES, "loc_added_sum", "loc_deleted_sum"),
    )
    return _with_dimensions(grain, staged["user_ide"], dims, *CHECKED["user_ide"])


def load_user_model_feature_day(staged: dict[str, DataFrame], dims, deal: Deal = as_is) -> DataFrame:
    grain = _folded(deal(staged["user_model_feature"]), "fact_user_model_feature_day").agg(
        *_sums(*_COUNT_NAMES)
    )
    return _with_dimensions(grain, staged["user_model_feature"], dims, *CHECKED["user_model_feature"])


def load_user_team_day(staged: dict[str, DataFrame], dims, deal: Deal = as_is) -> DataFrame:
    rows = deal(staged["user_teams"])
    grain = rows.select(*grouped_by(rows, FACT_KEYS["fact_user_team_day"])).dropDuplicates()
    return _with_dimensions(grain, staged["user_teams"], dims, *CHECKED["user_teams"])


def near_grain(rows: DataFrame, keys: list[str]) -> bool:
    """Whether folding saves little: most rows have a key of their own, and none has more than its part."""
    seen = crowds(rows, keys)
    return 2 * seen["keys"] > seen["rows"] and heavy_groups(rows, keys, seen=seen) is None


LOADS = {
    "fact_premium_requests": load_premium_requests,
    "fact_user_day": load_user_day,
    "fact_user_ide_day": load_user_ide_day,
    "fact_user_model_feature_day": load_user_model_feature_day,
    "fact_user_team_day": load_user_team_day,
}


def stamp(df: DataFrame, table: str, loaded_at: str) -> DataFrame:
    """Add the load time and the fact's column order and types. The month stays beside them where rows have it."""
    df = df.withColumn("loaded_at", F.lit(loaded_at).cast("timestamp_ntz"))
    month = [c for c in (PERIODS["month"],) if c in df.columns]
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in FACTS[table].fields), *month)


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows replace target rows with the same key; target rows without one stay."""
    kept = target.join(source.select(*keys), keys, "left_anti")
    return kept.select(*source.columns).unionByName(source)


def insert_only(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows stay as they are; source rows with new keys are added."""
    added = source.join(target.select(*keys), keys, "left_anti")
    return target.select(*source.columns).unionByName(added)
