"""Staging: typed rows with their join keys. Keys follow from the row, so a load stores the typed rows and
adds the keys where these are read: names are not written twice."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlens.functions import columns as C
from spendlens.operators import flatten
from spendlens.schemas import STAGING

_KEYS: dict[str, dict[str, Callable[[], Column]]] = {
    "activity_date": {"date_key": lambda: C.date_key("activity_date")},
    "usage_date": {"date_key": lambda: C.date_key("usage_date")},
    "user_login": {"user_key": lambda: C.norm("user_login")},
    "org_login": {"org_key": lambda: C.norm("org_login")},
    "model_name": {"model_key": lambda: C.norm("model_name")},
    "ide": {"editor_key": lambda: C.norm("ide")},
    "feature": {"feature_key": lambda: C.norm("feature")},
    "sku": {"product_key": lambda: C.product_key("product", "sku")},
    "team_id": {"team_key": lambda: C.team_key("team_id", C.norm("org_login"))},
}

#: What a key is made from, where that is more than the field it stands beside above.
_NAMES = {"product_key": ("product", "sku"), "team_key": ("team_id", "org_login")}
_MADE = [(key, _NAMES.get(key, (field,)), make) for field, own in _KEYS.items() for key, make in own.items()]


@dataclass(frozen=True)
class Dataset:
    """How one staging table is made. Adding a source means adding an entry to DATASETS."""

    name: str
    raw: str
    flatten: Callable[[DataFrame], DataFrame]


DATASETS = {
    d.name: d
    for d in (
        Dataset("user_day", "user_activity", flatten.flatten_user_day),
        Dataset("user_ide", "user_activity", flatten.flatten_user_ide),
        Dataset("user_model_feature", "user_activity", flatten.flatten_user_model_feature),
        Dataset("user_teams", "user_teams", flatten.flatten_user_teams),
        Dataset("premium_requests", "premium_requests", flatten.flatten_premium_requests),
        Dataset("seats", "seats", flatten.flatten_seats),
    )
}


def typed(df: DataFrame, name: str) -> DataFrame:
    """Cast to the staging schema, absent columns as NULL."""
    have = set(df.columns)
    return df.select(*(
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in STAGING[name].fields
    ))


def with_keys(df: DataFrame, name: str) -> DataFrame:
    """Typed rows with their join keys."""
    keys = {
        key: expression()
        for field in STAGING[name].names
        for key, expression in _KEYS.get(field, {}).items()
    }
    return df.withColumns(keys)


def named(df: DataFrame, keys: Iterable[str], *others: str) -> DataFrame:
    """The distinct names behind some keys, and other fields, with the keys: each is made once for a name instead
    of once for a row. Rows that hold the keys without the names are told apart by the keys."""
    made = {key: (names, expression) for key, names, expression in _MADE if key in keys}
    names = [name for key in keys for name in made[key][0]]
    if not set(names) <= set(df.columns):
        return df.select(*dict.fromkeys([*keys, *others])).distinct()
    told = df.select(*dict.fromkeys([*names, *(o for o in others if o not in keys)])).distinct()
    return told.withColumns({key: made[key][1]() for key in keys})


def stage(datasets: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All six staging tables; a dataset that is not given is staged empty."""
    return {name: with_keys(df, name) for name, df in stage_typed(datasets).items()}


def stage_typed(datasets: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The staging tables as a load stores them, without the keys."""
    staged = {}
    for name in STAGING:
        df = datasets.get(name)
        if df is None:
            spark = next(iter(datasets.values())).sparkSession
            df = spark.createDataFrame([], STAGING[name])
        staged[name] = typed(df, name)
    return staged
