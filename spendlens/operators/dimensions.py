"""Dimension maintenance: insert what is missing, keep what is known, never renumber."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendlens.functions import columns as C
from spendlens.operators.staging import named
from spendlens.schemas import DIMENSION_KEYS
from spendlens.session import BROADCAST_ROWS
from spendlens.sources.tables import empty

_BUCKETS = 1024

# How the rows that are new to a dimension are kept before they are numbered. Numbering reads them
# twice; a load writes them down first, so the staging tables behind them are scanned once.
Keep = Callable[[DataFrame], DataFrame]


def as_is(df: DataFrame) -> DataFrame:
    return df


# ------------------------------------------------------------------ shared steps


def insert_missing(existing: DataFrame, candidates: DataFrame, key: str) -> DataFrame:
    """Candidate rows whose key is not known yet. Known rows are never refreshed."""
    return candidates.join(existing.select(key), key, "left_anti")


class Checked(dict):
    """The dimensions of a load by name, with the keys that its datasets lack in them (`lists`): listed once for
    all the steps that check."""

    def __init__(self, dims, lists: list[tuple[DataFrame, dict[str, DataFrame]]]):
        super().__init__(dims)
        self.lists = lists


def _absent(rows: DataFrame, dims, names) -> dict[str, DataFrame]:
    found = {}
    for name in names:
        key = DIMENSION_KEYS[name]
        keys = named(rows, [key]).select(key).filter(F.col(key).isNotNull())
        found[name] = insert_missing(dims[name], keys, key).distinct()
    return found


def lacking(rows: DataFrame, dims, names) -> dict[str, DataFrame]:
    """Of each dimension the keys of the rows that it lacks, ready to be joined to the rows. A dimension
    is made from the rows it meets, so these keys are few however many members it has: they are
    broadcast after a count, and the rows stay where they are. A null key is lacking, too, but not listed."""
    listed = next((found for of, found in getattr(dims, "lists", ()) if of is rows), {})
    if set(names) <= set(listed):
        return {name: listed[name] for name in names}
    found = _absent(rows, dims, names)
    if not found:
        return found
    every = reduce(DataFrame.union, [df.select(F.lit(1)) for df in found.values()])
    small = every.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return {name: F.broadcast(df) if small else df for name, df in found.items()}


def list_lacking(rows: DataFrame, dims, names, keep: Keep) -> dict[str, DataFrame]:
    """What `lacking` finds, written down. Where a dimension lacks no key its list is known to be empty, so the
    rows meet no join for it."""
    spark = rows.sparkSession
    absent = _absent(rows, dims, names)
    kept = keep(_union([
        df.select(F.lit(name).alias("dimension"), F.col(DIMENSION_KEYS[name]).alias("key")) for name, df in absent.items()
    ]))
    sizes = {r["dimension"]: r["rows"] for r in kept.groupBy("dimension").agg(F.count("*").alias("rows")).collect()}
    found = {}
    for name, df in absent.items():
        listed = kept.filter(F.col("dimension") == name).select(F.col("key").alias(DIMENSION_KEYS[name]))
        if sum(sizes.values()) <= BROADCAST_ROWS:
            listed = F.broadcast(listed)
        found[name] = listed if sizes.get(name) else empty(spark, df.schema)
    return found


def lacks(rows: DataFrame, dims, names) -> DataFrame:
    """The rows with a flag for each dimension (`_dim_org` and so on): whether it lacks the row's key."""
    for name, keys in lacking(rows, dims, names).items():
        key, flag = DIMENSION_KEYS[name], f"_{name}"
        rows = rows.join(keys.withColumn(flag, F.lit(True)), key, "left")
        rows = rows.withColumn(flag, F.col(flag).isNotNull() | F.col(key).isNull())
    return rows


def assign_keys(new_rows: DataFrame, existing: DataFrame, natural: str, surrogate: str) -> DataFrame:
    """Continue the integer numbering of `existing` over the new rows, without gaps.

    Rows are numbered inside hash buckets of their natural key and shifted by the sizes of the
    buckets before; only the fixed number of bucket sizes is ever brought together. The numbers
    depend on nothing but the keys, so a recomputed task hands out the same ones.
    """
    bucket = F.pmod(F.xxhash64(natural), F.lit(_BUCKETS)).cast("int")
    rows = new_rows.drop(surrogate).withColumn("_bucket", bucket)
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("_bucket")
        .agg(F.count("*").alias("_size"))
        .select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    )
    position = F.row_number().over(Window.partitionBy("_bucket").orderBy(natural))
    last = existing.agg(F.coalesce(F.max(surrogate), F.lit(0)).alias("last")).scalar()
    return (
        rows.withColumn("_position", position)
        .join(F.broadcast(starts), "_bucket")
        .withColumn(surrogate, (last + F.col("_start") + F.col("_position")).cast("bigint"))
        .drop("_bucket", "_position", "_start")
    )


def grow(
    existing: DataFrame, candidates: DataFrame, key: str, surrogate: str, keep: Keep = as_is
) -> DataFrame:
    """The dimension with its missing rows appended and numbered."""
    new_rows = keep(insert_missing(existing, candidates, key))
    keyed = assign_keys(new_rows, existing, key, surrogate)
    return existing.unionByName(keyed.select(*existing.columns))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _spellings(df: DataFrame, key: str, *columns: str) -> DataFrame:
    """Distinct rows of a key and its attributes. Duplicates are hashed away first, because taking
    the least or greatest text of raw rows would sort them all."""
    keys = [key, *(c for c in columns if c.endswith("_key"))]
    return named(df, keys, *columns).filter(C.present(key)).select(key, *columns)


# ------------------------------------------------------------------ calendar


def fill_dim_date(staged: dict[str, DataFrame], existing: DataFrame, keep: Keep = as_is) -> DataFrame:
    """Whole months from the first to the last known day, without gaps after disjoint backfills."""
    sources = [
        staged["user_day"].select(F.col("activity_date").alias("d")),
        staged["premium_requests"].select(F.col("usage_date").alias("d")),
        staged["user_teams"].select(F.col("activity_date").alias("d")),
    ]
    spans = [s.agg(F.min("d").alias("lo"), F.max("d").alias("hi")) for s in sources]
    new = _union(spans).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    old = existing.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    span = (
        new.filter("lo is not null")
        .unionByName(old)
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    )
    days = span.filter("lo is not null").select(
        F.explode(F.sequence(F.trunc("lo", "MM"), F.last_day("hi"))).alias("date")
    )
    calendar = days.select(
        C.date_key("date").alias("date_key"),
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
        F.date_format("date", "MMMM").alias("month_name"),
        F.date_format("date", "yyyy-MM").alias("year_month"),
        (F.weekday("date") + 1).alias("day_of_week"),
        (F.weekday("date") >= 5).alias("is_weekend"),
    )
    return existing.unionByName(keep(insert_missing(existing, calendar, "date_key")))


# ------------------------------------------------------------------ small dimensions


def merge_dim_org(staged: dict[str, DataFrame], existing: DataFrame, keep: Keep = as_is) -> DataFrame:
    seen = _union([df.select("org_key", "org_login") for df in staged.values()])
    candidates = (
        _spellings(seen, "org_key", "org_login")
        .groupBy("org_key")
        .agg(F.min("org_login").alias("org_login"))
    )
    return grow(existing, candidates, "org_key", "org_sk", keep)


def merge_dim_editor(staged: dict[str, DataFrame], existing: DataFrame, keep: Keep = as_is) -> DataFrame:
    candidates = (
        _spellings(staged["user_ide"], "editor_key", "ide", "ide_family")
        .groupBy("editor_key")
        .agg(F.min("ide").alias("editor_name"), F.max("ide_family").alias("editor_family"))
    )
    return grow(existing, candidates, "editor_key", "editor_sk", keep)


def merge_dim_feature(staged: dict[str, DataFrame], existing: DataFrame, keep: Keep = as_is) -> DataFrame:
    candidates = (
        _spellings(staged["user_model_feature"], "feature_key", "feature")
        .groupBy("feature_key")
        .agg(F.min("feature").alias("feature"))
        .withColumn("feature_group", C.feature_group("feature_key"))
    )
    return grow(existing, candidates, "feature_key", "feature_sk", keep)


def merge_dim_model(staged: dict[str, DataFrame], existing: DataFrame, keep: Keep = as_is) -> DataFrame:
    """Models seen in activity or billing."""
    seen = _union(
        [staged[t].select("model_key", "model_name") for t in ("user_model_feature", "premium_requests")]
    )
    candidates = (
        _spellings(seen, "model_key", "model_name")
        .groupBy("model_key")
        .agg(F.min("model_name").alias("model_name"))
        .withColumn("is_custom_model", F.lit(False))
    )
    return grow(existing, candidates, "model_key", "model_sk", keep)


def merge_dim_product(staged: dict[str, DataFrame], existing: DataFrame, keep: Keep = as_is) -> DataFrame:
    """(product, sku) pairs; a blank product gets no row, so its billing stays orphaned."""
    candidates = (
        _spellings(staged["premium_requests"], "product_key", "product", "sku", "unit_type")
        .groupBy("product_key")
        .agg(
            F.min("product").alias("product"),
            F.min("sku").alias("sku"),
            F.max("unit_type").alias("unit_type"),
        )
    )
    return grow(existing, candidates, "product_key", "product_sk", keep)


def merge_dim_team(staged: dict[str, DataFrame], existing: DataFrame, keep: Keep = as_is) -> DataFrame:
    """Teams of named organisations; those are all in dim_org, as it is fed by the same rows."""
    candidates = (
        _spellings(staged["user_teams"], "org_key", "team_key", "team_id", "team_slug")
        .filter("team_id is not null")
        .groupBy("team_key", "team_id", "org_key")
        .agg(F.max("team_slug").alias("team_slug"))
    )
    return grow(existing, candidates, "team_key", "team_sk", keep)


# ------------------------------------------------------------------ users


def _known_text(name: str):
    return F.max(F.nullif(name, F.lit("")))


def upsert_dim_user_from_seats(staged: dict[str, DataFrame], existing: DataFrame) -> DataFrame:
    """Seat holders: new values replace old ones, blanks never do; cost centers are not touched.

    Rows that are new have no number yet.
    """
    seats = (
        staged["seats"]
        .filter(C.present("user_key"))
        .groupBy("user_key")
        .agg(
            F.min("user_login").alias("_login"),
            F.max(F.nullif("user_id", F.lit(0))).alias("_user_id"),
            _known_text("team_name").alias("_team_name"),
            _known_text("plan_type").alias("_plan_type"),
            F.max("created_at").alias("_created_at"),
            F.max("last_activity_at").alias("_last_activity_at"),
            _known_text("last_activity_editor").alias("_last_activity_editor"),
            F.lit(True).alias("_seat"),
        )
    )
    return existing.join(seats, "user_key", "full").select(
        "user_sk",
        "user_key",
        F.coalesce("user_login", "_login").alias("user_login"),
        F.coalesce("_user_id", "external_user_id").alias("external_user_id"),
        F.coalesce("_team_name", "team_name").alias("team_name"),
        "cost_center",
        F.coalesce("_plan_type", "plan_type").alias("plan_type"),
        F.coalesce("_created_at", "seat_created_at").alias("seat_created_at"),
        F.coalesce("_last_activity_at", "last_activity_at").alias("last_activity_at"),
        F.coalesce("_last_activity_editor", "last_activity_editor").alias("last_activity_editor"),
        F.coalesce("_seat", "is_active").alias("is_active"),
    )


def missing_users(staged: dict[str, DataFrame], known: DataFrame) -> DataFrame:
    """Users seen in activity, billing or teams that have no row yet."""
    seen = _union(
        [
            staged["user_day"].select("user_key", "user_login", "user_id"),
            staged["premium_requests"].select(
                "user_key", "user_login", F.lit(None).cast("bigint").alias("user_id")
            ),
            staged["user_teams"].select("user_key", "user_login", "user_id"),
        ]
    )
    candidates = (
        _spellings(seen, "user_key", "user_login", "user_id")
        .groupBy("user_key")
        .agg(
            F.min("user_login").alias("user_login"),
            F.max(F.nullif("user_id", F.lit(0))).alias("external_user_id"),
        )
        .withColumn("is_active", F.lit(True))
    )
    return insert_missing(known, candidates, "user_key")


def merge_dim_user(staged: dict[str, DataFrame], existing: DataFrame, keep: Keep = as_is) -> DataFrame:
    upserted = upsert_dim_user_from_seats(staged, existing)
    unnumbered = keep(
        upserted.filter("user_sk is null").unionByName(
            missing_users(staged, upserted), allowMissingColumns=True
        )
    )
    numbered = assign_keys(unnumbered, existing, "user_key", "user_sk")
    return upserted.filter("user_sk is not null").unionByName(numbered.select(*existing.columns))


def set_cost_center(dim_user: DataFrame, mapping: DataFrame | None = None) -> DataFrame:
    """Fill missing cost centers from the team, or take them from (user_login, cost_center) rows."""
    if mapping is None:
        return dim_user.withColumn("cost_center", F.coalesce("cost_center", "team_name"))
    wanted = mapping.groupBy(C.norm("user_login").alias("user_key")).agg(
        F.max("cost_center").alias("_mapped"), F.lit(True).alias("_listed")
    )
    return (
        dim_user.join(wanted, "user_key", "left")
        .withColumn(
            "cost_center", F.when(F.col("_listed"), F.col("_mapped")).otherwise(F.col("cost_center"))
        )
        .select(*dim_user.columns)
    )


MERGES = {
    "dim_date": fill_dim_date,
    "dim_org": merge_dim_org,
    "dim_editor": merge_dim_editor,
    "dim_feature": merge_dim_feature,
    "dim_model": merge_dim_model,
    "dim_product": merge_dim_product,
    "dim_user": merge_dim_user,
    "dim_team": merge_dim_team,
}


def merge_dimensions(staged: dict[str, DataFrame], existing) -> dict[str, DataFrame]:
    """All dimensions after this load; `existing` maps table names to their present content."""
    return {name: merge(staged, existing[name]) for name, merge in MERGES.items()}
