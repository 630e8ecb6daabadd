"""Checks: reconciliation, payload contract, seats, billing plan, constraints, allocation drift."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendlens import fixed_values as V
from spendlens.functions import columns as C
from spendlens.operators import dimensions
from spendlens.operators.allocate import USER_DAY_MODEL, allocate, between
from spendlens.schemas import DIMENSION_KEYS

_SALTS = 64


class LoadError(RuntimeError):
    """A load that must not be published."""

    def __init__(self, number: int, message: str):
        super().__init__(f"{number}: {message}")
        self.number = number


class SeatsUnavailable(RuntimeError):
    """An organisation has no seat with a login, so its spend cannot be attributed."""


class ConstraintViolation(RuntimeError):
    """A table breaks its key, range or reference constraint."""


# ------------------------------------------------------------------ reconciliation


_RECONCILED = {
    "user_day": ("rows_user_day", None, ()),
    "user_ide": ("rows_user_ide", "orphaned_user_ide", ("dim_org", "dim_editor", "dim_user")),
    "user_model_feature": (
        "rows_model_feature",
        "orphaned_user_model_feature",
        ("dim_org", "dim_model", "dim_feature", "dim_user"),
    ),
    "seats": ("rows_seats", None, ()),
    "premium_requests": (
        "rows_premium_requests",
        "orphaned_billing",
        ("dim_org", "dim_model", "dim_product", "dim_user"),
    ),
}


def _mapped(df: DataFrame, dims, names) -> DataFrame:
    """Staged rows, and those of them that miss a row in one of the dimensions. Only distinct keys move."""
    missing = reduce(Column.__or__, [F.col(f"_{n}") for n in names], F.lit(False))
    return dimensions.lacks(df, dims, names).agg(
        F.count("*").alias("rows"), F.count_if(missing).alias("orphans")
    )


def reconcile(staged: dict[str, DataFrame], dims) -> DataFrame:
    """One row of staged row counts and orphans. Billing orphans fail a strict load; activity rows
    without dimensions are left out of the facts and only reported."""
    parts, columns = None, []
    for dataset, (rows, orphans, names) in _RECONCILED.items():
        part = _mapped(staged[dataset], dims, names).withColumn("dataset", F.lit(dataset))
        parts = part if parts is None else parts.unionByName(part)
        for column, source in ((rows, "rows"), (orphans, "orphans")):
            if column:
                of_dataset = F.when(F.col("dataset") == dataset, F.col(source))
                columns.append(F.max(of_dataset).cast("bigint").alias(column))
    return parts.agg(*columns)


def check_load(counts: dict[str, int], strict: bool = True) -> list[str]:
    """Raise what a strict load must not survive; return what any load should say.

    Orphans are told in every mode: billing without dimensions is money that no report shows."""
    billing, activity, seats = (
        counts[f"rows_{name}"] for name in ("premium_requests", "user_day", "seats")
    )
    faults = {
        V.ORPHANED_BILLING: (
            counts["orphaned_billing"] > 0,
            f"{counts['orphaned_billing']} billing rows cannot be joined to all of their dimensions",
        ),
        V.NOTHING_STAGED: (not billing and not activity, "no billing and no activity to load"),
        V.NO_SEATS: (bool(activity) and not seats, "there are users with activity but no seats at all"),
    }
    found = {number: text for number, (wrong, text) in faults.items() if wrong}
    if strict and found:
        number = next(iter(found))
        raise LoadError(number, found[number])
    told = list(found.values())
    if seats and not billing:
        told.append("seats came without any billing")
    for dataset in ("user_ide", "user_model_feature"):
        orphans = counts[f"orphaned_{dataset}"]
        if orphans:
            told.append(f"{orphans} rows of {dataset} lack a dimension and stay out of the facts")
    return told


def orphans(staged: DataFrame, dims, dataset: str) -> DataFrame:
    """The staged rows of a dataset that miss a dimension row, with the names of what they miss."""
    names = _RECONCILED[dataset][2]
    marked = dimensions.lacks(staged, dims, names)
    missing = F.filter(
        F.array(*(F.when(F.col(f"_{n}"), F.lit(n)) for n in names)), lambda n: n.isNotNull()
    )
    return (
        marked.withColumn("missing", missing).filter(F.size("missing") > 0).select(*staged.columns, "missing")
    )


# ------------------------------------------------------------------ payload contract

_CONTRACT = {
    "user_activity": (
        "user_metrics", {"totals_by_ide": "totals_by_ide[]",
                         "totals_by_model_feature": "totals_by_model_feature[]"},
    ),
    "user_teams": ("user_teams", {}),
    "premium_requests": ("premium_request_usage", {"usageItems": "usageItems[]"}),
    "seats": ("seats", {}),
}


def _objects(lines: DataFrame, kind: str) -> DataFrame:
    """One variant per record of the lines; billing rows are unwrapped to their payload."""
    line = F.col("line")
    array = F.when(C.strip("line").startswith("["), line).otherwise(
        F.concat(F.lit("["), line, F.lit("]"))
    )
    records = lines.select(F.explode(F.from_json(array, "array<variant>")).alias("v"))
    if kind == "premium_requests":
        records = records.select(F.variant_get("v", "$.payload", "variant").alias("v"))
    return records.filter("v is not null")


def _has(entry, name: str) -> Column:
    """Whether the object carries the field, be it null."""
    return F.variant_get(entry, f"$.{name}", "variant").isNotNull()


def _entries(name: str) -> Column:
    """The objects of a nested array; none when it is absent."""
    entries = F.variant_get("v", f"$.{name}", "array<variant>")
    return F.coalesce(F.filter(entries, lambda e: e.isNotNull()), F.array().cast("array<variant>"))


def payload_contract(lines: DataFrame, kind: str) -> DataFrame:
    """Per record type and expected field: how many of all landed records carry it. One pass."""
    top, children = _CONTRACT[kind]
    counts, rows = [], []

    def add(record_type: str, records: Column, present) -> None:
        counts.append(F.coalesce(records, F.lit(0)).cast("bigint").alias(f"n_{record_type}"))
        for field in V.EXPECTED_FIELDS[record_type]:
            name = f"p_{record_type}_{field}"
            counts.append(F.coalesce(present(field), F.lit(0)).cast("bigint").alias(name))
            rows.append(
                F.struct(
                    F.lit(record_type).alias("record_type"),
                    F.lit(field).alias("field"),
                    F.col(f"`n_{record_type}`").alias("records"),
                    F.col(f"`{name}`").alias("present"),
                )
            )

    add(top, F.count("*"), lambda field: F.count_if(_has(F.col("v"), field)))
    for array, record_type in children.items():
        def present(field, array=array):
            return F.sum(F.size(F.filter(_entries(array), lambda e: _has(e, field))))

        add(record_type, F.sum(F.size(_entries(array))), present)
    totals = _objects(lines, kind).agg(*counts)
    return totals.select(F.inline(F.array(*rows))).withColumn(
        "missing", F.col("records") - F.col("present")
    )


def observed_values(lines: DataFrame) -> DataFrame:
    """dimension, value, entries: which editors, models and features the activity names."""

    def values(array: str, field: str) -> Column:
        return F.transform(
            _entries(array),
            lambda e: F.struct(
                F.lit(field).alias("dimension"),
                F.coalesce(F.variant_get(e, f"$.{field}", "string"), F.lit("?")).alias("value"),
            ),
        )

    found = F.concat(
        values("totals_by_ide", "ide"),
        values("totals_by_model_feature", "model"),
        values("totals_by_model_feature", "feature"),
    )
    records = _objects(lines, "user_activity").select(F.explode(found).alias("f"))
    return records.select("f.*").groupBy("dimension", "value").agg(F.count("*").alias("entries"))


def cross_product_published(lines: DataFrame) -> DataFrame:
    """Whether any editor entry also names a model, which would make the split exact."""
    crossed = F.exists(_entries("totals_by_ide"), lambda e: _has(e, "ide") & _has(e, "model"))
    return _objects(lines, "user_activity").agg(
        F.coalesce(F.bool_or(crossed), F.lit(False)).alias("cross_product")
    )


# ------------------------------------------------------------------ seats and billing plan


#: Organisations that an error or a warning names at most.
EXAMPLES = 20


def seats_by_org(seats: DataFrame) -> DataFrame:
    """Per organisation: seats and seats with a login."""
    return seats.groupBy("org_login").agg(
        F.count("*").alias("seats"), F.count_if(C.present("user_login")).alias("usable")
    )


def seat_guard(seats: DataFrame, orgs: DataFrame, strict: bool = True) -> DataFrame:
    """The organisations (org_login) without a usable seat: an error that names some, or rows to warn about."""
    usable = seats_by_org(seats).filter("usable > 0")
    bare = orgs.select("org_login").filter("org_login is not null").distinct().join(usable, "org_login", "left_anti")
    if strict:
        some = [r.org_login for r in bare.limit(EXAMPLES).collect()]
        if some:
            raise SeatsUnavailable(f"No seats with a login in: {', '.join(sorted(some))}")
    return bare


def _placed_users(seats: DataFrame, max_users: int) -> DataFrame:
    """org_login, user_login and whether a user is among the first by name of the organisation.

    The cut is found twice, inside salts of each organisation and then over what they keep, so even
    an organisation with most of the seats sends no more than the limit per salt to one task."""
    users = seats.filter(C.present("user_login")).select("org_login", "user_login").dropDuplicates()
    first = users.withColumn("_salt", F.pmod(F.xxhash64("user_login"), F.lit(_SALTS)))
    for keys in (["org_login", "_salt"], ["org_login"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("user_login"))
        first = first.withColumn("_place", place).filter(F.col("_place") <= max_users)
    last = first.groupBy(F.col("org_login").alias("_org")).agg(F.max("user_login").alias("_last"))
    return users.join(last, F.col("org_login").eqNullSafe(F.col("_org"))).select(
        "org_login", "user_login", (F.col("user_login") <= F.col("_last")).alias("planned")
    )


def billing_plan(seats: DataFrame, since, until, max_users: int | None = None) -> DataFrame:
    """org_login, user_login, usage_date to ask billing for: every user, every day. A caller that
    sets `max_users` per organisation gets the first by name; the others: `billing_plan_left_out`."""
    if max_users is None:
        users = seats.filter(C.present("user_login")).select("org_login", "user_login").dropDuplicates()
    else:
        users = _placed_users(seats, max_users).filter("planned").drop("planned")
    days = F.sequence(F.lit(str(since)).cast("date"), F.lit(str(until)).cast("date"))
    return users.select("org_login", "user_login", F.explode(days).alias("usage_date"))


def billing_plan_left_out(seats: DataFrame, max_users: int) -> DataFrame:
    """Per organisation: users, and how many of them a plan with this limit leaves out."""
    return _placed_users(seats, max_users).groupBy("org_login").agg(
        F.count("*").alias("users"), F.count_if(~F.col("planned")).alias("left_out")
    )


# ------------------------------------------------------------------ constraints


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).filter("rows > 1")


def out_of_range(df: DataFrame, column: str, low, high) -> DataFrame:
    c = F.col(column)
    return df.filter(c.isNull() | (c < low) | (c > high))


def dangling(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    return fact.join(dim.select(key), key, "left_anti")


def _require_none(df: DataFrame, message: str) -> None:
    found = df.limit(1).collect()
    if found:
        raise ConstraintViolation(f"{message}, for example {found[0].asDict()}")


def assert_grain(df: DataFrame, keys: list[str]) -> None:
    _require_none(duplicate_keys(df, keys), f"More than one row per {', '.join(keys)}")


def assert_range(df: DataFrame, column: str, low=0, high=1) -> None:
    _require_none(out_of_range(df, column, low, high), f"{column} outside {low}..{high}")


def assert_fk(fact: DataFrame, dim: DataFrame, key: str) -> None:
    _require_none(dangling(fact, dim, key), f"{key} without a dimension row")


# ------------------------------------------------------------------ allocation drift


def allocation_drift(T, since=None, until=None) -> DataFrame:
    """Per billing row: exact amount, allocated total, and their absolute difference.

    Shares are rounded, so a little drift is expected; it is measured, not hidden.
    """
    keys = [*USER_DAY_MODEL, "product_key"]
    split = allocate(T, since, until).groupBy(*keys).agg(
        F.sum("allocated_net_amount").cast(C.ALLOCATED_TOTAL).alias("allocated")
    )
    exact = between(T.fact_premium_requests, since, until).select(*keys, "net_amount")
    return exact.join(split, keys, "left").withColumn(
        "drift", F.abs(F.col("net_amount") - F.coalesce("allocated", F.lit(0)))
    )
