"""Allocation: exact dollars of (user, day, model) times editor share times feature share.

Group totals are aggregated and joined back rather than computed over a window: the totals fold
before the shuffle, and a group of any size can be split between tasks by the skew-join rule. Rows that
were dealt by user-day already take their totals from a window there. The
shares are put beside the billing rows when these are loaded, with user-days that hold more than their
part of the rows split; what reads allocated spend then splits each row by itself.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from spendlens import fixed_values as V
from spendlens.functions import columns as C
from spendlens.sources.tables import PERIODS, RANGE, deal_days, grouped_by, rows_by_day

USER_DAY = ["date_key", "user_key", "org_key"]
USER_DAY_MODEL = [*USER_DAY, "model_key"]
#: Rows below which no group is worth splitting.
HEAVY_LEAST = 100_000
EXACT_MEASURES = ("net_amount", "gross_amount", "net_quantity")

_SIGNALS = {
    "interactions": ("user_initiated_interaction_count", V.BY_INTERACTIONS),
    "generations": ("code_generation_activity_count", V.BY_GENERATIONS),
}
_FEATURE_SIGNAL = "user_initiated_interaction_count"
#: Buckets in which rows are counted before their groups are.
_CROWDS = 1 << 16


def between(df: DataFrame, since=None, until=None, user_key: str | None = None) -> DataFrame:
    """Slice a fact by its partition column and user before any join or aggregate."""
    monthly = "month_key" in df.columns
    if since is not None:
        first = C.to_date_key(since)
        df = df.filter(F.col("date_key") >= first)
        df = df.filter(F.col("month_key") >= first // 100) if monthly else df
    if until is not None:
        last = C.to_date_key(until)
        df = df.filter(F.col("date_key") <= last)
        df = df.filter(F.col("month_key") <= last // 100) if monthly else df
    if user_key is not None:
        df = df.filter(F.col("user_key") == user_key)
    return df


def _portion(part, whole):
    return part.cast("decimal(18,6)") / whole.cast("decimal(20,0)")


def ide_share(
    fact_user_ide_day: DataFrame,
    since=None,
    until=None,
    basis: tuple[str, ...] = ("interactions", "generations"),
    fallback: str | None = "equal",
    dealt: bool = False,
) -> DataFrame:
    """Share of each editor in its (day, user, organisation), by the first signal that is present.

    Editors without weight get no row. Without a fallback, user-days that show no signal get none
    either and their spend stays unallocated. Editors that come `dealt`, each user-day in one place,
    meet their totals there.
    """
    names = [_SIGNALS[b][0] for b in basis]
    group = grouped_by(fact_user_ide_day, USER_DAY) if dealt else USER_DAY
    scoped = between(fact_user_ide_day, since, until).select(*group, "editor_key", *names)
    whole = {**{f"total_{n}": F.sum(n) for n in names}, "editors": F.count("*")}
    if dealt:
        day = Window.partitionBy(*group)
        totalled = scoped.dropna(subset=USER_DAY).withColumns({n: total.over(day) for n, total in whole.items()})
    else:
        totals = scoped.groupBy(*USER_DAY).agg(*(total.alias(n) for n, total in whole.items()))
        totalled = scoped.join(totals, USER_DAY)
    share = _portion(F.lit(1), F.col("editors")) if fallback == "equal" else F.lit(None)
    reason = F.lit(V.EQUAL_SPLIT)
    for b in reversed(basis):
        name, why = _SIGNALS[b]
        total = F.col(f"total_{name}")
        share = F.when(total > 0, _portion(F.col(name), total)).otherwise(share)
        reason = F.when(total > 0, F.lit(why)).otherwise(reason)
    return (
        totalled
        .select(*group, "editor_key", share.alias("weight"), reason.alias("weight_basis"))
        .filter(F.col("weight") > 0)
        .select(*group, "editor_key", F.col("weight").cast(C.IDE_SHARE).alias("share"), "weight_basis")
        .drop(RANGE)
    )


def feature_share(
    fact_user_model_feature_day: DataFrame, since=None, until=None, user_key: str | None = None
) -> DataFrame:
    """Share of each feature in its (day, user, organisation, model); zero shares are kept."""
    scoped = between(fact_user_model_feature_day, since, until, user_key).select(
        *USER_DAY_MODEL, "feature_key", _FEATURE_SIGNAL
    )
    totals = scoped.groupBy(*USER_DAY_MODEL).agg(
        F.sum(_FEATURE_SIGNAL).alias("total"), F.count("*").alias("features")
    )
    share = _feature_portion(F.col(_FEATURE_SIGNAL), F.col("total"), F.col("features"))
    return scoped.join(totals, USER_DAY_MODEL).select(*USER_DAY_MODEL, "feature_key", share.alias("share"))


def _feature_portion(part, total, features):
    equal = _portion(F.lit(1), features)
    return F.when(total > 0, _portion(part, total)).otherwise(equal).cast(C.FEATURE_SHARE)


def attribution_quality(ide, feature):
    return (
        F.when(ide.isNull() & feature.isNull(), V.EXACT_UNALLOCATED)
        .when(ide.isNull(), V.FEATURE_ONLY)
        .otherwise(V.MODELLED)
    )


# ------------------------------------------------------------------ shares beside the billing rows


def _bucket(keys: list[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(_CROWDS)).cast("int")


def crowds(rows: DataFrame, keys: list[str]) -> Row:
    """In one reading: how many rows there are (`rows`), how many the fullest of the hash buckets holds (`most`) and
    about how many keys differ (`keys`): the least hash of a bucket tells how many it holds, to 0.4 % over all."""
    free = F.shiftrightunsigned(F.xxhash64(*keys), 16) / float(1 << 48)  # of the bits that tell the bucket
    counted = rows.groupBy(_bucket(keys).alias("_bucket")).agg(F.count(F.lit(1)).alias("_rows"), F.min(free).alias("_least"))
    told = counted.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)), F.coalesce(F.max("_rows"), F.lit(0)),
        F.count(F.lit(1)), F.coalesce(F.sum("_least"), F.lit(0.0)),
    ).first()
    n, most, full, least = told
    if full < 0.9 * _CROWDS:
        return Row(rows=n, most=most, keys=-_CROWDS * math.log1p(-full / _CROWDS))
    # (1 - exp(-x)) / x is the mean of the least of x hashes, an empty bucket counting as 1
    mean, x = (least + _CROWDS - full) / _CROWDS, 1.0
    for _ in range(100):
        x = -math.expm1(-x) / mean
    return Row(rows=n, most=most, keys=_CROWDS * x)


def heavy_groups(rows: DataFrame, keys: list[str], least: int = HEAVY_LEAST, *, seen: Row | None = None) -> DataFrame | None:
    """The groups that hold more than a fair part of the rows, with the number of parts to split each
    into; None without one. A fair part is a quarter of a shuffle partition's, so there are at most four
    such groups for each partition, however many rows there are. Rows are counted by a hash of their keys
    first (`seen`, their `crowds`), so only groups of crowded hashes are counted one by one."""
    spark = rows.sparkSession
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    fair = max(least, -(-(rows.count() if seen is None else seen.rows) // parts))
    if seen is not None and seen.most <= fair:
        return None
    bucket = _bucket(keys)
    counted = rows.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_rows"))
    crowded = [r["_bucket"] for r in counted.filter(F.col("_rows") > fair).collect()]
    if not crowded:
        return None
    sizes = rows.filter(bucket.isin(crowded)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    found = sizes.filter(F.col("_rows") > fair).collect()
    if not found:
        return None
    schema = StructType([*(rows.schema[k] for k in keys), StructField("_parts", IntegerType())])
    split = [(*(r[k] for k in keys), -(-r["_rows"] // fair)) for r in found]
    return spark.createDataFrame(split, schema).coalesce(1)


def with_shares(
    billing: DataFrame, editors: DataFrame, features: DataFrame, least: int = HEAVY_LEAST
) -> DataFrame:
    """Billing rows with the shares of their user-day (`editors`) and model (`features`, with their `share` or
    as the fact counts them) as arrays, null where there are none. All rows move once, to ranges of their
    user-day, in which the result stays. A user-day with more than its part of the rows is dealt over several
    parts, each with a copy of its shares."""
    weighed = "share" in features.columns
    weight = "share" if weighed else _FEATURE_SIGNAL
    bill = F.struct("product_key", *EXACT_MEASURES)
    editor = F.struct("editor_key", "share", "weight_basis")
    feature = F.struct("feature_key", F.col(weight).alias("weight"))
    month = [c for c in (PERIODS["month"],) if all(c in df.columns for df in (billing, editors, features))]
    bills = billing.select(*month, *USER_DAY_MODEL, bill.alias("_bill"))
    both = editors.dropna(subset=USER_DAY).select(*month, *USER_DAY, editor.alias("_editor")).unionByName(
        features.dropna(subset=USER_DAY_MODEL).select(*month, *USER_DAY_MODEL, feature.alias("_feature")),
        allowMissingColumns=True,
    )
    heavy = heavy_groups(billing, USER_DAY, least)
    key = USER_DAY
    if heavy is not None:
        key = [*USER_DAY, "_part"]
        of_row = F.pmod(F.xxhash64(*USER_DAY_MODEL, "_bill.product_key"), F.coalesce("_parts", F.lit(1)))
        bills = bills.join(F.broadcast(heavy), USER_DAY, "left").withColumn("_part", of_row.cast("int"))
        all_parts = F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))
        both = both.join(F.broadcast(heavy), USER_DAY, "left").withColumn("_part", all_parts)
    moved = deal_days(
        bills.select(*month, *key, "model_key", "_bill").unionByName(
            both.select(*month, *key, "model_key", "_editor", "_feature"), allowMissingColumns=True
        ),
        key, rows_by_day(billing, editors, features),
    )
    group = grouped_by(moved, key)
    model = Window.partitionBy(*group, "model_key")
    # in the order of models, so that one sort serves both windows
    day = Window.partitionBy(*group).orderBy("model_key").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    feature = F.col("_feature")
    beside = moved.withColumns({
        "_features": F.collect_list(feature).over(model),
        **({} if weighed else {"_total": F.sum("_feature.weight").over(model), "_count": F.count(feature).over(model)}),
    }).withColumn("_editors", F.collect_list("_editor").over(day)).filter("_bill is not null")

    def or_null(array):
        return F.when(F.size(array) > 0, F.array_sort(array))

    def shared(f):
        share = f["weight"] if weighed else _feature_portion(f["weight"], F.col("_total"), F.col("_count"))
        return F.struct(f["feature_key"].alias("feature_key"), share.alias("share"))

    return beside.select(
        *month, *USER_DAY_MODEL, "_bill.*",
        or_null(F.col("_editors")).alias("editors"), F.transform(or_null(F.col("_features")), shared).alias("features"),
    )


def fan_out(billing: DataFrame) -> DataFrame:
    """Billing rows with their shares, and whatever labels they carry, split over the editors and features
    of their user and day: each row by itself, without a join. The exact measures do not leave: summed
    over fanned-out rows they would overstate.
    """
    ide, feature = F.col("_ide"), F.col("_feature")
    ide_or_one = F.coalesce(ide, F.lit(1).cast(C.IDE_SHARE))
    feature_or_one = F.coalesce(feature, F.lit(1).cast(C.FEATURE_SHARE))

    def allocated(name: str):
        return (F.col(name) * ide_or_one * feature_or_one).cast(C.ALLOCATED)

    carried = [c for c in billing.columns if c not in (*EXACT_MEASURES, "editors", "features")]
    by_editor = billing.select(
        *carried, *EXACT_MEASURES, "features",
        F.inline_outer("editors").alias("editor_key", "_ide", "weight_basis"),
    )
    return by_editor.select(
        *carried, *EXACT_MEASURES, "editor_key", "_ide", "weight_basis",
        F.inline_outer("features").alias("feature_key", "_feature"),
    ).select(
        *carried,
        "editor_key",
        "feature_key",
        ide_or_one.alias("ide_share"),
        feature_or_one.alias("feature_share"),
        "weight_basis",
        allocated("net_amount").alias("allocated_net_amount"),
        allocated("gross_amount").alias("allocated_gross_amount"),
        allocated("net_quantity").alias("allocated_quantity"),
        attribution_quality(ide, feature).alias("attribution_quality"),
    )


def billing_rows(T, since=None, until=None, user_key: str | None = None) -> DataFrame:
    return between(T.fact_spend_shares, since, until, user_key).select(
        *USER_DAY_MODEL, "product_key", *EXACT_MEASURES, "editors", "features"
    )


def allocate(T, since=None, until=None, user_key: str | None = None) -> DataFrame:
    """Allocated rows by key; labels are attached by the views."""
    return fan_out(billing_rows(T, since, until, user_key))
