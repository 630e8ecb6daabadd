"""Shares stored beside the billing rows: plans without an exchange, split user-days, changed days only."""

from datetime import date
from statistics import median

import pytest
from pyspark.sql import functions as F

from checks.queries import events_tables, orders_tables
from spendlens.operators import allocate, governance
from spendlens.plans import load, views
from spendlens.sources.tables import Warehouse

from .conftest import SMALL
from .test_load import NOW, _base, _bill


@pytest.fixture
def no_broadcasts(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("tables", [events_tables, orders_tables])
def test_the_headline_view_moves_no_fact(spark, no_broadcasts, tables):
    plan = views.spend_by_user_model_editor(tables(spark, SMALL))._jdf.queryExecution().executedPlan().toString()
    assert "fact_spend_shares" in plan and plan.count("/fact_") == 1
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert exchanges and all("BroadcastExchange" in line for line in exchanges)


def test_a_dimension_is_only_broadcast_when_its_stored_size_is_small(spark, no_broadcasts, monkeypatch):
    T = events_tables(spark, SMALL)
    assert T.small("dim_user") and not T.small("fact_user_day")
    assert not T.replace(dim_user=T.dim_user).small("dim_user")
    monkeypatch.setattr("spendlens.sources.tables.BROADCAST_ROWS", 3)
    assert not events_tables(spark, SMALL).small("dim_user")


# ------------------------------------------------------------------ a user-day with most of the rows

BILL = "date_key int, user_key string, org_key string, model_key string, product_key string, " \
       "net_quantity decimal(18,4), gross_amount decimal(18,4), net_amount decimal(18,4)"


def _billing(spark, heavy, others):
    one = F.lit(1).cast("decimal(18,4)")
    hot = spark.range(heavy).select(
        F.lit(20260801).alias("date_key"), F.lit("whale").alias("user_key"), F.lit("o").alias("org_key"),
        F.concat(F.lit("m"), F.col("id") % 3).alias("model_key"), F.col("id").cast("string").alias("product_key"),
    )
    rest = spark.range(others).select(
        (F.lit(20260801) + F.col("id") % 3).cast("int").alias("date_key"),
        F.concat(F.lit("u"), F.col("id") % 400).alias("user_key"), F.lit("o").alias("org_key"),
        F.concat(F.lit("m"), F.col("id") % 3).alias("model_key"), F.col("id").cast("string").alias("product_key"),
    )
    return hot.union(rest).select(
        "*", *(one.alias(c) for c in ("net_quantity", "gross_amount", "net_amount"))
    )


def _shares(spark):
    editors = spark.range(400).select(
        F.lit(20260801).alias("date_key"), F.concat(F.lit("u"), "id").alias("user_key"), F.lit("o").alias("org_key"))
    editors = editors.union(editors.limit(1).withColumn("user_key", F.lit("whale")))
    editors = editors.select("*", F.explode(F.array(F.lit("vim"), F.lit("zed"))).alias("editor_key")).select(
        "*", F.lit(0.5).cast("decimal(9,8)").alias("share"), F.lit("equal_split").alias("weight_basis"))
    features = editors.filter("editor_key = 'vim'").select(
        *allocate.USER_DAY, F.lit("m1").alias("model_key"), F.lit("chat").alias("feature_key"),
        F.lit(1).cast("decimal(18,8)").alias("share"))
    return editors, features


def test_a_hot_user_day_is_split_and_its_rows_stay_the_same(spark, rows):
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        billing, (editors, features) = _billing(spark, 6000, 4000), _shares(spark)
        heavy = allocate.heavy_groups(billing, allocate.USER_DAY, 10).collect()
        assert [(r.user_key, r._parts) for r in heavy] == [("whale", 39)]  # 157 rows are a fair part
        split = allocate.with_shares(billing, editors, features, 10)
        sizes = sorted(r["count"] for r in split.groupBy(F.spark_partition_id().alias("p")).count().collect())
        assert sum(sizes) == 10_000 and sizes[-1] < 3 * median(sizes)
        assert rows(split) == rows(allocate.with_shares(billing, editors, features, 10**9))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    whale = split.filter("user_key = 'whale'")
    assert whale.filter("size(editors) = 2").count() == 6000
    assert whale.filter("features is not null").select("model_key").distinct().collect()[0][0] == "m1"
    assert allocate.fan_out(whale).count() == 12_000


def test_no_heavy_group_without_rows_or_with_even_ones(spark):
    billing = _billing(spark, 0, 300)
    assert allocate.heavy_groups(billing, allocate.USER_DAY, 50) is None
    assert allocate.heavy_groups(billing.limit(0), allocate.USER_DAY, 1) is None


# ------------------------------------------------------------------ changed days


def _paths(wh, table):
    return wh._published()[1][table]


@pytest.mark.parametrize("period", ["day", "month"])
def test_two_corrected_days_a_year_apart_touch_two_periods(spark, tmp_path, frames, rows, period):
    wh = Warehouse(spark, str(tmp_path / "wh"), period)
    days = ("2025-08-01", "2025-12-24", "2026-03-03", "2026-08-01")
    load.load_all(wh, frames(_base(days)), loaded_at=NOW)
    before = {t: _paths(wh, t) for t in ("fact_user_ide_share", "fact_spend_shares")}
    later = _base(("2025-08-01", "2026-08-01"))
    later["user_ide"] = [(d, "ann", "acme", "zed", "Zed", 6, 0) for d in ("2025-08-01", "2026-08-01")]
    load.load_all(wh, frames(later), loaded_at=NOW)
    for table, old in before.items():
        new = _paths(wh, table)
        same = {p for p in old if new[p] == old[p]}
        assert same == ({20251224, 20260303} if period == "day" else {202512, 202603})
    shares = rows(wh.tables().fact_user_ide_share, "date_key", "editor_key", F.col("share").cast("string"))
    assert shares == [
        (20250801, "vim", "0.25000000"), (20250801, "zed", "0.75000000"), (20251224, "vim", "1.00000000"),
        (20260303, "vim", "1.00000000"), (20260801, "vim", "0.25000000"), (20260801, "zed", "0.75000000")]
    spend = allocate.allocate(wh.tables()).groupBy("date_key").agg(F.sum("allocated_net_amount").cast("int"))
    assert rows(spend) == [(20250801, 5), (20251224, 5), (20260303, 5), (20260801, 5)]


def test_billing_without_new_activity_finds_the_stored_shares(spark, warehouse, frames, rows):
    load.load_all(warehouse, frames(_base()), loaded_at=NOW)
    late = {"premium_requests": [_bill("2026-08-01", "ann", "3", product="late")], "seats": _base()["seats"]}
    load.load_all(warehouse, frames(late), strict=False, loaded_at=NOW)
    got = rows(allocate.allocate(warehouse.tables()), "date_key", "product_key", "editor_key", "attribution_quality")
    assert got == [
        (20260801, "4:late:sku", "vim", "modelled"), (20260801, "4:plan:sku", "vim", "modelled"),
        (20260802, "4:plan:sku", "vim", "modelled")]


def test_reweighting_and_purging_reach_the_stored_shares(spark, warehouse, frames, rows):
    load.load_all(warehouse, frames(_base()), loaded_at=NOW)
    load.rebuild_shares(warehouse, date(2026, 8, 1), date(2026, 8, 1), "w", NOW, basis=("generations",))
    basis = allocate.allocate(warehouse.tables())
    assert rows(basis, "date_key", "weight_basis") == [(20260801, "code_generations"), (20260802, "user_interactions")]
    governance.purge(warehouse, date(2026, 8, 12), "p", retain_days=10, confirm=True)
    T = warehouse.tables()
    assert rows(allocate.allocate(T), "date_key", "attribution_quality") == [
        (20260801, "exact-unallocated"), (20260802, "modelled")]
    assert T.fact_spend_shares.filter("date_key = 20260801 and editors is null and features is null").count() == 1
    governance.purge(warehouse, date(2026, 8, 12), "q", retain_days=10, include_billing=True, confirm=True)
    assert rows(warehouse.tables().fact_spend_shares, "date_key") == [(20260802,)]
