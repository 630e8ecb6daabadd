"""What a load moves: rows meet large dimensions without being dealt by user, bitmaps move as numbers."""

import re

import pytest
from pyspark.sql import functions as F

from spendlens import fixed_values as V
from spendlens.operators import allocate, dimensions, distinct_users, facts, quality, staging
from spendlens.schemas import FACT_KEYS
from spendlens.sources import derive, raw
from spendlens.sources.tables import Warehouse, deal
from spendlens.streaming import ingest

IDES = "date_key int, user_key string, org_key string, editor_key string, n int"


@pytest.fixture
def no_broadcast(spark):
    """Every dimension as if it were larger than Spark broadcasts by itself."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def dims(spark):
    return {
        "dim_date": spark.createDataFrame([(20240101,)], "date_key int"),
        "dim_org": spark.createDataFrame([("o",)], "org_key string"),
        "dim_editor": spark.createDataFrame([("vim",)], "editor_key string"),
        "dim_user": spark.createDataFrame([("ann", 1), ("bob", 40_000)], "user_key string, user_sk bigint"),
    }


@pytest.fixture
def staged(spark):
    return spark.createDataFrame(
        [
            (20240101, "ann", "o", "vim", 1), (20240101, "ann", "o", "vim", 2), (20240101, "ghost", "o", "vim", 3),
            (20240101, None, "o", "vim", 4), (20240101, "bob", None, "vim", 5), (None, "bob", "o", "vim", 6),
            (20240101, "bob", "o", "vim", 7), (20240101, "bob", "x", "zed", 8),
        ],
        IDES,
    )


def test_dimension_checks_leave_the_rows_where_they_are(spark, rows, staged, dims, no_broadcast):
    known = facts._with_dimensions(staged, staged, dims, "dim_org", "dim_editor", "dim_user")
    assert sorted(r.n for r in known.collect()) == [1, 2, 7]
    assert "SortMergeJoin" not in _plan(known).split("BroadcastExchange")[0]


def test_reconciliation_moves_keys_only(staged, dims, no_broadcast):
    names = ("dim_org", "dim_editor", "dim_user")
    counted = quality._mapped(staged, dims, names)
    assert tuple(counted.first()) == (8, 4)
    assert "SortMergeJoin" not in _plan(counted).split("BroadcastExchange")[0]
    lost = {r.n: r for r in dimensions.lacks(staged, dims, names).collect()}
    assert [n for n in sorted(lost) if lost[n]["_dim_user"]] == [3, 4]
    assert [n for n in sorted(lost) if lost[n]["_dim_org"]] == [5, 8]


def test_no_partial_bitmap_moves(staged, dims):
    made = distinct_users.build({"activity": staged, "billing": staged.limit(1)}, dims["dim_user"])
    plan = _plan(made)
    assert plan.index("partial_bitmap_construct_agg") < plan.index("Exchange hashpartitioning(date_key")
    found = made.filter("date_key is not null and org_key = 'o' and source = 'activity'").groupBy().agg(
        F.sum(F.bitmap_count("users")).alias("users"), F.count("*").alias("bitmaps")
    )
    assert tuple(found.first()) == (2, 2)


# ------------------------------------------------------------------ one exchange for each fact

TEAMS = "date_key int, user_key string, org_key string, team_key string"


def _moves(df):
    planned = _plan(df).split("== Initial Plan ==")[-1]
    return [line for line in planned.splitlines() if "Exchange" in line and "BroadcastExchange" not in line]


def test_parts_follow_the_rows(spark):
    df = spark.range(1000).withColumn("key", F.col("id"))
    assert deal(df, ["key"], 3_000_000).rdd.getNumPartitions() == 12
    assert "REPARTITION_BY_COL" in _moves(deal(df, ["key"], 100))[0]


def test_dealt_rows_fold_where_they_are_stored(spark, rows, dims):
    dims = dims | {"dim_team": spark.createDataFrame([("t",)], "team_key string")}
    data = [(20240101, u, "o", t) for u in ("ann", "bob", "ghost") for t in ("t", "t", "x")]
    staged = {"user_teams": spark.createDataFrame(data, TEAMS)}
    keys = FACT_KEYS["fact_user_team_day"]
    dealt = facts.load_user_team_day(staged, dims, lambda df: deal(df, keys, len(data)))
    assert rows(dealt, *keys) == [(20240101, "ann", "t"), (20240101, "bob", "t")]
    moves = [line for line in _moves(dealt) if "range" in line or "date_key" in line]
    assert len(moves) == 1 and "rangepartitioning" in moves[0]


def test_only_rows_near_the_grain_are_dealt_unfolded(spark, monkeypatch):
    even = spark.range(1000).select(F.col("id").alias("date_key"), F.lit("u").alias("user_key"))
    assert facts.near_grain(even, ["date_key", "user_key"])
    assert not facts.near_grain(even.union(even).union(even), ["date_key", "user_key"])
    hot = even.union(even.limit(1).join(spark.range(300)).select("date_key", "user_key"))
    monkeypatch.setattr(allocate.heavy_groups, "__defaults__", (50,))
    assert not facts.near_grain(hot, ["date_key", "user_key"])


def test_dealt_editors_have_the_shares_of_others(spark, rows):
    data = [(20240101, u, "o", e, n * (u != "bob"), n) for u in ("ann", "bob") for n, e in enumerate(("vim", "zed", "vs"))]
    data.append((20240101, None, "o", "vim", 1, 1))
    names = ("user_initiated_interaction_count", "code_generation_activity_count")
    editors = spark.createDataFrame(data, "date_key int, user_key string, org_key string, editor_key string, "
                                    + ", ".join(f"{n} bigint" for n in names))
    dealt = allocate.ide_share(deal(editors, allocate.USER_DAY, 7), dealt=True)
    assert rows(dealt) == rows(allocate.ide_share(editors)) and dealt.count() == 4
    assert len(_moves(dealt)) == 1


def test_shares_meet_billing_in_one_exchange(spark, rows):
    amount = F.lit(1).cast("decimal(18,4)")
    days = spark.createDataFrame(
        [(20240101, "ann", "o", "m1"), (20240101, "ann", "o", "m1"), (20240101, "ann", "o", "m2"),
         (20240102, "bob", "o", "m1")], "date_key int, user_key string, org_key string, model_key string")
    billing = days.select("*", F.lit("p").alias("product_key"), *(amount.alias(c) for c in allocate.EXACT_MEASURES))
    editors = spark.createDataFrame(
        [(20240101, "ann", "o", "zed"), (20240101, "ann", "o", "vim"), (20240103, "ann", "o", "vim")],
        "date_key int, user_key string, org_key string, editor_key string",
    ).select("*", F.lit(0.5).cast("decimal(9,8)").alias("share"), F.lit("b").alias("weight_basis"))
    used = spark.createDataFrame(
        [(20240101, "ann", "o", "m1", "chat", 3), (20240101, "ann", "o", "m1", "cli", 1), (20240101, "ann", "o", "m3", "x", 1),
         (20240102, "bob", "o", "m1", "chat", 0), (20240102, "bob", "o", "m1", "cli", None)],
        "date_key int, user_key string, org_key string, model_key string, feature_key string, "
        "user_initiated_interaction_count bigint")
    spend = allocate.with_shares(billing, editors, used)
    assert rows(spend) == rows(allocate.with_shares(billing, editors, allocate.feature_share(used)))
    found = {(r.date_key, r.model_key): r for r in spend.collect()}
    assert spend.count() == 4
    assert [e.editor_key for e in found[20240101, "m2"].editors] == ["vim", "zed"] and found[20240101, "m2"].features is None
    assert [(f.feature_key, float(f.share)) for f in found[20240101, "m1"].features] == [("chat", 0.75), ("cli", 0.25)]
    assert found[20240102, "m1"].editors is None and [float(f.share) for f in found[20240102, "m1"].features] == [0.5, 0.5]
    assert len(_moves(spend)) == 1 and "Join" not in _plan(spend)


# ------------------------------------------------------------------ what a load stores


def test_stored_rows_hold_no_name_twice(spark, tmp_path):
    bill = spark.createDataFrame([("2026-08-01", "Ann ", "O", "Chat", "S")], "usage_date string, user_login string, "
                                 "org_login string, product string, sku string")
    stored = staging.stage_typed({"premium_requests": bill})["premium_requests"]
    assert not [c for c in stored.columns if c.endswith("_key")]
    Warehouse(spark, str(tmp_path)).write_run("r", "stg_premium_requests", stored)
    files = list((tmp_path / "_runs" / "r" / "stg_premium_requests").glob("*.parquet"))
    assert files and all(f.name.endswith(".zstd.parquet") for f in files)
    read = staging.with_keys(spark.read.schema(stored.schema).parquet(*map(str, files)), "premium_requests").first()
    assert (read.date_key, read.user_key, read.org_key, read.product_key) == (20260801, "ann", "o", "4:chat:s")


def test_teams_are_told_apart_by_their_members(spark, rows, monkeypatch):
    line = "'a' u, 'o' o, date'2024-01-01' d, 1 l_linenumber, 'R' l_returnflag, 'b' p_brand, 't' p_type, 1 q, 1.0 price, 0.1 discount"
    ids = spark.createDataFrame([(51,), (51,), (1,), (None,)], "user_id bigint")
    customer = spark.sql("SELECT 1L c_custkey, 'a' c_name, 1 c_nationkey, 's' c_mktsegment, 1.0 c_acctbal")
    monkeypatch.setattr(derive, "order_lines", lambda *_: ids.join(spark.sql(f"SELECT {line}")))
    monkeypatch.setattr(derive, "table", lambda *_: customer)
    made = derive.orders_datasets(spark, "")["user_teams"]
    assert rows(made, "user_id", "team_id", "team_slug") == rows(
        spark.createDataFrame([(None, None, None), (1, 1, "team1"), (51, 1, "team1")], "a bigint, b bigint, c string"))
    keys = re.findall(r"HashAggregate\(keys=\[(.*?)\]", _plan(made))
    assert keys and not any("team" in k or "%" in k for k in keys)


# ------------------------------------------------------------------ a batch of the stream


def test_a_batch_parses_its_activity_once(spark, rows, tmp_path):
    name, root = V.DATASETS["user_activity"], str(tmp_path / "raw")
    value = '{"day": "2026-08-01", "user_login": "ann", "totals_by_ide": [{"ide": "vim"}]}'
    payload = spark.createDataFrame([("2026-08-01", "acme", value)], "dt string, org string, value string")
    raw.write_raw(payload, root, name, "20260802T000000Z")
    lines = raw.raw_lines(spark, root, name).withColumn("dt", F.col("dt").cast("string")).withColumn("dataset", F.lit(name))
    made = ingest.touched_datasets(spark, root, lines, scratch=str(tmp_path / "touched"))
    assert all("Scan text" not in _plan(df) for df in made.values())
    whole = ingest.touched_datasets(spark, root, lines)
    assert sorted(made) == sorted(whole) == ["user_day", "user_ide", "user_model_feature"]
    assert all(rows(made[n]) == rows(whole[n]) for n in made) and made["user_ide"].count() == 1
