"""What a load reads: rows once for each question, none for sampling, and lists of lacking keys for all steps."""

import pytest
from pyspark.sql import functions as F

from spendlens.operators import allocate, dimensions, distinct_users, facts, quality, staging
from spendlens.plans import load
from spendlens.sources import tables
from spendlens.sources.tables import RANGE, Warehouse, deal_days, rows_by_day

from .conftest import DAY

IDES = "date_key int, user_key string, org_key string, editor_key string, n int"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------------ lacking keys


@pytest.fixture
def dims(spark):
    return {
        "dim_date": spark.createDataFrame([(20240101,)], "date_key int"),
        "dim_org": spark.createDataFrame([("o",)], "org_key string"),
        "dim_editor": spark.createDataFrame([("vim",), ("zed",)], "editor_key string"),
        "dim_user": spark.createDataFrame([("ann",), ("bob",)], "user_key string"),
    }


def test_listed_keys_serve_every_check(spark, rows, dims, tmp_path):
    data = [(20240101, u, o, "vim", n) for n, (u, o) in enumerate(
        [("ann", "o"), ("ann", "o"), ("ghost", "o"), (None, "o"), ("bob", None), ("bob", "x"), ("", "o")])]
    staged, wh = spark.createDataFrame(data, IDES), Warehouse(spark, str(tmp_path))
    names = facts.CHECKED["user_ide"]

    def keep(df):
        wh.write_run("r", "lacking", df)
        return wh.read_run("r", "lacking", df.schema)

    found = dimensions.list_lacking(staged, dims, names, keep)
    assert rows(wh.read_run("r", "lacking", spark.createDataFrame([], "dimension string, key string").schema)) == [
        ("dim_org", "x"), ("dim_user", ""), ("dim_user", "ghost")]
    checked = dimensions.Checked(dims, [(staged, found)])
    assert rows(facts._with_dimensions(staged, staged, checked, *names)) == rows(
        facts._with_dimensions(staged, staged, dims, *names))
    assert tuple(quality._mapped(staged, checked, names).first()) == tuple(quality._mapped(staged, dims, names).first()) == (7, 5)
    assert rows(dimensions.lacks(staged, checked, names)) == rows(dimensions.lacks(staged, dims, names))
    # an editor is never lacking: no join for it
    assert "editor_key" not in [line for line in _plan(facts._with_dimensions(staged, staged, checked, *names)).splitlines()
                                if "Join" in line]


def test_a_load_lists_lacking_keys_once(spark, tmp_path, monkeypatch):
    seen = []
    absent = dimensions._absent
    monkeypatch.setattr(dimensions, "_absent", lambda rows, dims, names: seen.append(names) or absent(rows, dims, names))
    bill = spark.createDataFrame([(DAY, "ann", "o", "p", "s", "m", 1)], "usage_date string, user_login string, "
                                 "org_login string, product string, sku string, model_name string, net_amount int")
    load.load_all(Warehouse(spark, str(tmp_path)), {"premium_requests": bill.withColumn("usage_date", F.to_date("usage_date"))})
    assert sorted(seen) == sorted(facts.CHECKED.values())


def test_keys_are_made_once_for_a_name(spark, rows):
    bills = spark.createDataFrame(
        [("Ann", "P", "S"), ("Ann", "P", "S"), ("ann ", "p", None), (None, "", "s")], "user_login string, product string, sku string")
    keyed = bills.withColumns({"user_key": staging.C.norm("user_login"), "product_key": staging.C.product_key("product", "sku")})
    for keys in (["user_key"], ["product_key"]):
        told = staging.named(keyed, keys)
        assert rows(told.select(*keys).distinct()) == rows(keyed.select(*keys).distinct())
        assert "user_key" not in _plan(told).split("HashAggregate")[-1] and told.count() == 3
    assert rows(staging.named(keyed.select("user_key"), ["user_key"])) == rows(keyed.select("user_key").distinct())


# ------------------------------------------------------------------ parts by counted days


@pytest.fixture
def uneven(spark):
    """Three rows on most days, a day with half of all, and rows without a day."""
    days = spark.range(3000).selectExpr("20240100 + cast(id % 10 as int) + 1 date_key", "concat('u', id % 50) user_key")
    hot = spark.range(3000).selectExpr("20240205 date_key", "concat('u', id % 997) user_key")
    return days.union(hot).union(spark.range(200).selectExpr("cast(null as int)", "concat('u', id)"))


def test_days_are_dealt_evenly_without_sampling(spark, rows, uneven, monkeypatch):
    monkeypatch.setattr(tables, "PART_ROWS", 500)
    dealt = deal_days(uneven, ["date_key", "user_key"], rows_by_day(uneven))
    assert "rangepartitioning" not in _plan(dealt) and "shufflepartitionidpassthrough" in _plan(dealt)
    sizes = dealt.groupBy(RANGE).count().collect()
    assert len(sizes) == 12 and max(r["count"] for r in sizes) < 800
    folded = dealt.groupBy(RANGE, "date_key", "user_key").count()
    assert _plan(folded).count("Exchange") == 1
    assert rows(folded.drop(RANGE)) == rows(uneven.groupBy("date_key", "user_key").count())
    spans = dealt.filter("date_key is not null").groupBy(RANGE).agg(F.min("date_key"), F.max("date_key")).orderBy(RANGE).collect()
    assert all(a[2] <= b[1] for a, b in zip(spans, spans[1:], strict=False))


def test_days_far_apart_and_no_days(spark, rows):
    far = spark.createDataFrame([(101, "a"), (99991231, "b")], "date_key int, user_key string")
    assert rows(deal_days(far, ["date_key", "user_key"], rows_by_day(far))) == rows(far)
    none = spark.createDataFrame([(None, "a"), (None, "b")], far.schema)
    assert deal_days(none, ["date_key", "user_key"], rows_by_day(none)).count() == 2
    assert deal_days(far.limit(0), ["date_key", "user_key"], {}).count() == 0


def test_crowds_tell_rows_and_keys_in_one_reading(spark):
    for keys, times in ((0, 1), (700, 3), (300_000, 2)):
        seen = allocate.crowds(spark.range(keys * times).select((F.col("id") % max(keys, 1)).alias("k")), ["k"])
        assert seen.rows == keys * times and abs(seen["keys"] - keys) <= 0.02 * keys
        assert seen.most >= (times if keys else 0)


# ------------------------------------------------------------------ shares and what is stored


def test_shares_are_put_together_by_one_sort(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path), "month")
    day, ddl = (20240101, 202401, "ann", "o"), "date_key int, month_key int, user_key string, org_key string"
    counts = "user_initiated_interaction_count long, code_generation_activity_count long"
    editors = spark.createDataFrame([(*day, "vim", 1, 1), (*day, "zed", 3, 1)], f"{ddl}, editor_key string, {counts}")
    used = spark.createDataFrame([(*day, "m", "chat", 1, 1)], f"{ddl}, model_key string, feature_key string, {counts}")
    billing = spark.createDataFrame([(*day, "m", "p")], f"{ddl}, model_key string, product_key string").withColumns(
        {m: F.lit(1).cast("decimal(18,4)") for m in allocate.EXACT_MEASURES})

    def store(made, table):
        wh.write_run("r", table, facts.stamp(made, table, "2024-02-01 00:00:00"), dealt=True)
        stored = made.sortWithinPartitions("month_key", "date_key", "user_key")
        assert "ObjectHashAggregate" not in _plan(stored) and _plan(stored).count("Sort [") == 1
        return wh.read_run("r", table)

    dealt = allocate.ide_share(deal_days(editors, allocate.USER_DAY, rows_by_day(editors)), dealt=True)
    store(allocate.with_shares(billing, store(dealt, "fact_user_ide_share"), used), "fact_spend_shares")
    spend = wh.read_run("r", "fact_spend_shares").first()
    assert [(e.editor_key, float(e.share)) for e in spend.editors] == [("vim", 0.25), ("zed", 0.75)]
    assert [(f.feature_key, float(f.share)) for f in spend.features] == [("chat", 1.0)] and spend.month_key == 202401


def test_bitmaps_move_once_by_counted_days(spark, rows):
    users = spark.createDataFrame([("ann", 1), ("bob", 40_000)], "user_key string, user_sk bigint")
    facts_of = {s: spark.createDataFrame([(20240101, "o", "ann"), (20240101, "o", "bob"), (20240202, "o", "ann")],
                                         "date_key int, org_key string, user_key string") for s in distinct_users.SOURCES}
    dealt = distinct_users.build(facts_of, users, rows_by_day(*facts_of.values()))
    assert "rangepartitioning" not in _plan(dealt)
    names = ("date_key", "source", "org_key", "bucket", "users")
    assert rows(dealt, *names) == rows(distinct_users.build(facts_of, users), *names) and dealt.count() == 6
