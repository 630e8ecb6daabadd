"""Stored star schema: idempotent loads, corrections, failures, erasure, retention."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from spendlens.fixed_values import DATASETS
from spendlens.operators import dimensions, governance, quality
from spendlens.operators.staging import stage
from spendlens.plans import load
from spendlens.schemas import DIMENSIONS, FACT_KEYS, FACTS
from spendlens.sources import derive, raw
from spendlens.sources.tables import Warehouse, WarehouseMissing

NOW = "2026-08-10 02:00:00"


def _facts(wh, rows):
    T = wh.tables()
    return {t: rows(T[t].drop("loaded_at", "month_key")) for t in FACTS}


def _bill(day, login, amount, model="m", product="plan"):
    return (day, login, "acme", product, "sku", model, amount)


def _base(days=("2026-08-01", "2026-08-02")):
    return {
        "user_day": [(d, "Ann", 1, "acme") for d in days],
        "user_ide": [(d, "ann", "acme", "vim", "Vim", 2, 1) for d in days],
        "user_model_feature": [(d, "ann", "acme", "m", "agent_edit", 1) for d in days],
        "user_teams": [(d, "ann", 1, "acme", 7, "core") for d in days],
        "premium_requests": [_bill(d, "ANN ", "5") for d in days],
        "seats": [("ann", 1, "acme", "Platform", "business", "2026-08-01 00:00:00")],
    }


@pytest.mark.parametrize("period", ["day", "month"])
def test_load_life_cycle(spark, tmp_path, frames, rows, period):
    wh = Warehouse(spark, str(tmp_path / "wh"), period)
    counts = load.load_all(wh, frames(_base()), loaded_at=NOW)
    assert counts["rows_premium_requests"] == 2 and counts["orphaned_billing"] == 0
    first = _facts(wh, rows)
    users = rows(wh.tables().dim_user, "user_sk", "user_key", "user_login", "team_name")
    assert users == [(1, "ann", "ann", "Platform")]  # three spellings, one user

    # the same data again changes nothing
    load.load_all(wh, frames(_base()), loaded_at=NOW)
    assert _facts(wh, rows) == first

    # a correction overwrites, a new day and user are added, the withdrawn model stays
    later = _base(("2026-08-02",))
    later["premium_requests"] = [_bill("2026-08-02", "ann", "9"), _bill("2026-09-03", "bob", "1", "m2")]
    later["user_ide"] = [("2026-08-02", "ann", "acme", "emacs", "Emacs", 6, 0)]
    later["seats"] = [("ann", 0, "acme", "", "", None), ("bob", 2, "acme", "", "", None)]
    load.load_all(wh, frames(later), loaded_at=NOW)
    T = wh.tables()
    spend = rows(T.fact_premium_requests, "date_key", "user_key", F.col("net_amount").cast("int"))
    assert spend == [(20260801, "ann", 5), (20260802, "ann", 9), (20260903, "bob", 1)]
    shares = rows(T.fact_user_ide_share, "date_key", "editor_key", F.col("share").cast("string"))
    assert shares == [(20260801, "vim", "1.00000000"), (20260802, "emacs", "0.75000000"), (20260802, "vim", "0.25000000")]
    # blanks did not erase what was known, numbers did not move
    assert rows(T.dim_user, "user_sk", "user_key", "external_user_id", "team_name") == [
        (1, "ann", 1, "Platform"), (2, "bob", 2, None)]
    assert T.dim_date.count() == 61  # August and September, without a gap

    # a reload that owns its days drops what the source withdrew
    load.load_all(wh, frames(_base(("2026-08-02",))), loaded_at=NOW, replace_window=(date(2026, 8, 2), date(2026, 8, 2)))
    T = wh.tables()
    assert rows(T.fact_user_ide_day, "date_key", "editor_key") == [(20260801, "vim"), (20260802, "vim")]
    assert T.fact_premium_requests.count() == 3

    # another weighting without fallback leaves nothing to store for a silent day
    load.rebuild_shares(wh, date(2026, 8, 1), date(2026, 8, 1), "again", NOW, basis=("generations",))
    basis = rows(wh.tables().fact_user_ide_share, "date_key", "weight_basis")
    assert basis == [(20260801, "code_generations"), (20260802, "user_interactions")]

    for table, keys in FACT_KEYS.items():
        quality.assert_grain(T[table], keys)
    quality.assert_range(T.fact_user_ide_share, "share")
    quality.assert_fk(T.fact_premium_requests, T.dim_user, "user_key")
    with pytest.raises(quality.ConstraintViolation):
        quality.assert_fk(T.fact_premium_requests, T.dim_user.filter("user_key = 'bob'"), "user_key")

    # retention: a preview changes nothing, a confirmed purge keeps billing
    preview = governance.purge(wh, date(2026, 8, 12), "p0", retain_days=10).first()
    assert (str(preview.cutoff_date), preview.activity_rows, preview.billing_rows) == ("2026-08-02", 1, 1)
    assert wh.tables().fact_user_day.count() == 2
    governance.purge(wh, date(2026, 8, 12), "p1", retain_days=10, confirm=True)
    T = wh.tables()
    assert rows(T.fact_user_day, "date_key") == [(20260802,)]
    assert T.fact_premium_requests.count() == 3

    # erasure: a preview changes nothing, a confirmed one leaves no trace of the login
    assert governance.forget_user(wh, "nobody", "e0").count() == 0
    assert governance.forget_user(wh, "Ann", "e1").first().billing_rows == 2
    assert wh.tables().fact_premium_requests.count() == 3
    assert governance.forget_user(wh, "Ann", "e2", confirm=True).first().billing_rows == 2
    T = wh.tables()
    assert [T[t].filter("user_key = 'ann'").count() for t in FACTS] == [0] * len(FACTS)
    assert rows(T.fact_premium_requests, "user_key") == [("bob",)]
    ann = T.dim_user.filter("user_sk = 1").first()
    assert (ann.user_login, ann.user_key, ann.external_user_id, ann.team_name, ann.is_active) == (
        "erased-1", "erased-1", None, None, False)
    assert ann.plan_type == "business"


def test_permuted_input_gives_the_same_facts(spark, tmp_path, frames, golden, rows):
    results = []
    for name, order in (("a", 1), ("b", -1)):
        wh = Warehouse(spark, str(tmp_path / name))
        load.load_all(wh, frames({n: r[::order] for n, r in golden.items()}), loaded_at=NOW)
        results.append((_facts(wh, rows), {d: rows(wh.tables()[d]) for d in DIMENSIONS}))
    assert results[0] == results[1]


def test_strict_load_publishes_nothing_when_billing_is_orphaned(warehouse, frames):
    data = _base()
    data["premium_requests"].append(_bill("2026-08-01", "ann", "1", product=" "))
    with pytest.raises(quality.LoadError) as failure:
        load.load_all(warehouse, frames(data))
    assert failure.value.number == 51001
    with pytest.raises(WarehouseMissing):
        warehouse.tables()


def test_check_load_numbers():
    counts = {"rows_user_day": 0, "rows_premium_requests": 0, "rows_seats": 1, "orphaned_billing": 0,
              "orphaned_user_ide": 2, "orphaned_user_model_feature": 0}
    with pytest.raises(quality.LoadError, match="51002"):
        quality.check_load(counts)
    with pytest.raises(quality.LoadError, match="51005"):
        quality.check_load({**counts, "rows_user_day": 1, "rows_seats": 0})
    assert len(quality.check_load(counts, strict=False)) == 3
    told = quality.check_load({**counts, "rows_premium_requests": 9, "orphaned_billing": 5}, strict=False)
    assert any(text.startswith("5 billing rows") for text in told)


def test_run_is_logged(spark, tmp_path, warehouse):
    from spendlens.fixed_values import DATASETS
    from spendlens.operators import runs

    def put(kind, dt, value):
        raw.write_raw(spark.createDataFrame([(dt, "acme", value)], "dt string, org string, value string"),
                      str(tmp_path / "raw"), DATASETS[kind], "20260802T020000Z")

    put("user_activity", "2026-08-01", '{"day": "2026-08-01", "user_login": "ann", "totals_by_ide": [{"ide": "vim"}]}')
    put("user_teams", "2026-08-01", '{"day": "2026-08-01", "user_login": "ann", "team_id": 7, "slug": "core"}')
    put("seats", "2026-08-01", '{"assignee": {"login": "ann", "id": 1}}')
    bill = '{"user_login": "ann", "period": "2026-08-01", "payload": {"usageItems": [{"product": "%s", "netAmount": 3}]}}'
    put("premium_requests", "2026-08-01", bill % "")
    with pytest.raises(quality.LoadError):
        load.run_ingestion(warehouse, str(tmp_path / "raw"), date(2026, 8, 1), date(2026, 8, 1))
    raw.write_raw(spark.createDataFrame([("2026-08-01", "acme", bill % "plan")], "dt string, org string, value string"),
                  str(tmp_path / "raw"), "premium_requests", "20260802T030000Z")
    load.run_ingestion(warehouse, str(tmp_path / "raw"), date(2026, 8, 1), date(2026, 8, 1), "backfill")
    states = runs.run_state(warehouse.tables().ingestion_run, "2030-01-01 00:00:00")
    assert sorted((r.status, r.message, r.rows_seats) for r in states.collect()) == [
        ("failed", "LoadError - see the job log for detail", 0), ("succeeded", None, 1)]
    assert warehouse.tables().fact_premium_requests.first().net_amount == 3


# ------------------------------------------------------------------ dimensions without storage


def test_numbers_continue_without_gaps(spark, rows):
    existing = spark.createDataFrame([(1, "a"), (7, "b")], "sk bigint, k string")
    new = spark.range(5000).select(F.concat(F.lit("n"), F.col("id").cast("string")).alias("k"))
    keyed = dimensions.assign_keys(new, existing, "k", "sk")
    numbers = keyed.agg(F.min("sk"), F.max("sk"), F.countDistinct("sk")).first()
    assert tuple(numbers) == (8, 5007, 5000)
    assert rows(keyed) == rows(dimensions.assign_keys(new.repartition(13), existing, "k", "sk"))


def test_known_rows_are_not_refreshed(spark, frames, rows):
    existing = spark.createDataFrame([(1, "vim", "vim", "Mine")], "editor_sk bigint, editor_key string, editor_name string, editor_family string")
    staged = stage(frames({"user_ide": [("2026-08-01", "a", "o", "VIM", "Vim", 1, 1), ("2026-08-01", "a", "o", "zed", "Zed", 1, 1)]}))
    assert rows(dimensions.merge_dim_editor(staged, existing)) == [(1, "vim", "vim", "Mine"), (2, "zed", "zed", "Zed")]


def test_calendar_is_empty_without_dates_and_has_no_gap(spark, frames):
    empty = spark.createDataFrame([], DIMENSIONS["dim_date"])
    assert dimensions.fill_dim_date(stage(frames({})), empty).count() == 0
    one = stage(frames({"premium_requests": [_bill("2026-01-15", "a", "1")]}))
    two = stage(frames({"premium_requests": [_bill("2026-03-15", "a", "1")]}))
    january = dimensions.fill_dim_date(one, empty)
    assert january.count() == 31
    both = dimensions.fill_dim_date(two, january)
    assert both.count() == 90
    saturday = both.filter("date_key = 20260103").first()
    assert (saturday.day_of_week, saturday.is_weekend, saturday.month_name, saturday.year_month) == (6, True, "January", "2026-01")


def test_cost_centers(spark, rows):
    users = spark.createDataFrame([("a", "t1", None), ("b", "t2", "old")], "user_key string, team_name string, cost_center string")
    assert rows(dimensions.set_cost_center(users), "user_key", "cost_center") == [("a", "t1"), ("b", "old")]
    mapping = spark.createDataFrame([("B ", "new")], "user_login string, cost_center string")
    assert rows(dimensions.set_cost_center(users, mapping), "user_key", "cost_center") == [("a", None), ("b", "new")]


# ------------------------------------------------------------------ windows


def test_windows():
    assert load.reload_window(date(2026, 8, 8)) == (date(2026, 8, 1), date(2026, 8, 8))
    assert load.backfill_window(date(2026, 8, 30)) == (date(2026, 8, 1), date(2026, 8, 29))
    assert load.backfill_window(date(2026, 8, 30), date(2020, 1, 1)) == (date(2020, 1, 1), date(2026, 8, 29))
    for since, until in (("2026-08-05", "2026-08-01"), ("2026-08-01", "2026-08-30")):
        with pytest.raises(ValueError):
            load.backfill_window(date(2026, 8, 30), date.fromisoformat(since), date.fromisoformat(until))


def test_month_store_prunes_partitions(spark, tmp_path, frames):
    from spendlens.operators.allocate import between

    wh = Warehouse(spark, str(tmp_path / "wh"), "month")
    load.load_all(wh, frames(_base()), loaded_at=NOW)
    plan = between(wh.tables().fact_premium_requests, date(2026, 8, 2))._jdf.queryExecution().executedPlan().toString()
    assert "month_key" in plan.split("PartitionFilters:")[1].split("]")[0]


def test_derived_domain_reaches_every_branch(spark):
    from checks.queries import events_tables

    T = events_tables(spark, "/root/testdata/sf0.001")
    assert {r.weight_basis for r in T.fact_user_ide_share.select("weight_basis").distinct().collect()} == {
        "user_interactions", "code_generations", "equal_split"}
    assert derive.events_run_log(derive.events(spark, "/root/testdata/sf0.001")).count() > 0


# ------------------------------------------------------------------ publication


def _state(wh, rows):
    T = wh.tables()
    return {t: rows(T[t]) for t in (*DIMENSIONS, *FACTS)}


@pytest.mark.parametrize("step", ["write_run", "publish", "manifest"])
def test_a_failing_load_leaves_the_old_state_whole(monkeypatch, warehouse, frames, rows, step):
    load.load_all(warehouse, frames(_base()), loaded_at=NOW)
    before = _state(warehouse, rows)
    later = _base(("2026-08-02",))
    later["premium_requests"] = [_bill("2026-08-02", "ann", "99"), _bill("2026-08-02", "new", "1")]

    def fail(*_, **__):
        raise OSError("disk")

    if step == "write_run":  # the last table that a load writes
        write = Warehouse.write_run
        monkeypatch.setattr(
            Warehouse, "write_run", lambda wh, run, t, df: fail() if t == "fact_user_ide_share" else write(wh, run, t, df)
        )
    elif step == "publish":
        monkeypatch.setattr(Warehouse, "periods", lambda wh, df: fail())
    else:
        monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrame.coalesce", fail)
    with pytest.raises(OSError):
        load.load_all(warehouse, frames(later), loaded_at=NOW)
    monkeypatch.undo()
    assert _state(warehouse, rows) == before
    load.load_all(warehouse, frames(later), loaded_at=NOW)
    assert warehouse.tables().dim_user.filter("user_key = 'new'").count() == 1


def test_open_tables_outlive_the_next_publication(warehouse, frames, rows):
    load.load_all(warehouse, frames(_base()), loaded_at=NOW)
    T = warehouse.tables()
    before = rows(T.fact_premium_requests)
    load.load_all(warehouse, frames(_base(("2026-08-02",))), loaded_at="2026-09-01 00:00:00")
    assert rows(T.fact_premium_requests) == before


def test_missing_or_otherwise_partitioned_store_is_an_error(spark, tmp_path, frames):
    with pytest.raises(WarehouseMissing):
        Warehouse(spark, str(tmp_path / "nowhere")).tables()
    load.load_all(Warehouse(spark, str(tmp_path / "wh"), "month"), frames(_base()), loaded_at=NOW)
    with pytest.raises(ValueError, match="month_key"):
        Warehouse(spark, str(tmp_path / "wh")).tables()


def test_a_withdrawn_day_leaves_with_its_window(warehouse, frames, rows):
    load.load_all(warehouse, frames(_base(("2026-08-01", "2026-08-02", "2026-08-05"))), loaded_at=NOW)
    window = (date(2026, 8, 1), date(2026, 8, 3))
    load.load_all(warehouse, frames(_base(("2026-08-01",))), loaded_at=NOW, replace_window=window)
    T = warehouse.tables()
    for table in ("fact_user_day", "fact_user_ide_day", "fact_user_ide_share", "fact_premium_requests"):
        assert {d for (d,) in rows(T[table], "date_key")} == {20260801, 20260805}, table


def test_unplaced_billing_is_kept_and_told(warehouse, frames, rows, caplog):
    data = _base()
    data["premium_requests"].append(_bill("2026-08-01", "ann", "7", product=" "))
    counts = load.load_all(warehouse, frames(data), strict=False, loaded_at=NOW, run_id="r1")
    assert counts["orphaned_billing"] == 1 and "1 billing rows" in caplog.text
    kept = rows(warehouse.tables().billing_orphans, "run_id", F.col("net_amount").cast("int"), "missing")
    assert kept == [("r1", 7, "dim_product")]


def test_grants_are_stored(spark, warehouse, frames, rows):
    load.load_all(warehouse, frames(_base()), loaded_at=NOW)
    warehouse.grant(spark.createDataFrame([("Boss", "*")], "principal_name string, cost_center string"), "g1")
    T = warehouse.tables()
    assert rows(governance.restricted(T, principal="boss").dim_user, "user_key") == [("ann",)]
    assert governance.restricted(T, principal="else").fact_premium_requests.count() == 0
    assert governance.restricted(T, is_admin=True) is T


# ------------------------------------------------------------------ the archive as a stream


def test_stream_reads_the_flat_layout_in_any_order(spark, tmp_path, rows):
    from spendlens.streaming.ingest import stream_ingest

    root = tmp_path / "raw"

    def put(dataset, dt, stamp, *records):
        folder = root / dataset / f"dt={dt}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{dataset}_acme_{stamp}.json").write_text("[" + ",".join(records) + "]")

    def bill(day, amount):
        return '{"user_login": "ann", "period": "%s", "payload": {"usageItems": [{"product": "p", "netAmount": %s}]}}' % (day, amount)

    names = DATASETS
    put(names["seats"], "2026-08-02", "20260802T020000Z", '{"assignee": {"login": "ann", "id": 1}}')
    put(names["premium_requests"], "2026-08-02", "20260803T020000Z", bill("2026-08-01", 5))
    put(names["premium_requests"], "2026-08-02", "20260802T020000Z", bill("2026-08-01", 3), bill("2026-08-02", 4))
    wh, checkpoint = str(tmp_path / "wh"), str(tmp_path / "cp")
    run = lambda: stream_ingest(spark, str(root), wh, checkpoint, files_per_batch=1, flat=True).awaitTermination()
    run()
    put(names["premium_requests"], "2026-08-02", "20260801T020000Z", bill("2026-08-01", 1), bill("2026-08-03", 9))  # late
    run()
    facts = Warehouse(spark, wh).tables().fact_premium_requests
    assert rows(facts, "date_key", F.col("net_amount").cast("int")) == [(20260801, 5), (20260802, 4), (20260803, 9)]
    (root / "stray.json").write_text("{}")
    with pytest.raises(Exception, match="Not a path of the raw zone"):
        run()


def test_no_event_is_too_late(spark, tmp_path, rows):
    from spendlens.streaming.activity import daily_activity, stream_daily_activity

    schema = "ts timestamp_ntz, user_id bigint, value double"
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for moment in ("2026-08-30 10:00:00", "2026-01-01 23:59:59", "2026-08-30 11:00:00"):
        event = spark.createDataFrame([(moment, 7, 1.5)], "ts string, user_id bigint, value double")
        event.withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(source)
        events = spark.readStream.schema(schema).parquet(source)
        stream_daily_activity(events, out, str(tmp_path / "cp")).awaitTermination()
    got = daily_activity(spark.read.parquet(out)).select(F.col("activity_date").cast("string"), "events", F.col("value").cast("string"))
    assert rows(got) == [("2026-01-01", 1, "1.5000"), ("2026-08-30", 2, "3.0000")]
