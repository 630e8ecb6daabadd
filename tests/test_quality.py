"""Checks, run log, governance and time measures on small frames."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from spendlens.operators import governance, quality, runs
from spendlens.plans import questions


def _seats(spark, *rows):
    return spark.createDataFrame(rows, "org_login string, user_login string")


def test_seat_guard(spark):
    seats = _seats(spark, ("acme", "a"), ("bare", ""))
    def orgs(*names):
        return spark.createDataFrame([(n,) for n in names], "org_login string")

    assert quality.seat_guard(seats, orgs("acme")).count() == 0
    with pytest.raises(quality.SeatsUnavailable, match="bare, none"):
        quality.seat_guard(seats, orgs("acme", "bare", "none", None))
    assert [r.org_login for r in quality.seat_guard(seats, orgs("bare", "bare"), strict=False).collect()] == ["bare"]


def test_billing_plan(spark, rows):
    ten = _seats(spark, *(("acme", f"user{i}") for i in range(10)))
    plan = quality.billing_plan(ten, "2026-08-01", "2026-08-01", max_users=3)
    assert rows(plan, "user_login") == [("user0",), ("user1",), ("user2",)]
    assert rows(quality.billing_plan_left_out(ten, 3)) == [("acme", 10, 7)]
    assert quality.billing_plan(ten, "2026-08-01", "2026-08-01").count() == 10
    two = _seats(spark, ("acme", "a"), ("acme", "b"), ("acme", "b"), ("acme", ""))
    assert quality.billing_plan(two, "2026-08-01", "2026-08-03").count() == 6
    assert quality.billing_plan(ten, "2026-08-01", "2026-08-01", max_users=None).count() == 10


def test_billing_plan_cut_is_exact_for_a_big_organisation(spark, rows):
    many = spark.range(3000).select(F.lit("acme").alias("org_login"), F.format_string("u%05d", "id").alias("user_login"))
    plan = quality.billing_plan(many, "2026-08-01", "2026-08-01", max_users=100)
    assert rows(plan, "user_login") == [(f"u{i:05d}",) for i in range(100)]


def test_payload_contract(lines, rows):
    df = lines(
        json.dumps([{"day": "d", "user_login": None, "totals_by_ide": [{"ide": "vim", "model": "m"}, {}]}]),
        json.dumps({"day": "d"}),
        "broken",
    )
    got = {(r.record_type, r.field): (r.records, r.present, r.missing) for r in quality.payload_contract(df, "user_activity").collect()}
    assert got[("user_metrics", "day")] == (2, 2, 0)
    assert got[("user_metrics", "user_login")] == (2, 1, 1)  # a null value is a present field
    assert got[("totals_by_ide[]", "ide")] == (2, 1, 1)
    assert got[("totals_by_model_feature[]", "model")] == (0, 0, 0)
    assert quality.cross_product_published(df).first().cross_product is True
    assert rows(quality.observed_values(df)) == [("ide", "?", 1), ("ide", "vim", 1)]


def test_run_states(spark):
    log = runs.log_entry(spark, "r1", "2026-08-01 02:00:00", "2026-08-01 02:00:00", "running")
    log = log.union(runs.log_entry(spark, "r1", "2026-08-01 02:05:00", "2026-08-01 02:00:00", "succeeded", counts={"rows_seats": 3}))
    log = log.union(runs.log_entry(spark, "r2", "2026-08-02 02:00:00", "2026-08-02 02:00:00", "running"))
    log = log.union(runs.log_entry(spark, "r3", "2026-08-03 02:00:00", "2026-08-03 02:00:00", "failed", message="x" * 3000))
    states = runs.run_state(log, "2026-08-02 04:30:00")
    by_id = {r.run_id: r for r in states.collect()}
    assert (by_id["r1"].status, by_id["r1"].rows_seats) == ("succeeded", 3)
    assert by_id["r2"].status == "abandoned" and str(by_id["r2"].completed_at) == "2026-08-02 04:30:00"
    assert len(by_id["r3"].message) == 3000
    assert runs.run_state(log, "2026-08-02 03:00:00").filter("run_id = 'r2'").first().status == "running"
    assert runs.ingestion_stalled(states, "2026-08-02 04:30:00").first().stalled is False
    assert runs.ingestion_stalled(states, "2026-08-04 04:30:00").first().stalled is True
    assert [r.run_id for r in runs.recent_runs(states, 2).collect()] == ["r3", "r2"]


def test_safe_error_hides_detail():
    text = runs.safe_error(RuntimeError("Server=tcp:db.example.net;Pwd=hunter2"))
    assert text.startswith("RuntimeError") and "hunter2" not in text and "example" not in text


def test_restrict(spark, rows):
    users = spark.createDataFrame([("ann", "ann", "CC1"), ("bob", "bob", "cc2"), ("cat", "cat", None)],
                                  "user_key string, user_login string, cost_center string")
    access = spark.createDataFrame([("boss", "cc1"), ("boss", "cc1 "), ("root", "*")], "principal_name string, cost_center string")

    def seen(who, **options):
        return [u for (u,) in rows(governance.restrict(users, access, who, **options), "user_login")]

    assert seen("Boss") == ["ann"]
    assert seen("bob") == ["bob"]
    assert seen("root") == ["ann", "bob", "cat"]
    assert seen("stranger") == []
    assert seen("stranger", is_admin=True) == ["ann", "bob", "cat"]
    managers = spark.createDataFrame([("M@x.org", "cc2")], "email string, cost_center string")
    assert rows(governance.restrict_report(users, managers, "m@x.org"), "user_login") == [("bob",)]


def test_pseudonymise(spark):
    df = spark.createDataFrame([("abc", 1.0), ("abc", None)], "login string, amount double")
    first, second = governance.pseudonymise(df, "login", ("amount",)).collect()
    assert first.login == second.login == "user-ba7816bf"
    assert (first.amount, second.amount) == ("present", "absent")


def test_question_arguments():
    assert tuple(questions.resolve_window(date(2026, 8, 31))) == (date(2026, 8, 1), date(2026, 8, 31))
    assert tuple(questions.resolve_window(date(2026, 8, 31), date(2020, 1, 1))) == (date(2020, 1, 1), date(2026, 8, 31))
    with pytest.raises(ValueError):
        questions.resolve_window(date(2026, 8, 31), since=date(2026, 9, 1))
    assert [questions.row_limit(n) for n in (None, 7, 5000)] == [None, 7, 5000]
    with pytest.raises(ValueError):
        questions.row_limit(0)


def test_damaged_values_are_zero_and_counted(spark):
    from spendlens.functions import columns as C

    given = ["3.9", "-3.9", "7", "3000000000", "1e3", "NaN", "Infinity", "abc", "", None, "99999999999999999999"]
    df = spark.createDataFrame([(g,) for g in given], "v string")
    got = [tuple(r) for r in df.select(C.count("v"), C.count_refused("v")).collect()]
    assert got == [(3, False), (-3, False), (7, False), (3000000000, False), (1000, False), (0, True), (0, True),
                   (0, True), (0, False), (0, False), (0, True)]
    numbers = spark.createDataFrame([(2.7,), (float("nan"),), (float("inf"),)], "v double")
    assert [r[0] for r in numbers.select(C.count("v")).collect()] == [2, 0, 0]
    days = spark.createDataFrame([("2026-08-01T10:00",), ("2026-13-45",), ("9999-01-01",), ("",), (None,)], "d string")
    got = [(str(a), b) for a, b in days.select(C.day("d"), F.coalesce(C.day_refused("d"), F.lit(False))).collect()]
    assert got == [("2026-08-01", False), ("None", True), ("None", True), ("None", False), ("None", False)]


def test_restriction_holds_in_every_report(spark):
    """As a user who sees nobody, no report that is made of users' rows shows a figure."""
    from checks.queries import AS_OF, SINCE, UNTIL, events_tables
    from spendlens.plans import frames, measures, views

    T = events_tables(spark, "/root/testdata/sf0.001")
    none = spark.createDataFrame([], "principal_name string, cost_center string")
    R = governance.restricted(T, none, "stranger")
    empty = [
        *(view(R) for view in views.VIEWS.values()), views.inactive_seats(R, AS_OF),
        questions.top_spenders(R, SINCE, UNTIL, None), questions.editor_spend(R, SINCE, UNTIL),
        questions.user_breakdown(R, "user1", SINCE, UNTIL), questions.month_exact(R, "2024-01"),
        measures.exact_measures(R, ["model_name"]), measures.allocated_measures(R, ["model_name"]),
        measures.engagement_measures(R, ["editor_family"]), measures.spend_over_time(R),
        frames.spend_by(R, "usage_date"), frames.interactions_by_feature_group(R), questions.weight_basis_counts(R),
    ]
    for i, report in enumerate(empty):
        assert report.limit(1).count() == 0, i
    (total,) = questions.summary(R, SINCE, UNTIL).collect()
    assert total.total_spend == 0 and total.active_users == 0
    assert questions.user_exact_total(R, "user1", SINCE, UNTIL).first().net_amount == 0
    assert frames.kpi_cards(R).first().total_spend is None and frames.detail_cards(R, "user1").first().total_spend is None
    assert questions.data_freshness(R).collect() == questions.data_freshness(T).collect()
