"""Allocation by hand-computed cases, and its invariants."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from spendlens.operators import allocate, quality
from spendlens.plans import load, measures, questions, views
from spendlens.sources.tables import Warehouse


@pytest.fixture(scope="module")
def T(spark, frames, golden, tmp_path_factory):
    wh = Warehouse(spark, str(tmp_path_factory.mktemp("golden")))
    load.load_all(wh, frames(golden), loaded_at="2026-08-02 02:00:00")
    return wh.tables()


def _shares(df, rows, user):
    return [(e, str(s), b) for e, s, b in rows(df.filter(f"user_key = '{user}'"), "editor_key", "share", "weight_basis")]


def test_ide_share_tiers(T, rows):
    df = T.fact_user_ide_share
    assert _shares(df, rows, "prompts") == [
        ("emacs", "0.35000000", "user_interactions"), ("zed", "0.65000000", "user_interactions")]
    assert _shares(df, rows, "codes") == [
        ("vim", "0.75000000", "code_generations"), ("vscode", "0.25000000", "code_generations")]
    assert _shares(df, rows, "equal") == [
        (e, "0.33333333", "equal_split") for e in ("emacs", "vim", "vscode")]
    assert _shares(df, rows, "zero") == [("vscode", "1.00000000", "user_interactions")]
    assert _shares(df, rows, "none") == []


def test_ide_share_variants(T, rows):
    by_code = allocate.ide_share(T.fact_user_ide_day, basis=("generations",))
    assert _shares(by_code, rows, "zero") == [("vim", "1.00000000", "code_generations")]
    bare = allocate.ide_share(T.fact_user_ide_day, fallback=None)
    assert _shares(bare, rows, "equal") == []
    assert _shares(bare, rows, "prompts") == _shares(T.fact_user_ide_share, rows, "prompts")


def test_feature_share_keeps_zeros_and_splits_equally_without_signal(T, rows):
    df = allocate.feature_share(T.fact_user_model_feature_day)
    assert [str(s) for (s,) in rows(df.filter("user_key = 'prompts'"), "share")] == ["0.25000000", "0.75000000"]
    assert [str(s) for (s,) in rows(df.filter("user_key = 'idle'"), "share")] == ["0.50000000", "0.50000000"]


def test_attribution_quality_has_four_cases(T, rows):
    quality_of = allocate.allocate(T).select("user_key", "attribution_quality").distinct()
    assert rows(quality_of) == [
        ("codes", "modelled"), ("equal", "modelled"), ("idle", "feature-only"), ("none", "exact-unallocated"),
        ("prompts", "modelled"), ("zero", "modelled")]


def test_headline_view(T, rows):
    view = views.spend_by_user_model_editor(T, login="Prompts ")
    got = rows(view, "editor_family", "feature", "feature_group", F.col("allocated_net_amount").cast("string"))
    assert got == [
        ("EMACS", "agent_edit", "Agent", "2.625000"),
        ("EMACS", "chat_inline", "Chat", "0.875000"),
        ("ZED", "agent_edit", "Agent", "4.875000"),
        ("ZED", "chat_inline", "Chat", "1.625000")]
    unattributed = views.spend_by_user_model_editor(T, login="none").first()
    assert (unattributed.editor_name, unattributed.editor_family) == ("unattributed", "Unattributed")
    assert (unattributed.feature, unattributed.ide_share, unattributed.feature_share) == ("unattributed", 1, 1)


def test_allocated_totals_meet_the_exact_ones(T):
    drift = quality.allocation_drift(T).agg(F.max("drift").alias("d"), F.count("*").alias("n")).first()
    assert drift.n == 6 and drift.d <= Decimal("0.000001")


def test_shares_sum_to_about_one(T):
    sums = T.fact_user_ide_share.groupBy("date_key", "user_key", "org_key").agg(F.sum("share").alias("s"))
    assert sums.filter(F.abs(F.col("s") - 1) > 0.0000001).count() == 0


def test_team_view_counts_a_member_in_each_team(T, rows):
    got = rows(views.spend_by_team(T), "team_slug", "active_users", F.col("net_amount").cast("string"))
    assert got == [("backend", 1, "10.0000"), ("frontend", 6, "60.0000")]
    assert views.spend_by_team(T, by_org=True).count() == 2


def test_chargeback_falls_back_to_team_and_to_unassigned(T, rows):
    got = rows(views.monthly_spend_by_team(T), "cost_center", "active_users")
    assert got == [("Platform", 3), ("unassigned", 3)]


def test_questions(T, rows):
    from datetime import date

    since, until = date(2026, 8, 1), date(2026, 8, 1)
    top = questions.top_spenders(T, since, until, 2).collect()
    assert [r.user_login for r in top] == ["codes", "equal"]
    assert questions.user_breakdown(T, "prompts", since, until).first().spend == Decimal("4.875")
    assert questions.user_exact_total(T, "nobody", since, until).collect()[0].asDict() == {
        "net_amount": 0, "quantity": 0, "models_used": 0}
    assert questions.summary(T, since, until).first().total_spend == 60
    assert questions.user_report(T, "nobody", date(2026, 8, 2)).count() == 0
    assert questions.user_report(T, "prompts", date(2026, 8, 2)).count() == 5
    short = questions.user_report(T, "prompts", date(2026, 8, 2), 2, with_rest=True).orderBy("position").collect()
    assert [(r.name.split(" ")[0], r.value) for r in short] == [
        ("Total", "$10.00"), ("opal-2", "$4.88"), ("opal-2", "$2.62"), ("Other", "$2.50")]
    team = questions.team_report(T, "platform", date(2026, 8, 2), 1, with_rest=True).orderBy("position").collect()
    assert [r.value for r in team] == ["$30.00", "$10.00", "$20.00"]
    assert questions.team_total(T, "PLATFORM", since, until).first().total == 30


def test_empty_window_yields_empty_measures(T):
    from datetime import date

    assert measures.exact_measures(T, ["model_name"], since=date(2030, 1, 1)).count() == 0
    total = measures.exact_measures(T, since=date(2030, 1, 1)).first()
    assert total.total_spend is None and total.spend_per_active_user is None


def test_ad_hoc_sql_over_registered_views(T, spark):
    views.register_views(T, "2026-08-31")
    spend = spark.sql(
        "SELECT user_login, SUM(allocated_net_amount) AS spend FROM vw_spend_by_user_model_editor "
        "WHERE year_month = '2026-08' AND user_login = 'prompts' GROUP BY user_login"
    ).first()
    assert spend.spend == 10
    joined = spark.sql(
        "SELECT MAX(d.date) AS latest FROM fact_premium_requests f "
        "JOIN dim_date d ON d.date_key = f.date_key JOIN dim_user u ON u.user_key = f.user_key"
    ).first()
    assert str(joined.latest) == "2026-08-01"
