"""Every operator as a query over the given tables.

The star schema of a folder is loaded once per session into the shared folder and then queried, as
a warehouse is; staging, archive and stream queries start from the tables each time.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.fixed_values import DATASETS
from spendlens.functions import columns
from spendlens.functions.columns import ide_family
from spendlens.operators import allocate, distinct_users, facts, flatten, governance, quality, runs
from spendlens.operators.staging import stage
from spendlens.plans import frames, load, measures, questions, sql_functions, views
from spendlens.schemas import FACT_KEYS
from spendlens.session import new_folder
from spendlens.sources import derive, raw, render, reports
from spendlens.sources.tables import Tables, Warehouse
from spendlens.streaming import activity, ingest

AS_OF = date(2024, 1, 31)
SINCE, UNTIL = date(2024, 1, 5), date(2024, 1, 25)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_MADE: dict[tuple, str] = {}


def _once(spark: SparkSession, sf_dir: str, what: str, make: Callable[[str], None]) -> str:
    """A folder made the first time a session asks for it."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), what)
    if key not in _MADE:
        root = new_folder(spark, what)
        make(root)
        _MADE[key] = root
    return _MADE[key]


def events_tables(spark: SparkSession, sf_dir: str) -> Tables:
    def make(root: str) -> None:
        ev = derive.events(spark, sf_dir)
        load.load_all(
            Warehouse(spark, root),
            derive.events_datasets(spark, sf_dir, f"{root}/_events"),
            loaded_at="2024-01-31 02:00:00",
            cost_centers=derive.events_cost_centers(ev),
        )

    T = Warehouse(spark, _once(spark, sf_dir, "events", make)).tables()
    states = runs.run_state(derive.events_run_log(derive.events(spark, sf_dir)), f"{AS_OF} 00:00:00")
    return T.replace(ingestion_run=states)


def orders_tables(spark: SparkSession, sf_dir: str) -> Tables:
    def make(root: str) -> None:
        load.load_all(
            Warehouse(spark, root, "month"),
            derive.orders_datasets(spark, sf_dir, f"{root}/_lines"),
            loaded_at="2001-11-30 02:00:00",
        )

    return Warehouse(spark, _once(spark, sf_dir, "orders", make), "month").tables()


def archive(spark: SparkSession, sf_dir: str) -> str:
    return _once(spark, sf_dir, "raw", lambda root: render.render_archive(spark, sf_dir, root))


def report(spark: SparkSession, sf_dir: str) -> str:
    return _once(spark, sf_dir, "report", lambda root: render.render_report(spark, sf_dir, root))


def query(f: Callable[[SparkSession, str], DataFrame]):
    QUERIES[f.__name__] = f
    return f


def events_query(name: str, f: Callable[[Tables], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: f(events_tables(spark, sf_dir))


def orders_query(name: str, f: Callable[[Tables], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: f(orders_tables(spark, sf_dir))


def _text_time(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.date_format(n, "yyyy-MM-dd HH:mm:ss") for n in names})


# ------------------------------------------------------------------ sources


@query
def report_records(spark, sf_dir):
    schema = "struct<id: bigint, interactions: double, user_id: bigint>"
    records = reports.read_report(spark, report(spark, sf_dir), schema)
    return records.groupBy("user_id").agg(
        F.count("*").alias("records"), F.sum("interactions").cast("bigint").alias("interactions")
    )


@query
def report_quality(spark, sf_dir):
    per_file = reports.report_quality(spark, report(spark, sf_dir))
    return per_file.agg(
        *(F.sum(c).cast("bigint").alias(c) for c in ("lines", "malformed", "records")),
        F.bool_or("unreadable").alias("unreadable"),
    )


@query
def raw_latest(spark, sf_dir):
    root = archive(spark, sf_dir)
    parts = []
    for kind, keys in (("user_activity", ("dt", "org")), ("user_teams", ("dt", "org")), ("seats", ("org",))):
        lines = raw.read_raw(spark, root, DATASETS[kind], latest_per=keys)
        parts.append(
            lines.groupBy("dt", "org", "stamp")
            .agg(F.count("*").alias("records"))
            .withColumn("dataset", F.lit(DATASETS[kind]))
        )
    return reduce(DataFrame.unionByName, parts)


@query
def raw_expired_partitions(spark, sf_dir):
    expired = raw.expired_raw_partitions(spark, archive(spark, sf_dir), AS_OF, retain_days=10)
    return expired.select("dataset", "dt")


# ------------------------------------------------------------------ flatteners over the archive


def _records(spark, sf_dir, kind):
    return raw.read_records(spark, archive(spark, sf_dir), kind)


@query
def flatten_user_day(spark, sf_dir):
    return flatten.flatten_user_day(_records(spark, sf_dir, "user_activity"))


@query
def flatten_user_ide(spark, sf_dir):
    return flatten.flatten_user_ide(_records(spark, sf_dir, "user_activity"))


@query
def flatten_user_model_feature(spark, sf_dir):
    return flatten.flatten_user_model_feature(_records(spark, sf_dir, "user_activity"))


@query
def flatten_user_teams(spark, sf_dir):
    return flatten.flatten_user_teams(_records(spark, sf_dir, "user_teams"))


@query
def flatten_premium_requests(spark, sf_dir):
    return flatten.flatten_premium_requests(raw.read_billing_archive(spark, archive(spark, sf_dir)))


@query
def billing_one_day(spark, sf_dir):
    """One day's billing, which lies in one of the two folders only."""
    day = date(2024, 1, 5)
    return flatten.flatten_premium_requests(raw.read_billing_archive(spark, archive(spark, sf_dir), day, day))


@query
def billing_day_folders(spark, sf_dir):
    """The folders that hold each usage day, by the index that archiving keeps."""
    return raw.usage_date_index(spark, archive(spark, sf_dir)).select("usage_date", "dt").distinct()


@query
def flatten_seats(spark, sf_dir):
    rows = flatten.flatten_seats(_records(spark, sf_dir, "seats"))
    return _text_time(rows, "created_at", "last_activity_at")


@query
def ide_family_labels(spark, sf_dir):
    rows = derive.events_user_ide(derive.events(spark, sf_dir))
    return rows.groupBy("ide").agg(F.count("*").alias("rows")).withColumn("ide_family", ide_family("ide"))


# ------------------------------------------------------------------ dimensions and facts

for _dim in ("dim_org", "dim_editor", "dim_feature", "dim_model", "dim_product", "dim_team"):
    events_query(_dim, lambda T, d=_dim: T[d].drop(f"{d[4:]}_sk"))
events_query("dim_date", views.date_table)
events_query(
    "dim_user",
    lambda T: _text_time(T.dim_user.drop("user_sk", "seat_created_at"), "last_activity_at"),
)


def _numbering(T: Tables) -> DataFrame:
    parts = [
        T[d].agg(
            F.count("*").alias("rows"), F.min(sk).alias("lowest"), F.max(sk).alias("highest"),
            F.countDistinct(sk).alias("numbers"),
        ).withColumn("dimension", F.lit(d))
        for d, sk in (
            ("dim_user", "user_sk"), ("dim_org", "org_sk"), ("dim_team", "team_sk"), ("dim_editor", "editor_sk"),
            ("dim_model", "model_sk"), ("dim_product", "product_sk"), ("dim_feature", "feature_sk"),
        )
    ]
    return reduce(DataFrame.unionByName, parts)


events_query("dim_numbering", _numbering)
for _fact in facts.LOADS:
    events_query(_fact, lambda T, f=_fact: T[f].drop("loaded_at"))
events_query("ide_share", lambda T: T.fact_user_ide_share.drop("loaded_at"))
events_query(
    "ide_share_generations",
    lambda T: allocate.ide_share(T.fact_user_ide_day, basis=("generations",)),
)
events_query(
    "ide_share_no_fallback", lambda T: allocate.ide_share(T.fact_user_ide_day, fallback=None)
)
events_query("feature_share", lambda T: allocate.feature_share(T.fact_user_model_feature_day))


def _spend_shares(T: Tables) -> DataFrame:
    """The stored shares beside the billing rows, each list as one text."""
    def listed(name: str, *parts: str):
        return F.array_join(
            F.transform(name, lambda s: F.concat_ws("/", *(s[p].cast("string") for p in parts))), ","
        ).alias(name)

    return T.fact_spend_shares.select(
        *allocate.USER_DAY_MODEL, "product_key", "net_amount", "gross_amount", "net_quantity",
        listed("editors", "editor_key", "share", "weight_basis"), listed("features", "feature_key", "share"),
    )


events_query("spend_shares", _spend_shares)


@query
def upsert_corrections(spark, sf_dir):
    """A first load with doubled amounts, then the trailing window again with the right ones."""
    T = events_tables(spark, sf_dir)
    keys = FACT_KEYS["fact_premium_requests"]
    right = T.fact_premium_requests.drop("loaded_at")
    first = right.withColumn("net_amount", (F.col("net_amount") * 2).cast("decimal(18,4)"))
    window = load.reload_window(date(2024, 1, 30))
    merged = facts.upsert(first, allocate.between(right, *window), keys)
    return merged.groupBy(F.to_date(F.col("date_key").cast("string"), "yyyyMMdd").alias("usage_date")).agg(
        F.sum("net_amount").cast("decimal(38,4)").alias("net_amount"), F.count("*").alias("rows")
    )


@query
def reload_window_rows(spark, sf_dir):
    datasets = derive.events_datasets(spark, sf_dir)
    window = load.in_window(datasets, *load.reload_window(date(2024, 1, 30)))
    parts = [df.agg(F.count("*").alias("rows")).withColumn("dataset", F.lit(n)) for n, df in window.items()]
    return reduce(DataFrame.unionByName, parts)


# ------------------------------------------------------------------ views

events_query("spend_by_user_model_editor", views.spend_by_user_model_editor)
events_query("spend_by_user_model", views.spend_by_user_model)
events_query("monthly_spend_by_team", views.monthly_spend_by_team)
events_query("editor_mix", views.editor_mix)
events_query("model_feature_mix", views.model_feature_mix)
events_query("spend_by_team", views.spend_by_team)
events_query(
    "inactive_seats", lambda T: _text_time(views.inactive_seats(T, AS_OF), "last_activity_at")
)

# ------------------------------------------------------------------ questions

events_query("user_breakdown", lambda T: questions.user_breakdown(T, "USER1", SINCE, UNTIL))
events_query("user_exact_total", lambda T: questions.user_exact_total(T, "user1", SINCE, UNTIL))
events_query(
    "user_exact_total_unknown", lambda T: questions.user_exact_total(T, "nobody", SINCE, UNTIL)
)
events_query("top_spenders", lambda T: questions.top_spenders(T, SINCE, UNTIL))
events_query("top_spenders_all", lambda T: questions.top_spenders(T, SINCE, UNTIL, None))
events_query("team_breakdown", lambda T: questions.team_breakdown(T, "CC0", SINCE, UNTIL))
events_query("team_total", lambda T: questions.team_total(T, "cc0", SINCE, UNTIL))
events_query("summary", lambda T: questions.summary(T, SINCE, UNTIL))
events_query("editor_spend", lambda T: questions.editor_spend(T, SINCE, UNTIL))
events_query(
    "data_freshness", lambda T: _text_time(questions.data_freshness(T), "last_successful_run")
)
events_query("freshness_by_fact", questions.freshness_by_fact)
events_query("weight_basis_counts", questions.weight_basis_counts)
events_query(
    "run_states",
    lambda T: _text_time(T.ingestion_run, "started_at", "completed_at"),
)
events_query(
    "recent_runs", lambda T: _text_time(runs.recent_runs(T.ingestion_run), "completed_at")
)
events_query(
    "ingestion_stalled", lambda T: runs.ingestion_stalled(T.ingestion_run, f"{AS_OF} 00:00:00")
)
events_query("month_of_user", lambda T: questions.month_of_user(T, "user1", "2024-01"))
events_query("month_exact", lambda T: questions.month_exact(T, "2024-01"))
events_query(
    "idle_seats_by_age",
    lambda T: _text_time(questions.idle_seats_by_age(T, AS_OF), "last_activity_at"),
)
events_query("user_report", lambda T: questions.user_report(T, "user1", AS_OF))
events_query("team_report", lambda T: questions.team_report(T, "cc0", AS_OF))
events_query("top_report", lambda T: questions.top_report(T, AS_OF))
events_query("summary_report", lambda T: questions.summary_report(T, AS_OF))



def sql_query(name: str, call: str, tables: Callable[[SparkSession, str], Tables]) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        sql_functions.register_functions(tables(spark, sf_dir), AS_OF)
        return spark.sql(f"SELECT * FROM {call}")

    QUERIES[name] = run


sql_query("sql_top_spenders", "top_spenders(DATE'2024-01-05', DATE'2024-01-25', 10)", events_tables)
sql_query("sql_user_exact_total", "user_exact_total('USER1 ', DATE'2024-01-05', DATE'2024-01-25')", events_tables)
sql_query("sql_team_breakdown", "team_breakdown('CC0', DATE'2024-01-05', DATE'2024-01-25')", events_tables)
sql_query("sql_team_total", "team_total('cc0', DATE'2024-01-05', DATE'2024-01-25')", events_tables)
sql_query("sql_orders_top_spenders", "top_spenders(DATE'1990-01-01', DATE'2030-01-01', 100)", orders_tables)

# ------------------------------------------------------------------ measures and report pages

events_query("exact_measures", lambda T: measures.exact_measures(T, ["org_login", "cost_center"]))
events_query("exact_measures_total", measures.exact_measures)
events_query(
    "allocated_measures", lambda T: measures.allocated_measures(T, ["org_login", "model_name"])
)
events_query("editor_share", lambda T: measures.editor_share(T, ["org_login", "editor_family"]))
events_query(
    "engagement_measures", lambda T: measures.engagement_measures(T, ["editor_family", "org_login"])
)
events_query("distinct_users_window", lambda T: distinct_users.distinct_users(T, since=SINCE, until=UNTIL))
events_query("distinct_users_by_org", lambda T: distinct_users.distinct_users(T, ["org_login", "year_month"]))
events_query("distinct_users_active", lambda T: distinct_users.distinct_users(T, ["org_login"], "activity", SINCE, UNTIL))
orders_query("orders_distinct_users", lambda T: distinct_users.distinct_users(T, ["org_login"]))
events_query("restricted_distinct_users", lambda T: distinct_users.distinct_users(_as_user2(T)))
events_query("seat_measures", lambda T: measures.seat_measures(views.inactive_seats(T, AS_OF)))
events_query(
    "freshness_measures",
    lambda T: measures.freshness_measures(T, AS_OF),
)
for _column in ("usage_date", "model_name", "cost_center"):
    events_query(f"spend_by_{_column}", lambda T, c=_column: frames.spend_by(T, c))
events_query("kpi_cards", frames.kpi_cards)
events_query(
    "user_table",
    lambda T: frames.user_table(
        T, {"year_month": "2024-01", "cost_center": "cc0", "model_name": "model-1"}
    ),
)
events_query("detail_matrix", frames.detail_matrix)
events_query("detail_matrix_of_user", lambda T: frames.detail_matrix(T, "user1"))
events_query(
    "detail_cards", lambda T: frames.detail_cards(T, "user1")
)
events_query("idle_seat_table", lambda T: frames.idle_seat_table(T, AS_OF))
events_query("acceptance_by_editor_family", frames.acceptance_by_editor_family)
events_query("interactions_by_feature_group", frames.interactions_by_feature_group)
events_query("date_model", frames.date_model)

# ------------------------------------------------------------------ quality


@query
def reconcile(spark, sf_dir):
    """Billing lines with one value of k lose their product and must show up as orphans."""
    T = events_tables(spark, sf_dir)
    datasets = derive.events_datasets(spark, sf_dir)
    datasets["premium_requests"] = derive.events_premium_requests(
        derive.events(spark, sf_dir), blank_product_k=42
    )
    return quality.reconcile(stage(datasets), T)


@query
def payload_contract(spark, sf_dir):
    root = archive(spark, sf_dir)
    parts = []
    for kind, keys in (("user_activity", ("dt", "org")), ("user_teams", ("dt", "org")),
                       ("premium_requests", ("org",)), ("seats", ("org",))):
        lines = raw.read_raw(spark, root, DATASETS[kind], latest_per=keys)
        parts.append(quality.payload_contract(lines, kind))
    return reduce(DataFrame.unionByName, parts)


@query
def observed_values(spark, sf_dir):
    return quality.observed_values(raw.read_raw(spark, archive(spark, sf_dir), DATASETS["user_activity"]))


@query
def cross_product_published(spark, sf_dir):
    """By organisation; the editor entries of org1 name a model for this."""
    lines = raw.read_raw(spark, archive(spark, sf_dir), DATASETS["user_activity"])
    named = F.regexp_replace("line", '"ide":', '"model":"m","ide":')
    lines = lines.withColumn("line", F.when(F.col("org") == "org1", named).otherwise(F.col("line")))
    parts = [
        quality.cross_product_published(lines.filter(F.col("org") == org)).withColumn("org", F.lit(org))
        for org in ("org0", "org1", "org2")
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def seats_by_org(spark, sf_dir):
    return quality.seats_by_org(derive.events_seats(derive.events(spark, sf_dir)))


@query
def billing_plan(spark, sf_dir):
    seats = derive.events_seats(derive.events(spark, sf_dir))
    return quality.billing_plan(seats, "2024-01-28", "2024-01-30", max_users=20)


@query
def billing_plan_all(spark, sf_dir):
    seats = derive.events_seats(derive.events(spark, sf_dir))
    return quality.billing_plan(seats, "2024-01-28", "2024-01-30")


@query
def billing_plan_left_out(spark, sf_dir):
    return quality.billing_plan_left_out(derive.events_seats(derive.events(spark, sf_dir)), max_users=20)


@query
def billing_orphans(spark, sf_dir):
    """Billing lines with one value of k lose their product; they are kept with what they miss."""
    T = events_tables(spark, sf_dir)
    bills = derive.events_premium_requests(derive.events(spark, sf_dir), blank_product_k=42)
    staged = stage({"premium_requests": bills})["premium_requests"]
    rows = quality.orphans(staged, T, "premium_requests")
    return rows.groupBy("usage_date", "org_login", F.array_join("missing", ",").alias("missing")).agg(
        F.count("*").alias("rows"), F.sum("net_amount").cast("decimal(38,4)").alias("net_amount")
    )


@query
def refused_values(spark, sf_dir):
    """Counts and days damaged for some values of k: what is read, and what is refused and counted."""
    ev = derive.events(spark, sf_dir).select(
        "k",
        F.expr("case k % 5 when 0 then 'NaN' when 1 then '3000000000' when 2 then '-Infinity' when 3 then k || '.9' else '' end").alias("c"),
        F.expr("case when k % 3 = 0 then '2026-13-45' when k % 3 = 1 then '9999-01-01' else cast(d as string) end").alias("t"),
    )
    return ev.groupBy((F.col("k") % 15).alias("case")).agg(
        F.sum(columns.count("c")).cast("bigint").alias("total"),
        F.count_if(columns.count_refused("c")).alias("counts_refused"),
        F.count(columns.day("t")).alias("days"),
        F.count_if(columns.day_refused("t")).alias("days_refused"),
    )


@query
def seat_guard(spark, sf_dir):
    """Organisations that have billing and no usable seat, by the guard that a strict load uses; the
    seats of org1 lose their logins for this."""
    seats = derive.events_seats(derive.events(spark, sf_dir))
    seats = seats.withColumn("user_login", F.when(F.col("org_login") != "org1", F.col("user_login")).otherwise(""))
    return quality.seat_guard(seats, seats.select("org_login"), strict=False)


@query
def replace_window_withdrawn_day(spark, sf_dir):
    """Two loads of a week: the second one without the days that divide by three, which must go."""
    def make(out: str) -> None:
        wh = Warehouse(spark, out)
        first, last = date(2024, 1, 8), date(2024, 1, 14)
        week = load.in_window(derive.events_datasets(spark, sf_dir), first, last)
        load.load_all(wh, week, loaded_at="2024-01-15 02:00:00")
        day = {n: next((c for c in ("activity_date", "usage_date") if c in df.columns), None) for n, df in week.items()}
        kept = {n: df.filter(F.dayofmonth(day[n]) % 3 != 0) if day[n] else df for n, df in week.items()}
        load.load_all(wh, kept, loaded_at="2024-01-16 02:00:00", replace_window=(first, last))

    T = Warehouse(spark, _once(spark, sf_dir, "withdrawn", make)).tables()
    parts = [
        T[f].groupBy(F.to_date(F.col("date_key").cast("string"), "yyyyMMdd").alias("usage_date"))
        .agg(F.count("*").alias("rows")).withColumn("fact", F.lit(f))
        for f in ("fact_premium_requests", "fact_user_day")
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def constraint_violations(spark, sf_dir):
    T = events_tables(spark, sf_dir)
    staged = stage(derive.events_datasets(spark, sf_dir))
    rules = {
        "duplicate fact_premium_requests": quality.duplicate_keys(
            T.fact_premium_requests, FACT_KEYS["fact_premium_requests"]
        ),
        "duplicates when a day comes twice": quality.duplicate_keys(
            T.fact_premium_requests.unionByName(T.fact_premium_requests.filter("date_key = 20240105")),
            FACT_KEYS["fact_premium_requests"],
        ),
        "ide_share range": quality.out_of_range(T.fact_user_ide_share, "share", 0, 1),
        "dangling users of fact_user_ide_day": quality.dangling(T.fact_user_ide_day, T.dim_user, "user_key"),
        "dangling users of staged user_ide": quality.dangling(staged["user_ide"], T.dim_user, "user_key"),
        "duplicate staged user_day": quality.duplicate_keys(staged["user_day"], FACT_KEYS["fact_user_day"]),
    }
    parts = [df.agg(F.count("*").alias("rows")).withColumn("rule", F.lit(n)) for n, df in rules.items()]
    return reduce(DataFrame.unionByName, parts)


def _drift_by_day(T: Tables) -> DataFrame:
    drift = quality.allocation_drift(T)
    return drift.groupBy(F.to_date(F.col("date_key").cast("string"), "yyyyMMdd").alias("usage_date")).agg(
        F.sum("allocated").cast("decimal(38,6)").alias("allocated"),
        F.sum("net_amount").cast("decimal(38,4)").alias("exact"),
        F.sum("drift").cast("decimal(38,6)").alias("drift"),
    )


events_query("allocation_drift", _drift_by_day)

# ------------------------------------------------------------------ governance


def _access(T: Tables) -> DataFrame:
    """Grants made from the cost centers: user2 manages cc1 and cc3, `auditor` sees everything."""
    centers = T.dim_user.filter("cost_center in ('cc1', 'cc3')").select("cost_center").distinct()
    mine = centers.select(F.lit("user2").alias("principal_name"), "cost_center")
    auditor = T.dim_user.agg(F.lit("auditor").alias("principal_name"), F.lit("*").alias("cost_center"))
    return mine.unionByName(auditor)


events_query(
    "restrict",
    lambda T: governance.restrict(T.dim_user, _access(T), "user2").select("user_login", "cost_center"),
)
events_query(
    "restrict_everything",
    lambda T: governance.restrict(T.dim_user, _access(T), "auditor").select("user_login", "cost_center"),
)
events_query(
    "restricted_spend",
    lambda T: measures.exact_measures(
        governance.restricted(T, _access(T), "user2"), ["user_login"], ["total_spend"]
    ).withColumnRenamed("total_spend", "spend"),
)


def _as_user2(T: Tables) -> Tables:
    return governance.restricted(T, _access(T), "user2")


events_query("restricted_summary", lambda T: questions.summary(_as_user2(T), SINCE, UNTIL))
events_query(  # user1 is hidden from user2
    "restricted_user_exact_total", lambda T: questions.user_exact_total(_as_user2(T), "user1", SINCE, UNTIL)
)
events_query(
    "restricted_user_breakdown", lambda T: questions.user_breakdown(_as_user2(T), "user1", SINCE, UNTIL)
)
events_query("restricted_editor_spend", lambda T: questions.editor_spend(_as_user2(T), SINCE, UNTIL))
events_query("restricted_detail_matrix", lambda T: frames.detail_matrix(_as_user2(T)))
events_query("restricted_kpi_cards", lambda T: frames.kpi_cards(_as_user2(T)))


def _manager_report(T: Tables) -> DataFrame:
    managers = T.dim_user.filter("cost_center is not null").select(
        F.concat(F.lit("lead-"), "cost_center", F.lit("@example.org")).alias("email"), "cost_center"
    ).distinct()
    spend = views.spend_by_user_model(T)
    return governance.restrict_report(spend, managers, "Lead-cc2@example.org").groupBy("user_login").agg(
        F.sum("net_amount").cast("decimal(38,4)").alias("spend")
    )


events_query("restrict_report", _manager_report)
events_query("erasure_preview", lambda T: governance.erasure_preview(T, "user1"))
events_query(
    "erased_users",
    lambda T: governance.erase_user(T.dim_user, "user1").select(
        F.regexp_replace("user_login", "^erased-[0-9]+$", "erased").alias("user_login"),
        "team_name", "cost_center", "last_activity_editor", "plan_type", "is_active",
    ),
)
events_query("purge_preview", lambda T: governance.purge_preview(T, AS_OF, retain_days=20))


def _privacy(spark: SparkSession, sf_dir: str, step: str) -> DataFrame:
    """A warehouse whose billing partly found no place: seen by user2, then without the first user that
    has such billing, then without the days before the cutoff."""
    def make(root: str) -> None:
        wh = Warehouse(spark, f"{root}/wh")
        ev = derive.events(spark, sf_dir)
        bills = derive.events_premium_requests(ev, blank_product_k=42)
        data = derive.events_datasets(spark, sf_dir, f"{root}/_events") | {"premium_requests": bills}
        load.load_all(
            wh, data, strict=False, loaded_at="2024-01-31 02:00:00", cost_centers=derive.events_cost_centers(ev)
        )

        def keep(name: str, df: DataFrame) -> None:
            df.coalesce(1).write.parquet(f"{root}/{name}")

        def left() -> DataFrame:
            T = wh.tables()
            parts = [
                T[t].agg(F.count("*").alias("rows")).withColumn("table", F.lit(t))
                for t in ("billing_orphans", "fact_premium_requests", "fact_spend_shares", "fact_user_day")
            ]
            return reduce(DataFrame.unionByName, parts)

        T = wh.tables()
        seen = _as_user2(T).billing_orphans
        keep("restricted", seen.groupBy("usage_date", "user_login", "missing").agg(F.count("*").alias("rows")))
        first = T.billing_orphans.agg(F.min(F.lower("user_login")).alias("u")).first().u
        governance.forget_user(wh, first or "user1", "erasure", confirm=True)
        keep("erased", left())
        governance.purge(wh, AS_OF, "retention", retain_days=20, include_billing=True, confirm=True)
        keep("purged", left())

    return spark.read.parquet(f"{_once(spark, sf_dir, 'privacy', make)}/{step}")


QUERIES["restricted_billing_orphans"] = lambda spark, sf_dir: _privacy(spark, sf_dir, "restricted")
QUERIES["erased_rows"] = lambda spark, sf_dir: _privacy(spark, sf_dir, "erased")
QUERIES["purged_rows"] = lambda spark, sf_dir: _privacy(spark, sf_dir, "purged")
events_query(
    "pseudonymise",
    lambda T: governance.pseudonymise(views.spend_by_user_model(T), "user_login", ("net_amount",))
    .groupBy("user_login", "net_amount")
    .agg(F.count("*").alias("rows")),
)

# ------------------------------------------------------------------ streaming


def _streamed(spark, sf_dir, name: str, root: str, **options) -> DataFrame:
    def make(out: str) -> None:
        ingest.stream_ingest(
            spark, root, f"{out}/warehouse", f"{out}/checkpoint", loaded_at="2024-01-31 02:00:00", **options
        ).awaitTermination()

    T = Warehouse(spark, _once(spark, sf_dir, name, make) + "/warehouse").tables()
    return T.fact_premium_requests.groupBy(
        F.to_date(F.col("date_key").cast("string"), "yyyyMMdd").alias("usage_date")
    ).agg(F.count("*").alias("rows"), F.sum("net_amount").cast("decimal(38,4)").alias("net_amount"))


@query
def stream_ingest(spark, sf_dir):
    return _streamed(spark, sf_dir, "stream", archive(spark, sf_dir))


@query
def stream_ingest_many_batches(spark, sf_dir):
    """The same archive in several batches, whose files come in no order of their stamps."""
    root = archive(spark, sf_dir)
    files = reduce(DataFrame.unionByName, [raw.raw_files(spark, root, name) for name in DATASETS.values()])
    return _streamed(spark, sf_dir, "stream-many", root, files_per_batch=max(1, files.count() // 3))


@query
def stream_daily_activity(spark, sf_dir):
    def make(out: str) -> None:
        table = derive.table(spark, sf_dir, "events")
        reader = spark.readStream.schema(table.schema)
        if any("/events.parquet/" in file for file in table.inputFiles()):
            events = reader.parquet(f"{sf_dir}/events.parquet")
        else:  # a stream watches folders: the one of the file
            events = reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)
        activity.stream_daily_activity(events, f"{out}/table", f"{out}/checkpoint").awaitTermination()

    return activity.daily_activity(spark.read.parquet(_once(spark, sf_dir, "activity", make) + "/table"))


# ------------------------------------------------------------------ orders domain

orders_query(
    "orders_spend_by_user_model_editor",
    lambda T: views.spend_by_user_model_editor(T).select(
        "usage_date", "user_login", "org_login", "model_name", "product", "sku", "editor_name",
        "feature", "weight_basis", "allocated_net_amount", "allocated_quantity",
    ),
)
orders_query(
    "orders_editor_spend", lambda T: questions.editor_spend(T, None, None)
)
orders_query("orders_detail_matrix", frames.detail_matrix)
orders_query(
    "orders_top_spenders",
    lambda T: questions.top_spenders(T, None, None, 100),
)
orders_query("orders_monthly_spend_by_team", views.monthly_spend_by_team)
orders_query("orders_spend_over_time", measures.spend_over_time)
orders_query(
    "orders_spend_over_time_by_org", lambda T: measures.spend_over_time(T, ["org_login"])
)
orders_query("orders_month_over_month", measures.month_over_month)
orders_query(
    "orders_month_over_month_by_org", lambda T: measures.month_over_month(T, ["org_login"])
)
