from datetime import date

from pyspark.sql import functions as F

from spendlens.operators import governance
from spendlens.operators.distinct_users import SOURCES, bitmaps, distinct_users
from spendlens.plans import load

from .conftest import activity


def days_of(month, users):
    data = {n: [] for n in ("user_day", "user_ide", "user_model_feature", "premium_requests", "seats")}
    for login, (org, first, last) in users.items():
        data["seats"].append((login, len(login), org, "t", "business", "2026-08-01 10:00:00"))
        for day in range(first, last + 1):
            when = f"2026-{month:02}-{day:02}"
            for name, rows in activity(when, login, [("vim", 1, 1)], org=org).items():
                data[name] += rows
            if day % 2:
                data["premium_requests"].append((when, login, org, "plan", "premium", "m", "1.0000"))
    return data


USERS = {"Ann": ("a", 1, 9), "bob": ("a", 3, 4), "cy": ("b", 4, 9), "di": ("b", 9, 9)}


def counted(T, by, source, since=None, until=None):
    """Distinct users over the facts."""
    fact = T[SOURCES[source]]
    labels = {"usage_date": F.to_date(F.col("date_key").cast("string"), "yyyyMMdd"), "org_login": F.col("org_key")}
    labels["year_month"] = F.date_format(labels["usage_date"], "yyyy-MM")
    day = labels["usage_date"]
    fact = fact.filter(day.between(since or "1990-01-01", until or "2099-01-01"))
    return fact.groupBy(*(labels[c].alias(c) for c in by)).agg(F.countDistinct("user_key").alias("users"))


def check(T, rows):
    cases = {
        (): (date(2026, 8, 3), date(2026, 8, 4)), ("usage_date",): (None, None),
        ("org_login", "year_month"): (date(2026, 8, 4), None),
    }
    for source in SOURCES:
        for by, window in cases.items():
            assert rows(distinct_users(T, by, source, *window)) == rows(counted(T, by, source, *window))


def test_equal_to_counts_of_distinct_users(warehouse, frames, rows):
    load.load_all(warehouse, frames(days_of(8, USERS)), run_id="r1")
    T = warehouse.tables()
    check(T, rows)
    assert rows(distinct_users(T)) == [(4,)]
    assert rows(distinct_users(T, since=date(2031, 1, 1))) == [(0,)]
    # a later load marks new users in its days and leaves the others as they are
    load.load_all(warehouse, frames(days_of(8, {"eve": ("b", 2, 3)})), run_id="r2")
    check(warehouse.tables(), rows)
    load.load_all(
        warehouse, frames(days_of(8, {"eve": ("a", 3, 3)})), run_id="r3", replace_window=(date(2026, 8, 3), date(2026, 8, 5))
    )
    check(warehouse.tables(), rows)
    assert rows(distinct_users(warehouse.tables(), since=date(2026, 8, 3), until=date(2026, 8, 5))) == [(1,)]


def test_restricted_erased_and_purged(warehouse, frames, rows):
    load.load_all(warehouse, frames(days_of(8, USERS)), run_id="r1")
    mine = governance.restricted(warehouse.tables(), access=_no_grants(warehouse), principal="ann")
    assert rows(distinct_users(mine)) == [(1,)]
    check(mine, rows)
    governance.forget_user(warehouse, "ann", "e", confirm=True)
    check(warehouse.tables(), rows)
    assert rows(distinct_users(warehouse.tables())) == [(3,)]
    governance.purge(warehouse, date(2026, 8, 14), "p", retain_days=8, confirm=True)
    check(warehouse.tables(), rows)
    governance.purge(warehouse, date(2026, 8, 16), "q", retain_days=8, include_billing=True, confirm=True)
    check(warehouse.tables(), rows)
    before = rows(bitmaps(warehouse.tables()), "date_key", "source", "org_key", "bucket")
    load.rebuild_bitmaps(warehouse, "b")
    assert rows(bitmaps(warehouse.tables()), "date_key", "source", "org_key", "bucket") == before
    check(warehouse.tables(), rows)


def _no_grants(wh):
    return wh.spark.createDataFrame([], "principal_name string, cost_center string")
