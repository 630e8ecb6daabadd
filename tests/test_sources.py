"""Report files and the raw zone."""

import gzip
import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from spendlens.sources import raw, reports

SCHEMA = "struct<id: bigint, n: double>"


def test_report_lines_of_every_kind(spark, tmp_path, rows):
    with gzip.open(tmp_path / "a.json.gz", "wt") as f:
        f.write('{"id": 1, "n": 2}\n\n   \n[{"id": 2}, {"id": 3, "n": "x"}]\n{"id": 4, \n{"id": 5}\n')
    path = str(tmp_path)
    assert rows(reports.read_report(spark, path, SCHEMA)) == [(1, 2.0), (2, None), (3, None), (5, None)]
    quality = reports.report_quality(spark, path).first()
    assert (quality.lines, quality.malformed, quality.records, quality.unreadable) == (4, 1, 4, False)


def test_mostly_damaged_report_fails(spark, tmp_path):
    (tmp_path / "good.json").write_text('{"id": 1}\n' * 10)
    (tmp_path / "bad.json").write_text('{"id": 1}\nnot json\nnot json\n')
    with pytest.raises(reports.UnreadableReport, match="bad.json"):
        reports.read_report(spark, str(tmp_path), SCHEMA)
    assert reports.read_report(spark, str(tmp_path), SCHEMA, strict=False).count() == 11


def _payloads(spark, rows):
    return spark.createDataFrame(rows, "dt string, org string, value string")


def test_latest_run_wins_and_dates_are_pruned(spark, tmp_path, rows):
    root = str(tmp_path)
    raw.write_raw(_payloads(spark, [("2026-08-01", "007", '{"id": 1}'), ("2026-08-02", "007", '{"id": 2}')]),
                  root, "d", "20260803T020000Z")
    raw.write_raw(_payloads(spark, [("2026-08-02", "007", '{"id": 20}'), ("2026-08-02", "a/b", '{"id": 21}')]),
                  root, "d", "20260804T020000Z")
    lines = raw.read_raw(spark, root, "d")
    assert rows(lines, "org", "line") == [("007", '{"id": 1}'), ("007", '{"id": 20}'), ("a_b", '{"id": 21}')]
    assert raw.read_raw(spark, root, "d", since=date(2026, 8, 2)).count() == 2
    assert raw.read_raw(spark, root, "d", latest_per=("org",)).count() == 2
    plan = raw.raw_lines(spark, root, "d", since=date(2026, 8, 2))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_flat_archive_files(spark, tmp_path, rows):
    folder = tmp_path / "seats" / "dt=2026-08-01"
    folder.mkdir(parents=True)
    for org, stamp, n in (("my_org", "20260801T020000Z", 1), ("my_org", "20260801T030000Z", 2), ("b", "20260801T020000Z", 3)):
        (folder / f"seats_{org}_{stamp}.json").write_text(json.dumps([{"id": n}, {"id": n * 10}]))
    lines = raw.read_raw(spark, str(tmp_path), "seats", flat=True)
    parsed = reports.parse_records(lines, SCHEMA)
    assert rows(parsed, "org", "record.id") == [("b", 3), ("b", 30), ("my_org", 2), ("my_org", 20)]


def test_billing_takes_the_latest_copy_of_each_day(spark, tmp_path, rows):
    def bill(login, period, amount):
        item = {"product": "p", "netAmount": amount}
        return json.dumps({"user_login": login, "period": period, "payload": {"usageItems": [item]}})

    root = str(tmp_path)
    raw.write_raw(_payloads(spark, [("2026-08-05", "acme", bill("a", "2026-08-01", 1)),
                                    ("2026-08-05", "acme", bill("a", "2026-08-05", 2))]),
                  root, "premium_requests", "20260806T020000Z")
    raw.write_raw(_payloads(spark, [("2026-08-06", "acme", bill("a", "2026-08-05", 3))]),
                  root, "premium_requests", "20260807T020000Z")
    df = raw.read_billing_archive(spark, root, since=date(2026, 8, 1), until=date(2026, 8, 6))
    got = df.select(F.col("usage_date").cast("string"), F.col("payload.usageItems")[0]["item"]["netAmount"].cast("int"))
    assert rows(got) == [("2026-08-01", 1), ("2026-08-05", 3)]


def _bills(spark, *rows):
    bill = '{"user_login": "a", "period": "%s", "payload": {"usageItems": [{"product": "p", "netAmount": %s}]}}'
    return _payloads(spark, [(dt, "acme", bill % (period, n)) for dt, period, n in rows])


def test_a_days_billing_opens_only_the_folders_that_hold_it(spark, tmp_path, rows):
    root = str(tmp_path)
    for i, dt in enumerate(("2026-08-05", "2026-08-12", "2026-08-19")):
        late = [(dt, "2026-08-01", 9)] if i == 2 else []
        raw.write_raw(_bills(spark, (dt, dt, i), (dt, f"2026-08-0{i + 1}", i), *late), root, "premium_requests", f"2026082{i}T020000Z")
    index = raw.usage_date_index(spark, root)
    assert index.count() == 7  # no file is indexed twice

    def folders(since, until, **more):
        return [str(d) for d in raw.billing_folders(spark, root, since, until, **more)]

    assert folders(date(2026, 8, 1), date(2026, 8, 1)) == ["2026-08-05", "2026-08-19"]
    assert folders(date(2026, 8, 2), date(2026, 8, 2)) == ["2026-08-12"]
    assert folders(date(2026, 8, 13), date(2026, 8, 18)) == []
    assert raw.read_billing_archive(spark, root, date(2026, 8, 13), date(2026, 8, 18)).count() == 0
    one = raw.read_billing_archive(spark, root, date(2026, 8, 2), date(2026, 8, 2))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "2026-08-12" in plan.split("PartitionFilters:")[1].split("]")[0] and "2026-08-19" not in plan
    latest = raw.read_billing_archive(spark, root, date(2026, 8, 1), date(2026, 8, 1))
    assert latest.select(F.col("payload.usageItems")[0]["item"]["netAmount"].cast("int")).first()[0] == 9


def test_files_that_the_index_does_not_know_are_read_and_can_be_indexed(spark, tmp_path):
    folder = tmp_path / "premium_requests" / "dt=2026-08-05"
    folder.mkdir(parents=True)
    record = {"user_login": "a", "payload": {"usageItems": [{"product": "p", "netAmount": 1}]}}
    days = [{**record, "period": f"2026-08-0{i}"} for i in (1, 2)] + [record]
    (folder / "premium_requests_my org_20260806T020000Z.json").write_text(json.dumps(days))
    root, day = str(tmp_path), date(2026, 8, 4)
    assert raw.usage_date_index(spark, root).count() == 0
    assert raw.billing_folders(spark, root, day, day, flat=True) == [date(2026, 8, 5)]
    assert raw.read_billing_archive(spark, root, date(2026, 8, 2), day, flat=True).count() == 1
    for _ in range(2):
        raw.index_usage_dates(spark, root, flat=True)
        assert raw.usage_date_index(spark, root).count() == 3  # two days, and a record without
    assert raw.billing_folders(spark, root, day, day, flat=True) == []
    assert raw.read_billing_archive(spark, root, date(2026, 8, 2), day, flat=True).count() == 1


def test_expired_partitions(spark, tmp_path, rows):
    raw.write_raw(_payloads(spark, [("2024-01-01", "a", "{}"), ("2026-01-01", "a", "{}")]), str(tmp_path), "d", "20260101T000000Z")
    got = raw.expired_raw_partitions(spark, str(tmp_path), date(2026, 2, 1), 730, ("d",))
    assert rows(got.select("dataset", F.col("dt").cast("string"), "files")) == [("d", "2024-01-01", 1)]
