import datetime as dt

from pyspark.sql import functions as F

from opinara.functions import dates as d


def test_safe_date(one):
    assert one(d.safe_date(F.col("v")), v="1779999853273") == dt.date(2026, 5, 28)
    assert one(d.safe_date(F.col("v")), v="2026-05-28T20:24") == dt.date(2026, 5, 28)
    assert one(d.safe_date(F.col("v")), v="garbage") is None
    assert one(d.safe_date(F.col("v").cast("string")), v=None) is None


def test_post_format(one):
    got = one(F.date_format(d.event_timestamp(F.col("v")), "yyyy-MM-dd HH:mm:ss"),
              v="Thu Mar 19 19:11:50 +0000 2026")
    assert got == "2026-03-19 19:11:50"
    got = one(F.date_format(d.event_timestamp(F.col("v")), "yyyy-MM-dd HH:mm:ss"), v="2026-04-11 02:47:45")
    assert got == "2026-04-11 02:47:45"


def test_event_date_falls_back_to_the_snapshot(spark):
    rows = spark.createDataFrame(
        [("Thu Mar 19 19:11:50 +0000 2026", "1779999853273"), (None, "1779999853273"), ("?", "2026-05-01"),
         (None, None)], "createdAt string, snapshot_date string")
    got = [r.event_date for r in d.normalize_event_date(rows).collect()]
    assert got == [dt.date(2026, 3, 19), dt.date(2026, 5, 28), dt.date(2026, 5, 1), None]
    got = [r.event_date for r in d.normalize_event_date(rows.drop("createdAt")).collect()]
    assert got[0] == dt.date(2026, 5, 28)


def test_mixed_datetime_switches_on_the_share(spark):
    ms, iso = "1779999853273", "2026-05-01 00:00:00"
    rows = spark.createDataFrame([(ms,)] * 9 + [(iso,)], "v string")
    got = d.parse_mixed_datetime(rows, "v", "t")
    assert got.filter("t is not null").count() == 9
    rows = spark.createDataFrame([(ms,)] * 8 + [(iso,)] * 2, "v string")  # exactly 80 %: not above
    got = d.parse_mixed_datetime(rows, "v", "t")
    assert got.filter("t is not null").count() == 2


def test_iso_week_carries_its_year(spark):
    rows = spark.createDataFrame([(dt.date(2024, 12, 30),), (dt.date(2027, 1, 1),)], "day date")
    got = [(r.iso_year, r.iso_week) for r in d.with_iso_week(rows, "day").collect()]
    assert got == [(2025, 1), (2026, 53)]


def test_week_bounds():
    assert d.week_bounds(2025, 1) == (dt.date(2024, 12, 30), dt.date(2025, 1, 6))


def test_named_columns_are_parsed_even_without_date_in_the_name(spark):
    rows = spark.createDataFrame([("2026-01-01 10:00:00", "x")], "createdAt string, updatedAt string")
    got = d.coerce_datetimes(rows, ["createdAt", "updatedAt", "absent"])
    assert got.dtypes == [("createdAt", "timestamp"), ("updatedAt", "timestamp")]
    assert got.first().updatedAt is None
