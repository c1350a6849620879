import datetime as dt

import pytest
from pyspark.sql import functions as F

from opinara.functions.dates import safe_date, with_iso_week
from opinara.session import delete_folder
from opinara.sources import readers
from opinara.streaming import jobs
from tests.fixtures import POSTS, land, news_snapshot, post, tweets_snapshot


def test_silver_stream_takes_each_file_once(spark, tmp_path):
    bronze, silver, ckpt = tmp_path / "bronze", str(tmp_path / "silver"), str(tmp_path / "ckpt")
    run = lambda: jobs.stream_silver(spark, "twitter", str(bronze), silver, ckpt, ["id"],
                                     lambda _: safe_date("snapshot_date"), per_batch=1)
    land(bronze, "twitter_tweets_20260528_100000.json", tweets_snapshot("2026-05-28", POSTS))
    run()
    assert spark.read.parquet(silver).count() == 4
    land(bronze, "twitter_tweets_20260529_100000.json",
         tweets_snapshot("2026-05-29", [post("2", "changed", 5, "bob"), post("9", "new", 1, "zed")], "s2"))
    run()
    run()  # nothing new
    got = {r.id: r.text for r in spark.read.parquet(silver).collect()}
    assert got.keys() == {"1", "2", "3", "4", "9"} and got["2"] == "changed"
    batch = readers.silver_tweets(readers.read_snapshots(spark, f"{bronze}/*.json", "twitter"))
    from opinara.operators.identity import latest_per_key
    want = latest_per_key(batch, ["id"], [F.col("snapshot_date").desc()])
    assert got == {r.id: r.text for r in want.collect()}


@pytest.fixture
def silver_run(spark, tmp_path):
    """Snapshots that land one by one, a run of the stream a file a batch, and the texts stored by it."""
    bronze, silver, ckpt = tmp_path / "bronze", str(tmp_path / "silver"), tmp_path / "ckpt"
    names = iter(range(100, 200))
    put = lambda day, *posts: land(bronze, f"twitter_tweets_20260528_{next(names)}000.json", tweets_snapshot(day, list(posts)))
    run = lambda: jobs.stream_silver(spark, "twitter", str(bronze), silver, str(ckpt), ["id"], lambda _: safe_date("snapshot_date"), per_batch=1)
    texts = lambda: {(r.id, r.iso_week): r.text for r in spark.read.parquet(silver).collect()}
    return put, run, texts, ckpt


def test_weeks_are_merged_once_a_run(monkeypatch, silver_run):
    put, run, texts, ckpt = silver_run
    merges, upsert_weekly = [], jobs.upsert_weekly
    monkeypatch.setattr(jobs, "upsert_weekly", lambda *a, **b: (merges.append(1), upsert_weekly(*a, **b)))
    for n in range(5):
        put("2026-05-28", post("same", f"text {n}", n, "ann"), post(f"own {n}", "text", n, "bob"))
    run()
    assert len(list((ckpt / "commits").glob("[0-9]*"))) == 5 and len(merges) == 1
    assert texts() == {("same", 22): "text 4", **{(f"own {n}", 22): "text" for n in range(5)}}
    assert not list((ckpt / "landed").iterdir())
    run()
    assert len(merges) == 1


def test_a_later_batch_wins_over_a_newer_date(silver_run):
    put, run, texts, _ = silver_run
    put("2026-05-29", post("1", "late date, early batch", 1, "ann"), post("2", "kept", 1, "ann"))
    put("2026-05-28", post("1", "early date, late batch", 1, "ann"))
    put("2026-06-02", post("1", "another week", 1, "ann"))
    run()
    want = {("1", 22): "early date, late batch", ("2", 22): "kept", ("1", 23): "another week"}
    assert texts() == want
    put("2026-05-28", post("2", "changed", 1, "ann"))
    run()
    assert texts() == want | {("2", 22): "changed"}


def test_a_merge_that_failed_is_made_up_for(monkeypatch, silver_run):
    put, run, texts, _ = silver_run
    put("2026-05-28", post("1", "first", 1, "ann"))
    with monkeypatch.context() as broken, pytest.raises(ZeroDivisionError):
        broken.setattr(jobs, "upsert_weekly", lambda *a, **b: 1 / 0)
        run()
    run()  # nothing new, but one batch that has landed
    assert texts() == {("1", 22): "first"}


def test_batches_left_behind_are_not_merged_again(monkeypatch, silver_run):
    put, run, texts, ckpt = silver_run
    put("2026-05-28", post("1", "old", 1, "ann"))
    put("2026-05-28", post("1", "new", 1, "ann"))
    with monkeypatch.context() as broken:  # the second of two batches is deleted, the first stays
        broken.setattr(jobs, "delete_folder", lambda uri: delete_folder(uri) if uri.endswith("=1") else None)
        run()
    assert [f.name for f in (ckpt / "landed").iterdir()] == ["batch=0"]
    put("2026-05-28", post("2", "other", 1, "ann"))
    run()
    assert texts() == {("1", 22): "new", ("2", 22): "other"} and not list((ckpt / "landed").iterdir())


def test_a_batch_that_fails_keeps_none_before_it_back(monkeypatch, silver_run):
    put, run, texts, _ = silver_run
    land_batches = jobs.land_batches

    def failing(path, **options):
        sink = land_batches(path, **options)

        def each(batch, number):
            sink(batch, number)
            if number == 1:
                raise ValueError("after it was written, before it was committed")
        return each

    put("2026-05-28", post("1", "first", 1, "ann"))
    put("2026-05-28", post("1", "second", 1, "ann"))
    with monkeypatch.context() as broken, pytest.raises(Exception, match="before it was committed"):
        broken.setattr(jobs, "land_batches", failing)
        run()
    assert texts() == {("1", 22): "first"}
    run()
    assert texts() == {("1", 22): "second"}


def test_news_stream_merges_batches_in_order(spark, tmp_path):
    bronze = tmp_path / "bronze"
    land(bronze, "webscraping_a_20260528_100000.json", news_snapshot("2026-05-28", {"n/1": ["old"], "n/2": ["x"]}))
    land(bronze, "webscraping_a_20260529_100000.json", [news_snapshot("2026-05-28", {"n/1": ["new", "y"]}, "n2")])
    jobs.stream_silver(spark, "webscraping", str(bronze), str(tmp_path / "s"), str(tmp_path / "c"), ["newsLink"],
                       lambda _: safe_date("snapshot_date"), per_batch=1)
    rows = spark.read.parquet(str(tmp_path / "s"))
    assert {(r.newsLink, tuple(r.comments), r.snapshot_id) for r in rows.collect()} == {("n/1", ("new", "y"), "n2"), ("n/2", ("x",), "n1")}
    assert "batch" not in rows.columns


def _events(spark, sf):
    return spark.read.parquet(f"{sf}/events.parquet").schema


def test_trend_stream_equals_batch(spark, sf, tmp_path):
    rows = jobs.stream_files(spark, sf, _events(spark, sf), "events.parquet")
    jobs.write_trend(jobs.stream_trend(rows, "ts", "event_type", score="value"),
                     str(tmp_path / "t"), str(tmp_path / "c"))
    got = {(r.period, r.event_type): r.n_records for r in spark.read.parquet(str(tmp_path / "t")).collect()}
    events = spark.read.parquet(f"{sf}/events.parquet")
    closed = events.agg(F.max("ts")).first()[0] - dt.timedelta(days=3)  # a day and the delay
    batch = events.groupBy(F.to_date("ts").alias("d"), "event_type").count()
    want = {(r.d, r.event_type): r["count"] for r in batch.collect() if dt.datetime.combine(r.d, dt.time()) <= closed}
    assert got == want and want


def test_dedup_stream_keeps_one_row_per_key(spark, tmp_path):
    folder = str(tmp_path / "in")
    at = dt.datetime(2026, 5, 28, 10)
    rows = [("a", at, 1), ("a", at + dt.timedelta(minutes=5), 2), ("b", at, 3)]
    kinds = "id string, ts timestamp, v int"
    spark.createDataFrame(rows, kinds).coalesce(1).write.parquet(folder)
    spark.createDataFrame([("b", at + dt.timedelta(minutes=1), 4), ("c", at, 5)], kinds).coalesce(1) \
        .write.mode("append").parquet(folder)
    source = jobs.stream_files(spark, folder, spark.read.parquet(folder).schema, per_batch=1)
    out = str(tmp_path / "out")
    jobs.run_available(jobs.stream_dedup(source, ["id"], "ts", "1 hour"), str(tmp_path / "c"),
                       jobs.land_batches(out))
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_alert_stream_equals_batch(spark, tmp_path):
    from opinara.operators.trends import ordered_alerts, sentiment_alerts
    folder = str(tmp_path / "in")
    days = [("b", "s", dt.date(2026, 5, d), n, 0.0) for d, n in ((1, 10.0), (2, 25.0), (3, 50.0), (4, 20.0))]
    kinds = "brand string, source string, date_day date, negative_pct double, positive_pct double"
    for part in (days[:2], days[2:]):
        spark.createDataFrame(part, kinds).coalesce(1).write.mode("append").parquet(folder)
    trend = jobs.stream_files(spark, folder, spark.read.parquet(folder).schema, per_batch=1)
    jobs.stream_alerts(trend, str(tmp_path / "out"), str(tmp_path / "c"))
    got = spark.read.parquet(str(tmp_path / "out" / "alerts")).drop("batch")
    want = sentiment_alerts(spark.createDataFrame(days, kinds))
    key = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert key(got) == key(want) and got.count() == 2


def test_refresh_touches_only_the_weeks_of_the_batch(spark, tmp_path):
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    rows = with_iso_week(spark.createDataFrame(
        [("a", dt.date(2026, 5, 28)), ("b", dt.date(2026, 5, 29)), ("c", dt.date(2026, 6, 2))], "id string, day date"), "day")
    rows.write.partitionBy("iso_year", "iso_week").parquet(silver)
    arrivals = str(tmp_path / "arrivals")
    rows.filter("iso_week = 22").select("iso_year", "iso_week").write.parquet(arrivals)
    stream = jobs.stream_files(spark, arrivals, "iso_year int, iso_week int")
    jobs.refresh_weeks(stream, gold, str(tmp_path / "c"), lambda df: df.groupBy("iso_year", "iso_week").count(), silver)
    assert [tuple(r) for r in spark.read.parquet(gold).select("iso_week", "count").collect()] == [(22, 2)]


def test_new_alerts_appear_after_many_old_ones(spark, tmp_path):
    folder, kinds = str(tmp_path / "in"), "brand string, source string, date_day date, negative_pct double, positive_pct double"
    day = lambda d, n: [(f"b{k}", "s", dt.date(2026, 5, d), n, 0.0) for k in range(12)]
    for part in (day(1, 0.0) + day(2, 50.0), [("b0", "s", dt.date(2026, 5, 3), 10.0, 0.0)], [("b0", "s", dt.date(2026, 5, 4), 90.0, 0.0)]):
        spark.createDataFrame(part, kinds).coalesce(1).write.mode("append").parquet(folder)
    trend = jobs.stream_files(spark, folder, spark.read.parquet(folder).schema, per_batch=1)
    jobs.stream_alerts(trend, str(tmp_path / "out"), str(tmp_path / "c"))
    got = spark.read.parquet(str(tmp_path / "out" / "alerts"))
    assert got.count() == 13 and got.filter("date = '2026-05-04'").count() == 1


def test_open_trend_holds_every_event_and_the_latest_value(spark, tmp_path):
    folder, kinds = str(tmp_path / "in"), "kind string, ts timestamp, v double"
    at = lambda d, h: dt.datetime(2026, 5, d, h)
    parts = ([("a", at(1, 1), 1.0), ("a", at(2, 1), 2.0), ("b", at(2, 13), 3.0)],
             [("a", at(2, 2), 4.0), ("b", at(9, 1), 5.0)], [("b", at(9, 20), 6.0)])
    run = lambda: jobs.write_open_trend(jobs.stream_trend(
        jobs.stream_files(spark, folder, kinds, per_batch=1), "ts", "kind", "12 hours", score="v", start=True),
        str(tmp_path / "t"), str(tmp_path / "c"))
    for part in parts:
        spark.createDataFrame(part, kinds).coalesce(1).write.mode("append").parquet(folder)
        run()
    got = jobs.read_open_trend(spark, str(tmp_path / "t"), ["start", "kind"])
    want = spark.createDataFrame([r for part in parts for r in part], kinds).groupBy(
        F.window("ts", "12 hours").start.alias("start"), "kind").agg(F.count("v").alias("n"), F.sum("v").alias("s"))
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(got.select("start", "kind", "n_records", "score_sum")) == key(want) and got.count() == 5


def test_open_volume_counts_every_event(spark, sf):
    import __spark_entry__ as entry
    rows = entry.queries()["stream_volume_open"](spark, sf)
    assert rows.agg(F.sum("n_records")).first()[0] == spark.read.parquet(f"{sf}/events.parquet").count()
