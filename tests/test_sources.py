import datetime as dt

import pytest
from pyspark.sql import functions as F

from opinara import schemas
from opinara.functions.dates import safe_date, with_iso_week
from opinara.functions.nested import expand_entities
from opinara.operators.filters import split_entities
from opinara.sources import readers, writers
from tests.fixtures import ARTICLES, POSTS, land, news_snapshot, tweets_snapshot


@pytest.fixture
def bronze(tmp_path):
    root = tmp_path / "bronze"
    land(root, "twitter_tweets_20260528_100000.json", tweets_snapshot("2026-05-28", POSTS))
    land(root, "twitter_tweets_20260529_100000.json", tweets_snapshot("2026-05-29", POSTS[:2], "s2"))
    land(root, "webscraping_noticias_20260528_100000.json", [news_snapshot("2026-05-28", ARTICLES)])
    return root


def test_read_object_or_list(spark, bronze):
    tweets = readers.read_snapshots(spark, f"{bronze}/twitter_*.json", "twitter")
    news = readers.read_snapshots(spark, f"{bronze}/webscraping_*.json", "webscraping")
    assert (tweets.count(), news.count()) == (2, 1)
    assert news.select(F.size("news")).first()[0] == 2


def test_latest_by_name(spark, bronze):
    assert readers.latest_by_name(spark, str(bronze), "twitter").endswith("20260529_100000.json")
    with pytest.raises(FileNotFoundError):
        readers.latest_by_name(spark, str(bronze), "absent")


def test_latest_document(spark, bronze):
    docs = readers.read_snapshots(spark, f"{bronze}/twitter_*.json", "twitter")
    assert [r._id for r in readers.latest_by(docs, "createdAt").select("_id").collect()] == ["s2"]


def test_silver_tweets_are_flat_and_clean(spark, bronze):
    rows = readers.silver_tweets(readers.read_snapshots(spark, f"{bronze}/twitter_*20260528*.json", "twitter"))
    row = rows.filter("id = '1'").first()
    assert row.author_userName == "ann" and row.snapshot_date == "1779926400000"
    assert row.text_cleaned == "I got the iPhone, great camera 😎"
    assert row.text_length == len(row.text_cleaned)
    assert dict(rows.dtypes)["id"] == "string" and dict(rows.dtypes)["likeCount"] == "bigint"


def test_silver_news_keeps_comments_as_an_array(spark, bronze):
    rows = readers.silver_news(readers.read_snapshots(spark, f"{bronze}/webscraping_*.json", "webscraping"))
    assert dict(rows.dtypes)["comments"] == "array<string>"
    assert {r.snapshot_id for r in rows.collect()} == {"n1"}


def test_expand_entities_of_landed_files(spark, bronze):
    tweets = readers.read_snapshots(spark, f"{bronze}/twitter_*20260528*.json", "twitter")
    news = readers.read_snapshots(spark, f"{bronze}/webscraping_*.json", "webscraping")
    rows = expand_entities(tweets.unionByName(news, allowMissingColumns=True))
    counts = {r.record_type: r["count"] for r in rows.groupBy("record_type").count().collect()}
    assert counts == {"tweet": 4, "news": 2, "news_comment": 5}
    assert "tweet_author_userName" in rows.columns and "news_newsLink" in rows.columns


def test_weekly_write_replaces_only_its_week(spark, tmp_path):
    path = str(tmp_path / "gold" / "t")
    writers.write_weekly(spark.createDataFrame([(1,)], "v int"), path, (2026, 21))
    writers.write_weekly(spark.createDataFrame([(2,)], "v int"), path, (2026, 22))
    writers.write_weekly(spark.createDataFrame([(3,)], "v int"), path, (2026, 22))
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 3]
    assert [r.v for r in readers.read_silver(spark, path, [(2026, 21)]).collect()] == [1]
    plan = readers.read_silver(spark, path, [(2026, 21)])._jdf.queryExecution().executedPlan().toString()
    pruned = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "iso_year" in pruned and "iso_week" in pruned and "= 2026" in pruned


def test_an_empty_week_replaces_a_full_one(spark, tmp_path):
    path = str(tmp_path / "t")
    full = spark.createDataFrame([(1,)], "v int")
    writers.write_weekly(full, path, (2026, 22))
    writers.write_weekly(full.filter("v > 1"), path, (2026, 22))
    assert readers.read_silver(spark, path, [(2026, 22)]).count() == 0


def test_latest_artifact_is_by_year_then_week(spark, tmp_path):
    for year, week in ((2025, 52), (2026, 2)):
        writers.write_weekly(spark.createDataFrame([(week,)], "v int"), str(tmp_path / "a"), (year, week))
    assert [r.v for r in readers.read_latest_artifact(spark, str(tmp_path), "a").collect()] == [2]


def test_upsert_weekly_is_idempotent(spark, tmp_path, bronze):
    path = str(tmp_path / "silver" / "tweets")
    def batch(pattern):
        rows = readers.silver_tweets(readers.read_snapshots(spark, f"{bronze}/{pattern}", "twitter"))
        return rows.withColumn("event_date", safe_date("snapshot_date"))
    for pattern in ("twitter_*20260528*", "twitter_*20260529*", "twitter_*20260529*"):
        writers.upsert_weekly(batch(pattern), path, ["id"], ["snapshot_date"], date_col="event_date")
    got = {r.id: r.snapshot_date for r in spark.read.parquet(path).collect()}
    assert got == {"1": "1780012800000", "2": "1780012800000", "3": "1779926400000", "4": "1779926400000"}


def test_upsert_leaves_other_weeks_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = lambda *data: spark.createDataFrame(data, "id string, day date, v int")
    writers.upsert_weekly(rows(("a", dt.date(2026, 5, 28), 1), ("b", dt.date(2026, 6, 2), 1)), path, ["id"], ["v"], "day")
    writers.upsert_weekly(rows(("a", dt.date(2026, 5, 28), 2)), path, ["id"], ["v"], "day")
    assert {(r.id, r.v) for r in spark.read.parquet(path).collect()} == {("a", 2), ("b", 1)}


def test_merged_read_unites_families(spark, tmp_path):
    root = tmp_path / "silver"
    spark.createDataFrame([("1", "hi", "7", "x")], "id string, text string, likeCount string, junk string") \
        .write.parquet(f"{root}/a/tweets_processed_2026_W21.parquet")
    spark.createDataFrame([("2", 5)], "id string, viewCount int").write.parquet(
        f"{root}/a/tweets_processed_2026_W22.parquet")
    # files must carry the family in their own name, as single-file writers do
    for i, part in enumerate(sorted(root.rglob("part-*.parquet"))):
        (root / f"tweets_processed_{i}.parquet").write_bytes(part.read_bytes())
    spark.createDataFrame([("n/1", ["a", "b"])], "newsLink string, comments array<string>").coalesce(1) \
        .write.parquet(f"{tmp_path}/n")
    part = next((tmp_path / "n").glob("part-*.parquet"))
    (root / "noticias_processed_0.parquet").write_bytes(part.read_bytes())
    rows = readers.read_silver_merged(spark, str(root))
    assert "junk" not in rows.columns and dict(rows.dtypes)["likeCount"] == "bigint"
    tweets, news = split_entities(rows)
    assert {r.id: (r.likeCount, r.viewCount) for r in tweets.collect()} == {"1": (7, None), "2": (None, 5)}
    assert [(r.newsLink, r.comments, r.source_type) for r in news.collect()] == [("n/1", '["a","b"]', "news")]
    with pytest.raises(FileNotFoundError):
        readers.read_silver_merged(spark, str(tmp_path / "n" / "none"))


def test_read_validation_totals(spark, sf):
    frames = [readers.with_lineage(spark.read.parquet(f"{sf}/{n}.parquet")).select("source_file", "source_group")
              for n in ("documents", "conversations")]
    got = readers.validate_read(frames[0].union(frames[1])).collect()
    assert sum(r.rows_read for r in got) == got[0].rows_total


def test_families(spark):
    df = spark.createDataFrame([("tweets_x.parquet",), ("noticias_y.parquet",), ("z",)], "f string")
    assert [r[0] for r in df.select(readers.file_family(F.col("f"))).collect()] == ["tweets", "news", "unknown"]


def test_snapshot_encodings(spark, tmp_path):
    df = spark.sql("select '6a22' _id, X'0AFF' raw, date'2026-05-28' d, timestamp'2026-05-28 01:02:03' t, "
                   "cast(null as string) n")
    path = writers.write_snapshot(df, str(tmp_path), "twitter", "tweets", dt.datetime(2026, 5, 28, 1, 2, 3))
    assert path.endswith("/twitter_tweets_20260528_010203.json")
    row = spark.read.json(path).first()
    assert (row._id, row.raw, row.d, row.t) == ("6a22", "0aff", "2026-05-28", "2026-05-28T01:02:03.000000")
    assert "n" in spark.read.text(path).first()[0]


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 'say "hi"\nthere, you', ["x"])], "id string, t string, l array<string>")
    writers.write_csv(df, str(tmp_path / "c"))
    row = readers.read_csv(spark, str(tmp_path / "c"), "id string, t string, l string").first()
    assert tuple(row) == ("a", 'say "hi"\nthere, you', '["x"]')


def test_timestamps_without_zone_become_instants(spark, sf):
    raw = spark.read.parquet(f"{sf}/events.parquet")
    assert dict(raw.dtypes)["ts"] == "timestamp_ntz"
    assert dict(readers.normalize_timestamps(raw).dtypes)["ts"] == "timestamp"


def test_schemas_keep_ids_as_text():
    assert schemas.TWEET["id"].dataType.simpleString() == "string"


def test_stamp(spark):
    df = with_iso_week(spark.sql("select date'2026-05-28' d"), "d").first()
    assert (df.iso_year, df.iso_week) == (2026, 22)


def test_upsert_keeps_undated_rows_of_earlier_batches(spark, tmp_path):
    from opinara.sources.writers import upsert_weekly
    path, kinds = str(tmp_path / "weekly"), "id string, v int, day date"
    for batch in ([("a", 1, None)], [("c", 2, None)], [("a", 3, None), ("d", 4, dt.date(2026, 5, 28))], [("e", 5, dt.date(2026, 5, 29))]):
        upsert_weekly(spark.createDataFrame(batch, kinds), path, ["id"], ["v"], date_col="day")
    got = {(r.id, r.v, r.iso_week) for r in spark.read.parquet(path).collect()}
    assert got == {("a", 3, None), ("c", 2, None), ("d", 4, 22), ("e", 5, 22)}


def test_latest_by_name_finds_files_and_folders(spark, tmp_path):
    (tmp_path / "twitter_a_20260101.json").write_text("{}")
    spark.range(1).write.json(str(tmp_path / "twitter_a_20260102.json"))
    (tmp_path / "webscraping_20270101.json").write_text("{}")
    assert readers.latest_by_name(spark, str(tmp_path), "twitter").endswith("twitter_a_20260102.json")
    with pytest.raises(FileNotFoundError):
        readers.latest_by_name(spark, str(tmp_path), "absent")


@pytest.mark.parametrize("scheme", ["file://", ""])
def test_scratch_is_cleared(spark, tmp_path, monkeypatch, scheme):
    import os
    from opinara import session
    monkeypatch.setattr(session, "shared_dir", lambda _: f"{scheme}{tmp_path}/shared")
    session.cut_lineage(spark.range(3))
    assert os.listdir(tmp_path / "shared" / "opinara")
    session.clear_scratch(spark)
    session.clear_scratch(spark)  # nothing left to clear
    assert not os.listdir(tmp_path / "shared" / "opinara")


def jobs_of(spark, name, run):
    spark.sparkContext.setJobGroup(name, name)
    try:
        result = run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name)), result


def test_quality_is_measured_by_the_job_that_writes(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1, "a", 2026, 1), (2, " ", 2026, 1), (3, None, 2026, 2), (None, "d", None, None)],
        "id long, `a.b` string, iso_year int, iso_week int")
    plain, _ = jobs_of(spark, "plain", lambda: writers.write_weekly(rows, f"{tmp_path}/plain"))
    watched, got = jobs_of(spark, "watched", lambda: writers.write_weekly_observed(
        rows, f"{tmp_path}/watched", ["a.b", "id"], ["id"]))
    assert watched == plain
    assert [tuple(r) for r in got.collect()] == [
        ("null_rate", "a.b", 2, 50.0, 4), ("null_rate", "id", 1, 25.0, 4), ("row_compliance", None, 3, 75.0, 4)]
    assert readers.read_silver(spark, f"{tmp_path}/watched").count() == 4
    one = writers.write_weekly_observed(rows.limit(0), f"{tmp_path}/watched", ["id"], ["id"], week=(2026, 1))
    assert [tuple(r) for r in one.collect()] == [("null_rate", "id", 0, 0.0, 0), ("row_compliance", None, 0, 0.0, 0)]
    assert readers.read_silver(spark, f"{tmp_path}/watched").count() == 2


def test_merges_leave_no_copies_behind(spark, tmp_path, monkeypatch):
    import os
    from opinara import session
    monkeypatch.setattr(session, "shared_dir", lambda _: f"{tmp_path}/shared")
    left = lambda: [f for _, _, files in os.walk(tmp_path / "shared") for f in files]
    path, kinds = str(tmp_path / "weekly"), "id string, v int, day date"
    for v in range(3):
        writers.upsert_weekly(spark.createDataFrame([("a", v, None), (f"b{v}", v, dt.date(2026, 5, 28))], kinds), path, ["id"], ["v"], "day")
        assert left() == []
    assert {(r.id, r.v) for r in spark.read.parquet(path).collect()} == {("a", 2), ("b0", 0), ("b1", 1), ("b2", 2)}
    with pytest.raises(ZeroDivisionError), session.staged(spark.range(3)):
        1 / 0
    assert left() != []  # weeks that may be half replaced can be had from the copy


def test_snapshots_land_compressed(spark, tmp_path):
    import os
    text = spark.range(200).select(F.col("id").cast("string").alias("_id"), F.repeat(F.lit("the same words "), 50).alias("t"))
    path = writers.write_snapshot(text, str(tmp_path), "twitter", "tweets")
    assert sum(os.path.getsize(f"{path}/{f}") for f in os.listdir(path)) < 200 * 750 / 5
    assert spark.read.json(path).count() == 200
