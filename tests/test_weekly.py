"""The whole week: landed JSON to Silver, Gold tables, story and long summaries."""

import json

import pytest
from pyspark.sql import functions as F

from opinara import vocab
from opinara.functions.dates import normalize_event_date, safe_date
from opinara.plans import weekly
from opinara.sources import readers, writers
from tests.fixtures import ARTICLES, POSTS, land, news_snapshot, tweets_snapshot


@pytest.fixture(scope="module")
def week(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("week")
    land(root / "bronze", "twitter_tweets_20260528_100000.json", tweets_snapshot("2026-05-28", POSTS))
    land(root / "bronze", "twitter_tweets_20260529_100000.json", tweets_snapshot("2026-05-29", POSTS[:2], "s2"))
    land(root / "bronze", "webscraping_noticias_20260528_100000.json", news_snapshot("2026-05-28", ARTICLES))
    land(root / "bronze", "webscraping_noticias_20260602_100000.json", news_snapshot("2026-06-02", {"https://n/9": ["late apple"]}))
    tweets = readers.silver_tweets(readers.read_snapshots(spark, f"{root}/bronze/twitter_*", "twitter"))
    news = readers.silver_news(readers.read_snapshots(spark, f"{root}/bronze/webscraping_*", "webscraping"))
    for name, rows, keys in (("tweets", tweets, ["id"]), ("news", news, ["newsLink"])):
        writers.upsert_weekly(rows.withColumn("event_date", safe_date("snapshot_date")), f"{root}/silver/{name}",
                              keys, ["snapshot_date"], date_col="event_date")
    return weekly.run_week(spark, f"{root}/silver", f"{root}/gold", 2026, 22), root


def test_governance_tables_have_their_columns(week):
    tables, _ = week
    assert set(vocab.GOVERNANCE_TWEETS_COLUMNS) <= set(tables["governance_tweets"].columns)
    assert set(vocab.GOVERNANCE_NEWS_COLUMNS) <= set(tables["governance_news"].columns)
    assert tables["governance_tweets"].count() == 4
    assert tables["governance_news"].count() == 5  # the later week is not there


def test_tags_and_experience(week):
    rows = {r.tweet_id: r for r in week[0]["governance_tweets"].collect()}
    assert (rows["1"].brand, rows["1"].product, rows["1"].topic) == ("apple", "iphone", "camera")
    assert rows["1"].experience_type == "personal_experience" and rows["2"].experience_type == "opinion"
    assert rows["2"].sentiment == "negative" and rows["2"].sentiment_score < 0
    assert rows["1"].total_engagement == 13 and rows["4"].brand is None


def test_brand_table(week):
    got = {r.brand: r for r in week[0]["brand_analytics"].collect()}
    assert (got["samsung"].mentions_twitter, got["samsung"].mentions_news) == (1, 2)
    assert got["samsung"].total_engagement == 7
    assert got["samsung"].negative_pct == 66.7  # rounded for display
    assert got["apple"].total_mentions == 2


def test_story(week):
    row = week[0]["storytelling"].first()
    assert row.top_brand == "samsung" and row.iso_week == 22
    assert {r["brand"] for r in json.loads(row.brand_sentiment_snapshot)} == {"apple", "google", "samsung"}


def test_governance_frames(week):
    tables, _ = week
    nulls = {(r.source, r.column): r.null_pct for r in tables["governance_nulls"].collect()}
    assert nulls["Twitter", "tweet_id"] == 0 and nulls["Twitter", "brand"] > 0 and ("News", "comment_text") in nulls
    volume = tables["governance_volume"].groupBy("source").agg(F.sum("n_records").alias("n")).collect()
    assert {r.source: r.n for r in volume} == {"Twitter": 4, "News": 5}
    assert {r.source: r.sample_size for r in tables["governance_lengths"].collect()} == {"Twitter": 4, "News": 5}
    assert "likeCount" in {r.metric for r in tables["governance_outliers"].collect()}


def test_kpis_and_alerts_exist(week):
    tables, _ = week
    status = {r.kpi: (r.value, r.status) for r in tables["governance_kpis"].collect()}
    assert status["total_records"] == (9.0, "INFO") and status["schema_compliance"][0] == 100.0
    assert tables["sentiment_alerts"].count() >= 0 and tables["daily_sentiment"].count() > 0
    assert tables["top_influencers"].orderBy(F.desc("engagement")).first().author_userName == "ann"


def test_second_run_changes_nothing(week, spark):
    tables, root = week
    before = {n: sorted(map(str, df.collect())) for n, df in tables.items()}
    again = weekly.run_week(spark, f"{root}/silver", f"{root}/gold", 2026, 22)
    assert {n: sorted(map(str, df.collect())) for n, df in again.items()} == before


def test_long_summaries(week, spark):
    _, root = week
    silver = {n: normalize_event_date(readers.read_silver(spark, f"{root}/silver/{n}").drop("event_date"))
              for n in ("tweets", "news")}
    news = silver["news"].withColumn("comments", F.to_json("comments"))
    governance, stories = weekly.run_long_summaries(silver["tweets"], news)
    rows = {(r.source_type, r.metric_name, r.metric_label): r for r in governance.filter("period is null").collect()}
    assert rows["tweets", "total_records", "total_records"].metric_value == 4.0
    assert rows["news", "duplicate_rows", "newsLink"].metric_pct == 0.0
    assert rows["news", "comment_count", "news_comments"].notes == "median=2, min=1, max=3"
    sections = {r.section for r in stories.select("section").distinct().collect()}
    assert sections == {"sentiment_distribution", "sentiment_trend", "source_comparison", "volume_trend",
                        "top_keywords", "keyword_sentiment", "top_bigrams", "topic_insights"}
