"""The weekly run: Silver tables to governance tables, roll-ups and the story row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from opinara import vocab
from opinara.functions.dates import safe_date
from opinara.functions.nested import explode_json_array, parse_comments
from opinara.functions.sentiment import lexicon_score, score_columns
from opinara.functions.taxonomy import experience_type, tag
from opinara.functions.text import clean_text
from opinara.operators import rollups, story
from opinara.operators.filters import filter_week
from opinara.operators.quality import (
    dashboard_metrics, governance_summary, kpi_bands, kpi_table, length_box, null_profile, outlier_rate, storytelling_summary,
)
from opinara.operators.shape import select_existing, total_engagement
from opinara.operators.trends import daily_sentiment, sentiment_alerts, volume_trend
from opinara.sources.readers import read_silver
from opinara.sources.writers import write_weekly

TAXONOMIES = {"brand": vocab.BRANDS, "product": vocab.PRODUCTS, "topic": vocab.TOPICS}


def default_scorer(text):
    return lexicon_score(text, vocab.POSITIVE_WORDS_BILINGUAL, vocab.NEGATIVE_WORDS_BILINGUAL)


def enrich(df: DataFrame, text: str, taxonomies=TAXONOMIES, scorer=default_scorer) -> DataFrame:
    """Tags and sentiment of every text, in one narrow stage."""
    return score_columns(tag(df, text, taxonomies), scorer(F.col(text)))


def _of_week(silver: DataFrame, year: int, week: int) -> DataFrame:
    """Rows of one ISO week, dated by their event date or else by their snapshot."""
    day = F.col("event_date").cast("date") if "event_date" in silver.columns \
        else safe_date("snapshot_date")
    return filter_week(silver.withColumn("date_day", day), "date_day", year, week)


def governance_tweets(silver: DataFrame, year: int, week: int, taxonomies=TAXONOMIES,
                      scorer=default_scorer, phrases=vocab.EXPERIENCE_PHRASES) -> DataFrame:
    """Enriched tweets of one ISO week."""
    text = "text_cleaned" if "text_cleaned" in silver.columns else "text"
    rows = _of_week(silver, year, week)
    parts = [c for c in vocab.ENGAGEMENT_PARTS if c in silver.columns]
    rows = rows.withColumns({
        "tweet_id": F.col("id"), "week": F.lit(week), "total_engagement": total_engagement(parts),
        "_text": F.col(text)})
    rows = rows.drop("text").withColumnRenamed("_text", "text")
    rows = enrich(rows, "text", taxonomies, scorer).withColumn(
        "experience_type", experience_type("text", phrases))
    return select_existing(rows, [*vocab.GOVERNANCE_TWEETS_COLUMNS, "sentiment_intensity"])


def governance_news(silver: DataFrame, year: int, week: int, taxonomies=TAXONOMIES,
                    scorer=default_scorer, clean: bool = True) -> DataFrame:
    """Enriched comments of one ISO week, one row per comment."""
    rows = _of_week(silver, year, week)
    keep = ["newsLink", "date_day"]
    if dict(silver.dtypes)["comments"] == "string":
        rows = explode_json_array(rows, "comments", "comment_text", keep)
    else:
        rows = rows.select(*keep, F.explode("comments").alias("comment_text"))
    if clean:
        rows = rows.withColumn("comment_text", clean_text("comment_text"))
    rows = enrich(rows.withColumn("week", F.lit(week)), "comment_text", taxonomies, scorer)
    return select_existing(rows, [*vocab.GOVERNANCE_NEWS_COLUMNS, "sentiment_intensity"])


def gold_tables(tweets: DataFrame, news: DataFrame) -> dict[str, DataFrame]:
    """The roll-ups as lazy frames over the two governance tables."""
    comments = tweets.select("brand", "text", "sentiment", "sentiment_score").unionByName(
        news.select("brand", F.col("comment_text").alias("text"), "sentiment", "sentiment_score"))
    brands = rollups.present(rollups.brand_analytics(tweets, news))
    topics = rollups.present(rollups.topic_analytics(tweets, news))
    products = rollups.present(rollups.product_analytics(tweets, news))
    quotes = rollups.representative_comments(comments)
    dated = tweets.select("date_day", "brand", "sentiment", "sentiment_score",
                          F.lit("Twitter").alias("source")).unionByName(
        news.select("date_day", "brand", "sentiment", "sentiment_score", F.lit("News").alias("source")))
    return {
        "brand_analytics": brands, "topic_analytics": topics, "product_analytics": products,
        "top_influencers": rollups.top_influencers(tweets),
        "representative_comments": quotes,
        "daily_sentiment": rollups.present(daily_sentiment(dated)),
        "governance_metrics": dashboard_metrics(tweets, news),
    }


def governance_frames(tweets: DataFrame, news: DataFrame) -> dict[str, DataFrame]:
    """Null shares per column, outliers, daily volume and text lengths behind the KPIs."""
    sources = [("Twitter", tweets, "text"), ("News", news, "comment_text")]
    nulls = [null_profile(df.drop("iso_year", "iso_week"), source=name) for name, df, _ in sources]
    rows = [df.select(F.lit(name).alias("source"), "date_day", F.length(text).alias("text_length")) for name, df, text in sources]
    both = rows[0].unionByName(rows[1])
    metrics = [c for c in vocab.DASHBOARD_OUTLIER_METRICS if c in tweets.columns]
    frames = {
        "governance_nulls": nulls[0].unionByName(nulls[1]),
        "governance_volume": volume_trend(both, "source", "date_day"),
        "governance_lengths": length_box(both, "source", "text_length"),
    }
    return frames | ({"governance_outliers": outlier_rate(tweets, metrics, "exact")} if metrics else {})


def reports(gold: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """What is told from the roll-ups."""
    return {
        "sentiment_alerts": sentiment_alerts(gold["daily_sentiment"]),
        "governance_kpis": kpi_table(gold["governance_metrics"]),
        "governance_bands": kpi_bands(gold["governance_metrics"]),
        "storytelling": story.story_row(gold["brand_analytics"], gold["topic_analytics"],
                                        gold["product_analytics"], gold["representative_comments"]),
    }


def run_week(spark: SparkSession, silver_root: str, gold_root: str, year: int, week: int,
             taxonomies=TAXONOMIES, scorer=default_scorer) -> dict[str, DataFrame]:
    """Build and write all artifacts of one week; returns the written tables.

    Only the week's partitions of Silver are read. The enriched rows are written first
    and read back, so texts are tagged and scored once however many roll-ups follow; the
    reports read the written roll-ups.
    """
    silver = {name: read_silver(spark, f"{silver_root}/{name}", [(year, week)])
              for name in ("tweets", "news")}
    enriched = {
        "governance_tweets": governance_tweets(silver["tweets"], year, week, taxonomies, scorer),
        "governance_news": governance_news(silver["news"], year, week, taxonomies, scorer),
    }

    def store(name: str, df: DataFrame) -> DataFrame:
        write_weekly(df, f"{gold_root}/{name}", (year, week))
        return read_silver(spark, f"{gold_root}/{name}", [(year, week)])

    written = {name: store(name, df) for name, df in enriched.items()}
    for frames in (gold_tables, governance_frames):
        for name, df in frames(written["governance_tweets"], written["governance_news"]).items():
            written[name] = store(name, df)
    for name, df in reports(written).items():
        written[name] = store(name, df)
    return written


def run_long_summaries(tweets: DataFrame, news: DataFrame, scorer=default_scorer
                       ) -> tuple[DataFrame, DataFrame]:
    """Long governance and storytelling tables from Silver tables with ``event_date``."""
    texts = tweets.select(F.lit("tweets").alias("source_type"), "event_date", "text").unionByName(
        news.select(F.lit("news").alias("source_type"), "event_date",
                    F.explode_outer(parse_comments("comments")).alias("text")))
    texts = texts.filter(F.trim("text") != "")
    scored = score_columns(texts, scorer(F.col("text")), inclusive=False)
    return governance_summary(tweets, news), storytelling_summary(scored)
