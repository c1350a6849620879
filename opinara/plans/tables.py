"""The test tables in the roles of tweets and news, and the vocabularies they hit.

The texts of the test tables are invented words, so the queries over them use their
own small taxonomies and lexicon; the real ones ship in ``opinara.vocab``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from opinara.functions.sentiment import lexicon_score, score_columns
from opinara.functions.taxonomy import tag
from opinara.sources.readers import normalize_timestamps

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Ordered test taxonomies over fragments of the invented words.
TEST_BRANDS = {
    "alpha": ["tionin", "ingth"],
    "beta": ["eaueau", "ouonn"],
    "gamma": ["ungsch", "ichei"],
    "delta": ["ciónm", "adore"],
    "epsilon": ["heand"],
}
TEST_TOPICS = {
    "north": ["thatin"],
    "south": ["ononst", "inoran"],
    "east": ["hehely"],
    "west": ["orantion", "eaux"],
    "centre": ["schei", "mente"],
}
TEST_PRODUCTS = {
    "lamp": ["reti"],
    "kettle": ["whou", "quel"],
    "radio": ["ungen"],
    "clock": ["ción"],
}
TEST_POSITIVE = "the la der that this les".split()
TEST_NEGATIVE = "of de und was for des".split()
TEST_WEIGHTS = {"the": 1.5, "la": 0.5, "der": 0.5, "that": 1.5, "this": 2.0, "les": 0.5,
                "of": -1.0, "de": -0.5, "und": -0.5, "was": -2.0, "for": -1.0, "des": -0.5}
TEST_PHRASES = ["and the", "of the", "in the", "que la"]
PART_KINDS = {k: [k] for k in "widget bolt gear gizmo plate ring rod anvil".split()}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return normalize_timestamps(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def documents(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents")


def conversations(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "conversations")


def lineitem(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


def labelled(spark, sf_dir) -> DataFrame:
    """Documents with their labels, which only some have."""
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")


def _day(key: str):
    return F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col(key), F.lit(30)).cast("int"))


def raw_tweets(spark, sf_dir) -> DataFrame:
    """Documents as tweets: the source is the author, the length the likes."""
    return documents(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("tweet_id"), "text", "lang",
        F.col("source").alias("author_userName"), F.pmod("doc_id", F.lit(1000)).alias("author_followers"),
        F.col("n_chars").alias("likeCount"), F.pmod("doc_id", F.lit(7)).alias("replyCount"),
        F.pmod("doc_id", F.lit(11)).alias("retweetCount"), F.pmod("doc_id", F.lit(5)).alias("quoteCount"),
        (F.col("n_chars") + F.pmod("doc_id", F.lit(7)) + F.pmod("doc_id", F.lit(11))
         + F.pmod("doc_id", F.lit(5))).alias("total_engagement"),
        _day("doc_id").alias("date_day"))


def raw_news(spark, sf_dir) -> DataFrame:
    """Conversation turns as the comments of an article."""
    return conversations(spark, sf_dir).select(
        F.concat(F.lit("conv/"), F.col("conv_id").cast("string")).alias("newsLink"),
        F.col("text").alias("comment_text"), _day("conv_id").alias("date_day"))


def score(df: DataFrame, text: str) -> DataFrame:
    return score_columns(df, lexicon_score(text, TEST_POSITIVE, TEST_NEGATIVE))


def enriched(df: DataFrame, text: str) -> DataFrame:
    return score(tag(df, text, {"brand": TEST_BRANDS, "product": TEST_PRODUCTS,
                                "topic": TEST_TOPICS}), text)


def tweets(spark, sf_dir) -> DataFrame:
    return enriched(raw_tweets(spark, sf_dir), "text")


def news(spark, sf_dir) -> DataFrame:
    return enriched(raw_news(spark, sf_dir), "comment_text")


def comments(spark, sf_dir) -> DataFrame:
    """Both sources as ``(brand, text, sentiment, sentiment_score)``."""
    return tweets(spark, sf_dir).select("brand", "text", "sentiment", "sentiment_score").unionByName(
        news(spark, sf_dir).select("brand", F.col("comment_text").alias("text"), "sentiment",
                                   "sentiment_score"))


def scored_texts(spark, sf_dir) -> DataFrame:
    """Both sources as ``(source_type, event_date, text, topic, sentiment, score)``."""
    return tweets(spark, sf_dir).select(
        F.lit("tweets").alias("source_type"), F.col("date_day").alias("event_date"), "text", "topic",
        "sentiment", "sentiment_score",
    ).unionByName(news(spark, sf_dir).select(
        F.lit("news").alias("source_type"), F.col("date_day").alias("event_date"),
        F.col("comment_text").alias("text"), "topic", "sentiment", "sentiment_score"))


def unscored_texts(spark, sf_dir) -> DataFrame:
    return raw_tweets(spark, sf_dir).select(F.lit("tweets").alias("source_type"), "text").unionByName(
        raw_news(spark, sf_dir).select(F.lit("news").alias("source_type"),
                                       F.col("comment_text").alias("text")))


def branded_days(spark, sf_dir) -> DataFrame:
    """Both sources as dated, branded sentiment records."""
    cols = ["date_day", "brand", "sentiment", "sentiment_score"]
    return tweets(spark, sf_dir).select(*cols, F.lit("Twitter").alias("source")).unionByName(
        news(spark, sf_dir).select(*cols, F.lit("News").alias("source")))


def event_days(spark, sf_dir) -> DataFrame:
    """Events as dated sentiment records: the type is the brand, the value the score."""
    value = F.col("value")
    return table(spark, sf_dir, "events").select(
        F.col("ts").cast("date").alias("date_day"), F.col("event_type").alias("brand"),
        F.lit("events").alias("source"), value.alias("sentiment_score"),
        F.when(value >= 60, "positive").when(value <= 20, "negative").otherwise("neutral")
        .alias("sentiment"))


#: Forty numeric columns with nulls in different rows.
WIDE_COLUMNS = {f"x{j:02d}": f"CASE WHEN l_orderkey % {j + 3} <> 0 THEN (l_orderkey * {j + 1} + l_linenumber * 7 + CAST(floor(l_quantity) AS BIGINT)) % {11 + j} END"
                for j in range(40)}
