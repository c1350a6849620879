"""The weekly story: mood, narratives, rankings, one story row, drill-downs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from opinara import vocab
from opinara.functions.nested import records_json
from opinara.functions.text import capitalize, fill, quote

MOODS = ("Positive", "Neutral", "Negative")


def _volume(mentions: str, mood: str) -> Column:
    return F.col(mentions) * F.col(f"{mood.lower()}_pct") / 100.0


def mood(brands: DataFrame, brand: str = "all", mentions: str = "total_mentions") -> DataFrame:
    """Sentiment volumes weighted by mentions, and the label that strictly leads."""
    rows = brands if brand == "all" else brands.filter(F.col("brand") == brand)
    totals = rows.agg(*[F.coalesce(F.sum(_volume(mentions, m)), F.lit(0.0)).alias(m.lower())
                        for m in MOODS])
    pos, neu, neg = F.col("positive"), F.col("neutral"), F.col("negative")
    return totals.withColumn(
        "dominant", F.when((pos > neg) & (pos > neu), "Positive")
        .when((neg > pos) & (neg > neu), "Negative").otherwise("Neutral"))


def sentiment_long(df: DataFrame, key: str, mentions: str = "total_mentions",
                   k: int | None = None) -> DataFrame:
    """Sentiment volumes as rows ``(key, sentiment, mentions)``, of the top ``k`` keys."""
    rows = df if k is None else df.orderBy(F.col(mentions).desc(), key).limit(k)
    wide = rows.select(key, *[_volume(mentions, m).alias(m) for m in MOODS])
    return wide.unpivot(key, list(MOODS), "sentiment", "mentions")


def channel_breakdown(brands: DataFrame, brand: str) -> DataFrame:
    """Mentions of one brand per channel."""
    return (brands.filter(F.col("brand") == brand)
            .unpivot("brand", ["mentions_twitter", "mentions_news"], "channel", "mentions"))


def topic_drilldown(rows: DataFrame, brand: str, k: int = 12) -> DataFrame:
    """Topics within one brand by mentions."""
    chosen = rows.filter((F.col("brand") == brand) & F.col("topic").isNotNull())
    return (chosen.groupBy("topic")
            .agg(F.count(F.lit(1)).alias("mentions"), F.avg("sentiment_score").alias("avg_score"))
            .orderBy(F.col("mentions").desc(), "topic").limit(k))


def engagement_points(df: DataFrame, fraction: float | None = None, seed: int = 7) -> DataFrame:
    """Engagement against sentiment, one point per record; ``fraction`` samples for display."""
    points = df.select(
        "tweet_id", "brand", "topic", "sentiment", "sentiment_score",
        F.coalesce(F.col("total_engagement").cast("double"), F.lit(0.0)).alias("total_engagement"),
        F.coalesce(F.col("author_followers").try_cast("double"), F.lit(0.0)).alias("followers"))
    return points if fraction is None else points.sample(fraction, seed)


def _signed(score: Column) -> Column:
    return F.concat(F.when(score >= 0, "+").otherwise(""), F.format_string("%.4f", score))


def brand_narrative(brands: DataFrame) -> DataFrame:
    """One paragraph per brand."""
    score = F.col("avg_score")
    tone = (F.when(score > 0.05, "mostly positive").when(score < -0.05, "mostly critical")
            .otherwise("mostly neutral"))
    pct = lambda c: F.format_string("%.1f", F.round(c, 1))
    return brands.select("brand", fill(
        vocab.BRAND_NARRATIVE, brand=capitalize("brand"), tone=tone,
        mentions=F.format_number("total_mentions", 0), score=_signed(F.round(score, 4)),
        positive=pct("positive_pct"), negative=pct("negative_pct")).alias("narrative"))


def alert_sentences(alerts: DataFrame) -> DataFrame:
    """One line of text per alert."""
    pct = lambda c: F.format_string("%.1f", F.col(c))
    said = {name: fill(template, severity=F.upper("severity"), brand=capitalize("brand"),
                       previous=pct("prev_pct"), current=pct("curr_pct"), delta=pct("delta"))
            for name, template in (("spike", vocab.SPIKE_SENTENCE), ("recovery", vocab.RECOVERY_SENTENCE))}
    return alerts.withColumn("sentence", F.when(
        F.col("type") == "negative_spike", said["spike"]).otherwise(said["recovery"]))


def comment_quotes(comments: DataFrame, n: int = 260) -> DataFrame:
    """Quotable best and worst comment of each brand; brands with neither are left out."""
    return comments.select(
        capitalize("brand").alias("brand"), quote("best_comment", n).alias("best_quote"),
        quote("worst_comment", n).alias("worst_quote"),
    ).filter(F.col("best_quote").isNotNull() | F.col("worst_quote").isNotNull())


def _leader(df: DataFrame, key: str, measure: str) -> Column:
    """Key with the largest measure, the first by name among equals."""
    return F.min_by(key, F.struct(-F.col(measure), F.col(key)))


def _top_list(df: DataFrame, key: str, measure: str, k: int, name: str) -> DataFrame:
    top = df.orderBy(F.col(measure).desc(), key).limit(k)
    ranked = F.sort_array(F.collect_list(F.struct((-F.col(measure)).alias("o"), F.col(key).alias("v"))))
    return top.agg(F.to_json(F.transform(ranked, lambda r: r["v"])).alias(name))


def story_row(brands: DataFrame, topics: DataFrame, products: DataFrame,
              comments: DataFrame) -> DataFrame:
    """One row that sums up the week. Lists are JSON strings.

    The inputs are roll-ups with one row per taxonomy key, so every part is a
    scalar over a small frame.
    """
    lead = brands.agg(
        _leader(brands, "brand", "total_mentions").alias("top_brand"),
        F.max("total_mentions").alias("top_mentions"),
        _leader(brands, "brand", "positive_pct").alias("best_brand"),
        _leader(brands, "brand", "negative_pct").alias("worst_brand"))
    summary = fill(vocab.EXECUTIVE_SUMMARY, brand=capitalize("top_brand"),
                   mentions=F.col("top_mentions").cast("string"))
    snapshot = records_json(
        brands, ["brand", "total_mentions", "positive_pct", "negative_pct", "neutral_pct", "avg_score"],
        [-F.col("total_mentions"), F.col("brand")], "v")
    quotes = records_json(comments.filter(F.col("brand").isNotNull()),
                          ["brand", "best_comment", "worst_comment"], [F.col("brand")], "v")
    return lead.select(
        summary.alias("executive_summary"), "top_brand", "best_brand", "worst_brand",
        snapshot.scalar().alias("brand_sentiment_snapshot"),
        _top_list(topics, "topic", "positive_pct", 3, "v").scalar().alias("top_positive_topics"),
        _top_list(topics, "topic", "negative_pct", 3, "v").scalar().alias("top_negative_topics"),
        _top_list(products, "product", "mentions", 5, "v").scalar().alias("top_products"),
        quotes.scalar().alias("representative_comments"))
