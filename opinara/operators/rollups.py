"""Sentiment roll-ups. Each is one hash aggregation with map-side combine."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from opinara import vocab
from opinara.functions.sentiment import LABELS
from opinara.functions.taxonomy import Taxonomy, keyword_hit, match_first
from opinara.functions.text import keyword_tokens, ngrams, remove_stop_words
from opinara.session import cut_lineage

#: Terms are first counted in so many groups by hash; terms of the greatest groups, so many, are counted first.
TERM_BUCKETS, FIRST_BUCKETS = 1 << 16, 1000


def _label_count(label: str) -> Column:
    return F.count_if(F.col("sentiment") == label)


def share_measures(n: Column, counts: Mapping[str, Column], total_score: Column) -> list[Column]:
    """Label percentages and mean score from sums; zero for an empty group."""
    def pct(count: Column) -> Column:
        return F.coalesce(F.try_divide(count.cast("double") * 100.0, n), F.lit(0.0))
    return [
        *[pct(counts[label]).alias(f"{label}_pct") for label in LABELS],
        F.coalesce(F.try_divide(total_score, n), F.lit(0.0)).alias("avg_score"),
    ]


def sentiment_measures() -> list[Column]:
    """Label percentages and mean score as aggregates over scored rows."""
    return share_measures(F.count(F.lit(1)), {x: _label_count(x) for x in LABELS},
                          F.sum("sentiment_score"))


def present(measures: DataFrame, pct_digits: int = 1, score_digits: int = 4) -> DataFrame:
    """Rounded for display, as the published tables are."""
    rounded = {c: F.round(c, pct_digits) for c in measures.columns if c.endswith("_pct")}
    if "avg_score" in measures.columns:
        rounded["avg_score"] = F.round("avg_score", score_digits)
    return measures.withColumns(rounded) if rounded else measures


def sentiment_pcts(df: DataFrame, by: list[str]) -> DataFrame:
    """Label percentages and mean score per group (or overall, also when empty)."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("mentions"), *sentiment_measures())


def brand_analytics(tweets: DataFrame, news: DataFrame) -> DataFrame:
    """Mentions per channel, engagement of the tweets and sentiment, per brand."""
    cols = ["brand", "sentiment", "sentiment_score"]
    rows = tweets.select(*cols, "total_engagement", F.lit("twitter").alias("source_type")).unionByName(
        news.select(*cols, F.lit(None).cast("bigint").alias("total_engagement"),
                    F.lit("news").alias("source_type")))
    return rows.filter(F.col("brand").isNotNull()).groupBy("brand").agg(
        F.count_if(F.col("source_type") == "twitter").alias("mentions_twitter"),
        F.count_if(F.col("source_type") == "news").alias("mentions_news"),
        F.count(F.lit(1)).alias("total_mentions"),
        F.coalesce(F.sum("total_engagement"), F.lit(0)).cast("bigint").alias("total_engagement"),
        *sentiment_measures(),
    )


def _both(tweets: DataFrame, news: DataFrame, cols: list[str]) -> DataFrame:
    return tweets.select(*cols).unionByName(news.select(*cols))


def topic_analytics(tweets: DataFrame, news: DataFrame) -> DataFrame:
    rows = _both(tweets, news, ["topic", "sentiment", "sentiment_score"])
    return sentiment_pcts(rows.filter(F.col("topic").isNotNull()), ["topic"])


def product_analytics(tweets: DataFrame, news: DataFrame | None = None) -> DataFrame:
    """Sentiment per product and its modal brand (the smallest among equals).

    Counted per (product, brand) first, so the mode needs no per-group buffer.
    """
    cols = ["product", "brand", "sentiment", "sentiment_score"]
    rows = _both(tweets, news, cols) if news is not None else tweets.select(*cols)
    pairs = rows.filter(F.col("product").isNotNull()).groupBy("product", "brand").agg(
        F.count(F.lit(1)).alias("n"), F.sum("sentiment_score").alias("score"),
        *[_label_count(x).alias(x) for x in LABELS])
    named = F.when(F.col("brand").isNotNull(), F.struct(-F.col("n"), F.col("brand")))
    return pairs.groupBy("product").agg(
        F.min_by("brand", named).alias("brand"),
        F.sum("n").alias("mentions"),
        *share_measures(F.sum("n"), {x: F.sum(x) for x in LABELS}, F.sum("score")))


def modal_label() -> Column:
    """Most frequent label of a group, the alphabetically first among equals."""
    neg, neu, pos = (_label_count(x) for x in ("negative", "neutral", "positive"))
    return (F.when((neg >= neu) & (neg >= pos), "negative")
            .when(neu >= pos, "neutral").otherwise("positive"))


def top_influencers(df: DataFrame, k: int = 20, author: str = "author_userName",
                    followers: str = "author_followers") -> DataFrame:
    """Authors with most engagement per brand; ties go by brand and author name."""
    rows = df.filter(F.col("brand").isNotNull() & F.col(author).isNotNull())
    number = lambda c: F.coalesce(F.col(c).try_cast("double"), F.lit(0.0))
    return (
        rows.groupBy("brand", author).agg(
            F.max(number(followers)).alias("followers"),
            F.sum(number("total_engagement")).alias("engagement"),
            F.count("tweet_id").alias("tweet_count"),
            modal_label().alias("sentiment"))
        .orderBy(F.col("engagement").desc(), "brand", author).limit(k)
    )


def representative_comments(rows: DataFrame, min_chars: int = 20, cut: int = 300) -> DataFrame:
    """Per brand the most strongly positive and negative text; equal strength goes by text.

    The greatest strength per brand and label is a hash aggregation over numbers; only the
    texts of that strength are compared, cut before: the smallest text has the smallest
    beginning.
    """
    quotes = rows.filter(F.col("brand").isNotNull() & (F.length("text") > min_chars)).select(
        "brand", "sentiment", F.abs("sentiment_score").alias("strength"), F.left("text", F.lit(cut)).alias("text"))
    charged = quotes.filter(F.col("sentiment").isin("positive", "negative"))
    most = charged.groupBy("brand", "sentiment").agg(F.max("strength").alias("strength"))
    best = charged.join(most, ["brand", "sentiment", "strength"]).groupBy("brand", "sentiment").agg(
        F.min("text").alias("text"))

    def quote(label: str) -> Column:
        return F.max(F.when(F.col("sentiment") == label, F.col("text")))

    chosen = best.groupBy("brand").agg(quote("positive").alias("best_comment"), quote("negative").alias("worst_comment"))
    return quotes.select("brand").distinct().join(chosen, "brand", "left")


def row_total(rows: DataFrame) -> Column:
    """Number of rows as a scalar. No column is read for it, nothing is computed."""
    return rows.agg(F.count(F.lit(1))).scalar()


def with_share(counts: DataFrame, count: str, total: Column, name: str = "share",
               scale: float = 100.0) -> DataFrame:
    """Share of a total that is known apart from the counts."""
    share = F.try_divide(F.col(count).cast("double") * scale, total)
    return counts.withColumn(name, F.coalesce(share, F.lit(0.0)))


def sentiment_distribution(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Records, share and mean score per label (within each period, if ``by`` names one)."""
    by = by or []
    counts = df.groupBy(*by, "sentiment").agg(
        F.count(F.lit(1)).alias("sentiment_count"), F.avg("sentiment_score").alias("avg_sentiment"))
    if not by:
        return with_share(counts, "sentiment_count", row_total(df), "sentiment_pct")
    # at most three labels per period
    total = F.sum("sentiment_count").over(Window.partitionBy(*by))
    return counts.withColumn(
        "sentiment_pct", F.col("sentiment_count").cast("double") * 100.0 / total)


def sentiment_trend(df: DataFrame, grain: str = "day", date_col: str = "event_date",
                    by: str = "source_type") -> DataFrame:
    """Mean score and volume per source and day or week."""
    start = F.date_trunc(grain, F.col(date_col)).cast("date")
    return df.groupBy(by, start.alias("period")).agg(
        F.avg("sentiment_score").alias("avg_sentiment"), F.count(F.lit(1)).alias("n_records"))


def source_comparison(df: DataFrame, by: str = "source_type", labels: bool = False) -> DataFrame:
    """Mean score and volume per source, optionally split by label."""
    keys = [by, "sentiment"] if labels else [by]
    return df.groupBy(*keys).agg(
        F.avg("sentiment_score").alias("avg_sentiment"), F.count(F.lit(1)).alias("n_records"))


def sized_terms(tokens: Column, sizes: tuple[int, ...], min_chars: int) -> Column:
    """The words and n-grams of a list of tokens as ``(size, term)``."""
    def sized(size: int) -> Column:
        terms = F.filter(tokens, lambda t: F.length(t) >= min_chars) if size == 1 else ngrams(tokens, size)
        return F.transform(terms, lambda t: F.struct(F.lit(size).alias("size"), t.alias("term")))

    groups = [sized(size) for size in sizes]
    return groups[0] if len(groups) == 1 else F.concat(*groups)


def term_rows(df: DataFrame, text: str = "text", by: str = "source_type",
              score: str | None = None, sizes: tuple[int, ...] = (1,),
              stop_words=vocab.STOP_WORDS, min_chars: int = 3) -> DataFrame:
    """Rows ``(source_type[, score], size, term)``, one for each time a text has the term."""
    tokens = remove_stop_words(keyword_tokens(text), stop_words, lowered=True)
    carried = [score] if score else []
    rows = df.filter(F.col(text).isNotNull()).select(
        F.col(by).alias("source_type"), *carried, tokens.alias("_tokens"))
    return rows.select("source_type", *carried, F.inline(sized_terms(F.col("_tokens"), sizes, min_chars)))


def term_counts(df: DataFrame, score: str | None = None, **terms) -> DataFrame:
    """Rows ``(source, size, term, mentions[, score_sum])``.

    Keywords and n-grams come from one pass over the texts. Only single words are
    held to ``min_chars``; n-grams are built before that filter.
    """
    sums = [F.sum(score).alias("score_sum")] if score else []
    return term_rows(df, score=score, **terms).groupBy("source_type", "size", "term").agg(
        F.count(F.lit(1)).alias("mentions"), *sums)


def term_bucket(source: Column | str, term: Column | str) -> Column:
    """The group by hash in which a term of a source is counted first."""
    return F.pmod(F.xxhash64(source, term), F.lit(TERM_BUCKETS)).cast("int")


def most_frequent(terms: DataFrame, buckets: DataFrame, k: int) -> DataFrame:
    """``source_type, term, mentions``: exact counts of the k most frequent terms, all those tied with them and some others.

    ``terms`` has a row for each time a term occurs, ``buckets`` the rows ``n`` of each ``term_bucket``. No term has more
    than its bucket, so buckets with less than the k-th greatest count are passed over: where few terms are
    frequent, the many rare ones are neither shuffled nor kept. That count is bounded from below by the terms of the
    greatest buckets; if there are others which may hold as frequent terms, those are counted as well.
    """
    n, mentions = F.col("n"), F.col("mentions")

    def counted(least: int) -> DataFrame:
        taken = F.broadcast(buckets.filter(n >= least).select("bucket"))  # 65,536 numbers at most
        return cut_lineage(terms.select("source_type", "term", term_bucket("source_type", "term").alias("bucket")).join(
            taken, "bucket").groupBy("source_type", "term").agg(F.count(F.lit(1)).alias("mentions")))

    def at_place(counts: DataFrame, by: Column, place: int) -> int:
        """The count at a place, 0 where there are fewer."""
        found = counts.select(by.alias("x")).orderBy(F.col("x").desc()).limit(place).agg(F.count("x").alias("n"), F.min("x").alias("x")).first()
        return found["x"] if found["n"] == place and place else 0

    first = at_place(buckets, n, FIRST_BUCKETS)
    counts = counted(first)
    least = at_place(counts, mentions, k)
    if least < first and not buckets.filter((n >= least) & (n < first)).isEmpty():
        counts = counted(least)
    return counts


def _top(counts: DataFrame, k: int, scope: str) -> DataFrame:
    order = [F.col("mentions").desc(), F.col("term"), F.col("source_type")]
    if scope == "global":
        return counts.orderBy(*order).limit(k)
    window = Window.partitionBy("source_type").orderBy(*order)
    return (counts.withColumn("_rn", F.row_number().over(window))
            .filter(F.col("_rn") <= k).drop("_rn"))


def top_keywords(df: DataFrame, k: int = 25, scope: str = "global", **terms) -> DataFrame:
    """Most frequent keywords, over all sources or within each."""
    return _top(term_counts(df, **terms), k, scope).select(
        "source_type", F.col("term").alias("keyword"), F.col("mentions").alias("keyword_count"))


def keyword_sentiment(df: DataFrame, k: int = 25, scope: str = "global", min_freq: int = 1,
                      score: str = "sentiment_score", **terms) -> DataFrame:
    """Mean score of the texts holding each frequent keyword, and its polarity."""
    counts = term_counts(df, score=score, **terms).filter(F.col("mentions") >= min_freq)
    mean = F.col("score_sum") / F.col("mentions")
    return _top(counts, k, scope).select(
        "source_type", F.col("term").alias("keyword"), mean.alias("avg_sentiment"), "mentions",
        F.when(mean > 0, "positive").when(mean < 0, "negative").otherwise("neutral")
        .alias("polarity"))


def top_bigrams(df: DataFrame, k: int = 25, scope: str = "global", **terms) -> DataFrame:
    """Most frequent pairs of words, over all sources or within each."""
    if scope == "global":
        rows = term_rows(df, sizes=(2,), **terms)
        buckets = cut_lineage(rows.groupBy(term_bucket("source_type", "term").alias("bucket")).agg(F.count(F.lit(1)).alias("n")))
        counts = most_frequent(rows, buckets, k)
    else:
        counts = term_counts(df, sizes=(2,), **terms)
    return _top(counts, k, scope).select(
        "source_type", F.col("term").alias("bigram"), F.col("mentions").alias("bigram_count"))


def topic_terms(df: DataFrame, k: int = 10, **terms) -> DataFrame:
    """Frequent keywords as a stand-in for topics."""
    return top_keywords(df, k, **terms).withColumnRenamed("keyword", "term")


def kpi_share(df: DataFrame) -> DataFrame:
    counts = df.groupBy("sentiment").agg(F.count(F.lit(1)).alias("n"))
    return with_share(counts, "n", row_total(df), "percentage", 1.0).select("sentiment", "percentage")


def kpi_score(df: DataFrame) -> DataFrame:
    """Mean and standard deviation of the score per label; one row has no deviation."""
    return df.groupBy("sentiment").agg(
        F.avg("sentiment_score").alias("mean"), F.stddev_samp("sentiment_score").alias("std"))


def topic_kpi(df: DataFrame) -> DataFrame:
    return df.filter(F.col("topic").isNotNull()).groupBy("topic").agg(
        F.avg("sentiment_score").alias("avg_score"), F.count(F.lit(1)).alias("count"))


def trend_kpi(df: DataFrame, date_col: str = "event_date") -> DataFrame:
    return df.groupBy(F.col(date_col).alias("date_only"), "sentiment").agg(
        F.count(F.lit(1)).alias("count"))


def mention_counts(df: DataFrame, text: str, taxonomy: Taxonomy) -> DataFrame:
    """Records naming each key (a record may count for several) and their share of all.

    All keys are counted in one pass, then turned into rows.
    """
    lowered = df.select(F.lower(F.coalesce(F.col(text), F.lit(""))).alias("_t"))
    totals = lowered.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(keyword_hit(F.col("_t"), kws)).alias(key) for key, kws in taxonomy.items()])
    long = totals.unpivot("_n", list(taxonomy), "key", "mentions")
    share = F.coalesce(F.try_divide(F.col("mentions").cast("double") * 100.0, F.col("_n")), F.lit(0.0))
    return long.select("key", "mentions", share.alias("share_pct"))


def reach_by_brand(df: DataFrame, text: str, taxonomy: Taxonomy, reach: str) -> DataFrame:
    """Mean reach of the records first-matched to each key."""
    tagged = df.select(match_first(text, taxonomy, default="other").alias("brand"), reach)
    return tagged.filter(F.col("brand") != "other").groupBy("brand").agg(
        F.avg(reach).alias("avg_reach"))


def daily_entity_summary(df: DataFrame, sums: list[str] | None = None,
                         date: str = "gold_event_date", entity: str = "gold_entity",
                         record: str = "gold_record_id", flag: str = "gold_has_text") -> DataFrame:
    """Distinct records, text coverage and engagement per day and entity."""
    return df.groupBy(date, entity).agg(
        F.count_distinct(record).alias("unique_records"),
        F.avg(F.when(F.col(flag), 1.0).otherwise(0.0)).alias("text_coverage_ratio"),
        *[F.sum(c).alias(f"total_{c}") for c in sums or []])


def topic_polarity(df: DataFrame) -> DataFrame:
    """Mentions of each topic in positive and in negative records."""
    return df.filter(F.col("topic").isNotNull()).groupBy("topic").agg(
        _label_count("positive").alias("positive_mentions"),
        _label_count("negative").alias("negative_mentions"),
        F.count(F.lit(1)).alias("mentions"))
