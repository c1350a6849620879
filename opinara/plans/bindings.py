"""One query per operator over the test tables.

Doubles are rounded to six digits and whole numbers widened to bigint, so that
results compare across engines whatever the order of summation.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from opinara import vocab
from opinara.functions import dates, nested, sentiment, taxonomy, text
from opinara.operators import (
    filters, identity, keyword_tables, partials, profile, quality, rollups, shape, story, trends,
)
from opinara.plans import tables as t, weekly
from opinara.session import cut_lineage, scratch_path
from opinara.sources import readers
from opinara.sources.writers import upsert_weekly, write_csv, write_snapshot, write_weekly, write_weekly_observed
from opinara.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def comparable(df: DataFrame, digits: int = 6) -> DataFrame:
    kinds = {"double": lambda c: F.round(c, digits),
             "float": lambda c: F.round(F.col(c).cast("double"), digits),
             "int": lambda c: F.col(c).cast("bigint"), "smallint": lambda c: F.col(c).cast("bigint")}
    changed = {c: kinds[k](c) for c, k in df.dtypes if k in kinds}
    return df.withColumns(changed) if changed else df


def query(name: str, digits: int = 6):
    def register(make: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: comparable(make(spark, sf_dir), digits)
        return make
    return register


# ---- scans, lineage, unions -------------------------------------------------

@query("latest_snapshot")
def _(spark, sf):
    rows = t.table(spark, sf, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return readers.latest_by(rows, "ts", ["user_id"], tie="event_id").drop("ts")


@query("latest_doc")
def _(spark, sf):
    rows = t.table(spark, sf, "documents").select("doc_id", "source", "n_chars")
    return readers.latest_by(rows, "n_chars", tie="doc_id")


@query("latest_doc_per_source")
def _(spark, sf):
    rows = t.table(spark, sf, "documents").select("source", "doc_id", "n_chars")
    return readers.latest_by(rows, "n_chars", ["source"], tie="doc_id")


@query("union_sources")
def _(spark, sf):
    return identity.union_sources({
        "documents": t.table(spark, sf, "documents").select(
            F.col("doc_id").cast("string").alias("record_id"), text.text_length("text").alias("chars"),
            "lang"),
        "conversations": t.table(spark, sf, "conversations").select(
            F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("record_id"),
            text.text_length("text").alias("chars"), "role"),
    })


@query("source_family")
def _(spark, sf):
    families = {"english": ["/en/"], "french": ["/fr/"], "german": ["/de/"], "spanish": ["/es/"]}
    return t.table(spark, sf, "pages").select(
        "page_id", readers.file_family(F.col("url"), families).alias("family"))


@query("rows_per_file")
def _(spark, sf):
    files = [readers.with_lineage(spark.read.parquet(f"{sf}/{name}.parquet")).select(
        "source_file", "source_group", *cols) for name, cols in
        {"documents": ["lang"], "conversations": ["role"]}.items()]
    merged = files[0].unionByName(files[1], allowMissingColumns=True)
    return profile.rows_per_file(merged, ["lang", "role"])


@query("validate_read")
def _(spark, sf):
    files = [readers.with_lineage(spark.read.parquet(f"{sf}/{name}.parquet")).select("source_file")
             for name in ("documents", "conversations", "pages")]
    return readers.validate_read(files[0].union(files[1]).union(files[2]))


@query("dataset_sizes")
def _(spark, sf):
    return profile.inventory({name: t.table(spark, sf, name) for name in t.TABLES})


# ---- projection and nested data --------------------------------------------

def _nested_events(spark, sf):
    return t.table(spark, sf, "events").select("event_id", F.struct(
        F.col("event_type").alias("type"),
        F.struct(F.col("value").alias("amount"),
                 F.from_json("props", "k bigint").alias("props")).alias("detail")).alias("event"))


@query("flatten_struct")
def _(spark, sf):
    return nested.flatten(_nested_events(spark, sf))


@query("nested_to_json")
def _(spark, sf):
    return nested.nested_to_json(t.table(spark, sf, "conversations").select(
        "conv_id", "turn", F.struct("role", F.when(F.col("turn") > 0, F.col("turn")).alias("later"))
        .alias("meta"), F.split("text", "\n").alias("lines")))


def _lines(df: DataFrame, *keep: str | Column) -> DataFrame:
    return df.select(*keep, F.split("text", "\n").alias("lines"))


@query("explode_children")
def _(spark, sf):
    parents = t.documents(spark, sf).select("doc_id", "lang", F.transform(
        F.split("text", "\n"), lambda line, i: F.struct(
            i.cast("bigint").alias("line_no"), F.length(line).alias("line_chars"))).alias("lines"))
    return nested.explode_children(parents, "lines", {"doc_id": "snapshot_id", "lang": "snapshot_lang"})


@query("expand_entities")
def _(spark, sf):
    posts = t.documents(spark, sf).select(
        F.col("doc_id").alias("snapshot"), F.array(F.struct(
            F.col("doc_id").cast("string").alias("id"), F.col("text").alias("text"))).alias("tweets"))
    articles = t.conversations(spark, sf).select(
        F.col("conv_id").alias("snapshot"), F.array(F.struct(
            F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("newsLink"),
            F.split("text", "\n").alias("comments"))).alias("news"))
    # snapshots that hold neither list, or an empty one
    bare = t.table(spark, sf, "labels").select(
        F.col("doc_id").alias("snapshot"), F.when(F.col("quality") == 1, F.array().cast(
            dict(posts.dtypes)["tweets"])).alias("tweets"))
    rows = nested.expand_entities(posts.unionByName(articles, allowMissingColumns=True).unionByName(
        bare, allowMissingColumns=True))
    return rows.select("record_type", "snapshot", "tweet_id", "news_newsLink", "tweet_text", "comment_text")


@query("coerce_lenient")
def _(spark, sf):
    rows = t.table(spark, sf, "documents").select(
        "doc_id", F.col("source").alias("whole"), F.substring("source", 4, 10).alias("suffix"),
        F.concat(F.substring("source", 4, 10), F.lit(".5")).alias("ratio"),
        F.when(F.col("lang") == "en", "true").otherwise(F.col("lang")).alias("flag"))
    return shape.coerce(rows, {"whole": "bigint", "suffix": "bigint", "ratio": "double", "flag": "boolean"})


@query("canonicalise")
def _(spark, sf):
    rows = shape.canonicalise(t.table(spark, sf, "documents"), {
        "tweet_id": ["id", "doc_id"], "gold_text": ["raw_text", "text"], "detected_lang": ["lang"]})
    return shape.select_existing(rows, ["tweet_id", "missing", "detected_lang", "n_chars"])


@query("first_available")
def _(spark, sf):
    return t.labelled(spark, sf).select(
        "doc_id", shape.first_available("quality", "toxic", F.lit(-1)).alias("label"),
        text.first_text(F.when(F.col("quality").isNull(), "  ").otherwise(F.col("lang")), "source")
        .alias("name"))


@query("row_completeness")
def _(spark, sf):
    return shape.completeness(t.labelled(spark, sf)).select("doc_id", "completeness")


@query("engagement_total")
def _(spark, sf):
    parts = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return t.table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.sum(shape.total_engagement(parts)).alias("total_engagement"),
        F.max(shape.total_engagement(parts, null_as_zero=False)).alias("max_engagement"))


@query("to_text")
def _(spark, sf):
    return t.table(spark, sf, "conversations").select(
        "conv_id", "turn", text.to_text(F.split("text", "\n"), is_array=True).alias("joined"),
        text.to_text("turn").alias("turn_text"))


def _mixed_records(spark, sf):
    posts = t.documents(spark, sf).select(
        F.col("doc_id").cast("string").alias("tweet_id"), F.lit("tweet").alias("record_type"),
        F.col("text").alias("tweet_text"), text.clean_text("text", "eda").alias("clean_text"),
        t._day("doc_id").cast("string").alias("createdAt"), F.col("n_chars").alias("tweet_likeCount"))
    replies = t.conversations(spark, sf).select(
        F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("news__id"),
        F.lit("news_comment").alias("record_type"), F.col("text").alias("comment_text"),
        t._day("conv_id").cast("string").alias("event_date"))
    pages = t.table(spark, sf, "pages").select(
        F.col("url").alias("_id"), F.lit(None).cast("string").alias("record_type"),
        F.col("html").alias("raw_text"))
    merged = posts.unionByName(replies, allowMissingColumns=True).unionByName(
        pages, allowMissingColumns=True)
    return shape.multimodal_records(
        merged, ["_id", "tweet_id", "news__id"], ["createdAt", "event_date"],
        ["raw_text", "tweet_text", "comment_text", "clean_text"],
        ["clean_text", "raw_text", "tweet_text", "comment_text"], keep=["tweet_likeCount"])


@query("multimodal_records")
def _(spark, sf):
    return _mixed_records(spark, sf).drop("gold_event_datetime")


# ---- filters and null policy --------------------------------------------------

@query("iso_week_filter")
def _(spark, sf):
    return filters.filter_week(t.table(spark, sf, "events"), "ts", 2024, 3).select(
        "event_id", "event_type", "value")


@query("drop_blank")
def _(spark, sf):
    rows = t.labelled(spark, sf).withColumn(
        "note", F.when(F.col("quality") == 1, F.col("lang")).when(F.col("quality") == 0, " \n\t"))
    return filters.drop_blank(rows, ["text", "note"]).select("doc_id", "note")


@query("min_length")
def _(spark, sf):
    return filters.min_length(t.table(spark, sf, "conversations"), "text", 200).select(
        "conv_id", "turn", F.length("text").alias("chars"))


@query("entity_split")
def _(spark, sf):
    mixed = t.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text").unionByName(
        t.table(spark, sf, "conversations").select(F.col("conv_id").alias("newsLink"), "text"),
        allowMissingColumns=True)
    posts, articles = filters.split_entities(mixed)
    return identity.union_sources({"tweets": posts, "news": articles}).groupBy("source_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))


@query("slice_source")
def _(spark, sf):
    rows = t.tweets(spark, sf).withColumnRenamed("author_userName", "source")
    return filters.select_slice(rows, "src3", "alpha").select("tweet_id", "sentiment")


@query("null_policy")
def _(spark, sf):
    rows = t.labelled(spark, sf).withColumns({
        "createdAt": F.when(F.col("lang") != "es", F.col("lang")),
        "author": F.when(F.col("quality") == 1, F.col("source"))})
    return filters.apply_null_policy(
        rows, drop=["text", "createdAt"],
        fill={"quality": 0, "toxic": 0, "author": "anonymous", "absent": 1},
    ).select("doc_id", "createdAt", "quality", "toxic", "author")


@query("cap_p99")
def _(spark, sf):
    rows = t.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_custkey")
    return filters.cap_at_percentile(rows, ["o_totalprice", "o_custkey"], 0.99)


@query("noise_rates")
def _(spark, sf):
    return filters.noise_rates(t.documents(spark, sf), "text", "lang")


@query("noise_rates_pages")
def _(spark, sf):
    pages = t.table(spark, sf, "pages").withColumn("lang", F.regexp_extract("url", r"\.[a-z]+/([a-z]+)/", 1))
    return filters.noise_rates(pages, "html", "lang")


@query("drop_noise")
def _(spark, sf):
    return filters.drop_noise(t.table(spark, sf, "conversations"), "text",
                              texts=["deleted"], prefix=r"^[^.\n]{1,40}\. ")


# ---- dates ----------------------------------------------------------------------

def _epoch_ms(c: str) -> Column:
    return F.unix_millis(F.col(c)).cast("string")


@query("safe_date")
def _(spark, sf):
    events = t.table(spark, sf, "events")
    encoded = [("ms", _epoch_ms("ts")), ("iso", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")),
               ("bad", F.col("event_type"))]
    parts = [events.select("event_id", F.lit(kind).alias("kind"), value.alias("raw"))
             for kind, value in encoded]
    rows = parts[0].union(parts[1]).union(parts[2])
    return rows.select("event_id", "kind", dates.safe_date("raw").alias("day"))


def _dated_events(spark, sf):
    kind = F.col("event_type")
    return t.table(spark, sf, "events").withColumns({
        "createdAt": F.when(kind == "click", F.date_format("ts", "EEE MMM dd HH:mm:ss Z yyyy"))
        .when(kind == "view", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(kind == "error", "garbage"),
        "snapshot_date": F.when(kind == "error", F.date_format("ts", "yyyy-MM-dd"))
        .otherwise(F.unix_millis(F.date_trunc("month", "ts")).cast("string"))})


@query("normalize_event_date")
def _(spark, sf):
    return dates.normalize_event_date(_dated_events(spark, sf)).select("event_id", "event_date")


@query("parse_mixed_datetime")
def _(spark, sf):
    rows = t.table(spark, sf, "events").withColumns({
        "mostly_ms": F.when(F.col("event_type") == "error", "n/a").otherwise(_epoch_ms("ts")),
        "mostly_iso": F.when(F.col("event_type") == "error", _epoch_ms("ts"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))})
    rows = dates.parse_mixed_datetime(rows, "mostly_ms", "a", ratio=0.5)
    rows = dates.parse_mixed_datetime(rows, "mostly_iso", "b", ratio=0.5)
    return rows.select("event_id", F.col("a").cast("date").alias("from_ms"),
                       F.col("b").cast("date").alias("from_iso"))


@query("first_datetime")
def _(spark, sf):
    rows = _dated_events(spark, sf)
    return rows.select("event_id", dates.period(
        dates.first_datetime("createdAt", "snapshot_date")).alias("event_day"))


@query("iso_week_volume")
def _(spark, sf):
    rows = dates.with_iso_week(t.table(spark, sf, "orders"), "o_orderdate")
    return rows.groupBy("iso_year", "iso_week").agg(F.count(F.lit(1)).alias("n_records"))


@query("coerce_datetimes")
def _(spark, sf):
    rows = dates.coerce_datetimes(_dated_events(spark, sf), ["createdAt", "snapshot_date", "absent"])
    return rows.select("event_id", F.date_format("createdAt", "yyyy-MM-dd HH:mm:ss").alias("created"),
                       F.date_format("snapshot_date", "yyyy-MM-dd").alias("snapshot"))


# ---- text ----------------------------------------------------------------------

@query("clean_text_nlp")
def _(spark, sf):
    return t.documents(spark, sf).select("doc_id", text.clean_text("text").alias("cleaned"))


@query("clean_text_pages")
def _(spark, sf):
    return t.table(spark, sf, "pages").select("page_id", text.clean_text("html").alias("cleaned"))


@query("clean_text_eda")
def _(spark, sf):
    return t.documents(spark, sf).select("doc_id", text.clean_text("text", "eda").alias("cleaned"))


@query("clean_text_full")
def _(spark, sf):
    return t.documents(spark, sf).select("doc_id", text.clean_text("text", "full").alias("cleaned"))


@query("token_counts")
def _(spark, sf):
    return t.documents(spark, sf).select(
        "doc_id", F.size(text.keyword_tokens("text")).alias("keyword_tokens"),
        F.size(text.word_tokens("text")).alias("word_tokens"))


@query("text_length_stats")
def _(spark, sf):
    return quality.text_stats(t.documents(spark, sf), text.text_length("text"), ["lang"])


@query("text_coverage")
def _(spark, sf):
    cleaned = t.documents(spark, sf).select("lang", text.clean_text("text", "full").alias("cleaned"))
    return cleaned.groupBy("lang").agg(
        F.count_if(text.has_text("cleaned")).alias("with_text"), F.count(F.lit(1)).alias("n"))


@query("lexicon_sentiment")
def _(spark, sf):
    return t.score(t.documents(spark, sf), "text").select(
        "doc_id", "sentiment_score", "sentiment_intensity", "sentiment")


@query("lexicon_polarity")
def _(spark, sf):
    value = sentiment.lexicon_score("text", t.TEST_POSITIVE, t.TEST_NEGATIVE, mode="polarity")
    return sentiment.score_columns(t.documents(spark, sf), value, (0.2, -0.2), inclusive=False).select(
        "doc_id", "sentiment_score", "sentiment")


@query("compound_sentiment")
def _(spark, sf):
    return sentiment.compound_sentiment(t.documents(spark, sf), "text", t.TEST_WEIGHTS).select(
        "doc_id", "sentiment_score", "sentiment")


@query("compound_sentiment_from_table")
def _(spark, sf):
    # weights held in a table: the words of the benchmark texts, weighted by their length
    words = t.table(spark, sf, "benchmark").select(F.explode(text.word_tokens("text")).alias("word"))
    lexicon = words.distinct().withColumn("weight", (F.length("word") - 4) / 10.0)
    docs = t.documents(spark, sf).select("doc_id", "text")
    return sentiment.compound_sentiment_from_table(docs, "doc_id", "text", lexicon).select(
        "doc_id", "sentiment_score", "sentiment")


@query("taxonomy_all")
def _(spark, sf):
    return t.documents(spark, sf).select(
        "doc_id", F.array_join(taxonomy.match_all("text", t.TEST_BRANDS), ",").alias("brands"))


@query("taxonomy_all_parts")
def _(spark, sf):
    kinds = {**t.PART_KINDS, "any_ring": ["ring", "gear"]}
    return t.table(spark, sf, "part").select(
        "p_partkey", F.array_join(taxonomy.match_all("p_name", kinds), ",").alias("kinds"))


@query("taxonomy_first")
def _(spark, sf):
    return taxonomy.tag(t.documents(spark, sf), "text", {
        "brand": t.TEST_BRANDS, "topic": t.TEST_TOPICS, "product": t.TEST_PRODUCTS,
    }).select("doc_id", "brand", "topic", "product")


@query("taxonomy_first_word")
def _(spark, sf):
    words = {"one": ["of the", "und"], "two": ["que la", "des"], "three": ["the"]}
    return t.documents(spark, sf).select(
        "doc_id", taxonomy.match_first("text", words, default="other", match="word").alias("tag"))


@query("taxonomy_reference_lists")
def _(spark, sf):
    return taxonomy.tag(t.documents(spark, sf), "text", {
        "brand": vocab.BRANDS, "topic": vocab.TOPICS, "product": vocab.PRODUCTS,
    }).select("doc_id", "brand", "topic", "product")


def _taxonomy_table(spark, lists):
    """A taxonomy as the rows of a table, numbered in declared order."""
    rows = [(key, number, word) for number, (key, words) in enumerate(lists.items()) for word in words]
    return spark.createDataFrame(rows, "key string, number int, keyword string")


@query("taxonomy_table_first")
def _(spark, sf):
    docs = t.documents(spark, sf).select("doc_id", "text")
    for name, lists in (("brand", t.TEST_BRANDS), ("topic", t.TEST_TOPICS), ("product", t.TEST_PRODUCTS)):
        docs = keyword_tables.match_first_table(docs, "text", _taxonomy_table(spark, lists), name)
    return docs.drop("text")


@query("taxonomy_table_all")
def _(spark, sf):
    docs = t.documents(spark, sf).select("doc_id", "text")
    found = keyword_tables.match_all_table(docs, "text", _taxonomy_table(spark, t.TEST_BRANDS), "brands")
    return found.select("doc_id", F.array_join("brands", ",").alias("brands"))


def _part_keywords(spark, sf):
    """The words of the part names and their beginnings, each word a key."""
    words = t.table(spark, sf, "part").select(F.explode(F.split("p_name", " ")).alias("key")).distinct()
    return words.select("key", F.ascii("key").alias("number"), F.explode(F.array(
        F.col("key"), F.substring("key", 1, 4), F.substring("key", 2, 3))).alias("keyword"))


@query("taxonomy_table_parts")
def _(spark, sf):
    docs = t.documents(spark, sf).select("doc_id", "text")
    words = _part_keywords(spark, sf)
    first = keyword_tables.match_first_table(docs, "text", words, "first", default="none")
    every = keyword_tables.match_all_table(first, "text", words, "every")
    return every.select("doc_id", "first", F.array_join("every", ",").alias("every"))


@query("experience_type")
def _(spark, sf):
    return t.conversations(spark, sf).select(
        "conv_id", "turn", taxonomy.experience_type("text", t.TEST_PHRASES).alias("experience_type"))


@query("keyword_frequency")
def _(spark, sf):
    return rollups.term_counts(t.unscored_texts(spark, sf)).select("source_type", "term", "mentions")


@query("language_vote")
def _(spark, sf):
    return t.documents(spark, sf).select("doc_id", text.detect_language("text").alias("detected"))


@query("language_confusion")
def _(spark, sf):
    rows = t.documents(spark, sf).select("lang", text.detect_language(text.clean_text("text", "eda"))
                                         .alias("detected"))
    return profile.language_confusion(rows, "lang", "detected")


@query("text_agreement")
def _(spark, sf):
    rows = t.documents(spark, sf).select("text", text.clean_text("text", "eda").alias("clean_text"))
    return profile.text_agreement(rows, "text", "clean_text")


# ---- arrays and JSON -------------------------------------------------------------

@query("explode_comments")
def _(spark, sf):
    rows = t.conversations(spark, sf).select(
        "conv_id", "turn", F.to_json(F.split("text", "\n")).alias("comments"))
    return nested.explode_json_array(rows, "comments", "comment")


def _comment_lists(spark, sf):
    """JSON lists for users, malformed values for the rest."""
    return t.conversations(spark, sf).select("conv_id", "turn", F.when(
        F.col("role") == "user", F.to_json(F.split("text", "\n")))
        .when(F.col("turn") == 1, F.lit(None).cast("string")).otherwise(F.col("text")).alias("comments"))


@query("parse_comments")
def _(spark, sf):
    return _comment_lists(spark, sf).select(
        "conv_id", "turn", nested.array_size(nested.parse_comments("comments")).alias("n_comments"))


@query("explode_outer_comments")
def _(spark, sf):
    return nested.explode_json_array(_comment_lists(spark, sf), "comments", "comment", outer=True)


@query("comment_count_stats")
def _(spark, sf):
    rows = _lines(t.documents(spark, sf), "lang")
    return quality.text_stats(rows, nested.array_size("lines"), ["lang"])


@query("story_row")
def _(spark, sf):
    # as in a weekly run: rows are tagged, scored and written once, the roll-ups read them
    # back, the story reads the written roll-ups
    cols = ["brand", "product", "topic", "sentiment", "sentiment_score"]
    posts = cut_lineage(t.tweets(spark, sf).select(*cols, "total_engagement", "text"))
    replies = cut_lineage(t.news(spark, sf).select(*cols, F.col("comment_text").alias("text")))
    quotes = posts.select(*cols, "text").unionByName(replies)
    return story.story_row(*map(cut_lineage, (
        rollups.present(rollups.brand_analytics(posts, replies)),
        rollups.present(rollups.topic_analytics(posts, replies)),
        rollups.present(rollups.product_analytics(posts, replies)),
        rollups.representative_comments(quotes),
    ))).drop("brand_sentiment_snapshot", "representative_comments")


@query("story_records")
def _(spark, sf):
    brands = rollups.brand_analytics(t.tweets(spark, sf), t.news(spark, sf))
    return nested.records_json(brands.select("brand", "total_mentions", "mentions_news"),
                               ["brand", "total_mentions", "mentions_news"],
                               [-F.col("total_mentions"), F.col("brand")], "records")


# ---- identity ---------------------------------------------------------------------

@query("latest_with_summary")
def _(spark, sf):
    detail = t.table(spark, sf, "labels").select(
        "doc_id", F.when(F.col("quality") == 1, "good").alias("text")).unionByName(
        t.table(spark, sf, "labels").select("doc_id", F.lit("again").alias("text")))
    latest = t.table(spark, sf, "documents").select("doc_id", "source")
    return identity.enrich_latest(latest, detail, "doc_id", "text")


@query("distinct_labels")
def _(spark, sf):
    return identity.distinct_keys([(t.table(spark, sf, "documents"), "lang"),
                                   (t.table(spark, sf, "events"), "event_type"),
                                   (t.table(spark, sf, "conversations"), "role")])


@query("dedup_keep_last")
def _(spark, sf):
    rows = t.table(spark, sf, "documents")
    return identity.dedup(rows, ["text"], F.col("doc_id"), "last", digest=True).select("doc_id", "source")


@query("dedup_keep_first")
def _(spark, sf):
    rows = t.table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return identity.dedup(rows, ["lang", "source"], F.col("doc_id"), "first")


@query("surrogate_id")
def _(spark, sf):
    rows = t.documents(spark, sf).select("text", "lang", "source", "n_chars")
    return identity.ensure_id(rows, fingerprint_cols=["text", "lang", "source"]).select(
        "tweet_id", "tweet_id_origin", "n_chars")


@query("surrogate_id_blank")
def _(spark, sf):
    rows = t.table(spark, sf, "documents").select(
        F.when(F.col("lang") == "fr", " ").otherwise(F.col("doc_id").cast("string")).alias("ID"),
        "source", "n_chars")
    return identity.ensure_id(rows, fingerprint_cols=["source", "n_chars"]).select(
        "tweet_id", "tweet_id_origin", "source")


@query("duplicate_ids")
def _(spark, sf):
    return identity.duplicate_ids(t.table(spark, sf, "documents"), F.md5("text"))


@query("duplicate_share")
def _(spark, sf):
    return identity.duplicate_share(t.table(spark, sf, "documents"), F.md5("text"))


@query("upsert_keep_last")
def _(spark, sf):
    existing = t.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("tag"),
                                                      F.col("n_chars").alias("at"))
    new = t.table(spark, sf, "labels").select(
        F.col("doc_id").alias("id"), F.concat(F.lit("q"), F.col("quality").cast("string")).alias("tag"),
        F.col("toxic").cast("bigint").alias("at"))
    return identity.upsert(new, existing, ["id"], ["at"])


@query("upsert_weekly_undated")
def _(spark, sf):
    """Two batches into a weekly table; every third order has no date."""
    path = f"{scratch_path(spark, 'silver')}/orders"
    rows = t.table(spark, sf, "orders").select("o_orderkey", F.lit(1).alias("round"), F.when(
        F.col("o_orderkey") % 3 != 0, F.col("o_orderdate")).alias("day"))
    for number, batch in enumerate((rows.filter("o_orderkey % 2 = 0"), rows.filter("o_orderkey % 2 = 1"),
                                    rows.filter("o_orderkey % 5 = 0")), 1):
        upsert_weekly(batch.withColumn("round", F.lit(number)), path, ["o_orderkey"], ["round"], date_col="day")
    return readers.read_silver(spark, path).select("o_orderkey", "round", "iso_year", "iso_week")


# ---- sentiment roll-ups --------------------------------------------------------------

@query("sentiment_pcts")
def _(spark, sf):
    return rollups.sentiment_pcts(t.tweets(spark, sf), ["lang"])


@query("sentiment_pcts_overall")
def _(spark, sf):
    return rollups.sentiment_pcts(t.tweets(spark, sf), [])


@query("brand_analytics")
def brand_analytics(spark, sf):
    return rollups.brand_analytics(t.tweets(spark, sf), t.news(spark, sf))


@query("brand_analytics_presented")
def _(spark, sf):
    return rollups.present(rollups.brand_analytics(t.tweets(spark, sf), t.news(spark, sf)), 1, 4)


@query("topic_analytics")
def _(spark, sf):
    return rollups.topic_analytics(t.tweets(spark, sf), t.news(spark, sf))


@query("product_analytics")
def _(spark, sf):
    return rollups.product_analytics(t.tweets(spark, sf), t.news(spark, sf))


def _parts(spark, sf):
    value = (F.col("p_size") - 25) / 25.0
    return sentiment.score_columns(taxonomy.tag(
        t.table(spark, sf, "part"), "p_name", {"product": t.PART_KINDS}).withColumn(
        "brand", F.col("p_brand")), value)


@query("product_analytics_parts")
def _(spark, sf):
    return rollups.product_analytics(_parts(spark, sf))


@query("top_influencers")
def _(spark, sf):
    return rollups.top_influencers(t.tweets(spark, sf))


@query("top_influencers_customers")
def _(spark, sf):
    orders = t.table(spark, sf, "orders").join(
        t.table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = orders.select(
        F.col("c_mktsegment").alias("brand"), F.col("c_name").alias("author_userName"),
        F.col("c_acctbal").alias("author_followers"), F.col("o_totalprice").alias("total_engagement"),
        F.col("o_orderkey").alias("tweet_id"),
        F.when(F.col("o_orderstatus") == "F", "positive").when(F.col("o_orderstatus") == "O", "negative")
        .otherwise("neutral").alias("sentiment"))
    return rollups.top_influencers(rows)


@query("representative_comments")
def _(spark, sf):
    return rollups.representative_comments(t.comments(spark, sf))


@query("sentiment_distribution")
def _(spark, sf):
    return rollups.sentiment_distribution(t.scored_texts(spark, sf))


@query("sentiment_distribution_by_day")
def _(spark, sf):
    return rollups.sentiment_distribution(t.scored_texts(spark, sf), ["event_date"])


@query("sentiment_trend")
def _(spark, sf):
    return rollups.sentiment_trend(t.scored_texts(spark, sf))


@query("sentiment_trend_weekly")
def _(spark, sf):
    return rollups.sentiment_trend(t.scored_texts(spark, sf), "week")


@query("source_comparison")
def _(spark, sf):
    return rollups.source_comparison(t.tweets(spark, sf), "author_userName")


@query("source_comparison_by_label")
def _(spark, sf):
    return rollups.source_comparison(t.scored_texts(spark, sf), labels=True)


@query("volume_trend")
def _(spark, sf):
    return trends.volume_trend(t.table(spark, sf, "events"), "event_type", "ts")


@query("cumulative_volume")
def _(spark, sf):
    return trends.volume_trend(t.table(spark, sf, "events"), "event_type", "ts", cumulative=True)


@query("top_keywords")
def _(spark, sf):
    return rollups.top_keywords(t.unscored_texts(spark, sf))


@query("top_keywords_per_source")
def _(spark, sf):
    return rollups.top_keywords(t.unscored_texts(spark, sf), scope="per_source")


@query("keyword_sentiment")
def _(spark, sf):
    return rollups.keyword_sentiment(t.scored_texts(spark, sf), min_freq=5)


@query("top_bigrams")
def _(spark, sf):
    return rollups.top_bigrams(t.unscored_texts(spark, sf))


@query("topic_terms")
def _(spark, sf):
    return rollups.topic_terms(t.unscored_texts(spark, sf))


@query("kpi_share")
def _(spark, sf):
    return rollups.kpi_share(t.scored_texts(spark, sf))


@query("kpi_score")
def _(spark, sf):
    return rollups.kpi_score(t.scored_texts(spark, sf))


@query("topic_kpi")
def _(spark, sf):
    return rollups.topic_kpi(t.scored_texts(spark, sf))


@query("trend_kpi")
def _(spark, sf):
    return rollups.trend_kpi(t.scored_texts(spark, sf))


@query("mention_counts")
def _(spark, sf):
    return rollups.mention_counts(t.documents(spark, sf), "text", t.TEST_BRANDS)


@query("mention_counts_published")
def _(spark, sf):
    """The published brands over texts that name them: part names in the role of products."""
    named = t.table(spark, sf, "part").select(F.concat_ws(" ", F.element_at(F.array(
        F.lit("Galaxy"), F.lit("iPhone"), F.lit("moto g"), F.lit("Redmi"), F.lit("radio")), F.pmod(
        "p_partkey", F.lit(5)).cast("int") + 1), "p_name").alias("text"))
    return rollups.mention_counts(named, "text", vocab.EDA_BRANDS)


@query("mention_counts_parts")
def _(spark, sf):
    return rollups.mention_counts(t.table(spark, sf, "part"), "p_name",
                                  {**t.PART_KINDS, "any_ring": ["ring", "gear"]})


@query("reach_by_brand")
def _(spark, sf):
    rows = t.table(spark, sf, "part").select("p_partkey", "p_name").join(
        t.table(spark, sf, "lineitem").select("l_partkey", "l_extendedprice"),
        F.col("p_partkey") == F.col("l_partkey"))
    return rollups.reach_by_brand(rows, "p_name", t.PART_KINDS, "l_extendedprice")


@query("daily_entity_summary")
def _(spark, sf):
    rows = t.table(spark, sf, "events").select(
        F.col("ts").cast("date").alias("gold_event_date"), F.col("event_type").alias("gold_entity"),
        F.col("user_id").alias("gold_record_id"), text.has_text(
            F.when(F.col("value") > 20, F.col("event_type"))).alias("gold_has_text"),
        F.col("value").alias("tweet_likeCount"))
    return rollups.daily_entity_summary(rows, ["tweet_likeCount"])


@query("daily_entity_summary_mixed")
def _(spark, sf):
    return rollups.daily_entity_summary(_mixed_records(spark, sf), ["tweet_likeCount"])


@query("topic_polarity")
def _(spark, sf):
    return rollups.topic_polarity(t.scored_texts(spark, sf))


# ---- story ------------------------------------------------------------------------------

@query("mood_snapshot")
def _(spark, sf):
    brands = rollups.brand_analytics(t.tweets(spark, sf), t.news(spark, sf))
    return story.mood(brands).unionByName(story.mood(brands, "beta"))


@query("brand_sentiment_long")
def _(spark, sf):
    return story.sentiment_long(rollups.brand_analytics(t.tweets(spark, sf), t.news(spark, sf)), "brand")


@query("product_sentiment_long")
def _(spark, sf):
    return story.sentiment_long(rollups.product_analytics(_parts(spark, sf)), "product", "mentions", k=5)


@query("channel_breakdown")
def _(spark, sf):
    return story.channel_breakdown(rollups.brand_analytics(t.tweets(spark, sf), t.news(spark, sf)), "alpha")


@query("topic_drilldown")
def _(spark, sf):
    return story.topic_drilldown(t.tweets(spark, sf), "alpha")


@query("engagement_points")
def _(spark, sf):
    return story.engagement_points(t.tweets(spark, sf))


@query("brand_narrative")
def _(spark, sf):
    return story.brand_narrative(rollups.brand_analytics(t.tweets(spark, sf), t.news(spark, sf)))


@query("comment_quotes")
def _(spark, sf):
    return story.comment_quotes(rollups.representative_comments(t.comments(spark, sf)))


# ---- trends and windows -------------------------------------------------------------------

@query("daily_sentiment")
def _(spark, sf):
    return trends.daily_sentiment(t.event_days(spark, sf))


@query("daily_sentiment_texts")
def _(spark, sf):
    return trends.daily_sentiment(t.branded_days(spark, sf))


@query("daily_trend_all")
def _(spark, sf):
    return trends.daily_trend_all(trends.daily_sentiment(t.event_days(spark, sf)))


@query("daily_trend_all_weighted")
def _(spark, sf):
    return trends.daily_trend_all(trends.daily_sentiment(t.event_days(spark, sf)), weighted=True)


@query("sentiment_alerts")
def _(spark, sf):
    return trends.sentiment_alerts(trends.daily_sentiment(t.branded_days(spark, sf)))


@query("sentiment_alerts_calendar")
def _(spark, sf):
    return trends.sentiment_alerts(trends.daily_sentiment(t.branded_days(spark, sf)), calendar_days=True)


@query("alert_sentences")
def _(spark, sf):
    alerts = trends.sentiment_alerts(trends.daily_sentiment(t.branded_days(spark, sf)))
    return story.alert_sentences(trends.ordered_alerts(alerts)).select("date", "severity", "sentence")


@query("snapshot_rank")
def _(spark, sf):
    rows = t.table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    ranked = identity.snapshot_rank(
        rows, "user_id", [F.col("ts").desc_nulls_last(), F.col("event_id").desc()],
        F.date_trunc("hour", "ts"))
    return ranked.select("event_id", "user_id", "snapshot_rank")


@query("latest_per_key")
def _(spark, sf):
    rows = t.table(spark, sf, "events").select("user_id", "event_type", "ts", "event_id", "value")
    return identity.latest_per_key(rows, ["user_id", "event_type"], [
        F.col("ts").desc_nulls_last(), F.col("event_id").desc()], total=True).drop("ts")


@query("top_k_per_group")
def _(spark, sf):
    rows = t.table(spark, sf, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    return trends.top_k(rows, [F.col("o_totalprice").desc(), F.col("o_orderkey")], 5, ["o_orderpriority"])


@query("top_topics")
def _(spark, sf):
    topics = rollups.topic_analytics(t.tweets(spark, sf), t.news(spark, sf))
    return trends.top_k(topics, [F.round("positive_pct", 6).desc(), F.col("topic")], 3)


@query("moving_average")
def _(spark, sf):
    daily = trends.volume_trend(t.table(spark, sf, "events"), "event_type", "ts")
    return trends.moving_average(daily, ["event_type"], "n_records", 7)


@query("peak_days")
def _(spark, sf):
    return trends.peak_days(t.table(spark, sf, "events"), "ts")


@query("tumbling_volume")
def _(spark, sf):
    rows = t.table(spark, sf, "events")
    return rows.groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(
        F.count(F.lit(1)).alias("n_records"), F.sum("value").alias("score_sum"),
        F.avg("value").alias("avg_score")).select(
        F.col("w.start").cast("date").alias("period"), "event_type", "n_records", "score_sum", "avg_score")


# ---- governance ------------------------------------------------------------------------------

@query("duplicate_rate")
def _(spark, sf):
    rows = t.table(spark, sf, "documents").select(F.md5("text").alias("digest"))
    return quality.duplicate_rate(rows, "digest")


@query("duplicate_rate_null_as_value")
def _(spark, sf):
    return quality.duplicate_rate(t.labelled(spark, sf), ["quality", "toxic", "lang"], null_as_value=True)


@query("row_compliance")
def _(spark, sf):
    return quality.row_compliance(t.labelled(spark, sf), ["doc_id", "text", "quality"])


@query("null_rates")
def _(spark, sf):
    rows = t.labelled(spark, sf).withColumn("note", F.when(F.col("lang") == "fr", " ").otherwise("x"))
    return quality.null_rates(rows, ["text", "lang", "quality", "toxic", "note"])


@query("text_stats")
def _(spark, sf):
    return quality.text_stats(t.unscored_texts(spark, sf), text.text_length("text"), ["source_type"])


@query("language_distribution")
def _(spark, sf):
    rows = t.table(spark, sf, "documents").select(F.when(F.col("lang") != "es", F.col("lang")).alias("lang"))
    return quality.language_distribution(rows)


@query("outlier_rate_approx")
def _(spark, sf):
    return quality.outlier_rate(t.lineitem(spark, sf), ["l_quantity", "l_discount", "l_tax"])


@query("outlier_rate_approx_texts")
def _(spark, sf):
    rows = t.raw_tweets(spark, sf)
    return quality.outlier_rate(rows, ["likeCount", "replyCount", "total_engagement"])


@query("outlier_rate_exact")
def _(spark, sf):
    return quality.outlier_rate(t.lineitem(spark, sf),
                                ["l_quantity", "l_extendedprice", "l_discount"], "exact")


@query("outlier_rate_exact_events")
def _(spark, sf):
    return quality.outlier_rate(t.table(spark, sf, "events"), ["value"], "exact")


def _silver_shaped(spark, sf):
    """Documents and conversations in the columns of the Silver tables."""
    posts = t.labelled(spark, sf).select(
        F.col("doc_id").cast("string").alias("id"), "text", F.col("quality").cast("string").alias("createdAt"),
        "lang", F.col("source").alias("author_userName"), F.col("toxic").cast("bigint").alias("retweetCount"),
        F.col("n_chars").alias("likeCount"), t._day("doc_id").alias("event_date"))
    articles = t.conversations(spark, sf).select(
        F.concat(F.lit("conv/"), F.col("conv_id").cast("string")).alias("newsLink"),
        F.to_json(F.split("text", "\n")).alias("comments"),
        F.when(F.col("role") == "user", "2024-01-01").alias("snapshot_date"),
        t._day("conv_id").alias("event_date"))
    return posts, articles


@query("governance_summary")
def _(spark, sf):
    return quality.governance_summary(*_silver_shaped(spark, sf))


@query("governance_kpi_view")
def _(spark, sf):
    return quality.kpi_view(quality.governance_summary(*_silver_shaped(spark, sf)), "2024-01-31")


@query("storytelling_summary")
def _(spark, sf):
    return quality.storytelling_summary(t.scored_texts(spark, sf).drop("topic"))


def _governance_tables(spark, sf):
    posts = t.tweets(spark, sf).join(
        t.table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("tweet_id"), "quality"),
        "tweet_id", "left").withColumn(
        "author_userName", F.when(F.col("quality").isNotNull(), F.col("author_userName")))
    return posts, t.news(spark, sf)


@query("critical_null_rate")
def _(spark, sf):
    posts, replies = _governance_tables(spark, sf)
    return quality.critical_null_rate([(posts, vocab.CRITICAL_TWEETS_COLUMNS),
                                       (replies, vocab.CRITICAL_NEWS_COLUMNS + ["absent"])])


@query("null_profile")
def _(spark, sf):
    return quality.null_profile(t.labelled(spark, sf), 10)


@query("combined_dup_rate")
def _(spark, sf):
    return quality.combined_dup_rate([
        (t.table(spark, sf, "documents").select(F.md5("text").alias("digest")), ["digest"]),
        (t.table(spark, sf, "conversations"), ["conv_id", "role"])])


@query("column_compliance")
def _(spark, sf):
    posts, replies = t.tweets(spark, sf), t.news(spark, sf)
    shared = quality.shared_columns(posts, replies)
    return posts.agg(F.count(F.lit(1)).alias("n")).select(
        "n", F.lit(quality.column_compliance(posts, vocab.GOVERNANCE_TWEETS_COLUMNS)).alias("tweets_pct"),
        F.lit(quality.column_compliance(replies, vocab.GOVERNANCE_NEWS_COLUMNS)).alias("news_pct"),
        F.lit(",".join(shared)).alias("shared"))


@query("diversity")
def _(spark, sf):
    return quality.diversity(t.raw_tweets(spark, sf))


@query("kpi_table")
def _(spark, sf):
    return quality.kpi_table(quality.dashboard_metrics(*_governance_tables(spark, sf)))


@query("kpi_bands")
def _(spark, sf):
    return quality.kpi_bands(quality.dashboard_metrics(*_governance_tables(spark, sf)))


@query("length_box")
def _(spark, sf):
    rows = t.unscored_texts(spark, sf).withColumn("text_length", text.text_length("text"))
    return quality.length_box(rows, "source_type", "text_length")


# ---- profiling ----------------------------------------------------------------------------------

@query("column_audit")
def _(spark, sf):
    return profile.column_audit(t.labelled(spark, sf))


@query("column_audit_orders")
def _(spark, sf):
    return profile.column_audit(t.table(spark, sf, "orders")).drop("dtype")


# means of cent values over 60,000 rows can end on a tie at six digits
@query("describe_numeric", digits=4)
def _(spark, sf):
    return profile.describe_numeric(t.lineitem(spark, sf),
                                    ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


@query("quality_summary")
def _(spark, sf):
    rows = t.labelled(spark, sf).select("source", "text", "lang", "n_chars", "quality")
    return profile.quality_summary(rows, "source", "text", "quality")


@query("top_values")
def _(spark, sf):
    return profile.top_values(t.labelled(spark, sf).select(F.col("quality")), "quality")


@query("top_values_source")
def _(spark, sf):
    return profile.top_values(t.table(spark, sf, "documents"), "source", 10)


@query("candidate_columns")
def _(spark, sf):
    return profile.candidate_columns(profile.column_audit(t.labelled(spark, sf)), 0.35).select(
        "column", "missing_ratio")


def _catalogued(spark, sf):
    rows = t.labelled(spark, sf).select(
        F.col("doc_id").alias("_id"), F.col("text").alias("clean_text"), F.col("lang").alias("detected_lang"),
        F.col("source").alias("tweet_author_name"), F.col("n_chars").alias("tweet_likeCount"),
        F.col("quality").alias("tweet_quoted_tweet_text"), F.col("toxic").alias("news_newsLink"),
        F.lit("tweet").alias("record_type"), F.col("quality").alias("tweet_author_coverPicture"),
        F.lit(None).cast("string").alias("news_comments_raw"), F.lit(None).cast("string").alias("tweet_place"),
        F.col("quality").alias("event_date"), F.col("lang").alias("misc"))
    return profile.classify_columns(profile.column_audit(rows))


@query("column_catalog")
def _(spark, sf):
    return _catalogued(spark, sf).select("column", "missing_ratio", "family", "recommendation")


@query("column_catalog_families")
def _(spark, sf):
    return profile.family_summary(_catalogued(spark, sf))


@query("corr_matrix")
def _(spark, sf):
    return profile.corr_matrix(t.lineitem(spark, sf),
                               ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


@query("corr_matrix_wide", digits=6)
def _(spark, sf):
    wide = t.lineitem(spark, sf).select(*[F.expr(e).alias(c) for c, e in t.WIDE_COLUMNS.items()])
    return profile.corr_matrix_wide(wide, list(t.WIDE_COLUMNS))


@query("engagement_summary", digits=4)
def _(spark, sf):
    rows = t.lineitem(spark, sf).select(
        "l_quantity", "l_extendedprice", F.when(F.col("l_returnflag") != "R", F.col("l_tax")).alias("l_tax"))
    return profile.engagement_summary(rows, ["l_quantity", "l_extendedprice", "l_tax"], log=True)


@query("crosstab")
def _(spark, sf):
    return profile.crosstab(t.table(spark, sf, "documents"), "lang", "source")


@query("null_structure")
def _(spark, sf):
    posts = t.labelled(spark, sf).select(
        F.lit("tweet").alias("record_type"), "text", F.col("quality").alias("parsed"), "doc_id", "lang")
    replies = t.conversations(spark, sf).select(
        F.lit("news_comment").alias("record_type"), "text", "role",
        F.when(F.col("turn") > 0, F.col("turn")).alias("parsed"))
    merged = posts.unionByName(replies, allowMissingColumns=True)
    return profile.null_structure(merged, "record_type", "text", "parsed", ["doc_id", "role"])


@query("entity_mix")
def _(spark, sf):
    return profile.entity_mix(_mixed_records(spark, sf), "gold_entity", "gold_text_clean",
                              "gold_event_date")


@query("snapshot_multiplicity")
def _(spark, sf):
    return profile.snapshot_multiplicity(t.table(spark, sf, "events"), "user_id")


@query("multiplicity_summary")
def _(spark, sf):
    return profile.multiplicity_summary(t.table(spark, sf, "events"), "user_id")


@query("cleaning_report")
def _(spark, sf):
    return profile.cleaning_report(t.documents(spark, sf), "text", ["text"], "lang", "doc_id")


# ---- written and read back ------------------------------------------------------------

def _as_snapshots(spark, sf) -> DataFrame:
    """Every document as a tweet snapshot of its own."""
    stamp = F.unix_millis(t._day("doc_id").cast("timestamp")).cast("string")
    author = F.struct(F.col("source").alias("userName"), F.col("doc_id").alias("followers"))
    return t.documents(spark, sf).select(
        F.concat(F.lit("s"), F.col("doc_id").cast("string")).alias("_id"), stamp.alias("date"),
        F.array(F.struct(F.col("doc_id").cast("string").alias("id"), "text", "lang",
                         F.col("n_chars").alias("likeCount"), author.alias("author"))).alias("tweets"),
        F.to_timestamp(t._day("doc_id")).alias("createdAt"))


@query("snapshot_json")
def _(spark, sf):
    root = scratch_path(spark, "bronze")
    landed = write_snapshot(_as_snapshots(spark, sf), root, "twitter", "tweets")
    rows = readers.silver_tweets(readers.read_snapshots(spark, landed, "twitter", lines=True))
    return rows.select("id", "text_cleaned", "text_length", "author_userName", "author_followers",
                       "likeCount", dates.safe_date("snapshot_date").alias("day"))


@query("latest_file")
def _(spark, sf):
    """Two landings of different tables; the one with the greater name is read."""
    root = scratch_path(spark, "bronze")
    docs, turns = t.table(spark, sf, "documents"), t.table(spark, sf, "conversations")
    for source, day, rows in (("twitter", 1, t.table(spark, sf, "labels").select("doc_id")),
                              ("twitter", 2, docs.select("doc_id", "text")), ("webscraping", 3, turns)):
        write_snapshot(rows, root, source, "tweets", datetime(2024, 1, day))
    return spark.read.schema("doc_id long, text string").json(readers.latest_by_name(spark, root, "twitter"))


def _weekly_orders(spark, sf) -> str:
    path = f"{scratch_path(spark, 'silver')}/orders"
    rows = dates.with_iso_week(t.table(spark, sf, "orders"), "o_orderdate").select(
        "o_orderkey", "o_custkey", "o_totalprice", "iso_year", "iso_week")
    write_weekly(rows, path)
    return path


@query("read_silver_weeks")
def _(spark, sf):
    return readers.read_silver(spark, _weekly_orders(spark, sf), [(1995, 1), (1996, 52)])


@query("write_weekly_replaces")
def _(spark, sf):
    path = _weekly_orders(spark, sf)
    one_week = readers.read_silver(spark, path, [(1995, 10)])
    write_weekly(one_week.withColumn("o_totalprice", F.lit(0.0)).drop("iso_year", "iso_week"),
                 f"{path}-new", (1995, 10))
    write_weekly(readers.read_silver(spark, f"{path}-new"), path)
    return readers.read_silver(spark, path).groupBy("iso_year", "iso_week").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total"))


@query("write_weekly_observed")
def _(spark, sf):
    def lost(col, every):
        return F.when(F.col("event_id") % every != 0, F.col(col)).alias(col)
    events = t.table(spark, sf, "events").select(
        "event_id", lost("ts", 13), lost("user_id", 11), lost("value", 7), "props",
        F.when(F.col("event_id") % 5 == 0, "  ").otherwise(F.col("event_type")).alias("event_type"))
    path = scratch_path(spark, "observed")
    measured = write_weekly_observed(dates.with_iso_week(events, "ts"), path, ["user_id", "value", "event_type", "props"],
                                     ["event_id", "user_id", "value"])
    stored = readers.read_silver(spark, path).agg(F.count(F.lit(1)).alias("rows_stored"))
    return measured.withColumn("rows_stored", stored.scalar())


@query("read_latest_artifact")
def _(spark, sf):
    root, name = _weekly_orders(spark, sf).rsplit("/", 1)
    return readers.read_latest_artifact(spark, root, name)


@query("csv_round_trip")
def _(spark, sf):
    path = scratch_path(spark, "csv")
    rows = t.documents(spark, sf).select("doc_id", "text", F.split("source", "c").alias("parts"))
    write_csv(rows, path)
    return readers.read_csv(spark, path, "doc_id bigint, text string, parts string")


@query("read_silver_merged")
def _(spark, sf):
    root = scratch_path(spark, "silver")
    docs, turns = t.table(spark, sf, "documents"), t.table(spark, sf, "conversations")
    docs.select(F.col("doc_id").cast("string").alias("id"), "lang", F.col("n_chars").cast("string")
                .alias("likeCount"), F.lit(1).alias("unknown")).write.parquet(f"{root}/tweets_2024_W01.parquet")
    # the same counter as a number: the files' schemas cannot be merged
    docs.select(F.concat(F.lit("b"), F.col("doc_id").cast("string")).alias("id"), F.col("n_chars")
                .alias("viewCount"), F.col("doc_id").alias("likeCount")).write.parquet(f"{root}/tweets_2024_W02.parquet")
    turns.select(F.col("conv_id").cast("string").alias("newsLink"), F.split("text", "\n").alias("comments")) \
        .write.parquet(f"{root}/noticias_2024_W01.parquet")
    rows = readers.read_silver_merged(spark, root)
    return rows.select("id", "lang", "likeCount", "viewCount", "newsLink", "comments", "source_type")


@query("select_by_pattern")
def _(spark, sf):
    return shape.select_by_pattern(t.table(spark, sf, "orders"), ["price", "priority"], keep=["o_orderkey"])


@query("user_scorer")
def _(spark, sf):
    """A caller's own scorer, as an Arrow UDF over batches of texts."""
    @F.pandas_udf("double")
    def vowels(texts: pd.Series) -> pd.Series:
        return (texts.str.count("[aeiou]") / texts.str.len().clip(lower=1) - 0.4).round(6)

    return sentiment.compound_sentiment(t.documents(spark, sf), "text", scorer=vowels).select(
        "doc_id", "sentiment_score", "sentiment")


def _weekly_run(spark, sf):
    """The whole weekly run over both tables: Silver upsert, governance, roll-ups, story."""
    root = scratch_path(spark, "lake")
    stamp = lambda key: F.unix_millis(t._day(key).cast("timestamp")).cast("string")
    posts = t.documents(spark, sf).select(
        F.col("doc_id").cast("string").alias("id"), "text", "lang", F.col("source").alias("author_userName"),
        F.col("doc_id").alias("author_followers"), F.col("n_chars").alias("likeCount"),
        stamp("doc_id").alias("snapshot_date"), t._day("doc_id").alias("event_date"))
    articles = t.conversations(spark, sf).select(
        F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("newsLink"),
        F.split("text", "\n").alias("comments"), stamp("conv_id").alias("snapshot_date"),
        t._day("conv_id").alias("event_date"))
    upsert_weekly(posts, f"{root}/silver/tweets", vocab.NATURAL_KEYS["tweets"], ["snapshot_date"], date_col="event_date")
    upsert_weekly(articles, f"{root}/silver/news", vocab.NATURAL_KEYS["news"], ["snapshot_date"], date_col="event_date")
    return weekly.run_week(
        spark, f"{root}/silver", f"{root}/gold", 2024, 3,
        {"brand": t.TEST_BRANDS, "product": t.TEST_PRODUCTS, "topic": t.TEST_TOPICS},
        lambda c: sentiment.lexicon_score(c, t.TEST_POSITIVE, t.TEST_NEGATIVE))


@query("weekly_brands")
def _(spark, sf):
    return _weekly_run(spark, sf)["brand_analytics"]


@query("weekly_governance", digits=6)
def _(spark, sf):
    """Four tables of the weekly run in one shape."""
    tables = _weekly_run(spark, sf)
    line = lambda name, *values: tables[name].select(F.lit(name).alias("frame"), *[
        F.expr(v).alias(c) for c, v in zip(("source", "label", "value", "sample_size"), values)])
    sizes = ("min_length", "q1", "median", "q3", "max_length")
    parts = [line("governance_nulls", "source", "column", "null_pct", "CAST(NULL AS BIGINT)").filter("label IN ('brand', 'product', 'topic')"),
             line("governance_volume", "source", "CAST(period AS STRING)", "CAST(n_records AS DOUBLE)", "CAST(NULL AS BIGINT)"),
             line("governance_outliers", "'Twitter'", "metric", "outlier_rate", "sample_size"),
             *[line("governance_lengths", "source", f"'{c}'", f"CAST({c} AS DOUBLE)", "sample_size") for c in sizes]]
    return reduce(lambda a, b: a.unionByName(b), parts)


# ---- streams: each takes all files that are there, stops, and its output is read back ----

def _event_stream(spark, sf) -> DataFrame:
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    return jobs.stream_files(spark, sf, schema, "events.parquet")


@query("stream_volume")
def _(spark, sf):
    out = scratch_path(spark, "stream")
    trend = jobs.stream_trend(_event_stream(spark, sf), "ts", "event_type", score="value")
    jobs.write_trend(trend, f"{out}/trend", f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/trend").drop("batch")


@query("stream_volume_open")
def _(spark, sf):
    out = scratch_path(spark, "stream")
    trend = jobs.stream_trend(_event_stream(spark, sf), "ts", "event_type", score="value", start=True)
    jobs.write_open_trend(trend, f"{out}/trend", f"{out}/checkpoint")
    return jobs.read_open_trend(spark, f"{out}/trend", ["start", "event_type"]).drop("start")


@query("stream_dedup")
def _(spark, sf):
    out = scratch_path(spark, "stream")
    rows = _event_stream(spark, sf).select("user_id", "event_type", "ts")
    unique = jobs.stream_dedup(rows, ["user_id", "event_type"], "ts", "2 days")
    jobs.run_available(unique, f"{out}/checkpoint", jobs.land_batches(f"{out}/rows"))
    return spark.read.parquet(f"{out}/rows").select("user_id", "event_type")


@query("stream_upsert")
def _(spark, sf):
    out = scratch_path(spark, "stream")
    rows = _event_stream(spark, sf).select("user_id", "event_id", "value", F.col("ts").cast("timestamp").alias("ts"))
    jobs.run_available(rows, f"{out}/checkpoint", lambda batch, _: upsert_weekly(
        batch, f"{out}/silver", ["user_id"], ["ts", "event_id"], date_col="ts"))
    return spark.read.parquet(f"{out}/silver").select("user_id", "iso_year", "iso_week", "event_id", "value")


@query("stream_silver")
def _(spark, sf):
    """Bronze JSON to the weekly table, a file a batch; a second run finds nothing new."""
    out = scratch_path(spark, "stream")
    landed = _as_snapshots(spark, sf)
    for day in (1, 2):
        part = landed.filter(F.pmod(F.xxhash64("_id"), F.lit(2)) == day - 1)
        write_snapshot(part, f"{out}/bronze", "twitter", "tweets", datetime(2024, 1, day))
    for _ in range(2):
        jobs.stream_silver(spark, "twitter", f"{out}/bronze/*", f"{out}/silver", f"{out}/checkpoint", ["id"],
                           lambda _: dates.safe_date("snapshot_date"), per_batch=1, lines=True)
    rows = readers.read_silver(spark, f"{out}/silver")
    return rows.select("id", "text_cleaned", "likeCount", "iso_year", "iso_week")


@query("stream_alerts")
def _(spark, sf):
    out = scratch_path(spark, "stream")
    daily = cut_lineage(trends.daily_sentiment(t.branded_days(spark, sf)))
    # ten days a file, one file a batch, in the order of days
    for part in range(3):
        first = F.date_add(F.lit("2024-01-01").cast("date"), 10 * part)
        daily.filter((F.col("date_day") >= first) & (F.col("date_day") < F.date_add(first, 10))).coalesce(1).write.mode(
            "append").parquet(f"{out}/days")
    days = jobs.stream_files(spark, f"{out}/days", daily.schema, per_batch=1)
    jobs.stream_alerts(days, out, f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/alerts").drop("batch")


@query("stream_refresh_weeks")
def _(spark, sf):
    """Weeks that new rows arrive for are rebuilt from Silver."""
    out, silver = scratch_path(spark, "stream"), _weekly_orders(spark, sf)
    arrivals = readers.read_silver(spark, silver).filter("iso_year = 1995").select("iso_year", "iso_week")
    arrivals.write.parquet(f"{out}/arrivals")
    rows = jobs.stream_files(spark, f"{out}/arrivals", arrivals.schema)
    jobs.refresh_weeks(rows, f"{out}/gold", f"{out}/checkpoint", lambda df: df.groupBy(
        "iso_year", "iso_week").agg(F.count(F.lit(1)).alias("n")), silver)
    return readers.read_silver(spark, f"{out}/gold")


DAY_KEYS = ["date_day", "source", "brand"]


@query("stream_weekly_rollup")
def _(spark, sf):
    """Daily sentiment from the partials of as many batches as files arrive, in no order of time."""
    out = scratch_path(spark, "stream")
    rows = t.event_days(spark, sf)
    rows.withColumn("part", F.pmod(F.crc32(F.col("sentiment_score").cast("string").cast("binary")), F.lit(3))).write.partitionBy(
        "part").parquet(f"{out}/arrivals")
    arriving = jobs.stream_files(spark, f"{out}/arrivals/*", rows.schema, per_batch=1)
    jobs.keep_rollup(arriving, f"{out}/gold", f"{out}/checkpoint", DAY_KEYS, partials.SENTIMENT, "date_day")
    return partials.sentiment_shares(partials.added(spark, f"{out}/gold", DAY_KEYS, partials.SENTIMENT, by_week=False))


@query("weekly_rollup_added")
def _(spark, sf):
    """Three batches with late rows of every week, one of them twice, added per week."""
    out, rows = scratch_path(spark, "table"), t.table(spark, sf, "events")
    measures = {"n": partials.counted(), "total": partials.summed("value"), "low": partials.least("value"),
                "high": partials.greatest("value")}
    for batch in (0, 1, 2, 1):
        own = rows.filter(F.pmod("event_id", F.lit(3)) == batch)
        partials.store_partials(own, out, batch, ["event_type"], measures, "ts")
    return partials.added(spark, out, ["event_type"], measures)


@query("distinct_sketch_weeks")
def _(spark, sf):
    """Distinct users per type from sketches stored per week and united, beside the exact number."""
    out, rows = scratch_path(spark, "table"), t.table(spark, sf, "events")
    measures = {"n": partials.counted(), "users": partials.distinct_sketch("user_id")}
    for batch in (0, 1):
        partials.store_partials(rows.filter(F.pmod("event_id", F.lit(2)) == batch), out, batch, ["event_type"], measures, "ts")
    united = partials.with_distinct(partials.added(spark, out, ["event_type"], measures, by_week=False), "users", "about")
    exact = rows.groupBy("event_type").agg(F.count_distinct("user_id").alias("users"))
    off = F.abs(F.col("about") - F.col("users")) / F.greatest("users", F.lit(1))
    return exact.join(united, "event_type").select("event_type", "n", "users", (off <= 4 * partials.SKETCH_ERROR).alias("within_error"))
