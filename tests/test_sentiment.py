import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from opinara import vocab
from opinara.functions import sentiment as s, taxonomy as tx
from opinara.plans.weekly import TAXONOMIES


def test_per_token_score(one):
    assert one(s.lexicon_score(F.col("v")), v="good bad great") == pytest.approx(1 / 3)
    assert one(s.lexicon_score(F.col("v")), v="") == 0.0
    assert one(s.lexicon_score(F.col("v").cast("string")), v=None) == 0.0
    assert one(s.lexicon_score(F.col("v")), v="good, good. meh_x") == pytest.approx(2 / 3)


def test_polarity_counts_distinct_blank_separated_words(one):
    score = lambda v: one(s.lexicon_score(F.col("v"), mode="polarity"), v=v)
    assert score("good good bad great") == pytest.approx(1 / 3)
    assert score("good, bad") == -1.0  # the comma sticks to its word
    assert score("nothing here") == 0.0


def test_label_bounds(one):
    label = lambda v, **k: one(s.sentiment_label(F.col("v"), **k), v=v)
    assert [label(v) for v in (0.05, -0.05, 0.0499)] == ["positive", "negative", "neutral"]
    assert [label(v, inclusive=False) for v in (0.05, -0.05, 0.0501)] == ["neutral", "neutral", "positive"]
    assert label(0.2, positive=0.2, negative=-0.2, inclusive=False) == "neutral"


def test_compound_is_signed_and_bounded(spark):
    rows = spark.createDataFrame([(1, "awful awful day"), (2, "fine")], "id int, text string")
    got = {r.id: r for r in s.compound_sentiment(rows, "text", {"awful": -2.0, "fine": 0.5}).collect()}
    assert got[1].sentiment_score == pytest.approx(-4 / math.sqrt(31))
    assert got[1].sentiment_intensity == pytest.approx(4 / math.sqrt(31))
    assert got[1].sentiment == "negative" and got[2].sentiment == "positive"


def test_lexicon_table_agrees_with_weights(spark):
    rows = spark.createDataFrame([(1, "awful awful fine"), (2, "x"), (3, None)], "id int, text string")
    lexicon = spark.createDataFrame([("awful", -2.0), ("fine", 0.5), ("rare", 9.0)], "word string, weight double")
    a = {r.id: r.sentiment_score for r in s.compound_sentiment_from_table(rows, "id", "text", lexicon).collect()}
    b = {r.id: r.sentiment_score for r in s.compound_sentiment(
        rows, "text", {"awful": -2.0, "fine": 0.5, "rare": 9.0}).collect()}
    assert a == pytest.approx(b)


def test_user_scorer_may_be_an_arrow_udf(spark):
    @F.pandas_udf("double")
    def shout(texts: pd.Series) -> pd.Series:
        return texts.str.count("!") / 10.0
    rows = spark.createDataFrame([("hey!",), ("calm",)], "text string")
    got = [r.sentiment for r in s.compound_sentiment(rows, "text", scorer=shout).collect()]
    assert got == ["positive", "neutral"]


def test_first_match_follows_declared_order(spark):
    rows = spark.createDataFrame([("Galaxy Watch by Apple",), ("php said",), (None,)], "text string")
    got = tx.tag(rows, "text", TAXONOMIES).collect()
    assert (got[0].brand, got[0].product, got[0].topic) == ("apple", "galaxy", "smartwatch")
    assert (got[1].brand, got[1].topic) == ("hp", "ai")  # substrings, not words
    assert (got[2].brand, got[2].product, got[2].topic) == (None, None, None)


def test_word_match(one):
    assert one(tx.match_first(F.col("v"), vocab.BRANDS, match="word"), v="php") is None
    assert one(tx.match_first(F.col("v"), vocab.BRANDS, "other", "word"), v="my HP!") == "hp"


def test_match_all_keeps_order(one):
    got = one(tx.match_all(F.col("v"), vocab.BRANDS), v="galaxy or iphone or hp")
    assert got == ["apple", "samsung", "hp"]


def test_experience(one):
    assert one(tx.experience_type(F.col("v")), v="So I GOT one") == "personal_experience"
    assert one(tx.experience_type(F.col("v").cast("string")), v=None) == "opinion"


def test_taxonomy_sizes():
    assert (len(vocab.BRANDS), len(vocab.PRODUCTS), len(vocab.TOPICS)) == (33, 14, 14)
    assert (len(vocab.POSITIVE_WORDS_BILINGUAL), len(vocab.NEGATIVE_WORDS_BILINGUAL)) == (21, 20)


def test_table_lexicon_matches_whatever_the_case(spark):
    rows = spark.createDataFrame([("1", "Good GOOD day"), ("2", "none")], "id string, text string")
    lexicon = spark.createDataFrame([("Good", 2.0)], "word string, weight double")
    got = {r.id: r.sentiment_score for r in s.compound_sentiment_from_table(rows, "id", "text", lexicon).collect()}
    assert got["1"] > 0 and got["2"] == 0
