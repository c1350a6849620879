from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from opinara import vocab
from opinara.functions import text as x


def test_clean_nlp(one):
    raw = "Hi @niño see http://x.y/z <b>ok</b>  now"
    assert one(x.clean_text(F.col("v")), v=raw) == "Hi see ok now"


def test_clean_nlp_keeps_a_tag_over_a_newline(one):
    assert one(x.clean_text(F.col("v")), v="x<a\nb>y") == "x<a b>y"


def test_clean_nlp_null_and_unicode_blanks(one):
    assert one(x.clean_text(F.col("v").cast("string")), v=None) == ""
    assert one(x.clean_text(F.col("v")), v="a  b\u0085c\x1cd\x0be") == "a b c d e"


def test_clean_nlp_url_without_scheme(one):
    assert one(x.clean_text(F.col("v")), v="go www.a.b/c?d=1 now") == "go now"


def test_clean_eda(one):
    assert one(x.clean_text(F.col("v"), "eda"), v="#big @you https://a.b/c <b>") == "big <b>"


def test_clean_full(one):
    raw = "The #Battery's life: it IS great!! @me http://a.b"
    assert one(x.clean_text(F.col("v"), "full"), v=raw) == "battery's life great"


def test_keyword_tokens_drop_blanks(one):
    got = one(x.keyword_tokens(F.col("v")), v=" #tag Foo, BAR-baz <i>x</i> @me www.a.b é1")
    assert got == ["foo", "bar", "baz", "x", "é1"]


def test_bigrams_have_no_empty_token(one):
    assert one(x.ngrams(x.keyword_tokens(F.col("v"))), v=" foo bar baz") == ["foo bar", "bar baz"]
    assert one(x.ngrams(x.keyword_tokens(F.col("v"))), v="foo") == []
    assert one(x.ngrams(x.keyword_tokens(F.col("v")), 3), v="a b c d") == ["a b c", "b c d"]


def test_stop_words_keep_duplicates(one):
    got = one(x.remove_stop_words(F.split("v", " ")), v="The phone the phone de la")
    assert got == ["phone", "phone"]


def test_stop_words_equal_sparks(spark):
    assert vocab.ENGLISH_STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")


def test_language_vote(one):
    say = lambda v: one(x.detect_language(F.col("v")), v=v)
    assert say("the phone is good") == "en"
    assert say("que la pantalla es") == "es"
    assert say("pantalla rápida") == "es"
    assert say("qwerty") == "unknown"
    assert say("") == "unknown"
    # counted without overlap: " the the the " holds " the " twice, " la la " holds " la " once
    assert say("the the the la que") == "en"
    assert say("the la") == "en"


def test_quote_and_capitalize(one):
    assert one(x.quote(F.col("v"), 5), v="abcdefg") == '"abcde..."'
    assert one(x.quote(F.col("v"), 5), v="abc") == '"abc"'
    assert one(x.quote(F.col("v"), 5), v=" NaN ") is None
    assert one(x.capitalize(F.col("v")), v="gALAXY watch") == "Galaxy watch"


def test_lengths_count_code_points(one):
    assert one(x.text_length(F.col("v")), v="a😎é") == 3


def test_to_text(one):
    assert one(x.to_text(F.array(F.lit("a"), F.lit(None), F.lit("b")), is_array=True), v=1) == "a b"
    assert one(x.to_text(F.col("v").cast("string")), v=None) == ""


def test_first_text(one):
    assert one(x.first_text(F.lit("  "), F.lit(None).cast("string"), F.lit("z")), v=1) == "z"
