"""Lexicon scores and labels."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from opinara import vocab
from opinara.functions.text import SPACE, bind, word_tokens

LABELS = ("positive", "negative", "neutral")


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def lexicon_score(col: Column | str, positive: Iterable[str] = vocab.POSITIVE_WORDS,
                  negative: Iterable[str] = vocab.NEGATIVE_WORDS,
                  mode: str = "per_token") -> Column:
    """Score a text by counting lexicon words; 0 where there is nothing to count.

    ``per_token``: (positive - negative) / tokens.
    ``polarity``:  (positive - negative) / (positive + negative) over distinct
                   blank-separated words.
    """
    pos, neg = set(positive), set(negative)
    text = F.coalesce(_col(col), F.lit(""))

    def only(tokens: Column, words: set[str]) -> Column:
        return F.filter(tokens, lambda t: t.isin(sorted(words)))

    def ratio(net: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(net.cast("double"), whole), F.lit(0.0))

    if mode == "per_token":
        # a word on both lists counts for neither; the rest is told apart among the hits
        up, down = pos - neg, neg - pos
        net = lambda hits: 2 * F.size(only(hits, up)) - F.size(hits)
        return bind(word_tokens(text), lambda ts: ratio(bind(only(ts, up | down), net), F.size(ts)))
    if mode == "polarity":
        words = F.split(F.lower(text), f"[{SPACE}]+")
        seen = lambda hits, which: F.size(only(hits, which))
        return bind(F.array_distinct(only(words, pos | neg)), lambda hits: ratio(
            seen(hits, pos) - seen(hits, neg), seen(hits, pos) + seen(hits, neg)))
    raise ValueError(f"unknown mode {mode!r}")


def sentiment_label(score: Column | str, positive: float = 0.05, negative: float = -0.05,
                    inclusive: bool = True) -> Column:
    """Positive, negative or neutral by two bounds."""
    value = _col(score)
    up = value >= positive if inclusive else value > positive
    down = value <= negative if inclusive else value < negative
    return F.when(up, "positive").when(down, "negative").otherwise("neutral")


def weight_sum(tokens: Column, weights: Mapping[str, float]) -> Column:
    """Sum of the weights of all tokens.

    One hash lookup drops the tokens without a weight. Words are grouped by weight, so
    each of the others costs a lookup per distinct weight, however long the lexicon.
    """
    classes: dict[float, list[str]] = defaultdict(list)
    for word, weight in weights.items():
        classes[float(weight)].append(word)

    def weight_of(token: Column) -> Column:
        chosen = F.lit(0.0)
        for weight, words in sorted(classes.items()):
            chosen = F.when(token.isin(sorted(words)), F.lit(weight)).otherwise(chosen)
        return chosen

    weighted = F.filter(tokens, lambda t: t.isin(sorted(weights)))
    return F.aggregate(weighted, F.lit(0.0), lambda total, t: total + weight_of(t))


def normalized(total: Column, alpha: float = 15.0) -> Column:
    """Squash a weight sum into [-1, 1]: s / sqrt(s^2 + alpha)."""
    return total / F.sqrt(total * total + F.lit(alpha))


def score_columns(df: DataFrame, score: Column, bounds: tuple[float, float] = (0.05, -0.05),
                  inclusive: bool = True) -> DataFrame:
    """Add the signed score, its intensity and its label."""
    return df.withColumn("sentiment_score", score).withColumns({
        "sentiment_intensity": F.abs("sentiment_score"),
        "sentiment": sentiment_label("sentiment_score", *bounds, inclusive=inclusive),
    })


def compound_sentiment(df: DataFrame, text: str, weights: Mapping[str, float] | None = None,
                       scorer=None) -> DataFrame:
    """Compound score of every row, without a shuffle.

    ``weights`` is a word -> weight mapping. ``scorer`` replaces it: any function
    from Column to Column, for instance an Arrow UDF around another analyzer.
    """
    if scorer is None:
        if weights is None:
            raise ValueError("give weights or a scorer")
        tokens = word_tokens(F.coalesce(F.col(text), F.lit("")))
        score = normalized(weight_sum(tokens, weights))
    else:
        score = scorer(F.col(text))
    return score_columns(df, score)


#: Parts into which every word's tokens are dealt, so that a frequent word is no single key.
WORD_PARTS = 32


def compound_sentiment_from_table(df: DataFrame, row_id: str, text: str,
                                  lexicon: DataFrame) -> DataFrame:
    """Compound score with the lexicon ``(word, weight)`` held in a table of any size.

    Words match whatever their case. Rows of one ``row_id`` are one text to the sum: give a
    unique id. Every lexicon row is repeated per part and a token joins the part of its row,
    so a word that is in every text spreads over the parts; the weights of a text are summed
    map-side and one (id, sum) row per text and part crosses the shuffle.
    """
    words = lexicon.groupBy(F.lower("word").alias("word")).agg(F.max("weight").cast("double").alias("weight"))
    words = words.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(WORD_PARTS - 1))))
    part = F.pmod(F.xxhash64(row_id), F.lit(WORD_PARTS)).cast("int")
    hits = (
        df.select(row_id, part.alias("_part"), F.explode(word_tokens(text)).alias("word"))
        .join(words, ["word", "_part"])
        .groupBy(row_id).agg(F.sum("weight").alias("_total"))
    )
    joined = df.join(hits, row_id, "left")
    return score_columns(joined, normalized(F.coalesce("_total", F.lit(0.0)))).drop("_total")
