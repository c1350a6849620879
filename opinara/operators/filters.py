"""Row filters, null policies, capping, noise."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from opinara import vocab
from opinara.functions.dates import week_bounds
from opinara.functions.text import MENTION, SPACE
from opinara.operators.quantiles import exact_quantiles


def filter_week(df: DataFrame, date_col: str, year: int, week: int) -> DataFrame:
    """Rows of one ISO week, as a range on the date itself so that it reaches the scan."""
    start, end = week_bounds(year, week)
    return df.filter((F.col(date_col) >= F.lit(start)) & (F.col(date_col) < F.lit(end)))


def not_blank(col: Column | str) -> Column:
    value = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.length(F.regexp_replace(value, f"[{SPACE}]+", "")) > 0, F.lit(False))


def drop_blank(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop rows where any of the columns is null or only white space."""
    return df.filter(reduce(lambda a, b: a & b, [not_blank(c) for c in cols]))


def min_length(df: DataFrame, col: str, n: int = 20) -> DataFrame:
    """Texts longer than ``n`` characters."""
    return df.filter(F.length(col) > n)


def split_entities(df: DataFrame, tweet_key: str = "id",
                   news_key: str = "newsLink") -> tuple[DataFrame, DataFrame]:
    """Rows of a mixed table by the key they carry."""
    return df.filter(F.col(tweet_key).isNotNull()), df.filter(F.col(news_key).isNotNull())


def select_slice(df: DataFrame, source: str = "all", brand: str = "all",
                 source_col: str = "source", brand_col: str = "brand") -> DataFrame:
    """One source, one brand, or everything."""
    if source != "all":
        df = df.filter(F.col(source_col) == source)
    if brand != "all":
        df = df.filter(F.col(brand_col) == brand)
    return df


def apply_null_policy(df: DataFrame, drop: Iterable[str] = (), fill: Mapping | None = None
                      ) -> DataFrame:
    """Drop rows that lack a required field, fill the optional ones."""
    present = [c for c in drop if c in df.columns]
    if present:
        df = df.na.drop(subset=present)
    fill = {c: v for c, v in (fill or {}).items() if c in df.columns}
    return df.na.fill(fill) if fill else df


def cap_at_percentile(df: DataFrame, cols: list[str], p: float = 0.99,
                      suffix: str = "_capped") -> DataFrame:
    """Cap each column at its exact percentile, found by distributed selection."""
    caps = exact_quantiles(df, cols, [p]).agg(
        F.map_from_entries(F.collect_list(F.struct("metric", "value"))).alias("caps")).scalar()

    def cap(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.least(F.col(c).cast("double"), caps[c]))

    return df.withColumns({c + suffix: cap(c) for c in cols})


def noise_rates(df: DataFrame, text: str, lang: str, target: str = "en") -> DataFrame:
    """Share of texts with a URL, with a mention, in another language."""
    def share(flag: Column) -> Column:
        return F.avg(F.when(flag, 1.0).otherwise(0.0))
    return df.agg(
        F.count(F.lit(1)).alias("records"),
        share(F.col(text).rlike(r"https?://|www\.")).alias("url_share"),
        share(F.col(text).rlike(MENTION)).alias("mention_share"),
        share(F.col(lang) != target).alias("other_language_share"),
    )


def drop_noise(df: DataFrame, col: str, texts: Iterable[str] = vocab.NOISE_TEXTS,
               prefix: str | None = vocab.QUOTED_REPLY_PREFIX) -> DataFrame:
    """Drop placeholder texts and strip the quoted-reply prefix."""
    kept = df.filter(F.coalesce(~F.lower(F.trim(col)).isin(list(texts)), F.lit(True)))
    return kept.withColumn(col, F.regexp_replace(col, prefix, "")) if prefix else kept
