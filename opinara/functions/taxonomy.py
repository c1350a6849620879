"""Tagging texts with ordered keyword taxonomies."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from opinara import vocab

Taxonomy = Mapping[str, Iterable[str]]


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _escape(keyword: str) -> str:
    return "".join(c if c.isalnum() or c in " _" else "\\" + c for c in keyword)


def keyword_hit(lowered: Column, keywords: Iterable[str], match: str = "substring") -> Column:
    """True where any keyword occurs in an already lower-cased text."""
    keywords = list(keywords)
    if match == "substring":
        hits = [lowered.contains(k) for k in keywords]
        found = hits[0]
        for hit in hits[1:]:
            found = found | hit
        return found
    if match == "word":
        joined = "|".join(_escape(k) for k in keywords)
        return lowered.rlike(rf"(?<![\p{{L}}\p{{N}}_])(?:{joined})(?![\p{{L}}\p{{N}}_])")
    raise ValueError(f"unknown match {match!r}")


def first_match_lowered(lowered: Column, taxonomy: Taxonomy, default: str | None = None,
                        match: str = "substring") -> Column:
    chosen = F.lit(default).cast("string")
    for key, keywords in reversed(list(taxonomy.items())):
        chosen = F.when(keyword_hit(lowered, keywords, match), F.lit(key)).otherwise(chosen)
    return chosen


def match_first(col: Column | str, taxonomy: Taxonomy, default: str | None = None,
                match: str = "substring") -> Column:
    """Key of the first taxonomy entry, in declared order, that occurs in the text."""
    return first_match_lowered(F.lower(F.coalesce(_col(col), F.lit(""))), taxonomy, default, match)


def match_all(col: Column | str, taxonomy: Taxonomy, match: str = "substring") -> Column:
    """All keys that occur in the text, in declared order."""
    lowered = F.lower(F.coalesce(_col(col), F.lit("")))
    keys = [F.when(keyword_hit(lowered, kws, match), F.lit(key)) for key, kws in taxonomy.items()]
    return F.filter(F.array(*keys), lambda k: k.isNotNull())


def experience_type(col: Column | str, phrases: Iterable[str] = vocab.EXPERIENCE_PHRASES) -> Column:
    """Personal experience or opinion; a missing text is an opinion."""
    lowered = F.lower(F.coalesce(_col(col), F.lit("")))
    return F.when(keyword_hit(lowered, phrases), "personal_experience").otherwise("opinion")


def tag(df: DataFrame, text: str, taxonomies: Mapping[str, Taxonomy],
        match: str = "substring") -> DataFrame:
    """First match of several taxonomies at once; the text is lower-cased one time."""
    lowered = df.withColumn("_lowered", F.lower(F.coalesce(F.col(text), F.lit(""))))
    return lowered.withColumns({
        name: first_match_lowered(F.col("_lowered"), taxonomy, match=match)
        for name, taxonomy in taxonomies.items()
    }).drop("_lowered")
