"""Column selection, renaming, coercion, completeness, canonical records."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from opinara import vocab
from opinara.functions.text import has_text


def select_existing(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Those of the wanted columns that exist, in the wanted order, each once."""
    wanted = dict.fromkeys(names)
    return df.select(*[c for c in wanted if c in df.columns])


def select_by_pattern(df: DataFrame, parts: Iterable[str], keep: Iterable[str] = ()) -> DataFrame:
    """``keep`` plus every column whose lower-cased name contains one of ``parts``."""
    parts = [p.lower() for p in parts]
    matching = [c for c in df.columns if any(p in c.lower() for p in parts)]
    return select_existing(df, [*keep, *matching])


def canonicalise(df: DataFrame, aliases: Mapping[str, Iterable[str]]) -> DataFrame:
    """Rename to each canonical name the first of its aliases that exists."""
    renames = {}
    for target, candidates in aliases.items():
        if target in df.columns:
            continue
        found = next((c for c in candidates if c in df.columns), None)
        if found is not None:
            renames[found] = target
    return df.withColumnsRenamed(renames) if renames else df


def coerce(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast where the value allows it; what does not parse becomes null."""
    return df.withColumns({
        c: F.col(c).cast("string").try_cast(kind) for c, kind in types.items() if c in df.columns
    })


def first_available(*cols: Column | str) -> Column:
    return F.coalesce(*cols)


def completeness(df: DataFrame, name: str = "completeness") -> DataFrame:
    """Number of non-null fields of each row."""
    flags = [F.col(f"`{c}`").isNotNull().cast("bigint") for c in df.columns]
    return df.withColumn(name, sum(flags[1:], flags[0]))


def total_engagement(parts: Iterable[str] = vocab.ENGAGEMENT_PARTS,
                     null_as_zero: bool = True) -> Column:
    """Sum of the engagement counters. Without ``null_as_zero`` one null voids the sum."""
    terms = [F.coalesce(F.col(p), F.lit(0)) if null_as_zero else F.col(p) for p in parts]
    return sum(terms[1:], terms[0])


def multimodal_records(df: DataFrame, ids: list[str], dates: list[str], raw_texts: list[str],
                       clean_texts: list[str], entity: str = "record_type",
                       keep: Iterable[str] = ()) -> DataFrame:
    """One schema for records of different kinds: the first available id, date and text."""
    def chain(cols: list[str], kind: str) -> Column:
        present = [F.col(c).cast(kind) for c in cols if c in df.columns]
        return F.coalesce(*present) if present else F.lit(None).cast(kind)

    entity_col = F.col(entity) if entity in df.columns else F.lit(None).cast("string")
    return df.select(
        chain(ids, "string").alias("gold_record_id"),
        F.coalesce(entity_col, F.lit("unknown")).alias("gold_entity"),
        chain(dates, "timestamp").alias("gold_event_datetime"),
        chain(dates, "timestamp").cast("date").alias("gold_event_date"),
        chain(raw_texts, "string").alias("gold_text_raw"),
        chain(clean_texts, "string").alias("gold_text_clean"),
        has_text(chain(clean_texts, "string")).alias("gold_has_text"),
        F.lit("record_level_multimodal").alias("gold_grain"),
        *[c for c in keep if c in df.columns],
    )
