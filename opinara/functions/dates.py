"""Dates from mixed encodings, ISO weeks, periods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

DIGITS = r"^[0-9]+$"
# "Thu Mar 19 19:11:50 +0000 2026" without its weekday, which the parser rejects.
POST_FORMAT = "MMM dd HH:mm:ss Z yyyy"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def from_epoch_ms(col: Column | str) -> Column:
    """Digits (possibly with a fraction) as milliseconds since 1970; null when they are not."""
    return F.timestamp_millis(_col(col).try_cast("double").cast("decimal(20,0)").try_cast("bigint"))


def safe_date(col: Column | str) -> Column:
    """Epoch milliseconds or an ISO string as a date; anything else is null."""
    text = _col(col).cast("string")
    return F.when(text.rlike(DIGITS),
                  F.timestamp_millis(text.try_cast("bigint")).cast("date")
                  ).otherwise(F.substring(text, 1, 10).try_cast("date"))


def event_timestamp(col: Column | str) -> Column:
    """Timestamp from epoch milliseconds, the social-post format or an ISO string."""
    text = _col(col).cast("string")
    return (
        F.when(text.rlike(DIGITS), F.timestamp_millis(text.try_cast("bigint")))
        .otherwise(F.coalesce(
            F.try_to_timestamp(F.substring(text, 5, 2**31 - 1), F.lit(POST_FORMAT)),
            text.try_cast("timestamp"),
        ))
    )


def normalize_event_date(df: DataFrame, created: str = "createdAt",
                         snapshot: str = "snapshot_date", name: str = "event_date") -> DataFrame:
    """Date of the record itself, else of the snapshot it came with."""
    candidates = [event_timestamp(c).cast("date") for c in (created, snapshot) if c in df.columns]
    return df.withColumn(name, F.coalesce(*candidates))


def parse_mixed_datetime(df: DataFrame, col: str, name: str, ratio: float = 0.8) -> DataFrame:
    """Read a column as epoch milliseconds when more than ``ratio`` of it is numeric,
    else as date strings. The share is one scalar aggregate over the whole column."""
    numeric = F.col(col).cast("string").try_cast("double")
    share = df.agg(F.avg(F.when(numeric.isNotNull(), 1.0).otherwise(0.0)).alias("share")).scalar()
    return df.withColumn(name, F.when(share > ratio, from_epoch_ms(F.col(col).cast("string")))
                         .otherwise(F.col(col).cast("string").try_cast("timestamp")))


def first_datetime(*cols: Column | str) -> Column:
    """First column that parses as a timestamp."""
    return F.coalesce(*[event_timestamp(c) for c in cols])


def coerce_datetimes(df: DataFrame, cols: list[str]) -> DataFrame:
    """Parse the named columns where they exist; what does not parse becomes null."""
    return df.withColumns({c: event_timestamp(c) for c in cols if c in df.columns})


def iso_year(col: Column | str) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), _col(col)).cast("int")


def iso_week(col: Column | str) -> Column:
    return F.weekofyear(_col(col))


def with_iso_week(df: DataFrame, date_col: str) -> DataFrame:
    """Both halves of the ISO week: the number alone mixes years."""
    return df.withColumns({"iso_year": iso_year(date_col), "iso_week": iso_week(date_col)})


def period(col: Column | str) -> Column:
    return F.date_format(_col(col), "yyyy-MM-dd")


def week_bounds(year: int, week: int):
    """First day of an ISO week and of the next one."""
    from datetime import date, timedelta
    start = date.fromisocalendar(year, week, 1)
    return start, start + timedelta(days=7)
