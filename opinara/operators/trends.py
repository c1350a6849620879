"""Volumes over time, daily sentiment, alerts, shares, rankings.

Windows here run over aggregated frames (one row per day and group), never over
the raw records.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from opinara.operators.rollups import row_total, sentiment_measures, with_share


def volume_trend(df: DataFrame, by: str, date_col: str, cumulative: bool = False) -> DataFrame:
    """Records per day and source, optionally with the running total of each source."""
    daily = df.groupBy(F.col(date_col).cast("date").alias("period"), by).agg(
        F.count(F.lit(1)).alias("n_records"))
    if not cumulative:
        return daily
    upto = Window.partitionBy(by).orderBy("period").rowsBetween(Window.unboundedPreceding, 0)
    return daily.withColumn("cumulative_records", F.sum("n_records").over(upto))


def moving_average(daily: DataFrame, by: Iterable[str], value: str, days: int = 7,
                   order: str = "period", name: str = "moving_avg") -> DataFrame:
    """Mean over the last ``days`` observed days of each group."""
    window = Window.partitionBy(*by).orderBy(order).rowsBetween(-(days - 1), 0)
    return daily.withColumn(name, F.avg(value).over(window))


def daily_sentiment(df: DataFrame, date_col: str = "date_day") -> DataFrame:
    """Sentiment shares and mentions per day, source and brand."""
    rows = df.filter(F.col(date_col).isNotNull() & F.col("brand").isNotNull())
    return rows.groupBy(F.col(date_col).cast("date").alias("date_day"), "source", "brand").agg(
        F.count(F.lit(1)).alias("mentions"), *sentiment_measures())


def daily_trend_all(daily: DataFrame, weighted: bool = False) -> DataFrame:
    """The same over all brands: plain mean of the brand shares, or weighted by mentions."""
    def mean(c: str) -> Column:
        if weighted:
            return F.sum(F.col(c) * F.col("mentions")) / F.sum("mentions")
        return F.avg(c)
    return daily.groupBy("date_day", "source").agg(
        *[mean(c).alias(c) for c in ("positive_pct", "negative_pct", "neutral_pct")],
        F.sum("mentions").alias("mentions"))


# Order in which alerts are shown.
SEVERITY_ORDER = {"critical": 0, "warning": 1, "info": 2}


def sentiment_alerts(trend: DataFrame, threshold: float = 15.0, critical: float = 25.0,
                     recovery_below: float = 40.0, calendar_days: bool = False) -> DataFrame:
    """Day-over-day jumps of the negative share, and recoveries of the positive one.

    A day is compared with the group's previous observed day; ``calendar_days`` asks
    for the day before. One day can raise both alerts. Percentages are compared at
    one decimal, as the trend table shows them.
    """
    window = Window.partitionBy("brand", "source").orderBy("date_day")
    days = trend.select("brand", "source", "date_day",
                        F.round("negative_pct", 1).alias("curr_neg"),
                        F.round("positive_pct", 1).alias("curr_pos")).withColumns({
        "prev_neg": F.lag("curr_neg").over(window),
        "prev_pos": F.lag("curr_pos").over(window),
        "prev_day": F.lag("date_day").over(window),
    })
    if calendar_days:
        days = days.filter(F.datediff("date_day", "prev_day") == 1)
    # rounded, so that 40.1 - 25.1 is 15 whatever its last bit
    up_neg = F.round(F.col("curr_neg") - F.col("prev_neg"), 6)
    up_pos = F.round(F.col("curr_pos") - F.col("prev_pos"), 6)
    alert = lambda prev, curr, delta, kind, severity: F.struct(
        F.col(prev).alias("prev_pct"), F.col(curr).alias("curr_pct"),
        F.round(delta, 1).alias("delta"), F.lit(kind).alias("type"), severity.alias("severity"))
    spike = F.when(up_neg >= threshold, alert(
        "prev_neg", "curr_neg", up_neg, "negative_spike",
        F.when(up_neg >= critical, "critical").otherwise("warning")))
    recovery = F.when((up_pos >= threshold) & (F.col("prev_pos") < recovery_below), alert(
        "prev_pos", "curr_pos", up_pos, "positive_recovery", F.lit("info")))
    found = F.filter(F.array(spike, recovery), lambda a: a.isNotNull())
    return days.select("brand", "source", F.col("date_day").alias("date"), F.inline(found))


def ordered_alerts(alerts: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` cards a reader sees: most severe first, then by date; ties by brand, source and type."""
    rank = F.lit(len(SEVERITY_ORDER))
    for severity, place in SEVERITY_ORDER.items():
        rank = F.when(F.col("severity") == severity, place).otherwise(rank)
    return alerts.orderBy(rank, "date", "brand", "source", "type").limit(k)


def top_k(df: DataFrame, order: list[Column], k: int, by: list[str] | None = None) -> DataFrame:
    """First ``k`` rows, overall or within each group. End the order with a key."""
    if not by:
        return df.orderBy(*order).limit(k)
    window = Window.partitionBy(*by).orderBy(*order)
    return (df.withColumn("rank", F.row_number().over(window).cast("bigint"))
            .filter(F.col("rank") <= k))


def peak_days(df: DataFrame, date_col: str, k: int = 10) -> DataFrame:
    """Busiest days and the share of all records they hold."""
    dated = df.filter(F.col(date_col).isNotNull())
    daily = dated.groupBy(F.col(date_col).cast("date").alias("period")).agg(
        F.count(F.lit(1)).alias("n_records"))
    return with_share(daily, "n_records", row_total(dated), "share_pct").orderBy(
        F.col("n_records").desc(), "period").limit(k)
