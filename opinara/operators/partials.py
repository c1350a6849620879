"""Roll-ups kept up to date by adding stored partial measures.

A batch leaves, per week and group, partials that can be added: counts, sums, extremes, sketches of
distinct values. They are stored per batch, so a repeated batch replaces its own; a roll-up is
the sum over the batches, and the rows behind it are never read again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from opinara.functions.dates import with_iso_week
from opinara.operators.rollups import LABELS, share_measures
from opinara.sources.writers import stored_table

#: Buckets of a distinct sketch as a power of two. The standard error is 1.04 / sqrt(2^12), 1.6 percent.
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


@dataclass(frozen=True)
class Partial:
    """What a batch stores for a group, and how stored values are added."""

    of_rows: Callable[[], Column]
    add: Callable[[str], Column]


def counted(where: str = "true") -> Partial:
    """Rows for which a SQL condition holds."""
    return Partial(lambda: F.count_if(F.expr(where)), F.sum)


def summed(col: str) -> Partial:
    return Partial(lambda: F.sum(col), F.sum)


def least(col: str) -> Partial:
    return Partial(lambda: F.min(col), F.min)


def greatest(col: str) -> Partial:
    return Partial(lambda: F.max(col), F.max)


def distinct_sketch(col: str, bits: int = SKETCH_BITS) -> Partial:
    """An approximate set of the values; ``hll_sketch_estimate`` tells its size. Nulls are not in it."""
    return Partial(lambda: F.hll_sketch_agg(col, bits), F.hll_union_agg)


SENTIMENT = {"mentions": counted(), "score_sum": summed("sentiment_score"),
             **{f"n_{label}": counted(f"sentiment = '{label}'") for label in LABELS}}


def store_partials(rows: DataFrame, path: str, batch: int | str, keys: list[str], measures: Mapping[str, Partial],
                   date_col: str) -> None:
    """Store a batch's partials per ISO week and ``keys``. The batch may touch any weeks, late ones too.

    What the batch stored before is replaced as a whole, also in weeks it no longer touches.
    Rows without a date are a week of their own. An empty batch stores nothing.
    """
    sums = with_iso_week(rows, date_col).groupBy("iso_year", "iso_week", *keys).agg(
        *[m.of_rows().alias(name) for name, m in measures.items()])
    (sums.write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy("iso_year", "iso_week").parquet(f"{path}/batch={batch}"))


def added(spark: SparkSession, path: str, keys: list[str], measures: Mapping[str, Partial],
          weeks: Iterable[tuple[int, int]] | None = None, by_week: bool = True) -> DataFrame | None:
    """The roll-up: partials of all batches added per week and ``keys``, or over ``weeks`` together.

    Only the partitions of ``weeks`` are read. None where nothing has been stored yet.
    """
    table = stored_table(spark, path)
    if table is None:
        return None
    if weeks is not None:
        wanted = [(F.col("iso_year") == year) & (F.col("iso_week") == week) for year, week in weeks]
        chosen = F.lit(False)
        for one in wanted:
            chosen = chosen | one
        table = table.filter(chosen)
    by = [*(["iso_year", "iso_week"] if by_week else []), *keys]
    return table.groupBy(*by).agg(*[m.add(name).alias(name) for name, m in measures.items()])


def sentiment_shares(sums: DataFrame) -> DataFrame:
    """Added ``SENTIMENT`` partials as mentions, label percentages and mean score."""
    own = [c for c in sums.columns if c not in SENTIMENT]
    return sums.select(*own, "mentions", *share_measures(
        F.col("mentions"), {label: F.col(f"n_{label}") for label in LABELS}, F.col("score_sum")))


def with_distinct(sums: DataFrame, sketch: str, name: str) -> DataFrame:
    """The sketch replaced by the number of distinct values it stands for."""
    return sums.withColumn(name, F.hll_sketch_estimate(sketch)).drop(sketch)
