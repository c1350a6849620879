"""Exact interpolated quantiles without gathering a column in one task.

The built-in exact percentile keeps every distinct value of a group in one
buffer. Here the wanted ranks are found by refinement: a histogram over the value
range of each group is counted map-side, the bucket holding each rank becomes the
next, narrower range, and only the rows inside the last ranges are looked at value
by value. Ranges are refined until they hold few rows or one value, whatever the data: a
pass narrows a range 4096-fold, so two passes do for most data and the width of a double
bounds them. What crosses the network is bounded by buckets x groups x quantiles.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from opinara.session import cut_lineage

BUCKETS = 4096
#: Rows of a range whose values are ranked one by one.
RANKED_ROWS = 20_000


def long_values(df: DataFrame, cols: list[str], by: Iterable[str] = ()) -> DataFrame:
    """(by..., metric, value) rows, nulls left out."""
    by = list(by)
    numbers = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols])
    return (numbers.unpivot(by, list(cols), "metric", "value")
            .filter(F.col("value").isNotNull() & ~F.isnan("value")))


def numbered_values(df: DataFrame, cols: list[str], by: list[str]) -> DataFrame:
    """The same with ``_m``, the metric's number, for its name: a whole number joins faster."""
    pairs = [x for i, c in enumerate(cols) for x in (F.lit(i).cast("bigint"), F.col(c).cast("double"))]
    return (df.select(*by, F.stack(F.lit(len(cols)), *pairs).alias("_m", "value"))
            .filter(F.col("value").isNotNull() & ~F.isnan("value")))


def _bucket(scaled: bool) -> Column:
    """Bucket of a value in its range, ``lo`` to ``hi``: the ends fall in the first and last.

    ``scaled`` spreads the buckets by magnitude, for ranges over many of them; a range
    that has come out of such a bucket is divided evenly.
    """
    scale = (lambda v: F.signum(v) * F.log1p(F.abs(v))) if scaled else (lambda v: v)
    lo = scale(F.col("lo"))
    place = (scale(F.col("value")) - lo) / (scale(F.col("hi")) - lo) * BUCKETS
    return F.when(F.col("lo") == F.col("hi"), 0).otherwise(
        F.least(F.floor(place), F.lit(BUCKETS - 1))).cast("int")


def _same_group(keys: list[str], left: str, right: str) -> Column:
    condition = F.col(f"{left}._m") == F.col(f"{right}._m")  # never null
    for key in keys:
        if key != "_m":
            condition = condition & F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}"))
    return condition


def _inside(values: DataFrame, ranges: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that fall in a range of their group; the ranges of a group are disjoint.

    There are at most two ranges per group and quantile; the join is planned from the size
    they were written with.
    """
    joined = values.alias("v").join(
        ranges.alias("r"), _same_group(keys, "v", "r")
        & (F.col("v.value") >= F.col("r.lo")) & (F.col("v.value") <= F.col("r.hi")))
    return joined.select("r.*", F.col("v.value").alias("value"))


def _ranks(probs: Column) -> Column:
    """Ranks next to each wanted place among ``n`` rows."""
    last = F.col("n") - 1
    return F.array_distinct(F.concat(F.transform(probs, lambda p: F.floor(p * last)),
                                     F.transform(probs, lambda p: F.ceil(p * last))))


def _holding(counted: DataFrame, group: list[str], order: str, probs: Column) -> DataFrame:
    """Buckets that hold a wanted rank, with the rows below them and those ranks."""
    running = Window.partitionBy(*group).orderBy(order)
    before = F.col("below") + F.sum("rows").over(running) - F.col("rows")
    return (
        counted.withColumn("below", before)
        .withColumn("ranks", F.filter(_ranks(probs), lambda r: (r >= F.col("below"))
                                      & (r < F.col("below") + F.col("rows"))))
        .filter(F.size("ranks") > 0)
    )


def _between(low: Column, high: Column, share: Column) -> Column:
    """Linear interpolation; an infinite neighbour gives infinity, equal ones themselves."""
    return (F.when((low == high) | (low == F.lit(float("-inf"))) & (high < F.lit(float("inf"))), low)
            .otherwise(low + (high - low) * share))


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float],
                    by: Iterable[str] = ()) -> DataFrame:
    """Rows ``(by..., metric, p, value, n)``, interpolated linearly between ranks.

    Infinite values count at their ends; nulls and NaN do not.
    """
    by = list(by)
    keys = [*by, "_m"]
    values = numbered_values(df, cols, by)
    finite = F.abs(F.col("value")) < F.lit(float("inf"))
    names = F.array(*[F.lit(c) for c in cols])
    wanted = F.array(*[F.lit(float(p)) for p in probs])

    def count(inside: DataFrame, place: str) -> DataFrame:
        # a range is told by its lower end; what else belongs to it comes along as a maximum
        return inside.groupBy(*keys, "lo", place).agg(
            F.count(F.lit(1)).alias("rows"), F.max("n").alias("n"), F.max("below").alias("below"),
            F.min("value").alias("first"), F.max("value").alias("final"))

    groups = cut_lineage(values.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("value") == F.lit(float("-inf"))).alias("below"),
        F.count_if(finite).alias("rows"), F.min(F.when(finite, F.col("value"))).alias("lo"),
        F.max(F.when(finite, F.col("value"))).alias("hi")))
    ranges, scaled = groups.filter("rows > 0").select(*keys, "n", "lo", "hi", "below"), True
    values = values.filter(finite)
    while True:
        inside = _inside(values, ranges, keys).withColumn("bucket", _bucket(scaled))
        ranges = cut_lineage(_holding(count(inside, "bucket"), [*keys, "lo"], "bucket", wanted).select(
            *keys, "n", F.col("first").alias("lo"), F.col("final").alias("hi"), "below", "rows"))
        widest, scaled = ranges.filter("lo < hi").agg(F.max("rows")).first()[0], False
        ranges = ranges.drop("rows")
        if (widest or 0) <= RANKED_ROWS:
            break
    counted = count(_inside(values, ranges, keys).withColumn("exact", F.col("value")), "exact")
    found = _holding(counted, [*keys, "lo"], "exact", wanted).select(
        *keys, "n", F.col("exact").alias("value"), F.explode("ranks").alias("rank"))
    ends = groups.withColumn("rank", F.explode(_ranks(wanted))).filter(
        (F.col("rank") < F.col("below")) | (F.col("rank") >= F.col("below") + F.col("rows"))).select(
        *keys, "n", F.when(F.col("rank") < F.col("below"), float("-inf")).otherwise(float("inf")).alias("value"), "rank")
    place = F.col("p") * (F.col("n") - 1)
    return (
        found.unionByName(ends).withColumn("p", F.explode(wanted)).withColumn("place", place)
        .filter((F.col("rank") == F.floor("place")) | (F.col("rank") == F.ceil("place")))
        .groupBy(*keys, "p", "n", "place")
        .agg(F.min_by("value", "rank").alias("low"), F.max_by("value", "rank").alias("high"))
        .select(*by, F.get(names, F.col("_m").cast("int")).alias("metric"), "p",
                _between(F.col("low"), F.col("high"), F.col("place") - F.floor("place")).alias("value"), "n")
    )


def quantile_columns(df: DataFrame, cols: list[str], names: dict[str, float],
                     by: Iterable[str] = ()) -> DataFrame:
    """The same as one row per group and metric, a column per named quantile."""
    by = list(by)
    long = exact_quantiles(df, cols, sorted(set(names.values())), by)
    return long.groupBy(*by, "metric").agg(
        F.max("n").alias("n"),
        *[F.max(F.when(F.col("p") == F.lit(float(p)), F.col("value"))).alias(name)
          for name, p in names.items()])
