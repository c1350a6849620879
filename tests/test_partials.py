import datetime as dt

import pytest
from pyspark.sql import functions as F

from opinara.operators import partials as p, rollups

SCHEMA = "brand string, day date, sentiment string, sentiment_score double, user long"
D = dt.date


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def batches():
    first = [("a", D(2026, 1, 1), "positive", 1.0, 1), ("a", D(2025, 12, 31), "negative", -1.0, 2), (None, D(2026, 1, 8), "neutral", 0.0, 3)]
    late = [("a", D(2025, 12, 29), "positive", 0.5, 1), ("a", None, "positive", 0.25, 4), ("b", D(2026, 1, 9), None, None, None)]
    return [first, late, [("b", D(2026, 1, 8), "negative", -0.5, 5)] * 3]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_added_batches_are_a_rebuild(spark, tmp_path):
    path = str(tmp_path / "gold")
    assert p.added(spark, path, ["brand"], p.SENTIMENT) is None
    for number in (0, 1, 2, 1):
        p.store_partials(frame(spark, batches()[number]), path, number, ["brand"], p.SENTIMENT, "day")
    every = frame(spark, [r for b in batches() for r in b])
    got = p.sentiment_shares(p.added(spark, path, ["brand"], p.SENTIMENT, by_week=False))
    want = rollups.sentiment_pcts(every, ["brand"])
    assert got.columns == want.columns and rows_of(got) == rows_of(want)
    weeks = {(r.iso_year, r.iso_week, r.brand): r.mentions for r in p.added(spark, path, ["brand"], p.SENTIMENT).collect()}
    assert weeks == {(2026, 1, "a"): 3, (2026, 2, None): 1, (None, None, "a"): 1, (2026, 2, "b"): 4}


def test_a_repeated_batch_leaves_nothing_of_what_it_was(spark, tmp_path):
    path = str(tmp_path / "gold")
    for rows in (batches()[0], batches()[2]):
        p.store_partials(frame(spark, rows), path, 7, ["brand"], p.SENTIMENT, "day")
    got = p.added(spark, path, ["brand"], p.SENTIMENT).collect()
    assert [(r.iso_week, r.brand, r.mentions) for r in got] == [(2, "b", 3)]
    p.store_partials(frame(spark, []), path, 8, ["brand"], p.SENTIMENT, "day")
    assert p.added(spark, path, ["brand"], p.SENTIMENT).count() == 1


def test_only_the_weeks_asked_for_are_read(spark, tmp_path):
    path = str(tmp_path / "gold")
    for number, rows in enumerate(batches()):
        p.store_partials(frame(spark, rows), path, number, ["brand"], p.SENTIMENT, "day")
    df = p.added(spark, path, ["brand"], p.SENTIMENT, weeks=[(2026, 2)])
    assert {r.iso_week for r in df.collect()} == {2}
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert "iso_year" in filters and "iso_week" in filters


def test_united_sketches_count_within_their_error(spark, tmp_path):
    path, measures = str(tmp_path / "gold"), {"users": p.distinct_sketch("user")}
    days = spark.range(60_000).select(
        F.lit("a").alias("brand"), F.date_add(F.lit("2026-01-01").cast("date"), F.pmod("id", F.lit(40)).cast("int")).alias("day"),
        F.pmod(F.xxhash64("id"), F.lit(20_000)).alias("user"))
    for batch in range(2):
        p.store_partials(days.filter(F.pmod("user", F.lit(2)) == batch), path, batch, ["brand"], measures, "day")
    exact = days.select("user").distinct().count()
    about = p.with_distinct(p.added(spark, path, ["brand"], measures, by_week=False), "users", "n").first().n
    assert abs(about - exact) <= 4 * p.SKETCH_ERROR * exact
    weekly = p.with_distinct(p.added(spark, path, ["brand"], measures), "users", "n").count()
    assert weekly == 7  # 1 January to 9 February


@pytest.mark.parametrize("measure, want", [(p.least("sentiment_score"), -0.5), (p.greatest("sentiment_score"), -0.5), (p.summed("user"), 15)])
def test_measures(spark, tmp_path, measure, want):
    path = str(tmp_path / "gold")
    p.store_partials(frame(spark, batches()[2]), path, 0, ["brand"], {"m": measure}, "day")
    assert p.added(spark, path, ["brand"], {"m": measure}).first().m == want
