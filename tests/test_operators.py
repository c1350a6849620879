import datetime as dt

import pytest
from pyspark.sql import functions as F

from opinara import vocab
from opinara.functions import nested
from opinara.operators import filters, identity, profile, quality, quantiles, rollups, shape, story, trends

DAY = lambda n: dt.date(2026, 5, n)


# ---- shape and nested

def test_flatten_joins_names(spark):
    df = spark.sql("select named_struct('b', named_struct('c', 1, 'd', array(2)), 'e', 'x') a, 5 f")
    assert nested.flatten(df).columns == ["a_b_c", "a_b_d", "a_e", "f"]


def test_nested_to_json_keeps_nulls(spark):
    df = spark.sql("select named_struct('a', cast(null as int), 'b', 'é') s, array('x') l, 1 n")
    row = nested.nested_to_json(df).first()
    assert (row.s, row.l, row.n) == ('{"a":null,"b":"é"}', '["x"]', 1)


@pytest.mark.parametrize("raw, want", [
    ('["a", null, "b"]', ["a", "b"]), ("['a', 'b']", ["a", "b"]), ("not a list", []), (None, []),
    ("[]", []), ('{"a": 1}', []), ("[1, 2]", ["1", "2"]),
])
def test_parse_comments(spark, raw, want):
    df = spark.createDataFrame([(raw,)], "c string")
    assert df.select(nested.parse_comments("c").alias("r")).first().r == want


def test_expand_falls_back_to_snapshot_rows(spark):
    got = nested.expand_entities(spark.createDataFrame([(1,)], "a int"))
    assert got.first().record_type == "snapshot"


def test_select_existing_and_pattern(spark):
    df = spark.createDataFrame([(1, 2, 3)], "id int, likeCount int, other int")
    assert shape.select_existing(df, ["likeCount", "absent", "id", "id"]).columns == ["likeCount", "id"]
    assert shape.select_by_pattern(df, ["LIKE"], keep=["id"]).columns == ["id", "likeCount"]


def test_canonicalise_takes_the_first_alias(spark):
    df = spark.createDataFrame([(1, 2)], "id int, viewCount int")
    got = shape.canonicalise(df, {"tweet_id": ["tweet_id", "id"], "views": ["view_count", "viewCount"]})
    assert got.columns == ["tweet_id", "views"]


def test_engagement_null_rules(spark):
    df = spark.createDataFrame([(1, None, 2, 3)], "likeCount int, replyCount int, retweetCount int, quoteCount int")
    assert df.select(shape.total_engagement().alias("r")).first().r == 6
    assert df.select(shape.total_engagement(null_as_zero=False).alias("r")).first().r is None


# ---- filters

def test_drop_blank(spark):
    df = spark.createDataFrame([("a",), (" \n ",), (None,)], "t string")
    assert [r.t for r in filters.drop_blank(df, ["t"]).collect()] == ["a"]


def test_min_length_is_strict(spark):
    df = spark.createDataFrame([("x" * 20,), ("x" * 21,)], "t string")
    assert filters.min_length(df, "t").count() == 1


def test_week_filter_reaches_the_scan(spark, tmp_path):
    df = spark.createDataFrame([(dt.date(2025, 1, 1),), (dt.date(2024, 1, 3),)], "day date")
    df.write.parquet(str(tmp_path / "t"))
    week = filters.filter_week(spark.read.parquet(str(tmp_path / "t")), "day", 2025, 1)
    assert [r.day for r in week.collect()] == [dt.date(2025, 1, 1)]  # the other is week 1 of 2024
    plan = week._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(day), GreaterThanOrEqual(day" in plan


def test_drop_noise(spark):
    df = spark.createDataFrame([("deleted",), ("joe, 22 hours agoyes it is",), ("fine",)], "t string")
    got = [r.t for r in filters.drop_noise(df, "t").collect()]
    assert got[1:] == ["fine"] and got[0].endswith("yes it is") and len(got) == 2


# ---- quantiles

VALUES = [1.0, 2.0, 3.0, 4.0, 10.0, 50.0]


def test_exact_quartiles_interpolate(spark):
    df = spark.createDataFrame([(v,) for v in VALUES], "v double")
    got = {r.p: r.value for r in quantiles.exact_quantiles(df, ["v"], [0.25, 0.75]).collect()}
    assert got == {0.25: 2.25, 0.75: 8.5}


@pytest.mark.parametrize("method, q1, q3", [("exact", 2.25, 8.5), ("approx", 2.0, 10.0)])
def test_outlier_both_methods(spark, method, q1, q3):
    df = spark.createDataFrame([(v,) for v in VALUES] + [(None,)], "v double")
    row = quality.outlier_rate(df, ["v"], method).first()
    iqr = q3 - q1
    assert (row.lower, row.upper) == (q1 - 1.5 * iqr, q3 + 1.5 * iqr)
    assert (row.outliers, row.sample_size) == (1, 6)


def test_exact_quantiles_against_brute_force(spark):
    df = spark.sql("""select id % 3 as g, case when id % 7 = 0 then null
        when id % 2 = 0 then -pow(1.01, id % 900) else (id * 37 % 1000) / 7.0 end as v from range(5000)""")
    got = {(r.g, r.p): r.value for r in quantiles.exact_quantiles(
        df, ["v"], [0.0, 0.1, 0.5, 0.99, 1.0], by=["g"]).collect()}
    want = {(r.g, p): v for r in df.groupBy("g").agg(
        F.percentile("v", F.array(*[F.lit(p) for p in (0.0, 0.1, 0.5, 0.99, 1.0)])).alias("q")).collect()
        for p, v in zip((0.0, 0.1, 0.5, 0.99, 1.0), r.q)}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], rel=1e-12) for k in want)


def test_quantiles_of_one_value_and_of_nothing(spark):
    df = spark.createDataFrame([(7.0,)] * 5, "v double")
    assert quantiles.exact_quantiles(df, ["v"], [0.5]).first().value == 7.0
    assert quantiles.exact_quantiles(df.filter("v < 0"), ["v"], [0.5]).count() == 0


def test_cap(spark):
    df = spark.sql("select cast(id as double) v from range(101)")
    got = filters.cap_at_percentile(df, ["v"], 0.9)
    assert got.agg(F.max("v_capped")).first()[0] == 90.0


# ---- identity

def test_upsert_twice_is_once(spark):
    base = spark.createDataFrame([("a", 1, "old"), ("b", 1, "old")], "id string, at int, v string")
    new = spark.createDataFrame([("b", 2, "new"), ("c", 2, "new")], "id string, at int, v string")
    once = identity.upsert(new, base, ["id"], ["at"])
    twice = identity.upsert(new, once, ["id"], ["at"])
    want = {("a", 1, "old"), ("b", 2, "new"), ("c", 2, "new")}
    assert {tuple(r) for r in once.collect()} == {tuple(r) for r in twice.collect()} == want


def test_the_new_batch_wins_even_when_older(spark):
    base = spark.createDataFrame([("a", 9, "old")], "id string, at int, v string")
    new = spark.createDataFrame([("a", 2, "new")], "id string, at int, v string")
    assert identity.upsert(new, base, ["id"], ["at"]).first().v == "new"


def test_upsert_of_numbered_batches_is_one_upsert_after_the_other(spark):
    kinds = "id string, at int, v string, day date"
    base = spark.createDataFrame([("a", 9, "stored", None), ("z", 1, "stored", None)], kinds)
    batches = [[("a", 5, "x", None), ("b", 5, "x", None), (None, 1, "x", None)], [("a", 1, "y", None), ("a", 2, "y2", None)],
               [("b", None, "w", None), (None, 1, "p", None), (None, 1, "q", None)]]
    one_by_one = base
    for rows in batches:
        one_by_one = identity.upsert(spark.createDataFrame(rows, kinds), one_by_one, ["id"], ["at"])
    numbered = spark.createDataFrame([(*r, n) for n, rows in enumerate(batches) for r in rows], f"{kinds}, part int")
    key = lambda df: sorted(map(tuple, df.collect()), key=repr)
    at_once = identity.upsert(numbered, base, ["id"], ["at"], batch="part")
    assert at_once.columns == base.columns and key(at_once) == key(one_by_one)
    first = identity.upsert(numbered, numbered.limit(0), ["id"], ["at"], batch="part")
    assert first.columns == base.columns and key(first) == [r for r in key(one_by_one) if r[0] != "z"]


def test_input_order_does_not_matter(spark):
    rows = [("a", 1, "x"), ("a", 1, "y"), ("a", None, "z"), ("b", None, "w")]
    kinds = "id string, at int, v string"
    pick = lambda data: {tuple(r) for r in identity.latest_per_key(
        spark.createDataFrame(data, kinds).repartition(3), ["id"], [F.col("at").desc_nulls_last()]).collect()}
    assert pick(rows) == pick(rows[::-1])
    assert ("b", None, "w") in pick(rows)


def test_group_limit_runs_before_the_shuffle(spark, sf):
    df = spark.read.parquet(f"{sf}/events.parquet")
    plan = identity.latest_per_key(df, ["user_id"], [F.col("ts").desc()], total=True)._jdf \
        .queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_rank_of_a_hot_key(spark):
    df = spark.sql("""select case when id % 3 = 0 then 'hot' else cast(id % 50 as string) end k, id,
        timestamp_seconds(id * 997 % 20000) ts from range(3000)""")
    got = identity.snapshot_rank(df, "k", [F.col("ts").desc(), F.col("id").desc()], F.date_trunc("hour", "ts"))
    from pyspark.sql import Window
    want = df.withColumn("r", F.row_number().over(Window.partitionBy("k").orderBy(F.desc("ts"), F.desc("id"))))
    assert {(r.id, r.snapshot_rank) for r in got.collect()} == {(r.id, r.r) for r in want.collect()}


def test_rank_puts_undated_rows_last(spark):
    df = spark.createDataFrame([("a", 1, dt.datetime(2026, 1, 1)), ("a", 2, None), ("a", 3, dt.datetime(2026, 1, 2))],
                               "k string, id int, ts timestamp")
    got = identity.snapshot_rank(df, "k", [F.col("ts").desc_nulls_last()], F.date_trunc("day", "ts"))
    assert {r.id: r.snapshot_rank for r in got.collect()} == {3: 1, 1: 2, 2: 3}


def test_ids_native_blank_and_missing(spark):
    df = spark.createDataFrame([(" 7 ", "x"), ("", "y"), (None, "y")], "ID string, body string")
    got = identity.ensure_id(df, fingerprint_cols=["body"]).collect()
    assert got[0].tweet_id == "7" and got[0].tweet_id_origin == "native_column"
    assert got[1].tweet_id == got[2].tweet_id and got[1].tweet_id.startswith("surrogate_")
    got = identity.ensure_id(df.select("body")).collect()
    assert got[1].tweet_id == got[2].tweet_id != got[0].tweet_id


def test_dup_metrics_differ_on_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,)], "id string")
    assert quality.duplicate_rate(df, "id").first().duplicate_rows == 3
    assert quality.duplicate_rate(df, "id", null_as_value=True).first().duplicate_rows == 2


# ---- roll-ups

SCORED = "brand string, product string, topic string, sentiment string, sentiment_score double"


def test_empty_group_is_zero(spark):
    row = rollups.sentiment_pcts(spark.createDataFrame([], SCORED), []).first()
    assert (row.mentions, row.positive_pct, row.avg_score) == (0, 0.0, 0.0)


def test_modal_brand_takes_the_smallest_tie_and_skips_null(spark):
    rows = [("b", "p", None, "positive", 0.5), ("a", "p", None, "negative", -0.5), (None, "p", None, "neutral", 0.0),
            (None, "p", None, "neutral", 0.0), (None, "q", None, "neutral", 0.0)]
    got = {r["product"]: r for r in rollups.product_analytics(spark.createDataFrame(rows, SCORED)).collect()}
    assert got["p"].brand == "a" and got["p"].mentions == 4 and got["q"].brand is None


def test_pcts_sum_to_hundred_and_mentions_to_tagged_rows(spark, sf):
    from opinara.plans import tables as t
    tweets, news = t.tweets(spark, sf), t.news(spark, sf)
    got = rollups.brand_analytics(tweets, news).collect()
    tagged = tweets.filter("brand is not null").count() + news.filter("brand is not null").count()
    assert sum(r.total_mentions for r in got) == tagged
    assert all(abs(r.positive_pct + r.negative_pct + r.neutral_pct - 100) < 1e-9 for r in got)


def test_influencer_sentiment_ties(spark):
    df = spark.createDataFrame(
        [("b", "u", "5", 1, "t1", "positive"), ("b", "u", "x", None, "t2", "negative"), (None, "v", "1", 9, "t3", "neutral")],
        "brand string, author_userName string, author_followers string, total_engagement int, tweet_id string, sentiment string")
    got = rollups.top_influencers(df).collect()
    assert [tuple(r) for r in got] == [("b", "u", 5.0, 1.0, 2, "negative")]


def test_representative_comments(spark):
    rows = [("b", "short", "positive", 0.9), ("b", "x" * 400, "positive", 0.8), ("b", "y" * 30, "positive", 0.8),
            ("b", "bad" * 10, "negative", -0.2), ("b", "worse" * 10, "negative", -0.7), ("c", "z" * 30, "neutral", 0.0)]
    df = spark.createDataFrame(rows, "brand string, text string, sentiment string, sentiment_score double")
    got = {r.brand: r for r in rollups.representative_comments(df).collect()}
    assert got["b"].best_comment == "x" * 300 and got["b"].worst_comment == "worse" * 10
    assert got["c"].best_comment is None and got["c"].worst_comment is None


def test_one_row_has_no_deviation(spark):
    df = spark.createDataFrame([("positive", 0.4)], "sentiment string, sentiment_score double")
    assert rollups.kpi_score(df).first().std is None


def test_keyword_limit_is_global_or_per_source(spark):
    df = spark.createDataFrame([("a", "one one two"), ("b", "two")], "source_type string, text string")
    assert rollups.top_keywords(df, 1).count() == 1
    assert rollups.top_keywords(df, 1, "per_source").count() == 2


def test_summary_reads_texts_twice(spark, sf):
    from opinara.plans import tables as t
    df = quality.storytelling_summary(t.scored_texts(spark, sf))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    sections = {r.section for r in df.select("section").distinct().collect()}
    assert len(sections) == 8
    # two tables, each scanned by the cube, by the terms and by the record total of each
    assert plan.count("Relation [") <= 8


# ---- trends

def _trend(spark, values, column="negative_pct"):
    other = "positive_pct" if column == "negative_pct" else "negative_pct"
    rows = [("b", "s", DAY(i + 1), float(v), 0.0) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"brand string, source string, date_day date, {column} double, {other} double")


def test_negative_spikes(spark):
    got = trends.ordered_alerts(trends.sentiment_alerts(_trend(spark, [10, 25, 50]))).collect()
    assert [(r.severity, r.delta, r.date) for r in got] == [("critical", 25.0, DAY(3)), ("warning", 15.0, DAY(2))]


def test_recovery_needs_a_low_start(spark):
    alerts = lambda v: trends.sentiment_alerts(_trend(spark, v, "positive_pct")).collect()
    assert [(r.type, r.severity) for r in alerts([39, 54])] == [("positive_recovery", "info")]
    assert alerts([40, 60]) == []


def test_alerts_compare_observed_days(spark):
    rows = [("b", "s", DAY(1), 10.0, 0.0), ("b", "s", DAY(9), 40.0, 0.0)]
    trend = spark.createDataFrame(rows, "brand string, source string, date_day date, negative_pct double, positive_pct double")
    assert trends.sentiment_alerts(trend).count() == 1
    assert trends.sentiment_alerts(trend, calendar_days=True).count() == 0


def test_trend_mean_and_weighted(spark):
    rows = [(DAY(1), "s", "a", 1, 100.0, 0.0, 0.0), (DAY(1), "s", "b", 3, 0.0, 100.0, 0.0)]
    daily = spark.createDataFrame(rows, "date_day date, source string, brand string, mentions bigint, "
                                        "positive_pct double, negative_pct double, neutral_pct double")
    assert trends.daily_trend_all(daily).first().positive_pct == 50.0
    assert trends.daily_trend_all(daily, weighted=True).first().positive_pct == 25.0


# ---- KPIs

def test_kpi_thresholds_at_their_bounds(spark):
    row = spark.createDataFrame([(10, 5.0, 2.0, 95.0, 3, 7)], "total_records int, null_rate double, duplicate_rate double, "
                                "schema_compliance double, unique_languages int, total_engagement int")
    status = {r.kpi: r.status for r in quality.kpi_table(row).collect()}
    assert status == {"total_records": "INFO", "null_rate": "FAIL", "duplicate_rate": "WARNING",
                      "schema_compliance": "FAIL", "unique_languages": "INFO", "total_engagement": "INFO"}
    band = {r.kpi: r.band for r in quality.kpi_bands(row).collect()}
    assert band == {"null_rate": "Critical", "duplicate_rate": "Critical", "schema_compliance": "Minor Drift"}


def test_column_compliance_compares_names(spark):
    df = spark.createDataFrame([(1, 2)], "tweet_id int, text_length int")
    assert quality.column_compliance(df, ["tweet_id", "text"]) == 50.0


def test_absent_critical_column_is_null(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert quality.critical_null_rate([(df, ["a", "b"])]).first().null_rate == 50.0
    assert quality.critical_null_rate([(df, ["a", "b"])], absent_is_null=False).first().null_rate == 0.0


def test_catalog_demotes_sparse_columns(spark):
    rows = [("tweet_author_name", 0.92), ("tweet_author_name", 0.96), ("tweet_quoted_tweet_x", 0.94),
            ("tweet_quoted_tweet_x", 0.96), ("tweet_lang", 0.1), ("tweet_lang", 0.96), ("news_title", 0.2)]
    got = profile.classify_columns(spark.createDataFrame(rows, "column string, missing_ratio double")).collect()
    assert [r.recommendation for r in got] == [
        "Review", "Drop for Gold", "Review", "Drop for Gold", "Keep", "Review", "Review"]


def test_correlation_uses_complete_pairs(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (2.0, 4.0, 1.0), (3.0, 6.0, 0.0)], "a double, b double, c double")
    got = {(r.a, r.b): r["corr"] for r in profile.corr_matrix(df, ["a", "b", "c"]).collect()}
    assert got["a", "b"] == pytest.approx(1.0) and got["c", "a"] == pytest.approx(-1.0) and len(got) == 9


def test_wide_correlations_of_203_columns(spark):
    import numpy as np
    rnd = np.random.default_rng(4)
    values = rnd.normal(1e6, 1.0, (300, 203)) + rnd.normal(0, 1, (300, 1))
    values[rnd.random(values.shape) < 0.1] = np.nan
    values[:, 7], values[:, 8] = 5.0, np.nan
    cols = [f"m {i}.x" for i in range(203)]
    rows = [[None if np.isnan(v) else float(v) for v in row] for row in values]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in cols)).repartition(5)
    got = {(r.a, r.b): r["corr"] for r in profile.corr_matrix_wide(df, cols).collect()}
    assert len(got) == 203 * 203
    for i, j in [(0, 1), (3, 3), (202, 0), (100, 55), (9, 202)]:
        both = ~np.isnan(values[:, i]) & ~np.isnan(values[:, j])
        assert got[cols[i], cols[j]] == pytest.approx(np.corrcoef(values[both, i], values[both, j])[0, 1], abs=1e-9)
    assert got[cols[7], cols[0]] is None and got[cols[8], cols[8]] is None
    assert {r["corr"] for r in profile.corr_matrix_wide(df.limit(0), cols[:3]).collect()} <= {None}


def test_a_technical_column_does_not_change_the_id_of_a_post(spark):
    rows = spark.createDataFrame([("a", "b", 1), ("a", "b", 2), ("a", "c", 1)], "clean_text string, source_file string, load int")
    ids = [r.tweet_id for r in identity.ensure_id(rows).collect()]
    assert ids[0] == ids[1] != ids[2]


# ---- story

BRANDS = ("brand string, total_mentions bigint, mentions_twitter bigint, mentions_news bigint, positive_pct double, "
          "negative_pct double, neutral_pct double, avg_score double")


def test_mood_needs_a_strict_majority(spark):
    tie = spark.createDataFrame([("a", 10, 5, 5, 50.0, 50.0, 0.0, 0.0)], BRANDS)
    assert story.mood(tie).first().dominant == "Neutral"
    assert story.mood(tie, "absent").first().dominant == "Neutral"
    good = spark.createDataFrame([("a", 10, 5, 5, 60.0, 30.0, 10.0, 0.0)], BRANDS)
    assert story.mood(good).first().dominant == "Positive"


def test_story_names_its_leaders(spark):
    brands = spark.createDataFrame([("sony", 5, 5, 0, 10.0, 80.0, 10.0, -0.2), ("apple", 9, 4, 5, 70.0, 5.0, 25.0, 0.3),
                                    ("bose", 9, 4, 5, 70.0, 5.0, 25.0, 0.3)], BRANDS)
    topics = spark.createDataFrame([("ai", 3, 50.0, 1.0), ("ev", 3, 60.0, 9.0)],
                                   "topic string, mentions bigint, positive_pct double, negative_pct double")
    products = spark.createDataFrame([("rtx", 3), ("pixel", 4)], "product string, mentions bigint")
    comments = spark.createDataFrame([("apple", "nice", None)], "brand string, best_comment string, worst_comment string")
    row = story.story_row(brands, topics, products, comments).first()
    assert (row.top_brand, row.best_brand, row.worst_brand) == ("apple", "apple", "sony")
    assert row.executive_summary == ("Apple fue la marca más mencionada durante la semana con 9 referencias entre "
                                     "redes sociales y comentarios de noticias.")
    assert row.top_positive_topics == '["ev","ai"]' and row.top_products == '["pixel","rtx"]'
    assert row.representative_comments == '[{"brand":"apple","best_comment":"nice","worst_comment":null}]'
    assert row.brand_sentiment_snapshot.startswith('[{"brand":"apple","total_mentions":9,')


def test_narrative_can_be_critical(spark):
    brands = spark.createDataFrame([("sony", 1500, 5, 0, 10.0, 80.0, 10.0, -0.2)], BRANDS)
    said = story.brand_narrative(brands).first().narrative
    assert "Sony accumulated a total volume of 1,500 mentions" in said
    assert "mostly critical with a net sentiment score of -0.2000" in said


def test_exact_quantiles_with_infinity_a_dense_cluster_and_far_outliers(spark):
    inf = float("inf")
    dense = [1e6 + i * 1e-7 for i in range(30000)]
    data = {"a": [-inf, -inf, *dense, inf], "b": [*dense, 1e300, -1e300], "c": [inf, inf], "d": [5.0] * 9 + [float("nan")],
            "e": [-inf, 3.0, inf]}
    rows = [(g, v) for g, values in data.items() for v in values]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    probs = [0.0, 0.25, 0.5, 0.999, 1.0]
    got = {(r.g, r.p): r.value for r in quantiles.exact_quantiles(df, ["v"], probs, ["g"]).collect()}
    want = {r.g: r.q for r in df.filter(~F.isnan("v")).groupBy("g").agg(
        F.expr("percentile(v, array(0.0, 0.25, 0.5, 0.999, 1.0))").alias("q")).collect()}
    for g in data:
        for p, w in zip(probs, want[g]):
            assert got[(g, p)] == w or abs(got[(g, p)] - w) <= 1e-9 * abs(w), (g, p, got[(g, p)], w)


def test_governance_scans_a_source_twice(spark, sf):
    from opinara.plans.bindings import _silver_shaped
    posts, _ = _silver_shaped(spark, sf)
    scans = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")
    first = quality.governance_partials(posts, ["id", "text"], "event_date", text="text", lang="lang", metrics=["likeCount"])
    bounds = spark.createDataFrame([("likeCount", 1.0, 5.0)], "metric string, lower double, upper double")
    second = quality.governance_judged(posts, "id", bounds, metrics=["likeCount"])
    assert scans(first) == scans(posts) and scans(second) <= scans(posts)
    # what is left reads only the two small tables
    whole = quality.governance_summary(*_silver_shaped(spark, sf))._jdf.queryExecution().optimizedPlan().toString()
    assert "doc_id" not in whole and "conv_id" not in whole and whole.count("Aggregate") <= 8


def test_governance_of_no_rows(spark):
    df = spark.createDataFrame([], "id string, text string, lang string, event_date date, likeCount long")
    rows = quality.governance_source(df, "it's", ["id"], "id", "event_date", text="text", lang="lang", metrics=["likeCount", "absent"]).collect()
    got = {(r.section, r.metric_label): (r.metric_value, r.metric_pct, r.sample_size, r.notes) for r in rows}
    assert got == {("summary", "total_records"): (0, None, 0, None), ("summary", "id"): (0, 0, 0, None),
                   ("null_rates", "id"): (0, 0, 0, None), ("text_stats", "it's_text"): (0, None, 0, None)} and {r.source_type for r in rows} == {"it's"}


def test_governance_of_one_hot_day_with_gaps(spark):
    rows = [(str(i % 7), None if i % 5 == 0 else " " if i % 5 == 1 else "x" * i, None if i % 3 else "en", None, float("nan") if i == 9 else float(i))
            for i in range(40)] + [(None, "y", "fr", None, None)]
    df = spark.createDataFrame(rows, "id string, text string, lang string, event_date date, likeCount double")
    got = {(r.section, r.metric_name, r.metric_label): r for r in quality.governance_source(
        df, "s", ["id", "text"], "id", "event_date", text="text", lang="lang", metrics=["likeCount"]).collect()}
    assert got["summary", "duplicate_rows", "id"].metric_value == 41 - 7 and got["null_rates", "null_rate", "text"].metric_value == 16
    assert got["summary", "schema_compliance_rate", "id,text"].metric_value == 32
    assert got["volume_trend", "records_per_day", "s"].metric_value == 41 and got["outlier_rate", "outlier_rate", "likeCount"].sample_size == 39
    assert got["language_distribution", "language_count", "unknown"].metric_value == 26


def test_wide_expressions_are_not_one_method(spark, monkeypatch):
    """HotSpot never compiles methods beyond 8000 bytes; both reads of the columns run with that limit."""
    from opinara import session
    key, seen, write = "spark.sql.codegen.hugeMethodLimit", [], session.cut_lineage
    before = spark.conf.get(key)
    monkeypatch.setattr(session, "cut_lineage", lambda df: seen.append(spark.conf.get(key)) or write(df))
    df = spark.range(50).select(*[F.expr(f"CASE WHEN id % {j + 2} <> 0 THEN id * {j + 1} % 17 END").alias(f"x{j}") for j in range(30)])
    assert profile.corr_matrix_wide(df, df.columns).count() == 900
    assert seen == ["8000", "8000"] and spark.conf.get(key) == before


@pytest.mark.parametrize("buckets, first", [(1 << 16, 1000), (1 << 16, 1), (3, 1), (40, 2)])
def test_frequent_pairs_are_exact_whatever_the_buckets(spark, monkeypatch, buckets, first):
    import random
    from collections import Counter
    monkeypatch.setattr(rollups, "TERM_BUCKETS", buckets)
    monkeypatch.setattr(rollups, "FIRST_BUCKETS", first)
    rnd = random.Random(7)
    texts = [(rnd.choice(["a", "b", None]), " ".join(rnd.choices("xa xb xc xd xe xf xg".split(), [9, 5, 4, 2, 1, 1, 1], k=12))) for _ in range(60)]
    want = Counter((s, f"{x} {y}") for s, t in texts for x, y in zip(t.split(), t.split()[1:]))
    df = spark.createDataFrame([*texts, ("a", None), ("b", "")], "source_type string, text string")
    for k in (1, 9, 500):
        got = {(r.source_type, r.bigram): r.bigram_count for r in rollups.top_bigrams(df, k).collect()}
        least = sorted(want.values(), reverse=True)[:k][-1]
        assert len(got) == min(k, len(want)) and all(want[p] == n for p, n in got.items()) and min(got.values()) == least
    assert rollups.top_bigrams(df.limit(0)).collect() == []


def test_rare_pairs_are_not_counted_one_by_one(spark, monkeypatch):
    monkeypatch.setattr(rollups, "FIRST_BUCKETS", 1)
    words = [chr(97 + i) + chr(97 + j) + "z" for i in range(26) for j in range(26)]
    df = spark.createDataFrame([("a", f"{x} {y}") for x in words for y in words[:9]] + [("a", "often seen")] * 400, "source_type string, text string")
    rows = rollups.term_rows(df, sizes=(2,))
    buckets = rows.groupBy(rollups.term_bucket("source_type", "term").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    counts = rollups.most_frequent(rows, buckets, 1)
    assert counts.count() < rows.distinct().count() and counts.orderBy(F.desc("mentions")).first()["term"] == "often seen"
