import random

import pytest
from pyspark.sql import functions as F

from opinara.functions import taxonomy
from opinara.operators import keyword_tables as kt
from opinara.plans import tables as t

SCHEMA = "id long, text string, digest string, gram int, key string, _tag string"
KEYS = "key string, number int, keyword string, digest int"


def frame(spark, texts):
    return spark.createDataFrame([(i, x, "clash", 1, "k", "t") for i, x in enumerate(texts)], SCHEMA).repartition(3)


def table(spark, lists):
    return spark.createDataFrame([(k, n, w, 0) for n, (k, ws) in enumerate(lists.items()) for w in ws], KEYS)


@pytest.fixture(params=[kt.BROADCAST_ROWS, 0], ids=["broadcast", "shuffled"])
def either(request, monkeypatch):
    monkeypatch.setattr(kt, "BROADCAST_ROWS", request.param)


@pytest.mark.parametrize("match", ["substring", "word"])
def test_equal_to_lists_in_code(spark, either, match):
    rnd = random.Random(3)
    letters = "aab é😀.-İß"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 30))) for _ in range(150)] + [None, "", None, "AA B", "aa b"]
    lists = {f"k{i}": ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 6))).lower() for _ in range(2)] for i in range(12)}
    df = frame(spark, texts)
    first = kt.match_first_table(df, "text", table(spark, lists), "got", "none", match).withColumn(
        "want", taxonomy.match_first("text", lists, "none", match))
    every = kt.match_all_table(df, "text", table(spark, lists), "got", match).withColumn("want", taxonomy.match_all("text", lists, match))
    for out in (first, every):
        assert out.columns == [*df.columns, "got", "want"] and out.count() == len(texts)
        assert out.filter(~F.col("got").eqNullSafe(F.col("want"))).collect() == []


def test_nulls_ties_empty_and_long(spark, either):
    keys = spark.createDataFrame([("b", 1, "xyz", 0), ("a", 1, "XYZ", 0), ("c", 2, "q", 0), ("c", 0, "nowhere", 0), (None, 0, "xyz", 0),
                                  ("d", 5, None, 0), ("b", 1, "xyz", 0)], KEYS)
    df = frame(spark, ["say xyz", None, "q and xyz", "word " * 30000 + "xyz", "say xyz"])
    got = {r.id: (r.tag, r.tags) for r in kt.match_all_table(kt.match_first_table(df, "text", keys), "text", keys).collect()}
    assert got == {0: ("a", ["a", "b"]), 1: (None, []), 2: ("c", ["c", "a", "b"]), 3: ("a", ["a", "b"]), 4: ("a", ["a", "b"])}
    everywhere = spark.createDataFrame([("e", 9, "", 0)], KEYS)
    assert {r.tag for r in kt.match_first_table(df, "text", everywhere).collect()} == {"e"}
    assert {r.tag for r in kt.match_first_table(df, "text", keys.limit(0), default="x").collect()} == {"x"}
    assert kt.match_first_table(frame(spark, []), "text", keys).collect() == []


def test_keywords_are_filed_under_their_rarest_substring(spark):
    df = frame(spark, ["abcd"] * 5 + ["abce", "xbcd"])
    rows = kt.keyword_rows(spark.createDataFrame([("k", 0, "abcd", 0), ("s", 1, "xb", 0)], KEYS))
    filed = {r.keyword: r.gram for r in kt.file_keywords(df, "text", rows, [2, 3]).collect()}
    assert filed == {"abcd": "abc", "xb": "xb"}  # six texts have either substring of abcd: the smaller one


def test_no_text_meets_every_keyword(spark, sf, either):
    docs = t.documents(spark, sf).select("doc_id", "text")
    plan = kt.match_first_table(docs, "text", table(spark, t.TEST_BRANDS))._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


def test_texts_are_not_taken_apart_into_lists_of_letters(spark):
    df = frame(spark, ["xyxyxyxy " * 50, "xxy", "é" * 9 + "xy", None])
    keys = spark.createDataFrame([("two", 0, "xy", 0), ("long", 1, "yxyxy", 0), ("accent", 2, "éx", 0)], KEYS)
    every = kt.match_all_table(df, "text", keys)
    plan = every._jdf.queryExecution().optimizedPlan().toString()
    assert "crc32" in plan and "array_distinct" not in plan and "split(" not in plan
    assert {r.id: r.tags for r in every.collect()} == {0: ["two", "long"], 1: ["two"], 2: ["two", "accent"], 3: []}
