import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinara.llm import toxicity as tox

DOC = "doc_id long, text string, fold int, y0 int, p_toxic double, _id string"
LABEL = "doc_id long, quality int, toxic int, text string"
RND = random.Random(8)
VOCAB = [f"{a}{b}{c}" for a in "abcde" for b in ("ran", "lim", "oto") for c in ("est", "ing", "u", "ors")]
STEMS = ["skarn", "vilth", "übelk"]


def prose(n):
    return " ".join(RND.choice(VOCAB) + RND.choice(["", "", ",", "."]) for _ in range(n))


def documents(n=600):
    rows, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        words = prose(RND.choice([5, 60, 300])).split()
        if bad:
            for _ in range(2):
                words.insert(RND.randrange(len(words)), RND.choice(STEMS) + RND.choice(["", "en", "ish", "x"]) + "!")
        rows.append((i, " ".join(words)))
        if i % 2:
            labels.append((i, int(not bad or RND.random() < 0.4), int(bad)))
        elif i % 10 == 0:
            labels.append((i, 0, int(bad)))
    return rows, labels


def frame(spark, rows):
    return spark.createDataFrame([(*r, 9, 9, 0.5, "clash") for r in rows], DOC).repartition(3)


def label_frame(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], LABEL)


def test_catches_toxic_documents_without_a_label_and_leaves_the_clean(spark):
    rows, labels = documents()
    got = {r.doc_id: r for r in tox.toxicity(frame(spark, rows), label_frame(spark, labels)).collect()}
    assert len(got) == len(rows) and all(0 <= r.p_low_quality <= 1 and 0 <= r.p_toxic <= 1 for r in got.values())
    rejected = {i for i, _ in rows if got[i].rejected}
    assert all(i % 5 == 0 for i in rejected) and len(rejected) >= 0.97 * len(rows) / 5
    kept = tox.drop_toxic(frame(spark, rows), label_frame(spark, labels))
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in rows} - rejected


def test_later_models_use_earlier_probabilities(spark):
    rows, labels = documents()
    labels = [(i, 1 - t, t) for i, _, t in labels]  # the first category is the second
    categories = {"first": F.col("quality") == 0, "second": F.col("toxic") == 1, "third": F.col("toxic") == 1}
    chain = tox.train_chain(frame(spark, rows), label_frame(spark, labels), categories)
    assert [link.name for link in chain] == ["first", "second", "third"]
    assert len(chain[2].earlier) == 2 and chain[1].earlier[0] > 0.1
    out = tox.predict_chain(frame(spark, rows), chain)
    assert out.columns == ["doc_id", "p_first", "p_second", "p_third", "rejected"]


def test_features_are_words_and_their_beginnings():
    data = np.frombuffer("Skarnish, skarn".encode(), np.uint8)
    found, texts = tox.features_of(data, np.array([0, len(data)]))
    again, _ = tox.features_of(np.frombuffer(b"skarnish SKARN", np.uint8), np.array([0, 14]))
    assert sorted(found) == sorted(again) and len(found) == 2 + 2 + 1 + 1 and set(texts) == {0}


def test_fit_is_the_minimum():
    rng = np.random.default_rng(1)
    x = (rng.random((300, 6)) < 0.3).astype(float)
    y = (x[:, 0] + rng.random(300) > 0.9).astype(float)
    w, bias = tox._fit(x, y)
    p = 1 / (1 + np.exp(-(x @ w + bias)))
    assert np.abs(x.T @ (p - y) + tox.RIDGE * w).max() < 0.05 and abs((p - y).sum()) < 0.05


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (3, 1, 0)], [(1, None, None)], [(99999, 1, 1)]])
def test_too_little_to_learn_rejects_nothing(spark, labels):
    rows, _ = documents(20)
    got = tox.toxicity(frame(spark, rows), label_frame(spark, labels)).collect()
    assert len(got) == 20 and not any(r.rejected for r in got)


def test_nulls_repeats_long_texts_and_no_rows(spark):
    rows, labels = documents()
    more = rows + [(None, "skarn vilth"), (700, None), (701, ""), (702, "word " * 60000 + "skarn vilthen"), rows[0], rows[0]]
    more_labels = labels + [(1, 1, 0), (None, 0, 1), (700, 0, 0), (0, None, 1)]
    got = tox.toxicity(frame(spark, more), label_frame(spark, more_labels)).collect()
    flags = [(r.doc_id, r.rejected) for r in got]
    assert len(got) == len(more) and flags.count((0, True)) == 3 and (None, True) in flags and (702, True) in flags
    assert (700, False) in flags and (701, False) in flags
    assert tox.toxicity(frame(spark, []), label_frame(spark, labels)).collect() == []


def test_every_sure_feature_is_kept(spark):
    words = [f"{a}{b}x" for a in "bcdfghjklmnpqrst" for b in "aeiouvwyzbcdfghj"]
    rows = [(i, " ".join(words) if i % 2 else "quiet words only", 0, i % 2, 0.0, str(i)) for i in range(60)]
    chosen = tox._choose_features(spark.createDataFrame(rows, DOC), 1)
    assert len(words) == 256 and len(chosen[0]) >= 256
