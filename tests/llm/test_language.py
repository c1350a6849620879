import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from opinara.llm.language import (HASHES, LanguageModel, _grams, gram_counts, held_out, identify_languages, predict_languages,
                                  train_languages)
from opinara.llm.words import buffers

SCHEMA = "doc_id long, text string, lang string, gram long, n long, source string"
SPEECH = {"aa": "the and that with from this have", "bb": "der und das mit von dieser haben für",
          "cc": "le et que avec de cette avoir été", "dd": "el y que con desde esta haber niño"}


def rows(n=400):
    out = []
    for i in range(n):
        lang = sorted(SPEECH)[i % 4]
        words = SPEECH[lang].split()
        out.append((i, " ".join(words[(i * 5 + 3 * k) % len(words)] for k in range(1 + i % 17)), lang))
    return out


def frame(spark, data):
    return spark.createDataFrame([(*r, 1, 2, "clash") for r in data], SCHEMA).repartition(3)


def test_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    right = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.min("score"), F.max("score")).first()
    assert right[0] >= 0.95 and 0 <= right[1] <= right[2] <= 1


def test_grams_by_brute_force(spark):
    texts = ["Abc dé", "", None, "x1y", "ÀB", "  a  b "]
    want = []
    for i, t in enumerate(texts):
        plain = "".join(chr(c + 32) if 0xC0 <= c <= 0xDE else chr(c).lower() if c < 128 and chr(c).isalpha() else chr(c) if c >= 128 else " "
                        for c in map(ord, t or ""))
        raw = f" {plain}  ".encode() if t else b""
        for size in (3, 4):
            for k in range(len(raw) - size + 1):
                gram = raw[k:k + size]
                if b"  " not in gram:
                    want.append((int.from_bytes(gram, "big"), i))
    got = []
    for first, data, offsets in buffers(pa.array(texts), 1 << 20):
        codes, owner, _ = _grams(data, offsets)
        got += [(int(c), int(o) + first) for c, o in zip(codes, owner)]
    assert sorted(got) == sorted(want)


def test_counts_cover_all_rows(spark):
    data = [(i, "abc", "aa") for i in range(50)] + [(99, "abc", "bb")]
    got = {(r.lang, r.gram): r.n for r in gram_counts(frame(spark, data).select("lang", "text")).collect()}
    assert got[("aa", int.from_bytes(b"abc", "big"))] == 50 and got[("bb", int.from_bytes(b"abc", "big"))] == 1


def test_filter_names_every_language_and_corrects_false_positives():
    rng = np.random.default_rng(2)
    model = LanguageModel([f"l{i}" for i in range(70)], np.zeros((1 << 14, 2), np.uint64))
    sets = [rng.integers(0, 1 << 32, 900 if i == 69 else 60).astype(np.uint64) for i in range(70)]
    for i, grams in enumerate(sets):
        mask = np.zeros(2, np.uint64)
        mask[i // 64] = np.uint64(1) << np.uint64(i % 64)
        model.learn(grams, mask)
    model.measure()
    for i, grams in enumerate(sets):  # no false negatives
        assert model.shares(grams, np.zeros(len(grams), int), 1)[0, i] == 1
    strange = rng.integers(1 << 40, 1 << 41, 20000).astype(np.uint64)
    assert 0 < model.false_rate[69] < 0.05 and HASHES == 3
    assert model.shares(strange, np.zeros(len(strange), int), 1)[0].max() < 0.005


def test_labels_of_held_out_rows_and_inputs_do_not_matter(spark):
    base = rows()
    other = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in base]
    one = sorted(map(str, identify_languages(frame(spark, base)).collect()))
    two = sorted(map(str, identify_languages(frame(spark, other)).collect()))
    assert one == two and not any("zz" in r for r in two)
    flags = {r.doc_id: r.held_out for r in identify_languages(frame(spark, base)).collect()}
    assert flags == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i, *_ in base}


def test_undetermined_nulls_ties_long_texts_and_no_rows(spark):
    base = rows()
    more = base + [(900, None, "aa"), (901, "", None), (902, "123 ... !", "bb"), (903, "中文", None), (904, "und das " * 40000, None),
                   (None, "cette avec", None), (3, base[3][1], base[3][2])]
    got = [(r.doc_id, r.lang_pred, r.score) for r in identify_languages(frame(spark, more)).collect()]
    by = {i: (lang, s) for i, lang, s in got}
    assert len(got) == len(more) and by[900] == by[901] == by[902] == ("und", 0.0)
    assert by[903][0] in SPEECH and by[904][0] == "bb" and by[None][0] == "cc"
    assert identify_languages(frame(spark, [])).collect() == []
    unlabelled = identify_languages(frame(spark, [(1, "some text", None)])).collect()
    assert [(r.lang_pred, r.score) for r in unlabelled] == [("und", 0.0)]


def test_model_is_used_on_other_rows(spark):
    model = train_languages(frame(spark, rows()).filter(~held_out()))
    got = predict_languages(frame(spark, [(1, "dieser mit haben", None)]), model).collect()
    assert got[0].lang_pred == "bb" and got[0].score > 0.9


def test_a_rare_language_keeps_its_grams_when_others_grow(spark):
    import random
    rnd = random.Random(4)
    rare = "zyxwu qopty vubbe hjarl xoqsu"
    word = lambda: "".join(rnd.choice("abcdefghilmnorst") for _ in range(6))
    docs = lambda n: [(0, rare, "rr")] + [(i, " ".join(word() for _ in range(500)), "ee") for i in range(1, n)]
    for n in (4, 80):
        model = train_languages(frame(spark, docs(n)))
        data, offsets = next(iter(buffers(pa.array([rare]), 1 << 20)))[1:]
        codes, texts, _ = _grams(data, offsets)
        assert model.shares(codes, texts, 1)[0, model.languages.index("rr")] > 0.99


def test_every_gram_of_a_language_is_kept(spark):
    import random
    rnd = random.Random(5)
    text = " ".join("".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(200)) for _ in range(2500))
    model = train_languages(frame(spark, [(k, text, "aa") for k in range(3)]))
    data, offsets = next(iter(buffers(pa.array([text]), 1 << 20)))[1:]
    codes, texts, _ = _grams(data, offsets)
    assert len(np.unique(codes)) > 250_000 and model.shares(codes, texts, 1)[0, 0] > 0.999
