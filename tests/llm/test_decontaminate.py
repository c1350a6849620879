import itertools
import random
import re

import pytest

from opinara.llm.decontaminate import MASKS, SUBSTITUTIONS, WINDOW, drop_contaminated, masks_for, overlaps

DOC = "doc_id long, text string, item_id long, seed long, hashes string"
ITEM = "item_id long, text string, doc_id long"
RND = random.Random(5)
VOCAB = [f"w{i}" for i in range(4000)]


def prose(n):
    return " ".join(RND.choice(VOCAB) for _ in range(n))


ITEMS = [(i, prose(n)) for i, n in enumerate([40, 25, 13, 12, 5, 4, 18])] + [(50, None), (51, ""), (None, prose(20))]


def changed(text, *places):
    out = text.split()
    for p in places:
        out[p] = "other"
    return " ".join(out)


def documents():
    item = dict(ITEMS)
    docs = [prose(300), None, "", "one", prose(4000)]
    docs += [f"{prose(50)} {item[0].upper()} {prose(50)}", item[0], f"{item[1]}\n\n{item[0]}. {item[2]}!"]
    docs += [f"{prose(9)} {changed(item[2], a, b)} {prose(3)}" for a, b in [(0, 12), (4, 9), (6, 7)]]
    docs += [f"{prose(9)} {changed(item[2], 1, 5, 9)} {prose(9)}"]          # three substitutions: clean
    docs += [" ".join(item[0].split()[10:24]) + " " + prose(30), prose(30) + " " + " ".join(item[0].split()[:12])]
    docs += [f"{prose(5)} {item[3]} {prose(5)}", changed(item[3], 4), f"x {item[4]} y", item[5], item[None]]
    docs += [f"{item[6]} {prose(20)} {item[6]}", " ".join(item[1].split()[3:] + ["end"])]
    rows = list(enumerate(docs))
    return rows + [rows[5], (None, item[0]), (None, "clean")]


def brute(docs, items):
    cut = lambda t: re.findall(r"[\u4e00-\u9fff]|[^\W_\u4e00-\u9fff]+", (t or "").lower())
    found = {}
    for d, t in docs:
        w = cut(t)
        for i, u in items:
            it = cut(u)
            size = min(len(it), 13)
            if size < 5:
                if it and w == it:
                    found[(d, i)] = max(found.get((d, i), ()), (size, size, 0, size))
                continue
            for start in range(-len(it), len(w) + 1):
                same = [w[start + k] == it[k] for k in range(len(it)) if 0 <= start + k < len(w)]
                best = max((sum(same[k:k + size]) for k in range(len(same) - size + 1)), default=0)
                if len(same) >= size and best >= size - (2 if size == 13 else 1 if size >= 7 else 0):
                    key = (sum(same), best, -start, len(same))
                    found[(d, i)] = max(found.get((d, i), key), key)
    return {k: (-v[2], v[3], v[0], v[1]) for k, v in found.items()}


def frames(spark):
    docs = spark.createDataFrame([(*r, 1, 2, "clash") for r in documents()], DOC)
    return docs, spark.createDataFrame([(*r, 9) for r in ITEMS], ITEM)


def test_masks_see_every_pair_of_substitutions():
    for wrong in itertools.combinations(range(WINDOW), SUBSTITUTIONS):
        assert any(not any(at + o in wrong for o in m) for m in MASKS for at in range(WINDOW - m[-1]))


def test_against_brute_force(spark):
    got = {(r.doc_id, r.item_id): (r.start, r.n_words, r.n_same, r.best_window) for r in overlaps(*frames(spark)).collect()}
    want = brute(documents(), ITEMS)
    assert got == want and len(want) >= 12 and (11, 2) not in want and (8, 2) in want


def test_both_sides_shuffled_give_the_same(spark, monkeypatch):
    want = sorted(map(str, overlaps(*frames(spark)).collect()))
    monkeypatch.setattr("opinara.llm.decontaminate.BROADCAST_SEEDS", 0)
    assert sorted(map(str, overlaps(*frames(spark)).collect())) == want


@pytest.mark.parametrize("which", ["docs", "items"])
def test_empty_side(spark, which):
    docs, items = frames(spark)
    out = overlaps(docs.limit(0) if which == "docs" else docs, items.limit(0) if which == "items" else items)
    assert out.collect() == [] and out.columns == ["doc_id", "item_id", "start", "n_words", "n_same", "best_window"]


def test_clean_documents_stay(spark):
    docs, items = frames(spark)
    kept = drop_contaminated(docs, items)
    assert sorted(map(str, kept.collect())) == sorted(
        str(r) for r in docs.collect() if not brute([(0, r.text)], ITEMS))


def test_items_of_all_lengths_with_substitutions(spark):
    rnd = random.Random(8)
    items = [(n, " ".join(rnd.choice(VOCAB) for _ in range(n))) for n in range(1, 41)]
    docs = []
    for n, text in items:
        for wrong in range(4):
            for _ in range(3):
                changes = rnd.sample(range(n), min(wrong, n))
                docs += [f"{prose(4)} {changed(text, *changes)} {prose(4)}", changed(text, *changes)]
    docs = list(enumerate(docs))
    got = overlaps(spark.createDataFrame(docs, "doc_id int, text string"), spark.createDataFrame(items, "item_id int, text string"))
    want = brute(docs, items)
    assert {(r.doc_id, r.item_id): (r.start, r.n_words, r.n_same, r.best_window) for r in got.collect()} == want
    assert {i for _, i in want} == set(range(1, 41))


def test_every_single_substitution_of_a_short_item_is_seen():
    for n in range(7, 13):
        (mask,) = masks_for([n])
        for wrong in range(n):
            assert any(wrong not in {at + o for o in mask} for at in range(n - mask[-1]))


def test_scripts_without_spaces_and_only_short_items(spark):
    items = [(1, "今天天气很好我们去公园散步吧朋友"), (2, "好吗"), (3, "yes no")]
    docs = [(1, "他说今天天气很坏我们去公园散步吧朋友。"), (2, "好吗"), (3, "你好吗"), (4, "Yes, no!"), (5, "yes no yes")]
    schema = "id int, text string"
    for some in (items, items[1:]):
        got = overlaps(spark.createDataFrame(docs, schema), spark.createDataFrame(some, schema), "id", "text", "id")
        assert {(r.doc_id, r.item_id): (r.start, r.n_words, r.n_same, r.best_window) for r in got.collect()} == brute(docs, some)


def test_texts_of_one_id_are_not_mixed(spark):
    item = dict(ITEMS)[0]
    halves = [" ".join(item.split()[:10]), " ".join(item.split()[10:20])]
    docs = [(7, f"{halves[0]} {prose(20)}"), (7, f"{prose(10)} {halves[1]} {prose(5)}"), (8, f"{prose(3)} {item}"), (8, prose(60)),
            (None, item), (None, prose(30))]
    frame = spark.createDataFrame(docs, "doc_id int, text string")
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    assert {(r.doc_id, r.item_id): (r.start, r.n_words, r.n_same, r.best_window) for r in overlaps(frame, items).collect()} == brute(docs, ITEMS)
    assert sorted(r.text for r in drop_contaminated(frame, items).collect()) == sorted(docs[k][1] for k in (0, 1, 3, 5))
