import math
from collections import Counter, defaultdict

import pytest

from opinara.llm.mixing import find_exponent, mix, mixed_documents

SCHEMA = "doc_id long, text string, source string, key string, block long, tokens long"
SIZES = {"a": 900, "b": 150, "c": 30, None: 60, "empty": 4}


def rows():
    out, i = [], 0
    for source, n in SIZES.items():
        for k in range(n):
            text = "" if source == "empty" else " ".join(["w"] * (1 + (7 * k) % 13))
            out.append((i, None if k == 5 else text, source, "clash", 1, 2))
            i += 1
    return out


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def totals(spark, *tokens):
    return spark.createDataFrame([(str(i), t) for i, t in enumerate(tokens)], "key string, tokens long")


def entropy(tokens, a):
    w = [t**a for t in tokens]
    return -sum(x / sum(w) * math.log(x / sum(w)) for x in w)


def test_exponent_meets_the_entropy(spark):
    tokens = [5000, 300, 20, 700]
    a = find_exponent(totals(spark, *tokens), target_entropy=0.8)
    assert entropy(tokens, a) == pytest.approx(0.8 * math.log(4), abs=1e-7) and 0 < a < 1
    assert find_exponent(totals(spark, *tokens), target_entropy=0.01) == 1.0


def test_exponent_meets_the_repeats(spark):
    a = find_exponent(totals(spark, 8000, 10, 500), max_repeats=4)
    assert (8000 / 10) ** (1 - a) == pytest.approx(4, rel=1e-6)
    assert find_exponent(totals(spark, 10, 12), max_repeats=2) == 0.0
    both = find_exponent(totals(spark, 8000, 10), target_entropy=0.99, max_repeats=2)
    assert 800 ** (1 - both) <= 2.000001


def test_few_sources(spark):
    assert find_exponent(totals(spark, 7), target_entropy=0.5, max_repeats=3) in (0.0, 1.0)
    assert find_exponent(totals(spark), max_repeats=3) == 1.0


def test_plan_meets_weights_and_reads_everything(spark):
    data = rows()
    plan = [r.asDict() for r in mix(frame(spark, data), max_repeats=3.0, block_tokens=100).collect()]
    uses = Counter(r["doc_id"] for r in plan)
    assert set(uses) == {r[0] for r in data} and all(1 <= n <= 3 for n in uses.values())
    tokens = {s: sum(len((r[1] or "").split()) for r in data if r[2] == s) for s in SIZES}
    real = {s: t for s, t in tokens.items() if t}
    a = find_exponent(totals(spark, *real.values()), max_repeats=3.0)
    scale = max(t / t**a for t in real.values())
    read = defaultdict(int)
    for r in plan:
        read[r["source"]] += r["n_tokens"]
    for s, t in real.items():
        assert scale * t**a - 13 <= read[s] <= scale * t**a + 1
    assert all(uses[r[0]] == 1 for r in data if r[2] == "empty")


def test_epochs_are_permutations_of_blocks(spark):
    plan = mix(frame(spark, rows()), max_repeats=3.0, block_tokens=100).collect()
    epochs = defaultdict(dict)
    for r in plan:
        epochs[(r.source, r.epoch)].setdefault(r.block, r.block_rank)
        assert epochs[(r.source, r.epoch)][r.block] == r.block_rank
    assert all(len(set(b.values())) == len(b) for b in epochs.values())
    assert epochs[("b", 0)].keys() >= epochs[("b", 1)].keys() and epochs[("b", 0)] != epochs[("b", 1)]
    again = mix(frame(spark, rows()).repartition(5), max_repeats=3.0, block_tokens=100).collect()
    assert sorted(map(str, plan)) == sorted(map(str, again))


def test_budget_smaller_than_the_corpus(spark):
    plan = mix(frame(spark, rows()), target_entropy=0.9, max_repeats=None, budget=1500, block_tokens=100).collect()
    assert 1500 - 5 * 13 <= sum(r.n_tokens for r in plan) <= 1500
    assert max(Counter(r.doc_id for r in plan if r.source == "a").values()) == 1


def test_null_ids_repeats_and_no_rows(spark):
    data = [(None, "a b", "s", "", 0, 0), (None, "c", None, "", 0, 0), (1, "d e", "s", "", 0, 0), (1, "d e", "s", "", 0, 0)]
    assert Counter(r.doc_id for r in mix(frame(spark, data)).collect())[1] >= 2
    assert mix(frame(spark, [])).collect() == [] and mixed_documents(frame(spark, [])).collect() == []
    out = mixed_documents(frame(spark, data))
    assert out.columns == frame(spark, data).columns and out.count() >= 4


def test_mixed_documents_follow_the_plan(spark):
    docs = frame(spark, rows())
    want = Counter(r.doc_id for r in mix(docs, max_repeats=3.0).collect())
    got = mixed_documents(docs, max_repeats=3.0)
    assert Counter(r.doc_id for r in got.collect()) == want and got.columns == docs.columns


def test_documents_with_the_names_of_the_plan(spark):
    schema = "doc_id long, source string, text string, _reads long, _epochs int, _copy string, doc int, reads int, epochs int, row int"
    rows = [(i, "a" if i < 20 else "b", "w " * 50, i, 1, "c", 2, 3, 4, 5) for i in range(24)]
    docs = spark.createDataFrame(rows, schema)
    got = mixed_documents(docs)
    assert got.columns == docs.columns and {tuple(r) for r in got.collect()} == set(rows)
    assert mixed_documents(docs.limit(0)).collect() == []
