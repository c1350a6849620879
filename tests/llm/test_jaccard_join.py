import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinara.llm.components import components
from opinara.llm.jaccard_join import class_counts, jaccard_components, join_cell, may_link

SCHEMA = "doc_id long, text string, n long, cell string, region string"


def sets(text, words):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + words]) for i in range(len(w) - words + 1)} or ({tuple(w)} if w else set())


def brute(rows, words=4, percent=85):
    made = [(i, sets(t, words)) for i, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = made[i][1], made[j][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b) or made[i][0] == made[j][0]:
                root[find(i)] = find(j)
    classes = {}
    for i in range(len(rows)):
        classes.setdefault(find(i), []).append(made[i][0])
    return sorted((i, len(s), min(classes[find(k)])) for k, (i, s) in enumerate(made))


def texts(seed=7):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    prose = lambda n: [rnd.choice(vocab) for _ in range(n)]
    passage = prose(50)
    out = []
    for _ in range(25):
        base = prose(rnd.choice([4, 9, 30, 120]))
        for _ in range(rnd.choice([1, 2, 8])):
            copy = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 4])):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocab)
            out.append(" ".join(copy))
        out.append(" ".join(prose(rnd.choice([0, 12, 40])) + passage + prose(9)))
    base = prose(60)
    for k in range(40):  # a chain: neighbours are near, its ends are not
        base = base[1:] + prose(1)
        out.append(" ".join(base))
    out += ["", None, " \t\n", "A b C", "a B c", "a b", "one", "ONE", "É b c d", "é b c d", "x " * 20000, "X " * 19000,
            " ".join(passage), " ".join(passage).upper()]
    rnd.shuffle(out)
    return list(enumerate(out))


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "clash", "clash") for r in rows], SCHEMA).repartition(6)


def result(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("cell_docs", [4000, 6])
def test_against_brute_force(spark, monkeypatch, cell_docs):
    monkeypatch.setattr("opinara.llm.jaccard_join.CELL_DOCS", cell_docs)
    monkeypatch.setattr("opinara.llm.jaccard_join.BROADCAST_IDS", cell_docs)
    rows = texts()
    got = result(jaccard_components(frame(spark, rows)))
    assert got == brute(rows) and len({c for *_, c in got}) < len(rows) - 60


def test_other_sizes(spark):
    rows = texts(11)
    assert result(jaccard_components(frame(spark, rows), words=5, percent=80)) == brute(rows, 5, 80)


def test_cells_lose_no_link():
    rnd = random.Random(3)
    for _ in range(60):
        base = rnd.sample(range(10**6), 60)
        members = []
        for k in range(rnd.choice([2, 3, 12, 40])):
            own = set(base) if rnd.random() < 0.7 else set(rnd.sample(base, 50))
            for _ in range(rnd.choice([0, 2, 5, 9, 14])):
                own.discard(rnd.choice(base))
                own.add(rnd.randrange(10**6))
            members.append(np.array(sorted(own), np.uint64))
        links = join_cell(members, np.arange(len(members)), 85)
        root = list(range(len(members)))
        find = lambda i: i if root[i] == i else find(root[i])
        for a, b in links:
            assert find(a) != find(b)
            root[find(a)] = find(b)
        for i in range(len(members)):
            for j in range(i):
                common = len(np.intersect1d(members[i], members[j]))
                if 100 * common >= 85 * (len(members[i]) + len(members[j]) - common):
                    assert find(i) == find(j)


def test_components(spark):
    rnd = random.Random(4)
    path = [(i, i + 1) for i in range(100, 160)]
    links = path + [(rnd.randrange(50), rnd.randrange(50)) for _ in range(30)] + [(900, k) for k in range(901, 960)]
    root = {n: n for link in links for n in link}

    def find(n):
        return n if root[n] == n else find(root[n])

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: find(n) for a, b in links if a != b for n in (a, b)}


def test_null_and_repeated_ids_and_no_rows(spark):
    same = "a b c d e f"
    rows = [(None, same), (3, same), (2, same), (None, "p q r s"), (5, "x y z u"), (5, "k l m n"), (6, "k l m n")]
    got = sorted((tuple(r) for r in jaccard_components(frame(spark, rows)).collect()), key=repr)
    assert got == sorted([(None, 3, 2), (3, 3, 2), (2, 3, 2), (None, 1, None), (5, 1, 5), (5, 1, 5), (6, 1, 5)], key=repr)
    assert jaccard_components(frame(spark, [])).collect() == []


@pytest.mark.parametrize("large", [3000, 20])
def test_vectors_prune_no_link(monkeypatch, large):
    monkeypatch.setattr("opinara.llm.jaccard_join.LARGE", large)
    rnd = random.Random(9)
    number = lambda: rnd.randrange(1 << 64)
    for percent in (85, 80):
        for _ in range(200):
            base = [number() for _ in range(rnd.choice([1, 5, 18, 40, 300]))]
            members = []
            for _ in range(6):
                own = set(base)
                for x in rnd.sample(base, rnd.randrange(len(base) // 4 + 1)):
                    own.discard(x)
                    if rnd.random() < 0.5:
                        own.add(number())
                members.append(own or {1})
            n = np.array([len(m) for m in members])
            keep = may_link(n, [class_counts(np.array(sorted(m), np.uint64)) for m in members], percent)
            for i, a in enumerate(members):
                if any(100 * len(a & b) >= percent * len(a | b) for j, b in enumerate(members) if j != i):
                    assert keep[i]
    far = [class_counts(np.array([number() for _ in range(200)], np.uint64)) for _ in range(4)]
    assert not may_link(np.full(4, 200), far, 85).any()
