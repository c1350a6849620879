import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from opinara.llm import prefix_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, path int"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows, families=True):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            convs[conv].append((turn is not None, turn or 0, role, digest, text))
    ordered = {c: [(t[2], t[4]) for t in sorted(own)] for c, own in convs.items()}
    full = {}
    for c, own in ordered.items():
        h = zlib.crc32(str(c).encode()) % 4 if families else 0
        full[c] = ordered.get(c - c % 20 if c >= 0 else c + -c % 20, [])[:h] + own[h:]
    members, children = defaultdict(list), defaultdict(set)
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                children[tuple(turns[:d - 1])].add(tuple(turns[:d]))
    out = []
    for node, own in members.items():
        below = [n for n in members if n[:len(node)] == node]
        saved = sum((len(members[n]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) for n in below if n)
        ends = ",".join(str(c) for c in sorted(c for c in own if len(full[c]) == len(node)))
        out.append((min(own), len(node), min(members[node[:-1]]) if node else None, len(own), len(children[node]),
                    sum(not children[n] for n in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def built(spark, rows, families=True, parts=3):
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(parts)
    return sorted((tuple(r) for r in trie.prefix_trie(frame, families=families).select(*COLUMNS).collect()), key=repr)


def sample(seed, convs, longest, words):
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample(range(3 * convs), convs):
        rows += [(c, t, rnd.choice(["user", "assistant"])[: rnd.choice([4, 9])], rnd.choice(words)) for t in range(rnd.randint(1, longest))]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, convs, longest, words", [
    (1, 60, 6, ["a", "b b"]), (2, 40, 17, ["x"]), (3, 90, 4, ["p", "q r", "", " s\tt "]), (4, 25, 40, ["u", "u", "u", "u", "v w"])])
def test_nodes_are_those_of_brute_force(spark, seed, convs, longest, words):
    rows = sample(seed, convs, longest, words)
    assert built(spark, rows) == brute(rows)


def test_long_common_beginnings(spark):
    rows = [(c, t, "user", "same words" if t < 33 + c % 5 else f"{c}") for c in range(14) for t in range(30 + 2 * c)]
    assert built(spark, rows, families=False) == brute(rows, families=False)


def test_nulls_ties_repeats_and_conversations_without_turns(spark):
    rows = [(1, None, "user", "z"), (1, 0, None, None), (1, 0, None, None), (2, 5, "b", "x"), (2, 5, "a", "y"), (None, 0, "user", "lost"),
            (3, 0, "user", "word " * 40000), (20, 0, "user", "first one"), (20, 1, "bot", "second"), (25, 0, "user", "own"), (26, 0, "user", "own"),
            (-3, 0, "user", "below zero"), (-20, 0, "user", "base"), (40, 0, "u", "")]
    got = built(spark, rows)
    assert got == brute(rows)
    assert any(r[1] == 0 and r[7] != hashlib.sha256(b"").hexdigest() for r in got)  # some conversations are left without a turn


def test_one_turnless_conversation_is_a_root_that_is_a_leaf(spark):
    rows = [(25, 0, "user", "own")]  # 1 borrowed at least of a first one that is absent
    assert zlib.crc32(b"25") % 4 >= 1
    assert built(spark, rows) == brute(rows) == [(25, 0, None, 1, 0, 1, 0, hashlib.sha256(b"25").hexdigest())]


def test_no_rows(spark):
    assert built(spark, []) == []


def test_lengths_of_handles(spark):
    pairs = [(a, b) for a in range(40) for b in range(a + 1, 41)]
    want = [max(range(a + 1, b + 1), key=lambda i: i & -i) for a, b in pairs]
    frame = spark.createDataFrame(pairs, "a int, b int").coalesce(1)
    assert [r[0] for r in frame.select(trie.two_fattest(F.col("a"), F.col("b"))).collect()] == want


def test_many_ids_of_one_node_are_joined_in_runs(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 50)
    ids = [random.Random(9).randrange(-500, 10 ** 9) for _ in range(900)]
    frame = spark.createDataFrame([(b"n", i) for i in ids] + [(b"m", 7)], "id binary, conv_id long").repartition(5)
    got = {bytes(r.id): r.ends_sha256 for r in trie.joined_digests(frame).collect()}
    assert got == {b"n": hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest(), b"m": hashlib.sha256(b"7").hexdigest()}


def test_only_the_waiting_look_again(spark):
    """Batches end: each one brings an edge for every place and next turn."""
    rows = [(c, t, "user", f"{c % (t + 1)}") for c in range(30) for t in range(8)]
    assert built(spark, rows) == brute(rows)
