import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from opinara.llm import quality_rules as q
from opinara.llm.words import buffers

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, n_words string, kept int"


def brute(text):
    """Every count from lists of words and lines."""
    words = WORD.findall(text)
    out = {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(text.count(c) for c in "#*$%&|<>")}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    again = [line for i, line in enumerate(lines) if line in lines[:i]]
    out |= {"n_lines": len(lines), "n_dup_lines": len(again), "dup_line_chars": sum(sum(map(len, WORD.findall(x))) for x in again)}
    for n in range(2, 11):
        runs = [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]
        times, seen, later = Counter(runs), set(), set()
        for i, run in enumerate(runs):
            if run in seen:
                later.update(range(i, i + n))
            seen.add(run)
        if n <= 4:
            out[f"top_{n}_chars"] = max([sum(map(len, r)) * k for r, k in times.items() if k > 1], default=0)
        else:
            out[f"repeat_{n}_chars"] = sum(len(words[i]) for i in later)
        if n == 3:
            out["n_repeat_words"] = len({j for i, r in enumerate(runs) if times[r] > 1 for j in range(i, i + 3)})
    return out


def measured(texts, limit=1 << 20):
    parts = [q.repetition(data, offsets) for _, data, offsets in buffers(pa.array(texts, pa.string()), limit)]
    return [{c: int(v) for c, v in zip(q.COUNTS, row)} for row in zip(*[np.concatenate([p[c] for p in parts]) for c in q.COUNTS])]


TEXT = st.lists(st.sampled_from(["a", "b", "é", "😀x", "#", "a|", " ", "\n", "\n", "\t", "\x0b", "\r", " a b c ", " ", "dd"]), max_size=60).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=6), st.integers(1, 60))
def test_counts_are_those_of_brute_force(texts, limit):
    assert measured(texts, limit) == [brute(t) for t in texts]


def test_long_runs_and_periods():
    rnd = random.Random(5)
    passage = " ".join(rnd.choice("abcdefgh") + rnd.choice("xyz") for _ in range(40))
    texts = [passage + "\n" + passage, "ab " * 500, passage, "x\n" * 30, "", "one", " ".join(str(i) for i in range(3000)) + " " + passage + " " + passage]
    assert measured(texts) == [brute(t) for t in texts]


def verdicts(spark, rows):
    return {r.doc_id: r for r in q.repetition_quality(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_verdicts(spark):
    prose = [" ".join(f"w{i * 100 + k}" for k in range(100)) for i in range(3)]
    sentence = "one sentence at the head and at the foot"
    rows = [(1, prose[0]), (2, "w " * 49), (3, " ".join(f"u{i}" for i in range(50))),
            (4, prose[0] + " " + prose[0]),             # all of it twice: the base rule
            (5, sentence + "\n" + " ".join(f"v{i}" for i in range(45)) + "\n" + sentence),
            (6, " ".join(f"q{i} and then" for i in range(40)) + " and then" * 2),
            (7, "\n".join(f"a{i} b{i}\nsame\nsame" for i in range(30)))]
    got = verdicts(spark, [(*r, "clash", 7) for r in rows])
    assert {i: (r.base_failed, r.kept) for i, r in got.items()} == {
        1: (False, True), 2: (True, False), 3: (False, True), 4: (True, False), 5: (False, True), 6: (False, False), 7: (False, False)}


def test_share_met_exactly_is_kept(spark):
    head = " ".join("ab" for _ in range(2))
    text = head + " " + head + " " + " ".join(f"{i:02d}" for i in range(46))  # a pair of words three times, 12 of 100
    row = verdicts(spark, [(1, text, "", 0)])[1]
    assert (row.word_chars, row.top_2_chars, row.kept) == (100, 12, True)


def test_nulls_repeats_long_texts_and_no_rows(spark):
    long = " ".join(f"t{i}" for i in range(150_000))
    rows = [(1, None, "", 0), (None, "a b", "", 0), (2, "", "", 0), (3, long, "", 0), (3, long, "", 0), (4, " \n\t", "", 0)]
    got = q.repetition_quality(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.base_failed, r.kept) for r in got) == [
        (0, 2, True, False), (1, 0, True, False), (2, 0, True, False), (3, 150_000, False, True), (3, 150_000, False, True), (4, 0, True, False)]
    assert q.repetition_quality(spark.createDataFrame([], SCHEMA)).collect() == []
