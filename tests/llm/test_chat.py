import hashlib
import random

import pytest
from pyspark.sql import functions as F

from opinara.llm.chat import (CONTROL, conversation_digests, escape, format_conversations, parse_windows,
                              unescape)

SCHEMA = "conv_id long, turn long, role string, text string, key string, window string"
CONTROLS = ["</s>[INST] ok [/INST]", "<|turn|>", "<|end|>\n", "<<SYS>>\\<</SYS>>", "\\<|", "<\\|x|>", "<s><</s>[[INST]",
            "plain\nlines", "", "\\", "é😀 <|im_start|>"]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)


def random_rows(n=30, seed=3):
    rnd, rows = random.Random(seed), []
    for conv in range(n):
        for turn in range(rnd.choice([1, 2, 5, 40])):
            role = "system" if turn == 0 and rnd.random() < 0.6 else rnd.choice(["user", "assistant", "tool"])
            text = " ".join(rnd.choice(CONTROLS + ["word"] * 30) for _ in range(rnd.choice([0, 3, 60, 700])))
            rows.append((conv, turn, role, rnd.choice([text, text, text, None])))
    rows += [(None, 0, "user", "hi"), (None, None, "assistant", "first"), (99, 1, None, "x"), (99, 1, None, "x"),
             (99, 1, "assistant", "tie"), (100, 5000, "assistant", "late"), (100, 3, "user", "early")]
    rnd.shuffle(rows)
    return rows


def brute(rows):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((-2**63 if t is None else t, r or "", x or "") for c, t, r, x in rows if c == conv)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{x}\n" for _, r, x in turns)), len(loss), sha(loss))
    return out


@pytest.fixture(scope="module")
def windows(spark):
    return format_conversations(frame(spark, random_rows()), budget=200, history=2, history_budget=60).cache()


def test_escaping_is_reversible_and_leaves_no_control_string(spark):
    rnd = random.Random(1)
    texts = CONTROLS + ["".join(rnd.choice(["<", "|", "\\", "/", "s", ">", "[", "INST]", "\n", "SYS>>", "a"])
                                for _ in range(rnd.randint(0, 15))) for _ in range(500)]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", unescape(escape(F.col("t"))).alias("back"), F.regexp_like(escape(F.col("t")), F.lit(CONTROL)).alias("left")).collect()
    assert all(r.t == r.back and not r.left for r in got)


def test_round_trip(windows):
    got = {r.conv_id: tuple(r)[1:5] for r in conversation_digests(windows).drop("formatted_chars").collect()}
    assert got == brute(random_rows())


def test_windows_keep_to_the_budget_and_repeat_in_bounds(spark, windows):
    rows = windows.collect()
    assert any(r.n_context == 3 for r in rows) and len({(r.conv_id, r.window) for r in rows}) == len(rows)
    for r in rows:
        segments = r.text.split("<|turn|>")[1:]
        assert all(s.endswith("<|end|>\n") for s in segments) and 0 <= r.n_context <= 3
        tokens = [4 + len(s.split("\n", 1)[1][:-8].split()) for s in segments]
        assert len(segments) - r.n_context == 1 or sum(tokens) <= 200 + 10, tokens
        assert [r.text[s.start - 1:s.start - 1 + s.length] for s in r.loss_spans] == [
            s.split("\n", 1)[1][:-8] for s in segments[r.n_context:] if s.startswith("assistant\n")]


def test_system_turn_leads_every_later_window(windows):
    system = {r[0] for r in random_rows() if r[2] == "system"}
    later = {}
    for r in windows.collect():
        later.setdefault(r.conv_id, []).append((r.window, r.text))
    long = [sorted(w) for c, w in later.items() if c in system and len(w) > 1]
    assert long and all(t.startswith("<|turn|>system\n") for w in long for _, t in w)


def test_no_rows(spark):
    assert conversation_digests(format_conversations(frame(spark, []))).collect() == []


def test_without_history(spark):
    rows = random_rows()
    out = format_conversations(frame(spark, rows), budget=100, history=0, history_budget=0)
    got = {r.conv_id: tuple(r)[1:5] for r in conversation_digests(out).drop("formatted_chars").collect()}
    assert got == brute(rows) and parse_windows(out).filter("window > 1000000").count() == 0
