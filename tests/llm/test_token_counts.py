import random

import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from opinara.llm.token_counts import count_tokens
from opinara.llm.tokenization import Encoder, cut_long

PATH = public_tokenizers.path("byte_bpe_50k.json")
MODEL = Tokenizer.from_file(PATH)
ENCODER = Encoder(PATH)
SCHEMA = "doc_id long, text string, n_tokens string"


def want(text: str) -> int:
    return len(MODEL.encode(text, add_special_tokens=False).ids)


# letters, digits, marks, every kind of white space, a special string
ALPHABET = st.sampled_from(list("aBé9'.!?ßs  \n\n\t\r\x0b\x0c\x1c\x1f\x85\xa0\u2003\u3000\ufeff\u2019中😀")
                           + [" the", "'ll", "<|endoftext|>", "  ", " \n"])


def ids(text: str) -> list[int]:
    return MODEL.encode(text, add_special_tokens=False).ids


@settings(max_examples=600, deadline=None)
@given(st.lists(st.lists(ALPHABET, max_size=25).map("".join), max_size=6))
def test_words_give_the_ids_of_the_whole(texts):
    got = [list(map(int, found[a:b])) for _, found, offsets in ENCODER.encode(pa.array(texts, pa.string()))
           for a, b in zip(offsets, offsets[1:])]
    assert got == [ids(t) for t in texts]


def test_batches_and_long_texts(monkeypatch):
    monkeypatch.setattr("opinara.llm.tokenization.BATCH_BYTES", 500)
    monkeypatch.setattr("opinara.llm.tokenization.REMEMBERED", 40)
    rnd = random.Random(2)
    texts = [" ".join(rnd.choice(["the", "Été,", "don't", "x1.", "naïve!", "\n", "a\nb"]) for _ in range(n))
             for n in (0, 3, 2000, 1, 40, 900, 5, 90)] + [None, "y" * 3000, " lead", "trail ", "a  b"]
    got = [list(map(int, found[a:b])) for _, found, offsets in ENCODER.encode(pa.array(texts, pa.string()).slice(1))
           for a, b in zip(offsets, offsets[1:])]
    assert got == [ids(t or "") for t in texts[1:]]


def test_long_texts_are_cut_without_loss():
    text = ("word  two\nthree <x> " * 4000) + "x" * 30000
    parts = list(cut_long(text, 1000))
    assert "".join(parts) == text and len(parts) > 20
    assert sum(want(p) for p in parts) == want(text)


def test_counts(spark):
    texts = ["hello world", "", None, "hello world", "a <|endoftext|> b", "é " * 30000, "x" * 5000]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(0, "other", "row"), (None, "no id", "")]
    got = count_tokens(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == sorted(
        (i if i is not None else -1, len((t or "").encode()), want(t or ""), want(t or "") > 512) for i, t, _ in rows)


def test_no_rows(spark):
    assert count_tokens(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_tokenizers(spark, name):
    texts = ["Hello  World it's", "ünï 中 <|endoftext|>", ""]
    path = public_tokenizers.path(name)
    if name.endswith("model"):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        expected = [len(model.encode(t)) for t in texts]
    else:
        model = Tokenizer.from_file(path)
        expected = [len(model.encode(t, add_special_tokens=False).ids) for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in count_tokens(docs, path).collect()}
    assert [got[i] for i in range(len(texts))] == expected
