import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from opinara.llm.jaccard_join import shingle_sets
from opinara.llm.tokenization import Encoder
from opinara.llm.words import _BLOCK, Sums, spans

PATH = public_tokenizers.path("byte_bpe_50k.json")
SIZES = [512, 1024, 2048, 4096, 16384, 65536]


def twins(size):
    """A Thue-Morse word and its complement: they collide in every polynomial hash modulo a power of two."""
    bits = [bin(i).count("1") & 1 for i in range(size)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("size", SIZES)
def test_long_regular_words_are_told_apart(size):
    text = " ".join([*twins(size), twins(size)[0]])
    data = np.frombuffer(text.encode(), np.uint8)
    start, end, _ = spans(data, np.array([0, len(data)]))
    first, second, again = Sums(data).hash(start, end)
    assert first == again != second
    data = np.frombuffer("".join(twins(size)).encode(), np.uint8)
    shingles, at = shingle_sets(data, np.array([0, size, 2 * size]), 4)
    assert len(set(shingles)) == 2 and list(np.diff(at)) == [1, 1]


def test_ids_of_long_regular_words():
    model, texts = Tokenizer.from_file(PATH), [f"x {word}" for size in SIZES[:4] for word in twins(size)]
    got = [list(map(int, ids[a:b])) for _, ids, offsets in Encoder(PATH).encode(pa.array(texts)) for a, b in zip(offsets, offsets[1:])]
    assert got == [model.encode(t, add_special_tokens=False).ids for t in texts]


def test_spans_hash_alike_wherever_they_stand():
    rng = np.random.default_rng(2)
    word, rest = rng.integers(0, 256, 40, np.uint8), rng.integers(0, 256, 100_000, np.uint8)
    places = np.array([0, 777, 50_000, 99_960])
    for p in places:
        rest[p:p + 40] = word
    assert len(set(Sums(rest).hash(places, places + 40))) == 1
    every = Sums(rest).hash(np.arange(99_000), np.arange(99_000) + 20)
    assert len(np.unique(every)) > 98_900


def test_a_span_has_one_hash_on_both_sides_of_a_block_and_across_it():
    rng = np.random.default_rng(11)
    word = rng.integers(0, 256, 90).astype(np.uint8)
    places = np.array([0, 500, 2 * _BLOCK - 45, 3 * _BLOCK - 90, 3 * _BLOCK, 4 * _BLOCK + 7])
    data = rng.integers(0, 256, 4 * _BLOCK + 97).astype(np.uint8)
    for place in places:
        data[place:place + len(word)] = word
    got = Sums(data).hash(places, places + len(word))
    assert len(set(got.tolist())) == 1
    assert got[0] == Sums(word).hash(np.array([0]), np.array([len(word)]))[0]
    data[2 * _BLOCK] ^= 1  # a letter of the word that crosses
    assert (Sums(data).hash(places, places + len(word)) != got).tolist() == [False, False, True, False, False, False]


def test_no_bytes_no_spans():
    empty = np.zeros(0, np.int64)
    assert len(Sums(np.zeros(0, np.uint8)).hash(empty, empty)) == 0
