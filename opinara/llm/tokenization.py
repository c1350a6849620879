"""Encoding texts with a public tokenizer file: whole texts, bounded memory.

A byte-level tokenizer cuts a text into words before it merges bytes, and a word's ids do
not depend on its neighbours. The words of many texts are found and hashed at once, each
distinct word is encoded once by the library, and its ids are remembered. Where a cut could
change the ids (special strings, runs of white space or unusual white space, other kinds
of tokenizer), the library gets the text itself.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from opinara.llm.words import Sums, buffers, spans

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one task, one core

#: Bytes of text that are encoded together.
BATCH_BYTES = 1 << 21
#: Distinct words a worker remembers before it forgets them all; about 60 bytes each.
REMEMBERED = 1_500_000

SPACE, FEED = 0x20, 0x0A
PUNCTUATION = b".,;:!?"
SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")
# white space on which regular expression libraries differ, or that is not ASCII
UNUSUAL_POINTS = [*range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x2010), 0x2028, 0x2029,
                  0x202F, 0x205F, 0x3000, 0xFEFF]
UNUSUAL = re.compile("[" + "".join(map(chr, UNUSUAL_POINTS)) + "]")
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True


def cut_long(text: str, limit: int = BATCH_BYTES) -> Iterator[str]:
    """Consecutive parts of about ``limit`` characters, cut before a single inner space."""
    start = 0
    while len(text) - start > limit:
        found = SAFE_CUT.search(text, start + limit)
        if not found:
            break
        yield text[start:found.start()]
        start = found.start()
    yield text[start:]


class Words:
    """Ids of the words met so far, by hash."""

    def __init__(self, dtype: np.dtype):
        self.dtype = dtype
        self.forget()

    def forget(self) -> None:
        self.keys, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.start, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, self.dtype)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key, -1 for those not met."""
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        known = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        return np.where(known, self.place[at] if len(self.keys) else -1, -1)

    def add(self, keys: np.ndarray, ids: np.ndarray, size: np.ndarray) -> None:
        """``keys`` in ascending order, none of them known; their ids one behind the other."""
        place = len(self.start) + np.arange(len(keys))
        at = np.searchsorted(self.keys, keys)
        self.keys, self.place = np.insert(self.keys, at, keys), np.insert(self.place, at, place)
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.ids = np.concatenate([self.ids, ids.astype(self.dtype)])


def ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indexes of the runs ``start[i] .. start[i] + size[i] - 1``, one behind the other."""
    ends = np.cumsum(size)
    return np.repeat(start - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


class Encoder:
    """Ids of texts as arrays of ``dtype``; ``path`` ends in .json or .model."""

    def __init__(self, path: str):
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            size, self.by_word, self.special = model.get_piece_size(), False, []
            self.encode_many = lambda texts: model.encode(texts, num_threads=1)
        else:
            from tokenizers import Tokenizer

            with open(path, encoding="utf-8") as file:
                spec = json.load(file)
            model = Tokenizer.from_file(path)
            model.no_padding()
            model.no_truncation()
            before = spec.get("pre_tokenizer") or {}
            size = model.get_vocab_size(with_added_tokens=True)
            self.special = [t["content"].encode() for t in spec.get("added_tokens", [])]
            self.by_word = (before.get("type") == "ByteLevel" and before.get("use_regex", True)
                            and not before.get("add_prefix_space") and not spec.get("normalizer"))
            self.encode_many = lambda texts: [
                e.ids for e in model.encode_batch_fast(texts, add_special_tokens=False)]
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        if self.by_word:
            (feed,), *marks = self.encode_many(["\n", *map(chr, PUNCTUATION)])
            self.feed = feed
            self.mark = np.zeros(256, self.dtype)
            self.mark[list(PUNCTUATION)] = [m[0] for m in marks]
            self.words = {before: Words(self.dtype) for before in ("", " ")}

    def encode(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first text, ids, offsets) of runs of texts: text i has ids[offsets[i]:offsets[i+1]].

        Null counts as empty.
        """
        for first, data, offsets in buffers(texts, BATCH_BYTES):
            if not self.by_word or len(data) > 2 * BATCH_BYTES:
                many = [self._one(bytes(data[a:b]).decode()) for a, b in zip(offsets, offsets[1:])]
                sizes = np.array([len(m) for m in many], np.int64)
                ids = np.concatenate(many) if many else np.zeros(0, self.dtype)
            else:
                ids, sizes = self._together(data, offsets)
            yield first, ids, np.concatenate([[0], np.cumsum(sizes)])

    def _one(self, text: str) -> np.ndarray:
        """One text by itself, long ones part by part where parts are safe."""
        raw = text.encode()
        if (not self.by_word or len(text) <= BATCH_BYTES or any(s in raw for s in self.special)
                or UNUSUAL.search(text)):
            return np.asarray(self.encode_many([text])[0], self.dtype)
        parts = []
        for part in cut_long(text):
            parts += [ids for _, ids, _ in self.encode(pa.array([part]))] if len(part) < len(text) else [
                np.asarray(self.encode_many([part])[0], self.dtype)]
        return np.concatenate(parts)

    def _usual(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Which texts are words between single spaces and line feeds and nothing else."""
        space, feed = data == SPACE, data == FEED
        wrong = (data < SPACE) & ~feed
        gap = space | feed
        wrong[1:] |= gap[1:] & gap[:-1]
        wrong[offsets[1:][np.diff(offsets) > 0] - 1] |= gap[offsets[1:][np.diff(offsets) > 0] - 1]
        for lead, mask, length in ((0xC2, 0x1F, 2), (0xE1, 0x0F, 3), (0xE2, 0x0F, 3), (0xE3, 0x0F, 3), (0xEF, 0x0F, 3)):
            at = np.flatnonzero(data[:len(data) - length + 1] == lead)
            point = np.full(len(at), lead & mask, np.int32)
            for k in range(1, length):
                point = point << 6 | (data[at + k] & 0x3F)
            wrong[at[np.isin(point, UNUSUAL_POINTS)]] = True
        counts = np.concatenate([[0], np.cumsum(wrong)])
        usual = counts[offsets[1:]] == counts[offsets[:-1]]
        raw = data.tobytes()
        for special in self.special:
            at = raw.find(special)
            while at >= 0:
                usual[np.searchsorted(offsets, at, side="right") - 1] = False
                at = raw.find(special, at + 1)
        # a text that begins with a gap has an empty first word
        begins = offsets[:-1][np.diff(offsets) > 0]
        usual[np.diff(offsets) > 0] &= ~gap[begins]
        return usual

    def _together(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        usual = self._usual(data, offsets)
        start, end, text = spans(data, offsets)
        keep = usual[text]
        start, end, text = start[keep], end[keep], text[keep]
        after_feed = np.zeros(len(start), bool)
        inner = start > offsets[text]
        after_feed[inner] = data[start[inner] - 1] == FEED
        after_space = inner & ~after_feed
        # punctuation behind a letter is a word of its own to the tokenizer
        last, previous = data[end - 1], data[np.maximum(end - 2, 0)]
        second = data[np.maximum(end - 3, 0)]
        letter = LETTER[previous] & (end - start >= 2) | (
            (second == 0xC3) & (previous >= 0x80) & (previous != 0x97) & (previous != 0xB7) & (end - start >= 3))
        mark = np.where(letter, self.mark[last], 0)
        core = end - (mark > 0)
        keys = Sums(data).hash(start, core)
        ids_start, ids_size = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
        ids_from = {}
        for before, which in (("", ~after_space), (" ", after_space)):
            at = np.flatnonzero(which)
            place = self._places(before, data, keys[at], start[at], core[at])
            table = self.words[before]
            ids_start[at], ids_size[at] = table.start[place], table.size[place]
            ids_from[before] = table.ids
        ids_start[after_space] += len(ids_from[""])
        pool = np.concatenate([ids_from[""], ids_from[" "]])
        # a word's ids: a line feed if one stands before it, the word's own, its mark
        size = ids_size + after_feed + (mark > 0)
        out = np.empty(int(size.sum()), self.dtype)
        at = np.cumsum(size) - size
        out[at[after_feed]] = self.feed
        out[(at + size - 1)[mark > 0]] = mark[mark > 0]
        out[ragged(at + after_feed, ids_size)] = pool[ragged(ids_start, ids_size)]
        sizes = np.bincount(text, size, len(offsets) - 1).astype(np.int64)
        if usual.all():
            return out, sizes
        pieces, ends = [], np.cumsum(sizes)
        for i in range(len(sizes)):
            if usual[i]:
                pieces.append(out[ends[i] - sizes[i]:ends[i]])
            else:
                pieces.append(self._one(bytes(data[offsets[i]:offsets[i + 1]]).decode()))
                sizes[i] = len(pieces[-1])
        return np.concatenate(pieces), sizes

    def _places(self, before: str, data: np.ndarray, keys: np.ndarray, start: np.ndarray,
                end: np.ndarray) -> np.ndarray:
        """Places of the words in their table; words not met yet are encoded by the library."""
        table = self.words[before]
        if len(table.keys) > REMEMBERED:
            table.forget()
        distinct, sample, inverse = np.unique(keys, return_index=True, return_inverse=True)
        place = table.find(distinct)
        new = np.flatnonzero(place < 0)
        if len(new):
            raw, mark = data.tobytes(), before.encode()
            words = [mark + raw[a:b] for a, b in zip(start[sample[new]].tolist(), end[sample[new]].tolist())]
            # one text with a line feed behind each word: its id is where the next word begins
            ids = np.asarray(self.encode_many([b"\n".join([*words, b""]).decode()])[0], self.dtype)
            feeds = np.flatnonzero(ids == self.feed)
            if len(feeds) != len(words):
                raise ValueError("the tokenizer merged a line feed with a word")
            size = np.diff(feeds, prepend=-1) - 1
            table.add(distinct[new], ids[ids != self.feed], size)
            place = table.find(distinct)
        return place[inverse]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process and file: a reused worker keeps what it remembers."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
