"""Language identification by language-bitmask n-gram filters (operator 9).

One Bloom filter serves all languages: a slot is a bitmask with a bit per language, a learned
n-gram sets its languages' bits in its slots, and the AND over the slots of an n-gram of a
text names every language that has it. A text's n-grams are counted per language, the counts
are corrected for the filter's false positives, and the largest share decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from opinara.llm.words import buffers, mix64
from opinara.session import cut_lineage

#: Lengths of the byte n-grams, and slots that an n-gram sets.
LENGTHS, HASHES = (3, 4), 3
#: An n-gram belongs to a language when it has at least this share of the rate it has in the
#: language where it is most frequent, and occurs once for every so many n-grams of that language
#: (once at least), up to so often. Other languages' text does not count.
MIN_RATIO, MIN_COUNT, ONCE_IN = 0.3, 3, 100_000
BATCH_BYTES = 1 << 20
UNKNOWN = "und"

# bytes of a text as the n-grams see them: ASCII letters in lower case, what is not ASCII as it
# is (capitals of the Latin-1 letters in lower case), all else a space
_SEEN = np.full(256, 0x20, np.uint8)
_SEEN[0x80:] = np.arange(0x80, 0x100)
_SEEN[65:91] = np.arange(97, 123)
_SEEN[97:123] = np.arange(97, 123)


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code, text, has an ASCII letter) of all n-grams; two spaces stand between texts."""
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    seen = np.full(len(data) + 2 * n + 2, 0x20, np.uint8)
    place = np.arange(len(data)) + np.repeat(2 * np.arange(n) + 1, sizes)
    plain = _SEEN[data]
    capital = np.zeros(len(data), bool)
    capital[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    plain[capital] += 0x20
    seen[place] = plain
    text = np.full(len(seen), -1, np.int64)
    text[place] = np.repeat(np.arange(n), sizes)
    text[place[offsets[:-1][sizes > 0]] - 1] = np.flatnonzero(sizes > 0)  # the space before a text
    space = seen == 0x20
    double = np.zeros(len(seen), bool)
    double[:-1] = space[:-1] & space[1:]
    codes, texts = [], []
    for length in LENGTHS:
        last = len(seen) - length + 1
        if last <= 0:
            continue
        code = np.zeros(last, np.uint64)
        bad = np.zeros(last, bool)
        for k in range(length):
            code = code << np.uint64(8) | seen[k:last + k]
            if k < length - 1:
                bad |= double[k:last + k]
        good = np.flatnonzero(~bad & (text[:last] >= 0))
        codes.append(code[good])
        texts.append(text[good])
    ascii_letter = (plain >= 97) & (plain <= 122)
    sums = np.concatenate([[0], np.cumsum(ascii_letter)])
    letters = sums[offsets[1:]] > sums[offsets[:-1]]
    return (np.concatenate(codes) if codes else np.zeros(0, np.uint64),
            np.concatenate(texts) if texts else np.zeros(0, np.int64), letters)


@dataclass
class LanguageModel:
    """Slots (one 64-bit mask per 64 languages), languages by size, false positive rates."""

    languages: list[str]
    slots: np.ndarray
    false_rate: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def _places(self, codes: np.ndarray) -> Iterator[np.ndarray]:
        mask = np.uint64(len(self.slots) - 1)
        first = mix64(codes + np.uint64(1))
        step = (first >> np.uint64(32)) | np.uint64(1)
        for k in range(HASHES):
            yield ((first + np.uint64(k) * step) & mask).astype(np.int64)

    def learn(self, codes: np.ndarray, masks: np.ndarray) -> None:
        for place in self._places(codes):
            np.bitwise_or.at(self.slots, place, masks)

    def measure(self) -> None:
        n = len(self.languages)
        filled = np.array([np.mean(self.slots[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)) for i in range(n)])
        self.false_rate = filled**HASHES

    def shares(self, codes: np.ndarray, texts: np.ndarray, n: int) -> np.ndarray:
        """Corrected share of each text's n-grams that each language has."""
        masks = None
        for place in self._places(codes):
            found = self.slots[place]
            masks = found if masks is None else masks & found
        total = np.maximum(np.bincount(texts, minlength=n), 1)
        out = np.zeros((n, len(self.languages)))
        for i, false in enumerate(self.false_rate):
            has = (masks[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)).astype(bool)
            share = np.bincount(texts[has], minlength=n) / total
            out[:, i] = np.clip((share - false) / max(1 - false, 1e-9), 0, 1)
        return out


def gram_counts(docs: DataFrame) -> DataFrame:
    """``(lang, gram, n)`` over ``docs`` (``lang, text``), counted in tasks first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[str, list[np.ndarray]] = {}

        def add(lang: str, grams: np.ndarray, n: np.ndarray) -> None:
            if lang in tables:
                grams = np.concatenate([tables[lang][0], grams])
                n = np.concatenate([tables[lang][1], n])
            keys, inverse = np.unique(grams, return_inverse=True)
            tables[lang] = [keys, np.bincount(inverse, n).astype(np.int64)]

        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for first, data, offsets in buffers(batch.column("text"), BATCH_BYTES):
                codes, texts, _ = _grams(data, offsets)
                own = np.array(langs[first:first + len(offsets) - 1], object)
                for lang in set(own):
                    keys, n = np.unique(codes[(own == lang)[texts]], return_counts=True)
                    add(lang, keys, n)
        for lang, (keys, n) in tables.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys), pa.string()), pa.array(keys.astype(np.int64)), pa.array(n)],
                names=["lang", "gram", "n"])

    return docs.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def train_languages(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Learn from every row of ``docs`` that has a language; null text counts as empty.

    What reaches the driver is the model: the distinct n-grams of each language, of which an
    alphabet has only so many.
    """
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).filter("lang IS NOT NULL")
    counts = cut_lineage(gram_counts(rows))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    sizes = {r["lang"]: r["total"] for r in totals.collect()}  # one row per language
    languages = sorted(sizes, key=lambda x: (-sizes[x], x))
    if not languages:
        return LanguageModel([], np.zeros((1, 1), np.uint64))
    rate = counts.join(F.broadcast(totals), "lang").select("lang", "gram", "n", "total", (F.col("n") / F.col("total")).alias("rate"))
    best = rate.groupBy("gram").agg(F.max("rate").alias("most"))
    own = rate.join(best, "gram").filter(
        (F.col("rate") >= MIN_RATIO * F.col("most")) & (F.col("n") >= F.least(F.lit(MIN_COUNT), F.lit(1) + F.floor(F.col("total") / ONCE_IN))))
    kept = [own.filter(F.col("lang") == lang).select("gram").toArrow()["gram"]
            for lang in languages]
    grams = [np.asarray(k.combine_chunks(), np.int64).astype(np.uint64) for k in kept]
    slots = 1 << int(np.clip(np.ceil(np.log2(max(8 * sum(map(len, grams)), 2))), 16, None))
    model = LanguageModel(languages, np.zeros((slots, (len(languages) + 63) // 64), np.uint64))
    for i, own_grams in enumerate(grams):
        mask = np.zeros(model.slots.shape[1], np.uint64)
        mask[i // 64] = np.uint64(1) << np.uint64(i % 64)
        model.learn(own_grams, mask)
    model.measure()
    return model


def predict_languages(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score)`` per row, from the whole text alone.

    ``score`` is the corrected share of the text's n-grams that the language has. Null text
    and texts without a letter are ``und`` with score 0, as is every text if nothing was
    learned. Ties go to the language with more training text. Repeated rows and null ids are
    judged row by row; other columns are ignored whatever their names.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # eight slots for each n-gram of a language

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            langs, scores = [], []
            for first, data, offsets in buffers(batch.column("text"), BATCH_BYTES):
                n = len(offsets) - 1
                codes, texts, letters = _grams(data, offsets)
                if not model.languages:
                    langs += [UNKNOWN] * n
                    scores.append(np.zeros(n))
                    continue
                share = model.shares(codes, texts, n)
                best = share.argmax(axis=1)
                for i in np.flatnonzero(~letters):  # few: a letter that is not ASCII
                    letters[i] = any(map(str.isalpha, bytes(data[offsets[i]:offsets[i + 1]]).decode()))
                langs += [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, letters)]
                scores.append(np.where(letters, share[np.arange(n), best], 0.0))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(langs, pa.string()),
                 pa.array(np.concatenate(scores) if scores else np.zeros(0))], names=["doc_id", "lang_pred", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(predict, f"doc_id {kind}, lang_pred string, score double")


def held_out(id_col: str = "doc_id") -> Column:
    """Whether an id is never learned from: crc32 of its text modulo 4 is 2."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(4)) == 2


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       lang_col: str = "lang") -> DataFrame:
    """Train on the rows not held out and predict all: ``doc_id, held_out, lang_pred, score``."""
    model = train_languages(docs.filter(~held_out(id_col)), text_col, lang_col)
    predicted = predict_languages(docs, model, id_col, text_col)
    return predicted.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
