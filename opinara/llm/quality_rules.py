"""Quality rules by repetition coverage (operator 12).

The words of many texts are hashed at once. Hashes of runs of words are rolled on from one
length to the next, and only places whose shorter run repeats are looked at again, so the
long runs of ordinary prose cost next to nothing. What counts is how many characters lie inside
repeated runs and lines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from opinara.llm.words import BLANK, Sums, buffers, mix64, spans

#: The largest share, in percent of the characters in words, that the most frequent run of 2 to 4
#: words may take with all its occurrences, that runs of 5 to 10 words may cover where
#: they occur again, and that lines may cover where they occur again; and the largest share of lines
#: that occur again. A text of fifty words may have one sentence at its head and its foot.
TOP_PERCENT = {2: 30, 3: 28, 4: 26}
REPEAT_PERCENT = {5: 30, 6: 29, 7: 28, 8: 27, 9: 26, 10: 25}
LINE_CHARS_PERCENT, LINES_PERCENT = 30, 50
#: The base rules: fewest words, and largest share of words in repeated runs of three.
MIN_WORDS, BASE_RUN, BASE_PERCENT = 50, 3, 50
SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
FEED = 0x0A
BATCH_BYTES = 1 << 20

COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "dup_line_chars", "n_repeat_words",
          *[f"top_{n}_chars" for n in TOP_PERCENT], *[f"repeat_{n}_chars" for n in REPEAT_PERCENT]]


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, begins): places in the order of their keys, and where a new key begins."""
    order = np.argsort(keys, kind="stable")  # equal keys in the order of the text
    begins = np.ones(len(keys), bool)
    begins[1:] = keys[order][1:] != keys[order][:-1]
    return order, begins


def _covered(n_words: int, at: np.ndarray, length: int) -> np.ndarray:
    """Which words lie in a run of ``length`` words from one of the places ``at``."""
    edges = np.zeros(n_words + 1, np.int64)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + length, -1)
    return np.cumsum(edges[:-1]) > 0


def _inside(chars: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Sums of ``chars`` (running, from 0) over spans."""
    return chars[end] - chars[start]


def repetition(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """``COUNTS`` of each text of a buffer."""
    n = len(offsets) - 1
    start, end, text = spans(data, offsets)
    sums = Sums(data)
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points before each byte
    size = _inside(points, start, end)

    def total(values: np.ndarray, of: np.ndarray) -> np.ndarray:
        return np.bincount(of, values, n).astype(np.int64)

    out = {"n_words": np.bincount(text, minlength=n).astype(np.int64), "word_chars": total(size, text)}
    symbol = np.concatenate([[0], np.cumsum(np.isin(data, SYMBOLS))])
    out["n_symbols"] = _inside(symbol, offsets[:-1], offsets[1:])

    # lines: what lies between line feeds and ends of texts, if a word does
    feeds = np.flatnonzero(data == FEED)
    first = np.concatenate([offsets[:-1], feeds + 1])
    owner = np.concatenate([np.arange(n), np.searchsorted(offsets, feeds, side="right") - 1])
    order = np.lexsort((first, owner))
    first, owner = first[order], owner[order]
    last = np.concatenate([first[1:] - 1, [len(data)]])
    ends_text = np.ones(len(first), bool)
    ends_text[:-1] = owner[1:] != owner[:-1]
    last[ends_text] = offsets[1:][owner[ends_text]]
    letters = np.concatenate([[0], np.cumsum(~BLANK[data])])
    has_word = _inside(letters, first, last) > 0
    first, last, owner = first[has_word], last[has_word], owner[has_word]
    in_words = np.concatenate([[0], np.cumsum(((data & 0xC0) != 0x80) & ~BLANK[data])])
    order, begins = _groups(mix64(owner.astype(np.uint64)) ^ sums.hash(first, last))
    again = order[~begins]
    out["n_lines"] = np.bincount(owner, minlength=n).astype(np.int64)
    out["n_dup_lines"] = np.bincount(owner[again], minlength=n).astype(np.int64)
    out["dup_line_chars"] = total(_inside(in_words, first[again], last[again]), owner[again])

    # runs of words: the hash of a run goes on from that of the run shorter by one word
    word = sums.hash(start, end)
    at, run = np.arange(len(word)), mix64(word ^ mix64(text.astype(np.uint64)))
    before = np.concatenate([[0], np.cumsum(size)])
    for length in range(2, max(REPEAT_PERCENT) + 1):
        fits = at + length <= len(word)
        at, run = at[fits], run[fits]
        fits = text[at + length - 1] == text[at]
        at, run = at[fits], run[fits]
        run = mix64(run + word[at + length - 1] + np.uint64(length))
        order, begins = _groups(run)
        group = np.cumsum(begins) - 1
        times = np.bincount(group, minlength=1)
        repeated = times[group] > 1
        order, group, begins = order[repeated], group[repeated], begins[repeated]
        places = at[order]
        if length in TOP_PERCENT:
            chars = _inside(before, places, places + length) * times[group]
            top = np.zeros(n, np.int64)
            np.maximum.at(top, text[places], chars)
            out[f"top_{length}_chars"] = top
        if length == BASE_RUN:
            hit = np.flatnonzero(_covered(len(word), places, length))
            out["n_repeat_words"] = np.bincount(text[hit], minlength=n).astype(np.int64)
        if length in REPEAT_PERCENT:
            hit = np.flatnonzero(_covered(len(word), places[~begins], length))
            out[f"repeat_{length}_chars"] = total(size[hit], text[hit])
        # a longer run repeats only where the shorter one does
        keep = np.sort(order)
        at, run = at[keep], run[keep]
    return out


def base_failed() -> Column:
    """Too few words, or too many in repeated runs of three."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > BASE_PERCENT * F.col("n_words"))


def covered_too_much() -> Column:
    """More characters in repeated runs or lines than one of the shares allows."""
    chars = F.col("word_chars")
    rules = [100 * F.col(f"top_{n}_chars") > p * chars for n, p in TOP_PERCENT.items()]
    rules += [100 * F.col(f"repeat_{n}_chars") > p * chars for n, p in REPEAT_PERCENT.items()]
    rules += [100 * F.col("dup_line_chars") > LINE_CHARS_PERCENT * chars,
              100 * F.col("n_dup_lines") > LINES_PERCENT * F.col("n_lines")]
    rejected = rules[0]
    for rule in rules[1:]:
        rejected = rejected | rule
    return rejected


def repetition_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``COUNTS``, ``base_failed``, ``kept``.

    A word is a run of anything but ASCII white space, a line what stands between line feeds
    and has a word. ``n_dup_lines`` lines equal an earlier one, ``dup_line_chars`` code points of words
    are in them. ``n_repeat_words`` words lie in runs of three that the text has twice or more, the first
    included. ``top_N_chars`` is the largest product of a run's code points and its
    occurrences among runs of N words that occur twice or more; ``repeat_N_chars`` counts the
    code points of words inside runs of N words that occurred before. Not kept is what fails the base
    rules or exceeds one of the shares; a share that is met exactly does not count against a text.

    Null and empty texts have no words and fail. Whole texts are read, one of any length by
    itself. Repeated rows and null ids are judged row by row; other columns are ignored whatever
    their names. No rows, no result.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in buffers(batch.column("text"), BATCH_BYTES):
                counts = repetition(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, len(offsets) - 1), *[pa.array(counts[c]) for c in COUNTS]],
                    names=["doc_id", *COUNTS])

    kind = rows.schema["doc_id"].dataType.simpleString()
    counted = rows.mapInArrow(measure, ", ".join([f"doc_id {kind}", *[f"{c} long" for c in COUNTS]]))
    failed = counted.withColumn("base_failed", base_failed())
    return failed.withColumn("kept", ~F.col("base_failed") & ~covered_too_much())

