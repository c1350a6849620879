"""Words of many texts at once: positions and 64-bit hashes over one byte buffer."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_MASK = (1 << 64) - 1
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: Lower case for A-Z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Sums are kept modulo a prime, since modulo a power of two some long words collide for every
#: base, and twice, with other bases and letter values: 62 bits in all.
_PRIME = (1 << 31) - 1
_BASES = (0x5A3C_91E7, 0x2D1F_6B4B)
_VALUES = [mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15 + 2 * k)) % np.uint64(_PRIME)
           for k in range(2)]
#: Buffers are summed in blocks of so many bytes: tables of powers are as long as a block, not as a buffer.
_BLOCK = 1 << 16


def _powers(base: int, n: int) -> np.ndarray:
    """``base`` to the powers 0 to n - 1 modulo the prime."""
    kept = np.ones(1, np.uint64)
    while len(kept) < n:
        more = kept[:n - len(kept)] * np.uint64(pow(base, len(kept), _PRIME)) % np.uint64(_PRIME)
        kept = np.concatenate([kept, more])
    return kept


def _fold(x: np.ndarray) -> np.ndarray:
    """The same numbers modulo the prime, 31 bits shorter."""
    return (x & np.uint64(_PRIME)) + (x >> np.uint64(31))


_INVERSES = [pow(base, -1, _PRIME) for base in _BASES]
_POWERS = [_powers(base, _BLOCK) for base in _BASES]
_INVERSE_POWERS = [_powers(inverse, _BLOCK) for inverse in _INVERSES]


class Sums:
    """Running sums of a buffer, from which any span's hash comes in constant time.

    Eight bytes a byte of the buffer are held; nothing outlives the buffer.
    """

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = [np.zeros(n + 1, np.uint32) for _ in _BASES]
        for sums, base, value, power in zip(self.sums, _BASES, _VALUES, _POWERS):
            before = 0
            for first in range(0, n, _BLOCK):
                block = value[data[first:first + _BLOCK]] * power[:n - first]
                block = _fold(np.cumsum(_fold(block))) * np.uint64(pow(base, first, _PRIME)) + np.uint64(before)
                block = _fold(_fold(block))
                before = int(block[-1])
                sums[first + 1:first + 1 + len(block)] = block

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Equal spans have equal hashes wherever they stand."""
        prime, halves = np.uint64(_PRIME), []
        block, inside = np.asarray(start) // _BLOCK, np.asarray(start) % _BLOCK
        for sums, inverse, power in zip(self.sums, _INVERSES, _INVERSE_POWERS):
            far = _powers(pow(inverse, _BLOCK, _PRIME), len(sums) // _BLOCK + 1)
            # twice the prime keeps the difference positive
            span = (sums[end].astype(np.uint64) + np.uint64(2 * _PRIME) - sums[start]) % prime
            halves.append(span * power[inside] % prime * far[block] % prime)
        size = (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        return mix64((halves[0] << np.uint64(31) | halves[1]) ^ size)


#: What separates words for a classifier: ASCII other than letters and digits.
NOT_WORD = np.zeros(256, bool)
NOT_WORD[:128] = [not chr(b).isalnum() for b in range(128)]


def spans(data: np.ndarray, offsets: np.ndarray,
          blank: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, byte behind, text) of every run of non-blank bytes; texts break runs."""
    inside = ~blank[data]
    breaks = np.zeros(len(data) + 1, bool)
    breaks[offsets] = True
    before = np.ones(len(data), bool)
    before[1:] = ~inside[:-1]
    start = np.flatnonzero(inside & (before | breaks[:-1]))
    behind = np.ones(len(data), bool)
    behind[:-1] = ~inside[1:]
    end = np.flatnonzero(inside & (behind | breaks[1:])) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def buffers(texts: pa.Array, limit: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows of about ``limit`` bytes; null is empty.

    One text longer than the limit is a run of its own.
    """
    texts = texts.cast(pa.large_string()) if texts.type != pa.large_string() else texts
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64, n + 1, texts.offset * 8) if n else np.zeros(1, np.int64)
    raw = texts.buffers()[2] if n else None
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    start = 0
    while start < n:
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1)
        own = offsets[start:end + 1]
        yield start, data[own[0]:own[-1]], own - own[0]
        start = end
