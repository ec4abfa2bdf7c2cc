"""Words of many texts at once, as 64-bit hashes, without a Python loop over words.

A word is a run of bytes other than space and 0x09-0x0D, so that UTF-8 text needs
no decoding.  A-Z are folded to a-z.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_SPAN = 1 << 20  # bytes hashed at once
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))

IS_SEPARATOR = np.zeros(256, dtype=bool)
IS_SEPARATOR[list(SEPARATORS)] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (splitmix finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


ALL_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
# All of ASCII but letters and digits, where punctuation is not part of a word.
IS_MARK = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])
_EXACT = np.where(IS_SEPARATOR, np.uint64(0), ALL_BYTES)
_FOLDED = _EXACT.copy()
_FOLDED[65:91] = _FOLDED[97:123]
_PLAIN = np.where(IS_MARK, np.uint64(0), _FOLDED)


@lru_cache(maxsize=2)
def _powers(base: int, size: int) -> np.ndarray:
    factors = np.full(size, base, dtype=np.uint64)
    factors[0] = 1
    return np.multiply.accumulate(factors)


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``size`` powers of an odd number modulo 2 ** 64, and their inverses."""
    width = 1 << max(20, size.bit_length())
    return _powers(int(_BASE), width)[:size], _powers(int(_INVERSE), width)[:size]


class Words(NamedTuple):
    """Words in text order: hash, first byte, byte after the last, number of the text."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray

    def bounds(self, texts: int) -> np.ndarray:
        """Where each text's words begin; one entry more than there are texts."""
        return np.searchsorted(self.text, np.arange(texts + 1))


def chunks(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """The texts of a string column, about ``limit`` bytes at a time.

    Yields first row, row after the last, the bytes, and the offsets in them.  A
    null counts as empty.  A text is never divided.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    low = 0
    while low < len(column):
        high = int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1
        high = min(max(high, low + 1), len(column))
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def span_hashes(
    data: np.ndarray,
    start: np.ndarray,
    end: np.ndarray,
    values: np.ndarray,
    gaps: bool = False,
) -> np.ndarray:
    """Hash of each span of bytes.

    ``gaps``: bytes whose value is not 0 lie between the spans.
    """
    hashed = np.empty(len(start), dtype=np.uint64)
    low = 0
    while low < len(start):
        high = max(int(np.searchsorted(end, start[low] + _SPAN, side="right")), low + 1)
        first, last = start[low], end[high - 1]
        width = 1 << max(20, int(last - first).bit_length())
        scaled = values[data[first:last]] * _powers(int(_BASE), width)[: last - first]
        if gaps:
            edges = np.stack([start[low:high], end[low:high]], axis=1).reshape(-1) - first
            sums = np.add.reduceat(np.append(scaled, np.uint64(0)), edges)[::2]
        else:
            sums = np.add.reduceat(scaled, start[low:high] - first)
        hashed[low:high] = sums * _powers(int(_INVERSE), width)[start[low:high] - first]
        low = high
    return mix(hashed + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(data: np.ndarray, offsets: np.ndarray, plain: bool = False) -> Words:
    """All words of the texts that lie in ``data`` between ``offsets``.

    ``plain``: punctuation divides words too.
    """
    size = len(data)
    if not size:
        none = np.zeros(0, dtype=np.int64)
        return Words(none.astype(np.uint64), none, none, none)
    inside = ~(IS_MARK if plain else IS_SEPARATOR)[data]
    cut = np.zeros(size + 1, dtype=bool)
    cut[offsets] = True
    before = np.empty(size, dtype=bool)
    before[0], before[1:] = True, ~inside[:-1]
    start = np.flatnonzero(inside & (before | cut[:-1]))
    after = np.empty(size, dtype=bool)
    after[-1], after[:-1] = True, ~inside[1:]
    end = np.flatnonzero(inside & (after | cut[1:])) + 1
    hashed = span_hashes(data, start, end, _PLAIN if plain else _FOLDED)
    return Words(hashed, start, end, np.searchsorted(offsets, start, side="right") - 1)


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words; of the whole text where it is shorter."""
    if not len(hashes):
        return hashes
    width = min(width, len(hashes))
    total = np.full(len(hashes) - width + 1, np.uint64(width), dtype=np.uint64)
    for k in range(width):
        total = mix(total * _BASE + hashes[k : len(hashes) - width + 1 + k])
    return total
