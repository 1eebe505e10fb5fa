"""Word arithmetic on whole Arrow batches: words, word hashes and gram hashes without a Python loop over words.

A batch of texts is handled in slices of about two megabytes, so memory does not follow the size of a batch. Texts
are arrays of symbols (UTF-8 bytes or code points). The hash of a run of symbols is a difference of two prefix
sums of ``mix(symbol) * BASE**position`` modulo 2**64, shifted back to position 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE = 1 << 21
BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
BASE_INV = pow(BASE, -1, 1 << 64)
SHINGLE = 0xD1342543DE82EF95

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base**0 .. base**(n-1)`` modulo 2**64, kept between calls."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(1024, 1 << (n - 1).bit_length())
        have = np.full(size, base, np.uint64)
        have[0] = 1
        _powers[base] = have = np.multiply.accumulate(have)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64: every input bit reaches every output bit."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_MIX = mix(np.arange(1, 257, dtype=np.uint64))

#: Lower-cases A-Z, leaves every other byte.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words between white space, and of words of letters and digits (any byte of a non-ASCII character counts).
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True


@dataclass
class Words:
    """Words of several texts. ``first`` has n + 1 entries: text i owns the words ``first[i] .. first[i+1] - 1``."""

    hashes: np.ndarray
    first: np.ndarray
    starts: np.ndarray
    ends: np.ndarray  # past the last symbol
    prefix: np.ndarray  # hash sums, one more than symbols

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def text_slices(column: pa.Array, size: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from row, to row, bytes, offsets) of about ``size`` bytes, SLICE if None; a NULL text is empty. A longer text stands alone."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1 + column.offset)[column.offset :]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    if column.null_count:
        column = column.fill_null("")
        offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1 + column.offset)[column.offset :]
        data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + (size or SLICE), "right")) - 1
        hi = min(n, max(lo + 1, hi))
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def words(symbols: np.ndarray, offsets: np.ndarray, inside: np.ndarray, mixed: np.ndarray) -> Words:
    """Maximal runs of symbols with ``inside``, never across two texts. ``mixed`` has a random number per symbol."""
    n = len(symbols)
    starts_here = np.zeros(n + 1, bool)
    starts_here[offsets[:-1]] = True
    starts_here[n] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | starts_here[1:-1]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:] | starts_here[1:-1]
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(stops) + 1
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(mixed * powers(BASE, n), out=prefix[1:])
    hashes = mix((prefix[ends] - prefix[starts]) * powers(BASE_INV, n + 1)[starts])
    return Words(hashes, np.searchsorted(starts, offsets), starts, ends, prefix)


def byte_words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> Words:
    """Words of UTF-8 texts after lower-casing A-Z."""
    lower = LOWER[data]
    return words(lower, offsets, is_word[lower], BYTE_MIX[lower])


def word_hash(text: str) -> int:
    """The hash that ``byte_words`` gives the word ``text``."""
    data = LOWER[np.frombuffer(text.encode(), np.uint8)]
    total = (BYTE_MIX[data] * powers(BASE, len(data))).sum(dtype=np.uint64)
    return int(mix(np.array([total], np.uint64))[0])


def gram_hashes(w: np.ndarray, n: int) -> np.ndarray:
    """Hashes of n consecutive words, at each word but the last n - 1; runs across texts are to be left out."""
    if len(w) < n:
        return np.zeros(0, np.uint64)
    out = np.full(len(w) - n + 1, n, np.uint64)
    for k, p in enumerate(powers(SHINGLE, n)):
        out += w[k : len(w) - n + 1 + k] * p
    return mix(out)
