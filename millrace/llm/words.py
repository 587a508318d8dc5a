"""Words and word n-grams of whole Arrow batches as 64-bit hashes, without a Python loop over words or texts.

A word's hash is a polynomial in its bytes modulo 2**64. Prefix sums of byte times power give every word's sum at
once; the inverse power (the base is odd) moves it to position 0; a bijective finaliser mixes the bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .shared import filled, forgets

_P, _Q = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
#: Bytes of text handled at once; a longer text is handled alone.
SLICE_BYTES = 1 << 20
_pow = np.ones(1, np.uint64)
_inv = np.ones(1, np.uint64)


def _powers(n: int) -> None:
    global _pow, _inv
    if len(_pow) >= n:
        return
    n = max(n, SLICE_BYTES + 1)
    with np.errstate(over="ignore"):
        _pow = np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(n - 1, _P, np.uint64))])
        _inv = np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(n - 1, pow(_P, -1, 1 << 64), np.uint64))])


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def _forget() -> None:
    global _pow, _inv
    _pow = _inv = np.ones(1, np.uint64)


forgets.append(_forget)


class Lexer:
    """Which bytes are parts of words; A-Z count as a-z."""

    def __init__(self, is_word: np.ndarray):
        value = np.arange(256)
        value[65:91] += 32
        self.is_word, self.value = is_word, (value + 1).astype(np.uint64)


def _mask(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a : b + 1] = True
    return out


#: Lower-cased digits, letters and everything beyond ASCII.
ALNUM = Lexer(_mask((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)))
#: Everything but ASCII white space.
SPACED = Lexer(~_mask((0x09, 0x0D), (0x20, 0x20)))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's UTF-8 bytes, and where each text begins and the last one ends. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = filled(column)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind, len(column) + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64) if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(at: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most so many bytes, or of one row."""
    lo, n = 0, len(at) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + most, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def word_places(raw: np.ndarray, at: np.ndarray, lexer: Lexer) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each word begins and ends (exclusive), in order, and at which word each text begins (and the last one ends)."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    word = lexer.is_word[raw]
    start, end = word.copy(), word.copy()
    start[1:] &= ~word[:-1]
    end[:-1] &= ~word[1:]
    edge = at[:-1][at[:-1] < n]
    start[edge] = word[edge]
    edge = at[1:][at[1:] > 0] - 1
    end[edge] = word[edge]
    first = np.flatnonzero(start)
    return first, np.flatnonzero(end) + 1, np.searchsorted(first, at)


def place_hashes(raw: np.ndarray, first: np.ndarray, end: np.ndarray, lexer: Lexer) -> np.ndarray:
    """The hash of each word."""
    n = len(raw)
    _powers(n + 1)
    value = lexer.value[raw]
    sums = np.zeros(n + 1, np.uint64)
    np.multiply(value, _pow[:n], out=value)
    np.cumsum(value, out=sums[1:])
    return mix((sums[end] - sums[first]) * _inv[first])


def word_hashes(raw: np.ndarray, at: np.ndarray, lexer: Lexer) -> tuple[np.ndarray, np.ndarray]:
    """Every word's hash in order, and at which word each text begins (and the last one ends)."""
    first, end, ptr = word_places(raw, at, lexer)
    return place_hashes(raw, first, end, lexer) if len(first) else np.zeros(0, np.uint64), ptr


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """The hash of the k words from each word on; the last k - 1 words begin none."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = words[:n].copy()
    for j in range(1, k):
        out *= np.uint64(_Q)
        out += words[j : j + n]
    return mix(out)


def gram_rows(ptr: np.ndarray, k: int, n_grams: int) -> tuple[np.ndarray, np.ndarray]:
    """For grams over all words together: the text of each word, and which grams lie within one text."""
    row = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
    return row, row[:n_grams] == row[k - 1 : k - 1 + n_grams]
