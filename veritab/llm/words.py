"""Vectorised word splitting and hashing over Arrow text columns.

Everything works on the UTF-8 bytes of a batch at once (numpy), in pieces of a few MB that end at document
borders, so the temporaries stay small whatever the batch size. A word's hash is a 64-bit polynomial of its
(mapped) bytes; shingle hashes combine the hashes of consecutive words. Two different words or shingles
share a hash with probability about 2**-64 per pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = np.asarray(x, dtype=np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass(frozen=True)
class Alphabet:
    """Which bytes belong to words; A-Z are read as a-z when ``lower``."""

    is_word: np.ndarray
    codes: np.ndarray


def alphabet(is_word: np.ndarray, lower: bool = True) -> Alphabet:
    codes = _BYTE_CODE[_LOWER] if lower else _BYTE_CODE.copy()
    return Alphabet(is_word, np.where(is_word, codes, np.uint64(0)))


def _space_words() -> np.ndarray:
    m = np.ones(256, dtype=bool)
    m[0x20] = False
    m[0x09:0x0E] = False
    return m


def _alnum_words() -> np.ndarray:
    m = np.zeros(256, dtype=bool)
    m[0x30:0x3A] = m[0x41:0x5B] = m[0x61:0x7B] = True
    m[0x80:] = True
    return m


SPACE_WORDS = alphabet(_space_words())  # runs of [^\x20\x09-\x0D]
ALNUM_WORDS = alphabet(_alnum_words())  # runs of digits, ASCII letters and everything beyond ASCII


_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, PIECE_BYTES + 1)
        with np.errstate(over="ignore"):
            for i, base in enumerate((_BASE, _BASE_INV)):
                p = np.full(size, base, dtype=np.uint64)
                p[0] = 1
                _powers[i] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


def pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of consecutive rows holding at most ``limit`` bytes, or one longer row.

    Null texts are empty. ``offsets`` has one more entry than rows and starts at 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return
    _, off_buf, data_buf = column.buffers()
    offsets = np.frombuffer(off_buf, dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data_buf, dtype=np.uint8) if data_buf is not None and data_buf.size else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), n)
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def split(data: np.ndarray, offsets: np.ndarray, letters: Alphabet) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, words per row) of the words; no word crosses a row border."""
    n = len(offsets) - 1
    if len(data) == 0:
        z = np.zeros(0, dtype=np.int64)
        return z, z, np.zeros(n, dtype=np.int64)
    m = letters.is_word[data]
    before = np.empty_like(m)
    before[0], before[1:] = False, m[:-1]
    firsts = offsets[:-1][offsets[:-1] < len(data)]
    before[firsts] = False
    starts = np.flatnonzero(m & ~before)
    after = np.empty_like(m)
    after[-1], after[:-1] = False, m[1:]
    lasts = offsets[1:][offsets[1:] > 0] - 1
    after[lasts] = False
    ends = np.flatnonzero(m & ~after) + 1
    counts = np.diff(np.searchsorted(starts, offsets))
    return starts, ends, counts


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, letters: Alphabet) -> np.ndarray:
    if len(starts) == 0:
        return np.zeros(0, dtype=np.uint64)
    power, inverse = _power(len(data) + 1)
    with np.errstate(over="ignore"):
        total = np.empty(len(data) + 1, dtype=np.uint64)
        total[0] = 0
        np.cumsum(letters.codes[data] * power[: len(data)], out=total[1:])
        return mix((total[ends] - total[starts]) * inverse[starts])


def combine(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive entries (length n-k+1, empty when n < k); k is part of the hash."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        acc = np.full(n, k, dtype=np.uint64)
        for j in range(k):
            acc = acc * _BASE + hashes[j : j + n]
    return mix(acc)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int, letters: Alphabet = SPACE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all rows one after another, set size per row).

    A row with fewer than k words, but not none, has its whole word sequence as its one shingle."""
    starts, ends, counts = split(data, offsets, letters)
    w = word_hashes(data, starts, ends, letters)
    sh = combine(w, k)
    first = np.concatenate(([0], np.cumsum(counts)))
    out, sizes = [], np.zeros(len(counts), dtype=np.int64)
    for i, c in enumerate(counts):
        if c >= k:
            s = np.unique(sh[first[i] : first[i] + c - k + 1])
        elif c:
            s = combine(w[first[i] : first[i + 1]], int(c))
        else:
            continue
        out.append(s)
        sizes[i] = len(s)
    return (np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)), sizes
