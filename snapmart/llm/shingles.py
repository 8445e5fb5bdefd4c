"""Words and word shingles of whole text batches, as numpy arrays.

A word is a run of bytes outside 0x20 and 0x09-0x0D; these are the code
points of the pattern ``[^\\x20\\x09-\\x0D]+``, since bytes of longer UTF-8
sequences are all above 0x7F. Word hashes come from one prefix sum over the
batch (a polynomial in an odd base modulo 2**64, so the sum of a range can be
shifted back to its start) followed by a mixing step; shingles combine the
hashes of adjacent words in order.
"""

from __future__ import annotations

import numpy as np

#: Odd multipliers of the hashes and of the 64-bit mixing step.
BASE = 0x9E3779B97F4A7C15
MIX_1 = 0xFF51AFD7ED558CCD
MIX_2 = 0xC4CEB9FE1A85EC53
WORD_STEP = 0xD6E8FEB86659FD93

WIDTH = 5
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLOCK = 1 << 16


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    out[0] = 1
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done : done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
        done += step
    return out


_FORWARD = _powers(BASE, _BLOCK)
_BACK = _powers(pow(BASE, -1, 1 << 64), _BLOCK)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(MIX_1)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(MIX_2)
    return x ^ (x >> np.uint64(33))


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the first word index of each row (plus the total)."""
    if data.size == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(offsets.size, np.int64)
    inside = ~_SPACE[data]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    row_starts = offsets[:-1][offsets[:-1] < data.size]
    before[row_starts] = False  # a word never runs over two rows
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    row_ends = offsets[1:]
    after[row_ends[row_ends > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of words of each row."""
    return np.diff(word_bounds(data, offsets)[2])


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word, and the first word index of each row (plus the total)."""
    starts, ends, first = word_bounds(data, offsets)
    if starts.size == 0:
        return np.zeros(0, np.uint64), first
    codes = (_LOWER[data] if lower else data).astype(np.uint64) + np.uint64(1)
    place = np.arange(data.size, dtype=np.int64)
    sums = np.zeros(data.size + 1, dtype=np.uint64)
    if data.size <= _BLOCK:
        np.cumsum(codes * _FORWARD[: data.size], out=sums[1:])
        raw = (sums[ends] - sums[starts]) * _BACK[starts]
    else:
        # Powers repeat in blocks; a block factor shifts each block to its place.
        blocks = data.size // _BLOCK + 1
        ahead = _powers(pow(BASE, _BLOCK, 1 << 64), blocks)
        back = _powers(pow(pow(BASE, -1, 1 << 64), _BLOCK, 1 << 64), blocks)
        np.cumsum(codes * _FORWARD[place % _BLOCK] * ahead[place // _BLOCK], out=sums[1:])
        raw = (sums[ends] - sums[starts]) * _BACK[starts % _BLOCK] * back[starts // _BLOCK]
    return mix(raw + np.uint64(MIX_2) * (ends - starts).astype(np.uint64)), first


def shingle_hashes(words: np.ndarray, first: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every shingle (repeats kept) and each row's first shingle index.

    A row with fewer than ``width`` words has its whole sequence as one
    shingle; a row without words has none.
    """
    n_words = np.diff(first)
    counts = np.where(n_words >= width, n_words - width + 1, np.minimum(n_words, 1))
    at = np.zeros(first.size, np.int64)
    np.cumsum(counts, out=at[1:])
    if at[-1] == 0:
        return np.zeros(0, np.uint64), at
    # Shingle k of a row starts at that row's word k.
    start = np.arange(at[-1]) + np.repeat(first[:-1] - at[:-1], counts)
    span = np.repeat(np.minimum(n_words, width), counts)
    out = span.astype(np.uint64) * np.uint64(MIX_1)
    short = bool((n_words < width).any())
    for j in range(width):
        step = np.uint64(pow(WORD_STEP, j + 1, 1 << 64))
        word = words[np.minimum(start + j, words.size - 1)] * step
        if short:
            word[span <= j] = 0
        out += word
    return mix(out), at


def text_shingles(data: np.ndarray, offsets: np.ndarray, lower: bool = True, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes (repeats kept) of each row of a text batch."""
    words, first = word_hashes(data, offsets, lower)
    return shingle_hashes(words, first, width)


def distinct_sorted(hashes: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Per row, the sorted distinct hashes."""
    out = []
    for i in range(at.size - 1):
        row = np.sort(hashes[at[i] : at[i + 1]])
        out.append(row[np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))] if row.size else row)
    return out
