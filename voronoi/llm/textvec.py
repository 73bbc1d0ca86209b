"""NumPy kernels over the bytes of an Arrow string column: words, hashes of words and of runs of words.

Words are ``[^\\x20\\x09-\\x0D]+``; A-Z can be lower-cased first. Hashes have 64 bits, the same on every machine: two
different words share one with probability 2**-64 or so.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Random odd multipliers by position in a word; a word longer than this goes round again with another factor.
_TURN = 1024
_AT = np.random.Generator(np.random.PCG64(20240817)).integers(0, 2**63, _TURN, dtype=np.uint64) * U(2) + U(1)
#: Bytes of words hashed at a time, which bounds the scratch memory.
_STEP = 1 << 19


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all rows, row offsets); a null row is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def lower(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U(33))
    x = x * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start and end byte of each word, index of each row's first word and after the last row's last)."""
    word = ~_SPACE[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets] = True
    before = np.ones(len(data) + 1, dtype=bool)  # a word may start here
    before[1:] = ~np.append(word, False)[:-1] if len(data) else True
    before |= first
    starts = np.flatnonzero(word & before[:-1])
    ends = np.flatnonzero(word & (~np.append(word[1:], False) | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word."""
    out = np.empty(len(starts), dtype=np.uint64)
    lens = ends - starts
    upto = np.concatenate(([0], np.cumsum(lens)))
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(upto, upto[i] + _STEP, "right")) - 1)
        n, begin = lens[i:j], upto[i:j] - upto[i]
        at = np.arange(int(upto[j] - upto[i])) - np.repeat(begin, n)
        value = data[at + np.repeat(starts[i:j], n)].astype(np.uint64) + U(1)
        value *= _AT[at % _TURN]
        if n.max() > _TURN:
            value *= mix((at // _TURN).astype(np.uint64)) | U(1)
        out[i:j] = mix(np.add.reduceat(value, begin) + n.astype(np.uint64) * U(0x9E3779B97F4A7C15))
        i = j
    return out


def shingles(words: np.ndarray, firsts: np.ndarray, n: int) -> list[np.ndarray]:
    """Per row the sorted distinct hashes of its runs of ``n`` words; fewer words count as one run, none as no run."""
    if len(words) >= n:
        runs = np.zeros(len(words) - n + 1, dtype=np.uint64)
        for k in range(n):
            runs = mix(runs * U(0x9E3779B97F4A7C15) + words[k:len(words) - n + 1 + k])
    out = []
    for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(runs[a:b - n + 1]))
        elif b > a:
            one = np.array([b - a], dtype=np.uint64)
            for w in words[a:b]:
                one = mix(one * U(0x9E3779B97F4A7C15) + w)
            out.append(one)
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def row_slices(offsets: np.ndarray, step: int) -> list[tuple[int, int]]:
    """Ranges of rows of about ``step`` bytes each; a longer row stands alone."""
    out, i, n = [], 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + step, "right")) - 1)
        out.append((i, min(j, n)))
        i = out[-1][1]
    return out
