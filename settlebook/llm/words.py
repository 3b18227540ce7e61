"""Words of a text as 64-bit hashes, with numpy.

Words are runs of bytes other than space and the controls 9 to 13. A word's
hash is a polynomial in its bytes modulo 2^64, mixed with its length.
"""

from __future__ import annotations

import numpy as np

WHITE = np.zeros(256, dtype=bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
BASE = 0x9E3779B97F4A7C15 | 1  # odd multiplier of the polynomial
BLOCK = 1 << 20  # bytes hashed at once
_powers = np.ones(1, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose bits all depend on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers_to(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(n, 1024) - 1, BASE, np.uint64)]), dtype=np.uint64)
    return _powers


def _hash_block(data: np.ndarray) -> np.ndarray:
    inside = ~WHITE[data]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return np.empty(0, np.uint64)
    size = end - start
    place = np.arange(len(data)) - np.repeat(start, np.diff(start, append=len(data)))[:len(data)] if start[0] == 0 else \
        np.arange(len(data)) - np.concatenate([np.zeros(start[0], np.int64), np.repeat(start, np.diff(start, append=len(data)))])
    place[~inside] = 0
    values = (data.astype(np.uint64) + np.uint64(1)) * _powers_to(int(size.max()) + 1)[place]
    values[~inside] = 0
    return mix(np.add.reduceat(values, start) + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(data: bytes) -> np.ndarray:
    """A hash per word, in order."""
    parts, at, n = [], 0, len(data)
    while at < n:
        end = min(at + BLOCK, n)
        while end < n and not WHITE[data[end]]:  # a block ends in front of white space
            stop = end + 1
            while stop < n and data[stop] not in b" \t\n\x0b\x0c\r":
                stop += 1
            end = stop
        parts.append(_hash_block(np.frombuffer(data, np.uint8, end - at, at)))
        at = end
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def runs(words: np.ndarray, size: int) -> np.ndarray:
    """A hash per window of ``size`` consecutive words: a polynomial in their
    hashes, put together from windows of 1, 2, 4, ... words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    power, width, step = 0xF1357AEA2E62A9C5, 1, words  # step: windows of ``width`` words; power: base ** width
    out, done, left = None, 0, size
    while True:
        if left & 1:
            if out is None:
                out = step.copy()
            else:
                m = len(words) - done - width + 1
                out = out[:m] * np.uint64(power) + step[done:done + m]
            done += width
        left >>= 1
        if not left:
            return mix(out[:n] + np.uint64(size))
        step = step[:-width] * np.uint64(power) + step[width:]
        power, width = power * power % 2**64, 2 * width


def shingles(data: bytes, size: int) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles; fewer words are one shingle, none are none."""
    words = word_hashes(data)
    if not len(words):
        return words
    return np.unique(runs(words, min(size, len(words))))
