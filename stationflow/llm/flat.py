"""Texts of an Arrow batch as one byte array, with hashes of their words and word runs.

Everything is done for all texts of a chunk at once; a chunk has a quarter of a MB, or is one long text.
A byte takes some 50 bytes of arrays while it is hashed, so a chunk is what a worker's memory goes by.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 18
U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


# A random value for each byte; the second table has A-Z as a-z.
BYTES = mix(np.arange(1, 257, dtype=U) * U(_BASE))
FOLDED = BYTES.copy()
FOLDED[65:91] = BYTES[97:123]
IN_WORD = np.ones(256, bool)
IN_WORD[[0x20, *range(0x09, 0x0E)]] = False
# Digits, A-Z, a-z and everything outside ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of an odd base modulo 2^64, and of its inverse."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, CHUNK + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, U)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def chunks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First and last row, bytes and offsets of some rows at a time; a NULL is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    texts = pa.concat_arrays([texts]) if texts.offset else texts
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    low = 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + CHUNK, "right")) - 1)
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def prefix_sums(data: np.ndarray, table: np.ndarray = BYTES) -> tuple[np.ndarray, np.ndarray]:
    """``p`` and ``down`` so that ``(p[j] - p[i]) * down[i]`` is a hash of the bytes i to j."""
    up, down = powers(len(data) + 1)
    p = np.zeros(len(data) + 1, U)
    values = table[data]
    values *= up[:-1]
    np.cumsum(values, out=p[1:])
    return p, down


def words(
    data: np.ndarray, offsets: np.ndarray, within: np.ndarray = IN_WORD
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z as a-z, and the first word of each text."""
    if not len(data):
        return np.zeros(0, U), np.zeros(len(offsets), np.int64)
    inside = within[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    before = np.concatenate(([False], inside[:-1])) & ~cut[:-1]
    after = np.concatenate((inside[1:], [False])) & ~cut[1:]
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    p, down = prefix_sums(data, FOLDED)
    hashes = mix((p[ends] - p[starts]) * down[starts] + (ends - starts).astype(U))
    return hashes, np.searchsorted(starts, offsets)


def runs(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words and the first run of each text; a shorter text is one run."""
    counts = np.diff(first)
    each = np.maximum(counts - n + 1, np.minimum(counts, 1))
    at = np.concatenate(([0], np.cumsum(each)))
    start = np.repeat(first[:-1] - at[:-1], each) + np.arange(at[-1])
    left = np.repeat(first[1:], each) - start
    padded = np.concatenate((hashes, np.zeros(n, U)))
    total = np.zeros(len(start), U)
    for k in range(n):
        total = mix(total + padded[start + k] * (left > k).astype(U) + U(k + 1))
    return total, at
