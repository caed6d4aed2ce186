"""Many texts as one flat byte array, and hashes of their words, for numpy work on Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_M = np.uint64(0x9E3779B97F4A7C15 | 1)
_INV = np.uint64(pow(int(_M), -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}


def _power_table(base: np.uint64, n: int) -> np.ndarray:
    """base**i mod 2**64 for i < n; grown by doubling and kept."""
    key = int(base)
    have = _powers.get(key)
    if have is None or len(have) < n:
        size = 1 << max(16, int(n).bit_length())
        factors = np.full(size, base, np.uint64)
        factors[0] = 1
        have = np.multiply.accumulate(factors)
        if size <= 1 << 23:
            _powers[key] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of at most `most` bytes together, one text at least."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    upper = (buf >= 65) & (buf <= 90)
    return np.where(upper, buf + np.uint8(32), buf)


def word_hashes(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end (in bytes of its text) of every word, and where each text's words begin."""
    joined = b" ".join([*texts, b""])
    buf = np.frombuffer(joined, np.uint8)
    if lower:
        buf = lower_ascii(buf)
    white = (buf == 32) | ((buf >= 9) & (buf <= 13))
    step = np.diff(np.concatenate(([1], white.astype(np.int8), [1])))
    starts, ends = np.flatnonzero(step == -1), np.flatnonzero(step == 1)
    powers, inverse = _power_table(_M, len(buf) + 1), _power_table(_INV, len(buf) + 1)
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * powers[: len(buf)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * inverse[starts]
    hashes = mix(hashes ^ ((ends - starts).astype(np.uint64) << np.uint64(40)))
    begins = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=begins[1:])
    first = np.searchsorted(starts, begins)
    of = np.repeat(begins[:-1], np.diff(first))
    return hashes, starts - of, ends - of, first
