"""Small helpers for tasks that work on whole texts in Arrow batches."""

from __future__ import annotations

import numpy as np
import xxhash

# Odd, so that its powers have inverses modulo 2 ** 64.
BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))


def ascii_words(text: str | None) -> list[bytes]:
    """Runs of what is neither a space nor one of the code points 9 to 13."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def word_codes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def powers(count: int, base: np.uint64 = BASE) -> np.ndarray:
    """base ** 0 ... base ** (count - 1), modulo 2 ** 64."""
    steps = np.full(count, base, np.uint64)
    if count:
        steps[0] = 1
    return np.multiply.accumulate(steps)


def rolling_hashes(codes: np.ndarray, width: int, base: np.uint64 = BASE) -> np.ndarray:
    """Karp-Rabin hash of every window of ``width`` codes, modulo 2 ** 64.

    Windows of equal codes have equal hashes wherever they lie: prefix sums are divided
    by the power at which the window starts.
    """
    count = len(codes) - width + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * powers(len(codes), base), out=sums[1:])
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    return (sums[width:] - sums[:-width]) * powers(count, inverse)


def mixed(hashes: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes, one to one."""
    out = hashes.copy()
    for factor in _MIX:
        out ^= out >> np.uint64(33)
        out *= factor
    return out ^ (out >> np.uint64(33))
