"""Content hashes of stretches of a sequence, and winnowed anchors.

A sequence is an array of 64-bit units: the bytes of a text, or the hashes of its words. The hash of a stretch is a
polynomial in its units modulo 2**64, so hashes of all stretches of one length come from one running sum. A winnowed
anchor is the least stretch of one length in a window; equal windows choose equal anchors.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)
CHUNK = 1 << 20


def _grow(n: int) -> None:
    """Powers of the base and of its inverse modulo 2**64, up to n."""
    global _powers, _inverse
    if len(_powers) < n:
        size = max(n, 2 * len(_powers), 1 << 16)
        for name, base in (("_powers", _BASE), ("_inverse", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            globals()[name] = np.cumprod(steps, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sums(units: np.ndarray) -> np.ndarray:
    """Running polynomial sums: one more than units, 0 first."""
    _grow(len(units) + 1)
    out = np.zeros(len(units) + 1, np.uint64)
    np.cumsum((units + np.uint64(1)) * _powers[: len(units)], dtype=np.uint64, out=out[1:])
    return out


def stretch(running: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the stretches from ``start`` to ``end``; equal contents have equal hashes."""
    return mix((running[end] - running[start]) * _inverse[start] + (end - start).astype(np.uint64))


def stretches(running: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all stretches of one length."""
    n = len(running) - length
    if n <= 0:
        return np.zeros(0, np.uint64)
    return mix((running[length:] - running[:n]) * _inverse[:n] + np.uint64(length))


def least(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` neighbouring hashes, the position of the least one, the leftmost of equal ones."""
    found = []
    low = np.uint64(CHUNK * 2 - 1)
    for start in range(0, len(hashes) - width + 1, CHUNK):
        part = hashes[start:start + CHUNK + width - 1]
        # The leading bits of the hash, then the position: the smallest of these numbers is the leftmost least.
        best = (part & ~low) | np.arange(len(part), dtype=np.uint64)
        reach = 1
        while reach * 2 <= width:
            best = np.minimum(best[:-reach], best[reach:])
            reach *= 2
        if reach < width:
            best = np.minimum(best[: len(part) - width + 1], best[width - reach:])
        found.append(start + (best & low).astype(np.int64))
    return np.concatenate(found) if found else np.zeros(0, np.int64)


_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True


def word_bounds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a byte array: runs without ASCII white space."""
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~_WHITE[raw]
    edges = np.diff(inside)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
