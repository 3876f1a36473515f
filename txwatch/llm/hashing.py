"""Vectorised hashes of words and word windows of one document.

A word's hash is a polynomial of its bytes modulo 2**64, taken from prefix
sums so that all words of a text cost a few numpy calls, then mixed. A window
of k words is a polynomial of its words' hashes, mixed again.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
BYTE_BASE, WORD_BASE, PAIR_BASE = 0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93 | 1, 0xA0761D6478BD642F | 1


class _Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            for name, base in (("up", self.base), ("down", self.inverse)):
                steps = np.full(size, base, U)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=U))
        return self.up[:n], self.down[:n]


_BYTES, _WORDS, _PAIRS = _Powers(BYTE_BASE), _Powers(WORD_BASE), _Powers(PAIR_BASE)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _ranges(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: _Powers) -> np.ndarray:
    up, down = powers.get(len(values))
    total = np.zeros(len(values) + 1, U)
    np.cumsum(values * up, out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U))


def word_hashes(parts: list[bytes]) -> np.ndarray:
    """One hash for each word (no word is empty or holds a space)."""
    if not parts:
        return np.zeros(0, U)
    raw = np.frombuffer(b" ".join(parts), np.uint8)
    gaps = np.flatnonzero(raw == 32)
    starts = np.concatenate(([0], gaps + 1))
    ends = np.concatenate((gaps, [len(raw)]))
    return _ranges(raw.astype(U) + U(1), starts, ends, _BYTES)


def window_hashes(hashes: np.ndarray, k: int, starts: np.ndarray | None = None, second: bool = False) -> np.ndarray:
    """A hash for each window of ``k`` words, or for those at ``starts``."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    at = np.arange(n) if starts is None else starts
    values = mix(hashes + U(0x632BE59BD9B4E019)) if second else hashes
    return _ranges(values, at, at + k, _PAIRS if second else _WORDS)
