"""Words of a text, hashed, as numpy arrays; used inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

# ``bytes.split`` cuts at exactly \x20 and \x09-\x0D.
WHITE = r"[\x20\x09-\x0D]+"

_MIX = 0x9E3779B97F4A7C15


def white_words(text: str | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, as UTF-8; none for null."""
    return text.encode().split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64 bits for each word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values = values ^ (values >> np.uint64(29))
    values = values * np.uint64(0xA0761D6478BD642F)
    return values ^ (values >> np.uint64(32))


class Rolling:
    """Hashes of any run of consecutive words, from prefix sums.

    A run is a polynomial in an odd base, modulo 2**64: as the base has an
    inverse, it is a difference of prefix sums divided by the power it starts at.
    """

    def __init__(self, hashes: np.ndarray, seed: int = 1):
        base = (2 * seed + 1) * 0x5851F42D4C957F2D % 2**64 | 1
        steps = np.full(len(hashes) + 1, base, np.uint64)
        steps[0] = 1
        powers = np.multiply.accumulate(steps)
        steps[1:] = pow(base, -1, 2**64)
        self._inverse = np.multiply.accumulate(steps)
        self._sums = np.zeros(len(hashes) + 1, np.uint64)
        salted = mix(hashes + np.uint64(seed * _MIX % 2**64))
        np.add.accumulate(salted * powers[:-1], out=self._sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64 bits for each run ``[start, end)``."""
        run = (self._sums[ends] - self._sums[starts]) * self._inverse[starts]
        return mix(run + (ends - starts).astype(np.uint64) * np.uint64(_MIX))


def window_hashes(hashes: np.ndarray, size: int, seed: int = 1) -> np.ndarray:
    """64 bits for each run of ``size`` consecutive words."""
    starts = np.arange(max(0, len(hashes) - size + 1))
    return Rolling(hashes, seed).of(starts, starts + size)
