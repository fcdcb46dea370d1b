"""Content-defined anchors of byte strings, and fingerprints of their surroundings.

Of the ``length - K + 1`` strings of ``K`` bytes in a window of ``length``
bytes, the one with the least hash is the window's anchor. Equal windows have
their anchor at the same place, so whatever two texts share in ``length`` bytes
or more, they share an anchor. Successive windows mostly share one: an anchor
stands for a run of window starts, about ``(length - K + 2) / 2`` of them.

Fingerprints are polynomials over 64-bit integers with an odd base, read off
prefix sums: with the inverse powers of the base, equal strings have equal
values wherever they start.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

K = 32
BASE = 0x9E3779B97F4A7C15
WORD = (1 << 64) - 1
INVERSE = pow(BASE, -1, 1 << 64)
MIX1, MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
S33 = np.uint64(33)
#: Bits of a hash that hold a position while minima are taken.
PLACE_BITS = 24
CHUNK = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a published finaliser)."""
    x = (x ^ (x >> S33)) * MIX1
    x = (x ^ (x >> S33)) * MIX2
    return x ^ (x >> S33)


@lru_cache(maxsize=4)
def powers(size: int, base: int) -> np.ndarray:
    out = np.full(size, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


@lru_cache(maxsize=4)
def letters(seed: int) -> np.ndarray:
    """A random 64-bit value for each byte."""
    half = np.random.default_rng(seed).integers(0, 1 << 63, 256, dtype=np.uint64)
    return half * np.uint64(2) + np.uint64(1)


class Prints:
    """Fingerprints of any substring of ``data``."""

    def __init__(self, data: np.ndarray, seed: int):
        size = 1 << max(10, int(len(data) + 1).bit_length())
        self.up = powers(size, BASE)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(letters(seed)[data] * powers(size, INVERSE)[: len(data)], out=self.sums[1:])

    def __call__(self, start, end) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.up[start])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minima of all runs of ``width`` values, by doubling."""
    have, out = 1, values
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def anchor_runs(data: np.ndarray, valid: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """``anchor, first, count``: runs of valid window starts with one anchor.

    ``valid`` says for each of the ``len(data) - length + 1`` windows whether it
    lies in one document.
    """
    prints = Prints(data, 1)
    at = np.arange(len(data) - K + 1)
    hashes = prints(at, at + K)
    mask = np.uint64((1 << PLACE_BITS) - 1)
    low = sliding_min((hashes & ~mask) | at.astype(np.uint64), length - K + 1)
    anchor = (low & mask).astype(np.int64)
    starts = np.flatnonzero(valid)
    if not len(starts):
        return starts, starts, starts, prints
    of = anchor[starts]
    new = np.flatnonzero(np.concatenate(([True], (of[1:] != of[:-1]) | (starts[1:] != starts[:-1] + 1))))
    count = np.diff(np.append(new, len(starts)))
    return of[new], starts[new], count, prints
