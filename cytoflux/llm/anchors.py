"""Content-defined anchors of byte strings, as array operations."""

from __future__ import annotations

import numpy as np

#: Multiplier of the polynomial hash. Strings can be built on which any polynomial modulo 2 ** 64 agrees, so that it
#: proposes equal strings and never decides.
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def mix(x: np.ndarray) -> np.ndarray:
    """A finalizer that spreads 64 bits."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Hashes:
    """Hashes of any substrings of one byte string, by differences of a polynomial's prefix sums."""

    _powers: tuple[np.ndarray, np.ndarray] | None = None

    def __init__(self, data: np.ndarray):
        n = len(data)
        if Hashes._powers is None or n >= len(Hashes._powers[0]):
            size = max(1 << 16, 2 * n)
            Hashes._powers = powers(MULTIPLIER, size), powers(np.uint64(pow(int(MULTIPLIER), -1, 1 << 64)), size)
        up, self.down = Hashes._powers
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))

    def runs(self, length: int) -> np.ndarray:
        """Of every substring of that length, in order."""
        n = len(self.sums) - length
        return mix((self.sums[length:] - self.sums[:n]) * self.down[:n] + np.uint64(length)) if n > 0 else np.zeros(0, np.uint64)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """The least of each w neighbours, from minima over blocks of w in both directions."""
    n = len(x)
    padded = np.full(-(-n // w) * w, TOP)
    padded[:n] = x
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[: n - w + 1], ahead[w - 1 : n])


def anchors(hashes: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The leftmost least place of each run of w hashes, by their upper 32 bits: places, and the first and last run
    that each is the least of.

    The choice looks at the run alone, so equal runs have equal anchors wherever they stand.
    """
    if len(hashes) < w:
        return (np.zeros(0, np.int64),) * 3
    low = np.uint64(0xFFFFFFFF)
    at = sliding_min((hashes & ~low) | np.arange(len(hashes), dtype=np.uint64), w) & low
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    return at[first].astype(np.int64), first, np.r_[first[1:], len(at)] - 1
