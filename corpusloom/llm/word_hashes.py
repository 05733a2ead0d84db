"""64-bit hashes of all words of a text at once."""

from __future__ import annotations

import numpy as np

MIX, SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_BASE = 0x5851F42D4C957F2D
# Bytes hashed together; a longer text is cut at white space.
_STRETCH = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * MIX
    return values ^ (values >> np.uint64(29))


class WordHasher:
    """Words are stretches of bytes between ASCII white space; equal words have equal hashes on every machine.

    A word's hash is a polynomial in random values of its bytes, taken from running sums over the whole text, and its
    length. Two different words agree with a chance of about 2**-50.
    """

    def __init__(self) -> None:
        self.values = np.random.default_rng(29).integers(1, 1 << 63, 256, dtype=np.uint64)
        self.powers = np.ones(1, np.uint64)
        self.inverses = np.ones(1, np.uint64)

    def _grow(self, size: int) -> None:
        inverse = pow(_BASE, -1, 1 << 64)
        while len(self.powers) < size:
            n = len(self.powers)
            self.powers = np.r_[self.powers, self.powers * np.uint64(pow(_BASE, n, 1 << 64))]
            self.inverses = np.r_[self.inverses, self.inverses * np.uint64(pow(inverse, n, 1 << 64))]

    def bounds(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of every word."""
        word = np.r_[False, ~_SPACE[raw], False]
        edges = np.flatnonzero(word[1:] != word[:-1])
        return edges[::2], edges[1::2]

    def hashes(self, text: bytes) -> np.ndarray:
        raw = np.frombuffer(text, np.uint8)
        starts, ends = self.bounds(raw)
        if len(raw) <= _STRETCH:
            return self._hashes(raw, starts, ends)
        parts, at = [], 0
        while at < len(starts):
            stop = max(at + 1, int(np.searchsorted(ends, starts[at] + _STRETCH, side="right")))
            begin, end = starts[at], ends[stop - 1]
            parts.append(self._hashes(raw[begin:end], starts[at:stop] - begin, ends[at:stop] - begin))
            at = stop
        return np.concatenate(parts) if parts else np.zeros(0, np.uint64)

    def _hashes(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(self.powers) < len(raw):
            self._grow(len(raw))
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(self.values[raw] * self.powers[: len(raw)], out=sums[1:])
        codes = (sums[ends] - sums[starts]) * self.inverses[starts]
        return mixed(codes + (ends - starts).astype(np.uint64) * SECOND)
