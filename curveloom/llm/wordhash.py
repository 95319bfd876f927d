"""Vectorised 64-bit hashes of the words of UTF-8 texts."""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes hashed at once; a longer word makes its block longer.
BLOCK = 1 << 20
SPACES = b" \t\n\x0b\x0c\r"


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finalizer for uint64."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class WordHasher:
    """Hashes of whitespace-separated words: a polynomial over random byte values, taken from prefix sums.

    With fold, A-Z count as a-z and the marks .,;:!?"() are passed over wherever they stand, so `"Wo(rd),` equals `word`.
    A word of marks alone stays a word, equal to all others of that kind.
    """

    def __init__(self, seed: int, fold: bool = False):
        rng = np.random.default_rng(seed)
        self.values = rng.integers(0, 1 << 64, 256, np.uint64, endpoint=False)
        self.base = np.uint64(int(rng.integers(1, 1 << 62)) * 2 + 1)
        self.space = np.zeros(256, bool)
        self.space[list(SPACES)] = True
        self.passed = None
        if fold:
            self.values[65:91] = self.values[97:123]
            self.passed = np.zeros(256, bool)
            self.passed[list(b'.,;:!?"()')] = True
            self.values[self.passed] = 0
        self.back = np.uint64(pow(int(self.base), -1, 1 << 64))
        self.up = self.down = np.empty(0, np.uint64)

    def __getstate__(self):
        return self.__dict__ | {"up": np.empty(0, np.uint64), "down": np.empty(0, np.uint64)}

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            ones = np.full(max(n, BLOCK), self.base)
            ones[0] = 1
            self.up = np.cumprod(ones)
            ones[1:] = self.back
            self.down = np.cumprod(ones)

    def __call__(self, text: bytes | np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Byte starts, byte ends and hashes of the words of one text, or of texts divided by whitespace."""
        buf = np.frombuffer(text, np.uint8) if isinstance(text, bytes) else text
        out, at = [], 0
        while at < len(buf):
            end = min(len(buf), at + BLOCK)
            while end < len(buf) and not self.space[buf[end - 1]]:  # up to the next space
                gap = np.flatnonzero(self.space[buf[end : end + BLOCK]])
                end = end + int(gap[0]) + 1 if len(gap) else min(len(buf), end + BLOCK)
            out.append(self._block(buf[at:end], at))
            at = end
        if not out:
            none = np.empty(0, np.int64)
            return none, none, np.empty(0, np.uint64)
        return tuple(np.concatenate(x) for x in zip(*out))

    def _block(self, buf: np.ndarray, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        inside = np.concatenate(([False], ~self.space[buf], [False]))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        self._powers(len(buf) + 1)
        if self.passed is None:
            up, first = self.up[: len(buf)], starts
        else:  # places among the bytes that are not passed over
            place = np.cumsum(~self.passed[buf]) - ~self.passed[buf]
            up, first = self.up[place], place[starts]
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(self.values[buf] * up)))
        return starts + at, ends + at, mix((sums[ends] - sums[starts]) * self.down[first])
