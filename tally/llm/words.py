"""Words of many texts at once: places and 64-bit hashes, computed over one buffer of bytes.

A word is a run of characters other than space, tab, line feed, vertical tab, form feed and carriage return. Its hash
depends on its bytes alone, so it is the same in every text, task and run. Hashes stand for words; two of a corpus's
words collide with a probability of about 2 ** -64 a pair.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

import numpy as np

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2 ** 64
_INVERSE = pow(_BASE, -1, 1 << 64)

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the base and its inverse, as many as the longest buffer so far needs."""

    def __init__(self):
        self.up = self.down = np.empty(0, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, b, np.uint64)]), dtype=np.uint64) for b in (_BASE, _INVERSE))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()
_LETTERS = mixed(np.arange(1, 257, dtype=np.uint64))


@dataclass
class Words:
    """``buffer``: the texts' UTF-8, each with a line feed behind it; text i is ``buffer[begins[i]:ends[i]]``."""

    buffer: np.ndarray
    begins: np.ndarray
    ends: np.ndarray
    lower: bool = False
    space: np.ndarray = field(init=False)

    def __post_init__(self):
        self.space = _SPACE[self.buffer]

    @classmethod
    def of(cls, texts: list[str], lower: bool = False) -> Words:
        """``lower``: A to Z count as a to z."""
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        ends = np.cumsum(np.fromiter((len(r) + 1 for r in raw), np.int64, len(raw))) - 1
        data = b"\n".join([*raw, b""])
        return cls(np.frombuffer(data.lower() if lower else data, np.uint8), np.concatenate([[0], ends[:-1] + 1])[: len(raw)], ends, lower)

    @cached_property
    def starts(self) -> np.ndarray:
        before = np.concatenate([[True], self.space[:-1]])
        return np.flatnonzero(~self.space & before)

    @cached_property
    def stops(self) -> np.ndarray:
        before = np.concatenate([[True], self.space[:-1]])
        return np.flatnonzero(self.space & ~before)

    @cached_property
    def hashes(self) -> np.ndarray:
        up, down = _POWERS.of(len(self.buffer) + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_LETTERS[self.buffer] * up[: len(self.buffer)], dtype=np.uint64)])
        return mixed((sums[self.stops] - sums[self.starts]) * down[self.starts])

    @cached_property
    def first(self) -> np.ndarray:
        """Number of the first word of each text; the word count is the difference to the next."""
        return np.searchsorted(self.starts, np.append(self.begins, len(self.buffer)))

    @cached_property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``width`` words within a text, and the number of each run's first word."""
        n = len(self.starts)
        if n < width:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        total = np.zeros(n - width + 1, np.uint64)
        for i in range(width):
            total += self.hashes[i : n - width + 1 + i] * (_LETTERS[i] | np.uint64(1))
        last = np.repeat(self.first[1:], self.counts)
        at = np.flatnonzero(np.arange(n) + width <= last)
        return mixed(total[at]), at
