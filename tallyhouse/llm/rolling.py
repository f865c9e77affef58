"""Word and word-window hashes of whole texts with numpy, without a loop over words.

A text is its UTF-8 bytes; words are runs of bytes other than 0x20 and 0x09-0x0D. A word's hash is
a polynomial of a random value per byte, made from one prefix of the whole block; a window's hash is
a polynomial of its words' mixed hashes. All arithmetic is modulo 2**64. Two hashes with
different constants together identify a window.
"""

from __future__ import annotations

import numpy as np

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
BASES = (0x9E3779B97F4A7C13, 0xD6E8FEB86659FD93)
WINDOW_FACTORS = (0xA24BAED4963EE407, 0x9FB21C651E98DF25)
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def _byte_values(seed: int) -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASES[seed]))
    values[IS_SPACE] = 0
    return values


_VALUES = [_byte_values(0), _byte_values(1)]


class _Tables(dict):
    """Powers by base, made where they are needed: a copy that travels to a task is empty."""

    def __reduce__(self):
        return _Tables, ()


_POWERS = _Tables()
LEAST_POWERS, MOST_POWERS = 1 << 18, 1 << 22


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        room = max(LEAST_POWERS, 1 << (n - 1).bit_length()) if n <= MOST_POWERS else n
        steps = np.full(room, base, dtype=np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, out=steps)
        if n <= MOST_POWERS:  # a very long text's powers go when it is done
            _POWERS[base] = have
    return have[:n]


class Words:
    """The words of a block of texts: where they are, whose they are, and their hashes."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        blob = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        if lower:
            capital = (blob >= 65) & (blob <= 90)
            blob = blob + (capital.astype(np.uint8) << np.uint8(5))
        gap = np.empty(len(blob) + 1, dtype=np.int8)
        gap[0] = 1
        gap[1:] = IS_SPACE[blob]
        edge = np.diff(gap)
        self.blob = blob
        self.starts, self.ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
        bounds = np.concatenate(([0], np.cumsum(lengths)))
        self.first = np.searchsorted(self.starts, bounds)  # word number at which each text begins
        self.counts = np.diff(self.first)

    def hashes(self, seed: int) -> np.ndarray:
        if not len(self.starts):
            return np.zeros(0, dtype=np.uint64)
        base = BASES[seed]
        sums = np.add.reduceat(_VALUES[seed][self.blob] * _powers(base, len(self.blob)), self.starts)
        inverse = _powers(pow(base, -1, 1 << 64), len(self.blob))
        sums = sums * inverse[self.starts]
        return mix(sums + (self.ends - self.starts).astype(np.uint64) * np.uint64(_MIX1))

    def window_starts(self, size: int) -> np.ndarray:
        """Word numbers at which a whole window of its text begins."""
        whole = np.maximum(self.counts - size + 1, 0)
        before = np.cumsum(whole) - whole
        return np.arange(int(whole.sum())) + np.repeat(self.first[:-1] - before, whole)

    def owner(self, size: int) -> np.ndarray:
        """The text number of every window of ``window_starts``."""
        return np.repeat(np.arange(len(self.counts)), np.maximum(self.counts - size + 1, 0))

    def windows(self, size: int, seed: int) -> np.ndarray:
        """A hash for every window of ``window_starts``."""
        return rolled(self.hashes(seed), size, seed)[self.window_starts(size)]


def rolled(words: np.ndarray, size: int, seed: int) -> np.ndarray:
    """The hash of the ``size`` words from each position on, as far as they are there."""
    n = max(len(words) - size + 1, 0)
    total, factor = np.zeros(n, dtype=np.uint64), np.uint64(WINDOW_FACTORS[seed])
    for k in range(size):
        total = total * factor + words[k : k + n]
    return mix(total)


def shingle_sets(texts: list[bytes], size: int = 5) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes, A-Z lower-cased; a text with fewer words is one
    shingle, a text without words has none."""
    words = Words(texts, lower=True)
    plain = words.hashes(0)
    every = rolled(plain, size, 0)
    sets = []
    for at, n in zip(words.first[:-1], words.counts):
        if n >= size:
            sets.append(np.unique(every[at : at + n - size + 1]))
        else:
            sets.append(rolled(plain[at : at + n], n, 0) if n else every[:0])
    return sets
