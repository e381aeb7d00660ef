"""Word shingles of a text as sets of 64-bit numbers, and the keys under which such sets meet.

Small helpers that run on the executors, a text at a time; Spark partitions and moves the work.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import functions as F

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_PIECE = 1 << 20  # bytes hashed at once
EACH = 20  # for so many shingles of a set, linked sets have one more of the rarest in common
_ODD = 0x9E3779B97F4A7C15
_BACK = pow(_ODD, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers (the finalizer of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# A number per byte value, and powers of an odd number and of its inverse, as many as were needed.
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = max(n, 1 << 16)
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        known = _powers[base] = np.multiply.accumulate(steps)
    return known[:n]


def word_hashes(raw: bytes) -> np.ndarray:
    """A number per word of a piece that ends with a word or white space.

    A word's bytes are weighed by powers of an odd number; running sums give every word's sum, and
    the inverse power moves it to the same place.
    """
    data = np.frombuffer(raw, np.uint8)
    inside = np.concatenate([[False], ~_SPACE[data], [False]]).astype(np.int8)
    step = np.diff(inside)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers(_ODD, len(data)), out=sums[1:])
    moved = (sums[ends] - sums[starts]) * powers(_BACK, len(data))[starts]
    return mix(moved + (ends - starts).astype(np.uint64))


def pieces(raw: bytes) -> list[bytes]:
    """A long text in pieces that are cut at white space."""
    out, start = [], 0
    while len(raw) - start > _PIECE:
        end = start + _PIECE
        while end < len(raw) and not _SPACE[raw[end]]:
            end += 1
        out.append(raw[start:end])
        start = end
    return [*out, raw[start:]]


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct shingles; the whole sequence is the one shingle of a text with fewer words.

    On bytes, ``lower`` changes A-Z only.
    """
    raw = text.encode("utf-8", "surrogatepass").lower() if text else b""
    ids = np.concatenate([word_hashes(p) for p in pieces(raw)]) if raw else np.zeros(0, np.uint64)
    if not len(ids):
        return ids
    width = min(words, len(ids))
    out = np.full(len(ids) - width + 1, width, np.uint64)
    for j in range(width):
        out = out * np.uint64(_ODD) + ids[j : len(ids) - width + 1 + j]
    out = mix(out)
    out.sort()
    new = np.empty(len(out), bool)
    new[0] = True
    np.not_equal(out[1:], out[:-1], out=new[1:])
    return out[new]


@dataclass(frozen=True)
class Similarity:
    """Two sets link when ``whole * intersection >= part * union``; shingles have ``words`` words."""

    words: int
    part: int
    whole: int = 100

    def needed_column(self, a, b):
        """Smallest intersection of linked sets of sizes ``a`` and ``b``, as a column."""
        return F.ceil(self.part * (a + b) / (self.part + self.whole))

    def band_column(self, n, largest: int):
        """Number of the size band: linked sets are in the same one or in neighbouring ones.

        Each band's least size is beyond what the least of the band before may link with.
        """
        edges = [1]
        while edges[-1] <= largest:
            edges.append(edges[-1] * self.whole // self.part + 1)
        return F.size(F.filter(F.array(*[F.lit(e).cast("long") for e in edges]), lambda e: e <= n))

    def schemes(self, n: int) -> list[tuple[int, int, int]]:
        """(number, fragments, spare fragments) of the cuts in which a set of size ``n`` takes part.

        Sizes fall into classes that grow by half. A pair is cut as the class of its larger set says,
        so a set takes part in its own class and in those its largest possible partner may have. Up
        to ``apart`` shingles of a linked pair differ; with more fragments than that, at least one
        (and one more per spare) is the same in both.
        """
        out, number, low = [], 0, 1
        largest = n * self.whole // self.part
        while low <= largest:
            high = max(low + 1, low + low // 2)
            if n < high:
                apart = 2 * (high - 1) * (self.whole - self.part) // (self.whole + self.part)
                if apart:
                    spare = 1 + apart // 16
                    out.append((number, apart + 1 + spare, spare))
            number, low = number + 1, high
        return out

    @property
    def thin(self) -> int:
        """Fragments of at most so many shingles say little and are passed over where that is safe."""
        return 1 if self.whole >= 7 * (self.whole - self.part) else 0

    @property
    def rare_first(self) -> bool:
        """Whether fragments would be so thin that prefixes of the rarest shingles make the better keys."""
        return not self.thin

    def prefix(self, shingles: np.ndarray, level: np.ndarray) -> np.ndarray:
        """The first shingles by level, then number: linked sets have ``least_column`` of these in common.

        Linked sets share at least ``part / whole`` of the larger one. So at most ``n - ceil(part * n / whole)`` of a set
        are not shared, and its first ``1 + n // EACH`` shared ones are among so many more; of the smaller set's
        first ones, each is among the larger one's, too.
        """
        n = len(shingles)
        first = n + 1 + (-self.part * n) // self.whole + n // EACH if n else 0
        return shingles[np.argsort(level, kind="stable")[:first]]

    def least_column(self, n):
        """Shingles of its prefix that a set of size ``n`` shares with that of any set it links with, as a column."""
        return F.floor(F.ceil(self.part * n / self.whole) / EACH) + 1

    def keys(self, shingles: np.ndarray) -> np.ndarray:
        """A key per fragment: equal for equal segments of the same cut.

        Thin fragments are left out by sets with at most as many of them as there are spares. Two
        linked sets still meet: if both leave theirs out, they have the same thin fragments among
        the equal ones, at most the spares; one that does not leave any out has all keys.
        """
        scrambled = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(shingles + np.uint64(1)))])
        top, out = shingles >> np.uint64(32), []
        for number, fragments, spare in self.schemes(len(shingles)):
            at = (top * np.uint64(fragments)) >> np.uint64(32)
            edges = np.searchsorted(at, np.arange(fragments + 1, dtype=np.uint64))
            segment = scrambled[edges[1:]] - scrambled[edges[:-1]]
            label = mix(np.arange(fragments, dtype=np.uint64) + np.uint64(number << 40) + np.uint64(7))
            thin = np.diff(edges) <= self.thin
            key = mix(segment ^ label)
            out.append(key[~thin] if thin.sum() <= spare else key)
        return np.concatenate(out) if out else np.zeros(0, np.uint64)
