"""Periodic runs of words, found in a grammar-compressed text.

Every text is a sequence of word numbers, compressed by Re-Pair: in each round the most frequent
pairs of a text's neighbours become new symbols, until no pair occurs twice. (All pairs of the
highest class of counts, by powers of two, are replaced in one round; of pairs that overlap, one
with the highest hash wins.) A run lies in the expansion of some lowest node of the parse
tree and crosses the border of that node's two children. So the runs across its border are computed
once for each symbol, at its first place, by longest common extensions of hashed prefixes, and are
moved to all its other places; the symbols that are left over stand under a balanced binary
tree, whose nodes occur once. Intervals inside others of the same period are merged into these, and an
interval belongs to its smallest period. What was found is compared word by word.

Null and empty texts have no words and no runs. A very long text takes memory and time in proportion
to its length times its logarithm, one text at a time. Runs of equal length tie by start, then
period. Repeated rows are searched each for itself; other columns are carried along in ``doc``.
An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlake.llm.text import packed

MIN_LENGTH = 12
TOGETHER = 250_000  # words of texts searched at once
_PRIMES = (np.uint64(2_147_483_647), np.uint64(2_147_483_629))
_MIX = np.uint64(0x9E3779B97F4A7C15)
_FOUND = "runs array<struct<start: long, length: long, period: long>>, collapsed string"


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x + _MIX) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Prefixes:
    """Hashed prefixes of a sequence, for longest common extensions of two places."""

    def __init__(self, ids: np.ndarray, seed: int):
        self.n, self.sums, self.powers = len(ids), [], []
        for i, p in enumerate(_PRIMES):
            base = np.uint64(1_000_003 + 2 * (2 * seed + i))
            powers = np.ones(self.n + 1, np.uint64)
            done, step = 1, base
            while done <= self.n:
                more = min(done, self.n + 1 - done)
                powers[done : done + more] = powers[:more] * step % p
                done, step = done + more, step * step % p
            values = mixed(ids.astype(np.uint64) + np.uint64(seed)) % p
            self.sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * powers[:-1] % p)]))
            self.powers.append(powers)

    def equal(self, i: np.ndarray, j: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether so many words from i and from j > i are the same."""
        out = np.ones(len(i), bool)
        for p, sums, powers in zip(_PRIMES, self.sums, self.powers):
            out &= (sums[i + length] - sums[i]) % p * powers[j - i] % p == (sums[j + length] - sums[j]) % p
        return out

    def extension(self, i: np.ndarray, j: np.ndarray, limit: np.ndarray, back: bool) -> np.ndarray:
        """Length of the longest common extension of i and j > i, up to the limit, forwards or backwards."""
        low, high = np.zeros(len(i), np.int64), limit.copy()
        while len(i) and (low < high).any():
            half = (low + high + 1) >> 1
            same = self.equal(i - half, j - half, half) if back else self.equal(i, j, half)
            low, high = np.where(same, half, low), np.where(same, high, half - 1)
        return low


class Nodes:
    """Nodes of the parse tree as (lo, mid, hi), and all places of those that occur more than once."""

    def __init__(self) -> None:
        self.first: list[np.ndarray] = []  # rows lo, mid, hi
        self.places: list[tuple[np.ndarray, np.ndarray]] = []  # (index of the node, start)
        self.count = 0

    def add(self, nodes: np.ndarray, which: np.ndarray, starts: np.ndarray) -> None:
        self.first.append(nodes)
        self.places.append((which + self.count, starts))
        self.count += nodes.shape[1]


def compress(ids: np.ndarray, doc: np.ndarray, least: int) -> tuple[np.ndarray, Nodes]:
    """Starts of the symbols that are left, and the grammar's symbols of at least ``least`` words."""
    nodes, done = Nodes(), []
    sym, pos, size = ids.astype(np.int64), np.arange(len(ids)), np.ones(len(ids), np.int64)
    link = np.append(doc[1:] == doc[:-1], False) if len(ids) else np.zeros(0, bool)
    fresh = int(ids.max(initial=0)) + 1
    while True:
        at = np.flatnonzero(link)
        if not len(at):
            break
        a, b, d = sym[at], sym[at + 1], doc[pos[at]]
        # In a row of equal symbols every second pair counts, as neighbours overlap.
        odd = np.zeros(len(at), bool)
        twin = np.flatnonzero(a == b)
        if len(twin):
            opens = np.append(True, (np.diff(at[twin]) != 1) | (np.diff(a[twin]) != 0))
            begin = np.maximum.accumulate(np.where(opens, at[twin], 0))
            odd[twin] = (at[twin] - begin) & 1 == 1
        key = mixed(mixed(a.astype(np.uint64) * _MIX + b.astype(np.uint64)) + d.astype(np.uint64))
        bits = np.uint64(len(at).bit_length())
        order = (np.sort((key >> bits << bits) | np.arange(len(at), dtype=np.uint64)) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        differs = np.append(False, (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0) | (np.diff(d[order]) != 0))
        group = np.empty(len(at), np.int64)
        group[order] = np.cumsum(differs)
        count = np.bincount(group[~odd], minlength=int(group[order[-1]]) + 1)[group]
        link[at[count < 2]] = False  # a pair that occurs once never occurs more often later
        tier = np.frexp(count.astype(np.float64))[1]
        opens = np.flatnonzero(np.append(True, np.diff(d) != 0))
        highest = np.repeat(np.maximum.reduceat(tier, opens), np.diff(np.append(opens, len(d))))
        wanted = (tier == highest) & (count >= 2) & ~odd
        rank = np.zeros(len(sym) + 2, np.uint64)
        rank[at[wanted] + 1] = key[wanted] | np.uint64(1)
        here = rank[at + 1]
        taken = np.flatnonzero(wanted & (here > rank[at]) & (here > rank[at + 2]))
        taken = taken[np.bincount(group[taken], minlength=len(at) + 1)[group[taken]] >= 2]
        if not len(taken):  # two pairs of one hash side by side
            break
        kinds, first, which = np.unique(group[taken], return_index=True, return_inverse=True)
        left = at[taken]
        hi = pos[left + 1] + size[left + 1]
        long_enough = (hi - pos[left])[first] >= least
        if long_enough.any():
            number = np.cumsum(long_enough) - 1
            told = long_enough[which]
            f = left[first[long_enough]]
            nodes.add(
                np.stack([pos[f], pos[f + 1], pos[f + 1] + size[f + 1]]), number[which[told]], pos[left[told]]
            )
        sym[left], size[left] = fresh + which, hi - pos[left]
        fresh += len(kinds)
        link[left] = link[left + 1]
        stays = np.ones(len(sym), bool)
        stays[left + 1] = False
        sym, pos, size, link = sym[stays], pos[stays], size[stays], link[stays]
        alone = ~(link | np.append(False, link[:-1]))
        done.append(pos[alone])
        sym, pos, size, link = sym[~alone], pos[~alone], size[~alone], link[~alone]
    return np.sort(np.concatenate([*done, pos])), nodes


def tree_levels(starts: np.ndarray, doc: np.ndarray, ends: np.ndarray, least: int) -> Iterator[np.ndarray]:
    """Nodes (lo, mid, hi) of a balanced tree over each text's symbols, level by level."""
    if not len(starts):
        return
    d = doc[starts]
    opens = np.append(True, np.diff(d) != 0)
    begin = np.maximum.accumulate(np.where(opens, np.arange(len(d)), 0))
    last = np.append(np.flatnonzero(opens)[1:], len(d))[np.cumsum(opens) - 1]  # index after the text's last symbol
    place = np.arange(len(d)) - begin
    half = 1
    while half <= place.max():
        mid = np.flatnonzero(place & (2 * half - 1) == half)
        upto = mid + half
        hi = np.where(upto < last[mid], starts[np.minimum(upto, len(d) - 1)], ends[d[mid]])
        nodes = np.stack([starts[mid - half], starts[mid], hi])
        yield nodes[:, nodes[2] - nodes[0] >= least]
        half *= 2


def crossing(nodes: np.ndarray, threes: np.ndarray, prefixes: Prefixes, least: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(index of the node, start, end, period) of the repetitions across the nodes' borders.

    A run of at least ``least`` >= 12 words and two periods repeats six words or more at the
    distance of its period around the border, so three of them to one side; that is looked up first.
    """
    width = nodes[2] - nodes[0]
    for right in (True, False):
        most = np.minimum(nodes[2] - nodes[1] if right else nodes[1] - nodes[0], width // 2)
        upto = np.cumsum(most)
        cuts = np.searchsorted(upto, np.arange(0, upto[-1] if len(upto) else 0, 4 * TOGETHER), "right")
        for lo_node, hi_node in zip(cuts, np.append(cuts[1:], len(most))):
            if lo_node == hi_node:
                continue
            n = most[lo_node:hi_node]
            node = np.repeat(np.arange(lo_node, hi_node), n)
            q = np.arange(len(node)) - np.repeat(np.cumsum(n) - n, n) + 1
            mid = nodes[1][node]
            other = mid + q if right else mid - q
            # ``threes`` has three places in front, so that index i + 3 is place i.
            hit = (threes[mid + 3] == threes[other + 3]) | (threes[mid] == threes[np.maximum(other, 0)])
            node, q, mid, other = node[hit], q[hit], mid[hit], other[hit]
            i, j = (mid, other) if right else (other, mid)
            after = prefixes.extension(i, j, nodes[2][node] - j, back=False)
            before = prefixes.extension(i, j, i - nodes[0][node], back=True)
            fits = before + after + q >= np.maximum(least, 2 * q)
            yield node[fits], (i - before)[fits], (j + after)[fits], q[fits]


def runs_of(ids: np.ndarray, doc: np.ndarray, ends: np.ndarray, least: int = MIN_LENGTH, seed: int = 0) -> np.ndarray:
    """Rows (start, end, period) of all runs of several texts written one after another.

    ``doc`` numbers the text of each word, ``ends`` gives each text's end.
    """
    if len(ids) < least:
        return np.zeros((0, 3), np.int64)
    prefixes = Prefixes(ids, seed)
    v = np.concatenate([np.zeros(3, np.uint64), ids.astype(np.uint64) + np.uint64(1), np.zeros(3, np.uint64)])
    threes = mixed(mixed(mixed(v[:-2]) + v[1:-1]) + v[2:])
    left_over, grammar = compress(ids, doc, least)
    found = []
    if grammar.count:
        first = np.concatenate(grammar.first, axis=1)
        which = np.concatenate([w for w, _ in grammar.places])
        starts = np.concatenate([s for _, s in grammar.places])
        order = np.argsort(which, kind="stable")
        which, starts = which[order], starts[order]
        begin = np.searchsorted(which, np.arange(grammar.count + 1))
        for node, start, end, q in crossing(first, threes, prefixes, least):
            times = begin[node + 1] - begin[node]
            row = np.repeat(np.arange(len(node)), times)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            shift = starts[begin[node[row]] + nth] - first[0][node[row]]
            found.append(np.stack([start[row] + shift, end[row] + shift, q[row]]))
    for level in tree_levels(left_over, doc, ends, least):
        found.extend(np.stack(part[1:]) for part in crossing(level, threes, prefixes, least))
    runs = maximal(np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64))
    if not all(verified(ids, *run) for run in runs):  # two different stretches of one hash: take other hashes
        return runs_of(ids, doc, ends, least, seed + 1)
    return runs


def maximal(found: np.ndarray) -> np.ndarray:
    """Intervals inside others of their period go; of equal intervals the smallest period stays."""
    start, end, q = found[:, np.lexsort((-found[1], found[0], found[2]))]
    if not len(start):
        return np.zeros((0, 3), np.int64)
    group = np.cumsum(np.append(0, np.diff(q) != 0)) * (end.max() + 1)
    reach = np.maximum.accumulate(group + end)
    kept = np.append(True, (group + end)[1:] > reach[:-1])
    start, end, q = start[kept], end[kept], q[kept]
    order = np.lexsort((q, end, start))
    start, end, q = start[order], end[order], q[order]
    new = np.append(True, (np.diff(start) != 0) | (np.diff(end) != 0))
    start, end, q = start[new], end[new], q[new]
    order = np.lexsort((q, start))
    return np.stack([start[order], end[order], q[order]], axis=1)


def verified(ids: np.ndarray, start: int, end: int, q: int) -> bool:
    return np.array_equal(ids[start : end - q], ids[start + q : end])


def searched(texts: list[str | None], least: int = MIN_LENGTH) -> Iterator[tuple[list[tuple[int, int, int]], str]]:
    """(runs as (start, length, period), collapsed text) of each text."""
    part: list[list[bytes]] = []
    size = 0
    for text in texts:
        # bytes.split cuts at the six ASCII white spaces and nothing else.
        part.append(text.encode("utf-8", "surrogatepass").split() if text else [])
        size += len(part[-1])
        if size > TOGETHER:
            yield from search_part(part, least)
            part, size = [], 0
    yield from search_part(part, least)


def search_part(part: list[list[bytes]], least: int) -> Iterator[tuple[list[tuple[int, int, int]], str]]:
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for words in part for w in words], np.int64)
    lengths = np.array([len(words) for words in part], np.int64)
    ends = np.cumsum(lengths)
    begins = ends - lengths
    doc = np.repeat(np.arange(len(part)), lengths)
    runs = runs_of(ids, doc, ends, least)
    edge = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 1], -1)
    kept = np.cumsum(edge)[: len(ids)] == 0
    cuts = np.searchsorted(runs[:, 0], np.append(begins, len(ids)))
    for k, words in enumerate(part):
        own = runs[cuts[k] : cuts[k + 1]]
        if len(own):
            words = [w for w, keep in zip(words, kept[begins[k] : ends[k]]) if keep]
        spans = [(int(s - begins[k]), int(e - s), int(q)) for s, e, q in own]
        yield spans, b" ".join(words).decode("utf-8", "surrogatepass")


def found_frames(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        rows = [
            ([{"start": s, "length": n, "period": q} for s, n, q in spans], text) for spans, text in searched(texts.tolist())
        ]
        yield pd.DataFrame(rows, columns=["runs", "collapsed"])


def periodic_runs(docs: DataFrame, text: Column | None = None) -> DataFrame:
    """Each document as ``doc`` with its ``runs`` (start, length, period; by start, then period) and
    ``collapsed``, its words joined by blanks without those that a run repeats."""
    text = F.col("text") if text is None else text
    found = F.pandas_udf(found_frames, _FOUND)
    return docs.select(packed(docs).alias("doc"), found(text).alias("_found")).select("doc", "_found.*")


def longest(runs: Column) -> Column:
    """The run of greatest length, then smallest start, then period; null without runs."""
    return F.array_min(F.transform(runs, lambda r: F.struct(
        (-r["length"]).alias("shorter"), r["start"].alias("start"), r["period"].alias("period"))))
