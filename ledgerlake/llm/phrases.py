"""Phrase collocations from an FM-index per shard.

Each task writes the words of its texts as numbers, piece after piece with a border between, and
indexes a shard as soon as it has ``SHARD`` words: suffixes sorted by their first words,
the Burrows-Wheeler transform of the words and of the reversed words. Intervals of phrases are
extended to the left and to the right, both indexes kept in step, up to the phrases' length; an interval's
width is the phrase's count in the shard. Counts are added over the shards.

Longer phrases are taken in a second pass: a phrase can be frequent only if all its parts are, so an
interval is extended only to words with which its two longest parts are frequent, as a bitmap of fixed
size has it. The bitmap errs to one side only: it may let an infrequent phrase pass, which the exact
counts then drop. So nothing that could be frequent is lost at any size.

A null text has no pieces; a null language is ``und``; empty texts and texts without words add
nothing; a very long text is cut into shards between pieces (a single piece stays whole). Repeated
rows count each. Ties are settled by the count, then by the phrase in byte order. Other columns are not looked
at. An empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ledgerlake.llm.scratch import materialize

SHARD = 1 << 20  # words indexed at once
BITS = 1 << 27  # of the bitmap of frequent phrases, 16 MB
SPREAD = 64  # parts of a language's phrases in the ranking's first step
_BUCKET = 8 * 4096  # bits of one of Spark's bitmaps
_TIMES, _MODULUS = 1_000_003, 2_147_483_647
_BORDER = b"\xff"  # a byte that no UTF-8 text has
_COUNTS = "lang string, phrase string, n long"
_TABLE = bytes(
    0xFF if c in b".,;:!?" or 0x0A <= c <= 0x0D else c + 32 if 65 <= c <= 90 else c for c in range(256)
)


def words_of(text: str) -> list[bytes]:
    """Lower-cased words with a border after each piece."""
    return (text.encode("utf-8", "surrogatepass").translate(_TABLE) + _BORDER).replace(_BORDER, b" \xff ").split()


class Index:
    """One direction of the FM-index: suffixes sorted by ``depth`` symbols, transform and LF mapping."""

    def __init__(self, text: np.ndarray, depth: int, symbols: int):
        bits = max(1, int(symbols).bit_length())
        later = [np.append(text[k:], np.zeros(min(k, len(text)), text.dtype)) for k in range(depth)]
        if bits * depth <= 62:
            key = later[0].astype(np.int64)
            for k in range(1, depth):
                key = (key << bits) | later[k]
            order = np.argsort(key)
        else:
            order = np.lexsort(later[::-1])
        self.bwt = text[order - 1]  # a text begins with a border, so the first one's neighbour is one, too
        self.counts = np.bincount(text, minlength=symbols + 1)
        self.before = np.concatenate([np.zeros(1, np.int64), np.cumsum(self.counts)])
        by_symbol = np.argsort(self.bwt, kind="stable")
        self.lf = np.empty(len(text), np.int32)
        self.lf[by_symbol] = np.arange(len(text), dtype=np.int32)


class Intervals:
    """Phrases as rows of word numbers with their intervals in both directions."""

    def __init__(self, words: np.ndarray, lo: np.ndarray, back: np.ndarray, n: np.ndarray):
        self.words, self.lo, self.back, self.n = words, lo, back, n

    def where(self, mask: np.ndarray) -> Intervals:
        return Intervals(self.words[mask], self.lo[mask], self.back[mask], self.n[mask])


class PhraseIndex:
    """Bidirectional FM-index of one shard; symbol 0 is the border."""

    def __init__(self, text: np.ndarray, depth: int):
        symbols = int(text.max(initial=0))
        self.forward = Index(text, depth, symbols)
        self.reverse = Index(np.roll(text[::-1], 1), depth, symbols)

    def single(self) -> Intervals:
        words = np.flatnonzero(self.forward.counts[1:]) + 1
        at = self.forward.before[words]
        return Intervals(words[:, None].astype(np.int32), at, at.copy(), self.forward.counts[words])

    def extended(self, of: Intervals, left: bool) -> Intervals:
        """All extensions by one word; the other direction's intervals follow."""
        index, lo, other = (self.forward, of.lo, of.back) if left else (self.reverse, of.back, of.lo)
        which = np.repeat(np.arange(len(of.n)), of.n)
        rows = np.repeat(lo, of.n) + np.arange(len(which)) - np.repeat(np.cumsum(of.n) - of.n, of.n)
        symbol = index.bwt[rows]
        key = which * (len(index.counts) + 1) + symbol
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.append(True, np.diff(key) != 0)) if len(key) else np.zeros(0, np.int64)
        n = np.diff(np.append(first, len(key)))
        phrase, added = which[order[first]], symbol[order[first]]
        own = index.lf[rows[order[first]]]  # the first of the symbol's rows maps to where the longer phrase begins
        base = np.cumsum(of.n) - of.n
        stepped = other[phrase] + first - base[phrase]  # smaller symbols stand before it in the other direction
        words = np.hstack([added[:, None], of.words[phrase]]) if left else np.hstack([of.words[phrase], added[:, None]])
        out = Intervals(words, own, stepped, n) if left else Intervals(words, stepped, own, n)
        return out.where(added > 0)


def phrase_text(words: np.ndarray, names: pa.Array) -> pa.Array:
    columns = [names.take(pa.array(words[:, k])) for k in range(words.shape[1])]
    return columns[0] if len(columns) == 1 else pc.binary_join_element_wise(*columns, pa.scalar(" ", pa.large_string()))


class Frequent:
    """Bitmap of frequent phrases of one length."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def has(self, lang: str, words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Whether phrases may be frequent; ``hashes`` holds each word's CRC-32."""
        at = np.full(len(words), zlib.crc32(lang.encode("utf-8", "surrogatepass")), np.int64)
        for k in range(words.shape[1]):
            at = (at * _TIMES + hashes[words[:, k]]) % _MODULUS
        at %= BITS
        return (self.bits[at >> 3] >> (at & 7) & 1).astype(bool)


def bitmap_of(phrases: DataFrame) -> np.ndarray:
    """``BITS`` bits as bytes, whatever the number of (lang, phrase) rows; one row for 32,768 bits comes to the driver.

    A phrase's place is folded from its words' checksums, so that tasks need no phrases as texts.
    """
    folded = F.aggregate(
        F.split("phrase", " "), F.crc32("lang"), lambda h, w: (h * F.lit(_TIMES) + F.crc32(w)) % F.lit(_MODULUS)
    )
    at = folded % F.lit(BITS)
    parts = (
        phrases.select(F.floor(at / _BUCKET).alias("part"), (at % _BUCKET).alias("bit"))
        .groupBy("part").agg(F.expr("bitmap_construct_agg(bit)").alias("bits")).collect()
    )
    out = np.zeros(BITS // 8, np.uint8)
    for row in parts:
        start = row["part"] * (_BUCKET // 8)
        out[start : start + _BUCKET // 8] = np.frombuffer(row["bits"], np.uint8)
    return out


Counts = Callable[[PhraseIndex, str, np.ndarray], Iterator[Intervals]]


def short_counts(index: PhraseIndex, lang: str, hashes: np.ndarray) -> Iterator[Intervals]:
    """Words and pairs of words."""
    single = index.single()
    yield single
    yield index.extended(single, left=True)


def longer_counts(k: int, frequent: Frequent) -> Counts:
    """Phrases of k words whose two longest parts may be frequent."""

    def counts(index: PhraseIndex, lang: str, hashes: np.ndarray) -> Iterator[Intervals]:
        found = index.extended(index.single(), left=True)
        for _ in range(k - 3):
            found = index.extended(found, left=False)
        found = found.where(frequent.has(lang, found.words, hashes))
        found = index.extended(found, left=False)
        yield found.where(frequent.has(lang, found.words[:, 1:], hashes))

    return counts


class Numbers(dict):
    """Numbers new words as they are asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class Shard:
    """Words of texts as numbers; 0 is the border."""

    def __init__(self) -> None:
        self.number = Numbers({_BORDER: 0})
        self.ids = array("i")

    def add(self, words: list[bytes]) -> None:
        self.ids.extend(map(self.number.__getitem__, words))


def pieces_from(words: list[bytes]) -> Iterator[slice]:
    """The words of a text, in parts that end behind a piece, each over ``SHARD`` words but the last."""
    start = 0
    while start < len(words):
        end = len(words)
        if end - start > SHARD:
            end = words.index(_BORDER, start + SHARD) + 1  # the last word is a border
        yield slice(start, end)
        start = end


def shard_counts(depth: int, counts: Counts, totals: bool):
    """A task's function: batches of (lang, text) to rows (lang, phrase, n), shard after shard."""

    def emit(lang: str, shard: Shard) -> Iterator[pa.RecordBatch]:
        text = np.frombuffer(shard.ids, np.int32)
        names = pa.array(
            ["" if w == _BORDER else w.decode("utf-8", "surrogatepass") for w in shard.number], pa.large_string()
        )
        hashes = np.array([zlib.crc32(w) for w in shard.number], np.int64)
        if totals and len(text):
            yield rows(lang, pa.array([None], pa.string()), np.array([(text > 0).sum()]))
        for found in counts(PhraseIndex(np.append(np.int32(0), text), depth), lang, hashes):
            for at in range(0, len(found.n), 100_000):
                part = slice(at, at + 100_000)
                yield rows(lang, phrase_text(found.words[part], names).cast(pa.string()), found.n[part])

    def rows(lang: str, phrase: pa.Array, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(n), pa.string()), phrase, pa.array(n, pa.int64())], names=["lang", "phrase", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, Shard] = {}
        held = 0
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                lang, words = lang.as_py(), words_of(text.as_py())
                for start in pieces_from(words):
                    shard = waiting.setdefault(lang, Shard())
                    shard.add(words[start])
                    held += start.stop - start.start
                    if held >= SHARD:
                        longest = max(waiting, key=lambda x: len(waiting[x].ids))
                        held -= len(waiting[longest].ids)
                        yield from emit(longest, waiting.pop(longest))
        for lang, shard in waiting.items():
            yield from emit(lang, shard)

    return run


def phrase_counts(docs: DataFrame, depth: int = 3, least: int = 10, lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(lang, n words) and the table (lang, phrase, words, n) of all phrases found ``least`` times or more."""
    texts = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), "text").filter("text is not null")

    def summed(run) -> DataFrame:
        return texts.mapInArrow(run, _COUNTS).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))

    size = F.size(F.split("phrase", " ")).alias("words")
    kept = (F.col("n") >= least) | F.col("phrase").isNull()
    counted = materialize(summed(shard_counts(min(depth, 2), short_counts, True)).filter(kept).select("lang", "phrase", size, "n"))
    totals = counted.filter("phrase is null").select("lang", "n")
    tables = [counted.filter("phrase is not null")]
    sc = docs.sparkSession.sparkContext
    for k in range(3, depth + 1):
        sent = sc.broadcast(bitmap_of(tables[-1].filter(F.col("words") == k - 1)))
        run = shard_counts(k, sent_counts(k, sent), False)
        tables.append(materialize(summed(run).filter(kept).select("lang", "phrase", size, "n")))
    out = tables[0]
    for more in tables[1:]:
        out = out.union(more)
    return totals, out.filter(F.col("words") <= depth)


def sent_counts(k: int, sent) -> Counts:
    return lambda index, lang, hashes: longer_counts(k, Frequent(sent.value))(index, lang, hashes)


def part(words: Column, start: int | Column, length: int | Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(
    docs: DataFrame, depth: int = 3, least: int = 10, inside: int = 50, top: int = 2000, lang: str = "lang"
) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase is cut in two where that gives the lowest score, floor(1,000,000 a a / (l r)), a being its own
    count, l and r those of its parts. Phrases inside a longer one that has ``inside`` per cent of
    their count or more are left out.
    """
    return ranked_phrases(*phrase_counts(docs, depth, least, lang), inside, top)


def ranked_phrases(totals: DataFrame, counts: DataFrame, inside: int, top: int) -> DataFrame:
    """``collocations`` from (lang, n words) and (lang, phrase, words, n) of the frequent phrases."""
    phrases = counts.filter("words > 1").withColumn("w", F.split("phrase", " "))
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "lang", "phrase", F.col("n").alias("a"), "k",
        part(F.col("w"), F.lit(1), F.col("k")).alias("first"), part(F.col("w"), F.col("k") + 1, F.col("words") - F.col("k")).alias("rest"),
    )
    known = counts.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_part"), F.col("n").alias("_n"))
    for side, name in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(known, (F.col("lang") == F.col("_lang")) & (F.col(side) == F.col("_part"))).withColumn(name, F.col("_n")).drop("_lang", "_part", "_n")
    scored = cuts.withColumn("score", F.expr(
        "(cast(1000000 as decimal(7,0)) * (cast(a as decimal(15,0)) * cast(a as decimal(15,0))))"
        " div (cast(l as decimal(15,0)) * cast(r as decimal(15,0)))"
    ))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("_best")).select("lang", "phrase", "a", "_best.score", "_best.l", "_best.r")
    # Of every phrase, its inner parts of two words or more.
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("words") - m + 1), lambda i: part(F.col("w"), i, m))))
    around = (
        phrases.filter("words > 2").select(F.col("lang").alias("_lang"), F.explode(F.array_distinct(spans)).alias("_part"), "n")
        .groupBy("_lang", "_part").agg(F.max("n").alias("_longer"))
    )
    alone = best.join(around, (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_part")), "left").filter(
        F.expr(f"_longer is null or cast(100 as decimal(20,0)) * _longer < cast({inside} as decimal(20,0)) * a")
    )
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    spread = W.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SPREAD))).orderBy(*order)
    some = alone.withColumn("_rn", F.row_number().over(spread)).filter(F.col("_rn") <= top)
    ranked = some.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "score").join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
