"""Benchmark decontamination by the items' word windows.

The benchmark's windows of consecutive words are numbered words under a rolling hash. They are sent
to the executors in blocks of a fixed number of windows, one pass over the documents per block,
whatever the benchmark's size; of several passes each is written before the next block is sent. A document is a sequence of word numbers; places whose hash is a
window's are verified word by word. Overlapping hits merge into spans of words.

Null and empty texts have no words and no hits; items without words have no windows; shorter items
are one window; items with the same text all count; rows with a null item_id are found but not
named; repeated documents are judged each for itself; very long texts are scanned whole, one at a
time; with an empty benchmark nothing is hit.
Other columns are carried along or not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerlake.llm.scratch import materialize
from ledgerlake.llm.text import packed, row_key

WINDOW = 10
BLOCK = 300_000  # windows sent at once, some 30 MB
CUT_ABOVE = 0.0  # share of hit words above which the pipeline drops a document

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_WORD_IN_SQL = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"  # the same on text with either case
_STEP = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    """Runs of digits, letters and anything beyond ASCII, with A-Z as a-z (bytes.lower does just that)."""
    return _WORD.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []


def rolling(ids: np.ndarray, width: int) -> np.ndarray:
    out = np.full(len(ids) - width + 1, width, np.uint64)
    for j in range(width):
        out = (out ^ ids[j : len(ids) - width + 1 + j]) * _STEP
        out ^= out >> np.uint64(29)
    return out


class WindowIndex:
    """A block of windows: word numbers, and per width the sorted hashes, the windows and their items."""

    def __init__(self, windows: list[tuple[list[bytes], list[str]]]):
        self.number: dict[bytes, int] = {}
        by_width: dict[int, list[tuple[list[int], list[str]]]] = {}
        for words, items in windows:
            ids = [self.number.setdefault(w, len(self.number) + 1) for w in words]
            by_width.setdefault(len(ids), []).append((ids, items))
        self.widths = {}
        for width, found in by_width.items():
            ids = np.array([f[0] for f in found], np.uint64)
            hashes = np.concatenate([rolling(row, width) for row in ids])
            order = np.argsort(hashes, kind="stable")
            self.widths[width] = (hashes[order], ids[order], [found[i][1] for i in order])

    def scan(self, words: list[bytes]) -> tuple[list[int], list[int], list[str]]:
        """Starts and ends of the merged spans, and the items whose windows occur."""
        n, items = len(words), set()
        ids = np.fromiter((self.number.get(w, 0) for w in words), np.uint64, n)
        edge = np.zeros(n + 1, np.int64)
        unknown = np.concatenate([np.zeros(1, np.int64), np.cumsum(ids == 0)])
        for width, (hashes, windows, named) in self.widths.items():
            if n < width:
                continue
            whole = np.flatnonzero(unknown[width:] == unknown[:-width])
            if not len(whole):
                continue
            seen = rolling(ids, width)[whole]
            at = np.searchsorted(hashes, seen)
            maybe = np.flatnonzero(hashes[np.minimum(at, len(hashes) - 1)] == seen)
            for k in maybe:
                place, row = whole[k], at[k]
                while row < len(hashes) and hashes[row] == seen[k]:  # equal hashes of different windows
                    if np.array_equal(windows[row], ids[place : place + width]):
                        edge[place] += 1
                        edge[place + width] -= 1
                        items.update(named[row])
                    row += 1
        hit = np.concatenate([[False], np.cumsum(edge)[:n] > 0, [False]]).astype(np.int8)
        step = np.diff(hit)
        return np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist(), sorted(items)


def windows_of(benchmark: DataFrame, width: int) -> DataFrame:
    """Distinct windows as their words joined by blanks, with the ids of their items."""

    @F.pandas_udf("array<string>")
    def windows(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            words = [w.decode("utf-8", "surrogatepass") for w in words_of(text)]
            last = max(len(words) - width, 0)
            out.append([" ".join(words[i : i + width]) for i in range(last + 1)] if words else [])
        return pd.Series(out)

    return (
        benchmark.select(F.col("item_id").cast("string").alias("item"), F.explode(windows("text")).alias("w"))
        .groupBy("w").agg(F.collect_set("item").alias("items"))
    )


def merged(spans: Column) -> Column:
    """Hit words of sorted spans (start, end) of several blocks, overlaps counted once."""
    start = F.struct(F.lit(0).cast("long").alias("upto"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        F.array_sort(spans), start,
        lambda a, s: F.struct(
            F.greatest(a["upto"], s["end"]).alias("upto"),
            (a["n"] + F.greatest(s["end"] - F.greatest(a["upto"], s["start"]), F.lit(0))).alias("n"),
        ),
    )["n"]


def hits(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """The documents with n_words, spans, items and n_hit beside them, in a struct ``hits``."""
    windows = materialize(windows_of(benchmark, width))
    blocks = max(1, -(-windows.count() // block))
    share = F.pmod(F.xxhash64("w"), F.lit(blocks))
    sc, parts = docs.sparkSession.sparkContext, []
    key = row_key(F.col("doc_id"), F.col("text"))
    for k in range(blocks):
        rows = windows.filter(share == k).collect()  # about ``block`` windows
        sent = sc.broadcast(
            WindowIndex([(r["w"].encode("utf-8", "surrogatepass").split(b" "), r["items"]) for r in rows])
        )
        scan = scan_column(sent)("text")
        if blocks > 1:  # one index at a time: each pass is written before the next is sent
            found = docs.select(key.alias("_key"), scan.alias("_scan")).filter(F.size("_scan.spans") > 0)
            parts.append(materialize(found.groupBy("_key").agg(F.first("_scan").alias("_scan"))))
            sent.destroy()
    if blocks == 1:
        scanned = docs.select(packed(docs).alias("doc"), F.array(scan).alias("_scan"))
    else:
        every = reduce(DataFrame.union, parts).groupBy("_key").agg(F.collect_list("_scan").alias("_scan"))
        scanned = docs.select(packed(docs).alias("doc"), key.alias("_at")).join(every, F.col("_at") == F.col("_key"), "left")
        none = F.array().cast(every.schema["_scan"].dataType)
        scanned = scanned.select("doc", F.coalesce("_scan", none).alias("_scan"))
    spans, items = F.flatten(F.col("_scan.spans")), F.array_sort(F.array_distinct(F.flatten(F.col("_scan.items"))))
    n_words = F.coalesce(F.regexp_count(F.col("doc.text"), F.lit(_WORD_IN_SQL)), F.lit(0)).cast("long")
    return scanned.select(
        "doc",
        F.struct(
            (F.col("_scan")[0]["n_words"] if blocks == 1 else n_words).alias("n_words"), spans.alias("spans"),
            items.alias("items"), merged(spans).alias("n_hit"),
        ).alias("hits"),
    )


def scan_column(sent):
    @F.pandas_udf("n_words long, spans array<struct<start: long, end: long>>, items array<string>")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        index = sent.value
        for texts in batches:
            out = []
            for text in texts:
                words = words_of(text)
                starts, ends, items = index.scan(words)
                out.append((len(words), [{"start": a, "end": b} for a, b in zip(starts, ends)], items))
            yield pd.DataFrame(out, columns=["n_words", "spans", "items"])

    return scan


@F.pandas_udf(T.StringType())
def cut_spans(texts: pd.Series, spans: pd.Series) -> pd.Series:
    """The texts without their spans of hit words; what stands between the words of a span goes too."""
    out = []
    for text, cuts in zip(texts, spans):
        if text is None or not len(cuts):
            out.append(text)
            continue
        raw = text.encode("utf-8", "surrogatepass")
        at = [(m.start(), m.end()) for m in _WORD.finditer(raw.lower())]
        kept, upto = [], 0
        for cut in sorted(cuts, key=lambda c: (c["start"], c["end"])):
            start, end = at[cut["start"]][0], at[cut["end"] - 1][1]
            kept.append(raw[upto : max(start, upto)])
            upto = max(end, upto)
        out.append(b"".join([*kept, raw[upto:]]).decode("utf-8", "surrogatepass"))
    return pd.Series(out)


def decontaminate(docs: DataFrame, benchmark: DataFrame, drop_above: float = CUT_ABOVE) -> DataFrame:
    """Documents whose share of hit words is above ``drop_above`` go; spans are cut from the others."""
    judged = hits(docs, benchmark)
    n_hit, n_words = F.col("hits.n_hit"), F.greatest(F.col("hits.n_words"), F.lit(1))
    kept = judged.filter(n_hit <= drop_above * n_words)
    if drop_above <= 0:  # whoever stays has no span to cut
        return kept.select("doc.*")
    text = cut_spans(F.col("doc.text"), F.col("hits.spans"))
    return kept.select(*[text.alias(c) if c == "text" else F.col(f"doc.`{c}`").alias(c) for c in docs.columns])
