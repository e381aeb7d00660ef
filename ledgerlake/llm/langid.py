"""Language identification, words first, then shorter and shorter character n-grams.

Known words are scored by the logarithm of their relative frequency in each language. A word known
in no language is scored by the mean over its longest character n-grams (blanks at its ends) of
which any language knows one, from ``ORDERS[0]`` letters down to single ones; a word without any
known n-gram says nothing. A language that lacks a known word or n-gram gets ``MISSING``. A text's
score for a language is the mean over its words, and the best language's share of the scores'
powers is the ``score`` that is returned.

The model is fitted on a bounded sample of the labelled rows, drawn by hash: at most
``SAMPLE_BYTES`` of texts, shared evenly among at most ``LANGUAGES`` languages (those with most labelled
text). So what is sent to the executors is bounded, whatever the corpus; words and n-grams that the
sample has but once are left to shorter ones. A text longer than a language's share is not learnt from.

Every whole text is judged, however long, by its text alone. A null text, an empty one, and one
without letters is ``und`` with score 0, as is any text if nothing could be learnt. Of languages that
tie, the one with most labelled text wins, then the smaller name. Rows with a null language are not learnt
from; repeated rows count each. Other columns are carried along in ``doc``. An empty table gives an empty one.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ledgerlake.llm.text import packed

SAMPLE_BYTES = 32_000_000
LANGUAGES = 200
ORDERS = (5, 4, 3, 2, 1)
MISSING = 7.0  # minus the decimal logarithm of a frequency below any that the sample can show
LEAST = 2  # occurrences in the sample
UNDETERMINED = "und"
_REMEMBERED = 100_000  # unseen words whose scores a worker keeps


@cache
def word_pattern():
    """A letter, then letters and the marks on them."""
    import regex

    return regex.compile(r"\p{L}[\p{L}\p{M}]*")


def words_of(text: str | None) -> list[str]:
    return word_pattern().findall(text.lower()) if text else []


def grams(word: str, order: int) -> list[str]:
    """N-grams with a blank at either end of the word; single letters without."""
    whole = f" {word} " if order > 1 else word
    return [whole[i : i + order] for i in range(len(whole) - order + 1)]


class LanguageModel:
    """Minus decimal log frequencies of words (order 0) and n-grams, sparse by language."""

    def __init__(self, languages: list[str], rows: list[tuple[int, str, int, float]]):
        self.languages = languages
        rows = sorted(rows)  # the same sums in the same order in every run
        self.index: list[dict[str, int]] = [{} for _ in range(max(ORDERS) + 1)]
        starts, last = [], None
        for i, (order, gram, _, _) in enumerate(rows):
            if (order, gram) != last:
                self.index[order][gram] = len(starts)
                starts.append(i)
                last = (order, gram)
        self.starts = np.array([*starts, len(rows)], np.int64)
        self.language = np.array([r[2] for r in rows], np.int64)
        self.gain = np.array([r[3] for r in rows], np.float64) - MISSING

    def summed(self, ids: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Per language, the weighted sum of frequencies' logarithms less ``MISSING``."""
        n = self.starts[ids + 1] - self.starts[ids]
        row = np.repeat(np.arange(len(ids)), n)
        at = np.repeat(self.starts[ids], n) + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        return np.bincount(self.language[at], weights[row] * self.gain[at], len(self.languages))

    def unseen(self, word: str) -> np.ndarray | None:
        for order in ORDERS:
            known = self.index[order]
            ids = [known[g] for g in grams(word, order) if g in known]
            if ids:
                return self.summed(np.array(ids), np.full(len(ids), 1 / len(ids)))
        return None

    def judge(self, text: str | None, memory: dict[str, np.ndarray | None]) -> tuple[str, float]:
        words = words_of(text)
        if not words or not self.languages:
            return UNDETERMINED, 0.0
        known, ids, weights = self.index[0], [], []
        total, n = np.zeros(len(self.languages)), 0
        for word, count in Counter(words).items():
            at = known.get(word)
            if at is not None:
                ids.append(at)
                weights.append(count)
                n += count
                continue
            if word not in memory:
                if len(memory) >= _REMEMBERED:
                    memory.clear()
                memory[word] = self.unseen(word)
            score = memory[word]
            if score is not None:
                total = total + count * score
                n += count
        if ids:
            total = total + self.summed(np.array(ids), np.array(weights, np.float64))
        mean = np.round(total / max(n, 1), 9)
        best = int(np.argmin(mean))
        return self.languages[best], round(float(1 / np.sum(10.0 ** (mean[best] - mean))), 9)


def sample(labelled: DataFrame, budget: int, languages: int) -> tuple[list[str], DataFrame]:
    """The languages, most labelled text first, and (lang, text) rows of at most ``budget`` bytes."""
    size = F.octet_length("text").cast("long")
    totals = (
        labelled.groupBy("lang").agg(F.sum(size).alias("bytes")).filter("bytes > 0")
        .orderBy(F.col("bytes").desc(), "lang").limit(languages).collect()
    )
    if not totals:
        return [], labelled.select("lang", "text").limit(0)
    each = budget // len(totals)
    share = F.create_map(*[F.lit(x) for r in totals for x in (r["lang"], min(1.0, each / r["bytes"]))])
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = (
        labelled.withColumn("_size", size).withColumn("_draw", draw)
        .filter(F.col("_draw") < share[F.col("lang")]).filter(F.col("_size") <= each)
    )
    # The draw keeps about the share of each language; the running sum makes the bound strict.
    upto = W.partitionBy("lang").orderBy("_draw", "doc_id", "text").rowsBetween(W.unboundedPreceding, 0)
    kept = drawn.withColumn("_upto", F.sum("_size").over(upto)).filter(F.col("_upto") <= each)
    return [r["lang"] for r in totals], kept.select("lang", "text")


def counted_words(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        counts: Counter[tuple[str, str]] = Counter()
        for lang, text in zip(frame["lang"], frame["text"]):
            for word, n in Counter(words_of(text)).items():
                counts[lang, word] += n
        yield pd.DataFrame([(*k, n) for k, n in counts.items()], columns=["lang", "word", "n"])


def fit(labelled: DataFrame, budget: int = SAMPLE_BYTES, languages: int = LANGUAGES) -> LanguageModel:
    """The model of (doc_id, text, lang) rows whose language is known."""
    names, rows = sample(labelled.select("doc_id", "text", "lang").filter("lang is not null"), budget, languages)
    words = rows.mapInPandas(counted_words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))

    def of_order(k: int) -> Column:
        whole = F.concat(F.lit(" "), F.col("word"), F.lit(" ")) if k > 1 else F.col("word")
        places = F.sequence(F.lit(1), F.greatest(F.length(whole) - k + 1, F.lit(1)))
        cut = F.transform(places, lambda i: F.substring(whole, i, F.lit(k)))
        return F.transform(F.filter(cut, lambda g: F.length(g) == k), lambda g: F.struct(F.lit(k).alias("k"), g.alias("gram")))

    every = F.concat(F.array(F.struct(F.lit(0).alias("k"), F.col("word").alias("gram"))), *[of_order(k) for k in ORDERS])
    counted = (
        words.select("lang", "n", F.explode(every).alias("g")).groupBy("lang", "g.k", "g.gram").agg(F.sum("n").alias("n"))
        .withColumn("total", F.sum("n").over(W.partitionBy("lang", "k"))).filter(F.col("n") >= LEAST)
    )
    number = {name: i for i, name in enumerate(names)}
    found = counted.select("k", "gram", "lang", (-F.log10(F.col("n") / F.col("total"))).alias("v")).collect()
    return LanguageModel(names, [(r["k"], r["gram"], number[r["lang"]], round(r["v"], 9)) for r in found])


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """Each document as ``doc`` with ``lang_pred`` and ``score``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        memory: dict[str, np.ndarray | None] = {}
        for texts in batches:
            yield pd.DataFrame([sent.value.judge(t, memory) for t in texts], columns=["lang_pred", "score"])

    found = F.pandas_udf(judged, "lang_pred string, score double")
    return docs.select(packed(docs).alias("doc"), found("text").alias("_found")).select("doc", "_found.*")


def held_out(doc_id: Column, parts: int = 5) -> Column:
    """Whether a row is kept from learning; a null id counts as an empty text, which is held out."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(parts)) == 0


def is_held_out(doc_id: object, parts: int = 5) -> bool:
    """The same in Python."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % parts == 0
