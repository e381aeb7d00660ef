"""Quality rules with risk-controlled thresholds.

A document's badness is a handful of rates, each in whole per mille. A level from the most
lenient to the strictest gives one cutoff per rate, and a document is rejected when any rate is
above its cutoff. Per stratum (the language) labelled documents say how many good ones a level
would reject. Levels are tested from the most lenient on; a level passes while the exact binomial
test shows, at a significance shared out over the strata (Bonferroni), that the true share of good
documents rejected is at most the limit. Testing in a fixed order stops at the first level that
fails, so the levels of a stratum need no further correction. The last level that passed holds;
strata with too few labels to prove anything reject nothing.

Null and empty texts have no words and rates of 0, null languages are a stratum of their own,
repeated label rows of a document count as one (it is good if any says so), labels without a
document are ignored, very long texts are measured whole, documents at a cutoff pass, and empty tables
give empty results or no thresholds. Documents may carry
any other columns. Everything runs as built-in expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ledgerlake.llm.text import SPACE, WORD, let, word_count
from ledgerlake.llm.scratch import materialize

SYMBOL = r"[#*$%&|<>]"
CAPITAL = r"\p{Lu}"

# Cutoffs per level, from lenient to strict, in per mille: symbols per word, repeated lines per
# line, repeated words per word, capitals per word character, exclamation marks per word.
RATES = ("symbol_rate", "dup_line_rate", "repeat_rate", "capital_rate", "exclaim_rate")
LEVELS = (
    (900, 900, 480, 900, 900),
    (700, 850, 470, 700, 700),
    (500, 800, 460, 500, 500),
    (400, 750, 450, 400, 400),
    (300, 700, 440, 350, 300),
    (250, 650, 430, 300, 250),
    (200, 600, 420, 250, 200),
    (150, 550, 410, 200, 150),
    (100, 500, 400, 180, 100),
)
RISK = 0.05  # share of a stratum's good documents that may be rejected
CONFIDENCE = 0.95  # that this holds in every stratum at once
TAIL = 4096  # terms of the binomial sum; the rest is bounded from above


def repeated_words(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more in the array of words.

    Windows are sorted with their places; equal neighbours are repeats. Going through the places
    in order, each repeat covers up to three words more than the one before, so no set is built.
    """

    def windows(w: Column) -> Column:
        return F.array_sort(
            F.transform(
                F.sequence(F.lit(1), F.size(w) - 2),
                lambda i: F.struct(F.concat_ws(" ", F.slice(w, i, 3)).alias("w"), i.alias("i")),
            )
        )

    def places(sorted_windows: Column) -> Column:
        def repeated(x: Column, at: Column) -> Column:
            left = (at > 0) & (F.get(sorted_windows, at - 1)["w"] == x["w"])
            right = F.coalesce(F.get(sorted_windows, at + 1)["w"] == x["w"], F.lit(False))
            return F.when(left | right, x["i"])

        return F.array_sort(F.array_compact(F.transform(sorted_windows, repeated)))

    def covered(at: Column) -> Column:
        return F.aggregate(
            at,
            F.struct(F.lit(-9).alias("last"), F.lit(0).cast("long").alias("n")),
            lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(p - acc["last"], F.lit(3))).alias("n")),
        )["n"]

    return let(
        words, lambda w: F.when(F.size(w) >= 3, covered(let(windows(w), places))).otherwise(0).cast("long")
    )


def measures(docs: DataFrame, carry: Sequence[str]) -> DataFrame:
    """The carried columns of the documents as a struct ``doc`` with counts and rates beside it."""
    whole = F.struct(*[F.col(f"`{c}`") for c in carry])
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.regexp_like(x, F.lit(WORD)))
    line_counts = let(
        lines, lambda x: F.struct(F.size(x).alias("all"), F.size(F.array_distinct(x)).alias("different"))
    )

    def rate(n: Column, of: Column) -> Column:
        return F.when(of > 0, F.floor(1000 * n / of)).otherwise(0).cast("long")

    return (
        docs.select(whole.alias("doc"), F.col("text").alias("text"))
        .withColumn("n_words", word_count(text))
        .withColumn("word_chars", F.length(F.regexp_replace(text, SPACE, "")).cast("long"))
        .withColumn("n_symbols", F.regexp_count(text, F.lit(SYMBOL)).cast("long"))
        .withColumn("_l", line_counts)
        .withColumn("n_lines", F.col("_l.all").cast("long"))
        .withColumn("n_dup_lines", (F.col("_l.all") - F.col("_l.different")).cast("long"))
        .drop("_l")
        .withColumn("n_repeat_words", repeated_words(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))))
        .withColumn("n_capitals", F.regexp_count(text, F.lit(CAPITAL)).cast("long"))
        .withColumn("n_exclaims", F.regexp_count(text, F.lit("!")).cast("long"))
        .drop("text")
        .withColumn("symbol_rate", rate(F.col("n_symbols"), F.col("n_words")))
        .withColumn("dup_line_rate", rate(F.col("n_dup_lines"), F.col("n_lines")))
        .withColumn("repeat_rate", rate(F.col("n_repeat_words"), F.col("n_words")))
        .withColumn("capital_rate", rate(F.col("n_capitals"), F.col("word_chars")))
        .withColumn("exclaim_rate", rate(F.col("n_exclaims"), F.col("n_words")))
        .withColumn(
            "base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
        )
    )


def first_rejecting(levels: Sequence[Sequence[int]] = LEVELS) -> Column:
    """The most lenient level that rejects a document; as many as there are levels if none does."""
    out = F.lit(len(levels))
    for k in range(len(levels) - 1, -1, -1):
        above = F.lit(False)
        for name, cutoff in zip(RATES, levels[k]):
            above = above | (F.col(name) > cutoff)
        out = F.when(above, k).otherwise(out)
    return out


def log_gamma(x: Column) -> Column:
    """ln gamma(x) for x >= 1: Stirling's series ten steps up, less the logarithms of the steps."""
    y = x + 10
    series = 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y)
    up = (y - 0.5) * F.log(y) - y + 0.9189385332046727 + series
    steps = F.lit(0.0)
    for k in range(10):
        steps = steps + F.log(x + k)
    return up - steps


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(at most k of n) at rate ``p``, never below the true value.

    Terms fall from j = k downwards when k is under n * p, the only case in which a small tail can
    come out; what lies below the last of ``TAIL`` terms is bounded by a geometric series.
    """
    k, n = k.cast("double"), n.cast("double")
    lowest = F.greatest(k - (TAIL - 1), F.lit(0.0))

    def term(j: Column) -> Column:
        choose = log_gamma(n + 1) - log_gamma(j + 1) - log_gamma(n - j + 1)
        return F.exp(choose + j * F.log(F.lit(p)) + (n - j) * F.log(F.lit(1 - p)))

    terms = F.transform(F.sequence(lowest.cast("long"), k.cast("long")), lambda j: term(j.cast("double")))
    total = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
    ratio = lowest * (1 - p) / ((n - lowest + 1) * p)
    rest = F.when(lowest > 0, term(lowest) * ratio / (1 - ratio)).otherwise(0.0)
    return F.when(k >= n * p, F.lit(1.0)).otherwise(total + rest)


def thresholds(
    measured: DataFrame,
    labels: DataFrame,
    levels: Sequence[Sequence[int]] = LEVELS,
    risk: float = RISK,
    confidence: float = CONFIDENCE,
) -> DataFrame:
    """stratum, n_good and level: the strictest level proven safe per stratum, -1 if none is.

    All labelled documents are counted; the counts, a row per stratum and level, are small.
    """
    good = (
        labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("q"))
        .filter("q = 1").select(F.col("doc_id").alias("labelled"))
    )
    hits = (
        measured.filter(~F.col("base_failed"))
        .select(F.col("doc.doc_id").alias("id"), F.col("doc.lang").alias("stratum"), first_rejecting(levels).alias("level"))
        .join(good, F.col("id") == F.col("labelled"))
        .groupBy("stratum", "level").agg(F.count("*").alias("n"))
    )
    counts = hits.groupBy("stratum").agg(
        F.sum("n").alias("n_good"), F.map_from_entries(F.collect_list(F.struct("level", "n"))).alias("by_level")
    )
    strata = F.count("*").over(W.partitionBy(F.lit(0)))
    tested = (
        counts.withColumn("limit", (1 - confidence) / strata)
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(len(levels) - 1))).alias("level"))
        .withColumn(
            "n_rejected",
            F.aggregate(
                F.sequence(F.lit(0), F.col("level")), F.lit(0).cast("long"),
                lambda a, j: a + F.coalesce(F.col("by_level")[j], F.lit(0)),
            ),
        )
        .withColumn("passes", binomial_tail(F.col("n_rejected"), F.col("n_good"), risk) <= F.col("limit"))
    )
    first_failure = F.min(F.when(~F.col("passes"), F.col("level")))
    return tested.groupBy("stratum", "n_good").agg(
        (F.coalesce(first_failure, F.lit(len(levels))) - 1).alias("level")
    )


def judge(
    docs: DataFrame,
    labels: DataFrame,
    levels: Sequence[Sequence[int]] = LEVELS,
    risk: float = RISK,
    confidence: float = CONFIDENCE,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """``doc`` (the carried columns as a struct, all by default), the counts, base_failed, level and kept.

    The measures are written once, as both the thresholds and the verdicts need them. The
    thresholds have a row per stratum and are joined like any table; the optimizer broadcasts them
    by their measured size.
    """
    carry = docs.columns if carry is None else [*dict.fromkeys(["doc_id", "lang", *carry])]
    measured = materialize(measures(docs, carry))
    levels_of = thresholds(measured, labels, levels, risk, confidence).select(
        F.col("stratum").alias("of"), F.col("level")
    )
    joined = measured.withColumn("_rejecting", first_rejecting(levels)).join(
        levels_of, F.col("doc.lang").eqNullSafe(F.col("of")), "left"
    )
    rejected = F.col("_rejecting") <= F.coalesce(F.col("level"), F.lit(-1))
    return joined.withColumn("kept", ~F.col("base_failed") & ~rejected).drop("of", "_rejecting")
