"""The operators' queries over the given tables, and the oracle SQL of those that SQL can express."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlake.llm import (
    decontaminate, extract, fixity, jaccard, langid, licenses, mixing, phrases, rules, runs, slots, tokens, urls,
)
from ledgerlake.llm.oracles import ORACLES  # noqa: F401
from ledgerlake.llm.shingles import Similarity
from ledgerlake.llm.text import SPACE
from ledgerlake.session import shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf, "documents"))


@query
def op2_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.hits(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select(
        "doc.doc_id", "hits.n_words", "hits.n_hit", F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hits.items", ","), 256).alias("items_sha256"),
        (F.col("hits.n_hit") > 0).alias("contaminated"),
    )


@query
def op3_main_text(spark: SparkSession, sf: str) -> DataFrame:
    return extract.extract_text(table(spark, sf, "pages"))


@query
def op4_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf, "documents"), tokenizer_path("piece_bpe_32k.model"))


@query
def op5_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    judged = rules.judge(table(spark, sf, "documents"), table(spark, sf, "labels"), carry=["doc_id"])
    return judged.select(
        "doc.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op6_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    classes = jaccard.jaccard_classes(table(spark, sf, "documents"), Similarity(words=3, part=90))
    return classes.select("doc_id", "n_shingles", "component_id")


@query
def op7_fixity_audit(spark: SparkSession, sf: str) -> DataFrame:
    return fixity.fixity_audit(table(spark, sf, "pages"))


@query
def op8_fair_mix(spark: SparkSession, sf: str) -> DataFrame:
    mix = mixing.fair_mix(table(spark, sf, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


@query
def op9_virtual_slots(spark: SparkSession, sf: str) -> DataFrame:
    maps = f"{shared_dir(spark)}/slot_maps/{hashlib.md5(sf.encode()).hexdigest()}"
    return slots.shard_documents(table(spark, sf, "documents"), maps=maps)


@query
def op10_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf, "pages"))


@query
def op11_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    kept_from_learning = langid.held_out(F.col("doc_id"))
    model = langid.fit(docs.filter(~kept_from_learning))
    return langid.identify(docs, model).select(
        "doc.doc_id", langid.held_out(F.col("doc.doc_id")).alias("held_out"), "lang_pred", "score"
    )


def with_planted_period(docs: DataFrame) -> DataFrame:
    """The documents' words as a text of their own: those of one in ten ids end in repetitions.

    With h the CRC-32 of the id as text, g its tenth and n words, each word from a = g % n on is
    replaced by the one at a + (i - a) % p, p = 1 + (n - a) div (3 + g % 8). A null id draws nothing.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split(F.coalesce("text", F.lit("")), SPACE), lambda w: w != "")
    n, g = F.col("_n"), F.col("_g")
    drawn = (
        docs.withColumn("_h", h).withColumn("_w", F.when(F.col("_h") % 10 == 0, words))
        .withColumn("_n", F.size("_w")).withColumn("_g", F.floor(F.col("_h") / 10))
        .withColumn("_a", F.when(n > 0, F.expr("_g % _n")))
        .withColumn("_p", F.lit(1) + F.expr("(_n - _a) div (3 + _g % 8)"))
    )
    place = lambda i: F.when(i < F.col("_a"), i).otherwise(F.col("_a") + (i - F.col("_a")) % F.col("_p")).cast("int")
    repeated = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(F.col("_w"), place(i))), " ")
    return drawn.select("doc_id", F.when(F.col("_a").isNotNull(), repeated).otherwise(F.col("text")).alias("text"))


@query
def op12_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    found = runs.periodic_runs(with_planted_period(table(spark, sf, "documents"))).withColumn("_top", runs.longest(F.col("runs")))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    listed = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit("")))
    length, period = -F.col("_top.shorter"), F.col("_top.period")
    return found.select(
        "doc.doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("_top.start").alias("start"), length.alias("length"),
        period.alias("period"), F.expr("(1000 * -_top.shorter) div _top.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op13_phrases(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.collocations(table(spark, sf, "documents"))
