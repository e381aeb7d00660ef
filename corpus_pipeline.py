"""The training-corpus pipeline: quality, near copies, decontamination, mixing and sharding.

Each stage takes (spark, docs, sf_dir) and returns documents; it is written as Parquet to the
shared folder and read again as the input of the next. What a stage wrote on its way is deleted when
the next one begins, as its result is written by then; so run one pipeline at a time per process.

Null and empty texts have no words, and so are rejected by the first stage's word count; a null id, language or
source is a value like others. Very long texts go through every stage whole. Repeated rows are near copies of each
other, so one of them stays; ties between near copies go to the smallest id, null ids last. Empty tables pass
through as empty tables, and columns beyond those of documents are carried along to the end.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import decontaminate, jaccard, mixing, rules, scratch, slots
from ledgerlake.llm.oracles import pipeline_sql
from ledgerlake.llm.shingles import Similarity
from ledgerlake.operators.scale import materialize

NEAR = Similarity(words=5, part=80)
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_done_with: list[str] = []


def stage(fn: Stage) -> Stage:
    @wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        scratch.drop(spark, _done_with)
        with scratch.noted() as folders:
            out = fn(spark, docs, sf_dir)
        _done_with.extend(folders)
        return out

    return run_stage


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; the thresholds come from the labelled ones."""
    return rules.judge(docs, _table(spark, sf_dir, "labels")).filter("kept").select("doc.*")


@stage
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return jaccard.one_of_each(docs, NEAR)


@stage
def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return decontaminate.decontaminate(docs, _table(spark, sf_dir, "benchmark"))


@stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target shares; a document that is taken twice stands twice."""
    return mixing.mixed_documents(docs)


@stage
def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its virtual slot and shard."""
    return slots.with_shard(docs)


STAGES = [
    ("quality_rules", quality),
    ("near_copies", near_copies),
    ("decontamination", benchmark_passages),
    ("mixing", mix),
    ("sharding", shard),
]

ORACLE_SQL = pipeline_sql()


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return reduce(lambda docs, named: materialize(named[1](spark, docs, sf_dir)), STAGES, documents)
