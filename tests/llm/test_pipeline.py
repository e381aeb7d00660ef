"""The stages on awkward rows and on an empty table."""

from __future__ import annotations

import corpus_pipeline
from llm_helpers import odd_docs  # noqa: F401


def test_stages_on_awkward_rows(spark, sf, odd_docs):
    docs = odd_docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd_docs, sf)
        assert out.count() <= 2 * odd_docs.count()
        assert out.columns[: len(odd_docs.columns)] == odd_docs.columns, name
        assert stage(spark, docs.limit(0), sf).isEmpty(), name


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_copies", "decontamination", "mixing", "sharding"]
