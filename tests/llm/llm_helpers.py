"""Awkward rows and brute-force versions that several tests use."""

from __future__ import annotations

import re

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, size string, node string, label string, level int"
LONG = " ".join(f"w{i % 5000}x{i // 7}" for i in range(60_000))
PROSE = "the quick brown fox jumps over the lazy dog while seven wizards box with quartz judges near a vivid lake "


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and very long texts, repeated rows, repeated ids, clashing extra columns."""
    rows = [
        (1, PROSE * 4, "en", "a"), (2, PROSE * 4, "en", "b"), (2, PROSE * 4, "en", "b"), (3, None, "en", "a"),
        (4, "", None, None), (5, "   \n\t ", "de", "a"), (6, LONG, "en", "b"), (7, LONG + " end", "en", "b"),
        (None, PROSE * 3 + "and more", "fr", None), (None, None, None, None), (8, "one", "en", "c"),
        (8, "another text of the same id " * 12, "en", "c"), (9, "A !!! " * 80, "en", "c"),
        (10, "naïve café Ünïcode 中文 " * 30, "fr", "a"), (11, "x\ny\nx\ny\nx", "en", "a"),
    ]
    return spark.createDataFrame([(*r, len(r[1] or ""), "k", "s", "n", "l", 3) for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


def ids(df):
    return sorted((r["doc_id"] for r in df.select("doc_id").collect()), key=lambda x: (x is None, x or 0))


def shingles(text, k):
    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1)) or (frozenset([tuple(words)]) if words else frozenset())


def brute_components(sets, part):
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    names = sorted(sets)
    for i, a in enumerate(names):
        for b in names[:i]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= part * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: find(i) for i in sets}
