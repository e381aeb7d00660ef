"""How common shingles are, in a table of counters of fixed size.

Counters are shared by all shingles that hash to them, so a count may be too large, never too small.
Every document is counted. The table has the same size whatever the input, and the driver holds its levels only.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from ledgerlake.llm.shingles import shingle_set

COUNTERS = 1 << 23
_PART = 1 << 12  # counters in a row
_STEPS = 8  # levels for each doubling of a count


def place(shingles: np.ndarray) -> np.ndarray:
    """The counter of each shingle."""
    return (shingles >> np.uint64(64 - (COUNTERS.bit_length() - 1))).astype(np.int64)


def levels(texts: DataFrame, words: int) -> np.ndarray:
    """A byte per counter: the logarithm of how many documents of ``texts(text)`` have its shingles.

    A task counts in a table of its own and sends the parts that are not empty; they are added part by
    part, a row at a time.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = np.zeros(COUNTERS, np.uint32)
        for batch in batches:
            for text in batch["text"]:
                np.add.at(table, place(shingle_set(text, words)), 1)
        parts = table.reshape(-1, _PART)
        filled = np.flatnonzero(parts.any(axis=1))
        for some in np.array_split(filled, max(1, len(filled) // 256)):
            yield pd.DataFrame({"part": some, "counts": [zlib.compress(parts[i].tobytes(), 1) for i in some]})

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch["part"], batch["counts"]):
                total = sums.setdefault(part, np.zeros(_PART, np.uint64))
                total += np.frombuffer(zlib.decompress(counts), np.uint32)
        for part, total in sums.items():
            level = np.minimum(255, _STEPS * np.log2(total + 1.0)).astype(np.uint8)
            yield pd.DataFrame({"part": [part], "level": [level.tobytes()]})

    counted = texts.select("text").mapInPandas(count, "part long, counts binary")
    out = np.zeros(COUNTERS, np.uint8)
    for row in counted.repartition("part").mapInPandas(add, "part long, level binary").collect():
        start = row["part"] * _PART
        out[start : start + _PART] = np.frombuffer(row["level"], np.uint8)
    return out
