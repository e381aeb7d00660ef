"""Token counts with a whole-token shortcut.

The model's vocabulary is proved offline to keep pre-tokens apart: no piece goes on from another
character to a blank mark, and none holds a line feed, so no merge crosses such a border and a
text's count is the sum over its pre-tokens. A pre-token that is a piece in whole and encodes alone
as that piece counts 1 without merging; the library merges the rest, each different one once as
long as a worker remembers it.

Null and empty texts have no tokens; very long texts go through the same steps; repeated rows
are counted each; other columns are not looked at. Special strings are ordinary text, as the
library's default has it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import DataFrame, functions as F

LIMIT = 4096
REMEMBERED = 400_000  # counts a worker keeps; beyond that it starts afresh
TOGETHER = 1_000_000  # characters of texts split at once
BLANK = "▁"
_PRETOKEN = re.compile(r" *[^ \n]+|\n| +")
_LINE = "\n"


class TokenCounter:
    """Counts of whole texts under one sentencepiece BPE model."""

    def __init__(self, model: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        normal = [
            p for i, p in enumerate(pieces)
            if not (self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i))
        ]
        self.separable = self.proved(normal)
        self.counts: dict[str, int] = {}
        if self.separable:
            whole = [p for p in normal if p.startswith(BLANK)]
            alone = self.library.encode([_LINE + p.replace(BLANK, " ") for p in whole], num_threads=1)
            self.single = {
                p.replace(BLANK, " "): 1
                for p, ids in zip(whole, alone) if len(ids) == 3 and pieces[ids[2]] == p
            }
            self.counts = dict(self.single)

    def proved(self, normal: list[str]) -> bool:
        """Whether borders before blanks and around line feeds are never merged over.

        The normalizer must also leave texts as they are, but for blanks and one blank put in
        front; a sample of what normalizers change is compared.
        """
        crossing = re.compile(f"[^{BLANK}]{BLANK}|{_LINE}")
        probes = ["  a  b ", "ﬁ½Ａ é", "a\n \n\nb", "\t x\r\n", " ", " a　b", "​z"]
        kept = all(
            self.library.decode(self.library.encode(p)) == p and self.library.encode(p, out_type=str)[0].startswith(BLANK)
            for p in probes
        )
        line = self.library.encode(_LINE, out_type=str)
        return kept and line == [BLANK, "<0x0A>"] and not any(crossing.search(p) for p in normal)

    def remember(self, words: set[str]) -> None:
        """The library's counts of pre-tokens, merged behind a line feed, whose two tokens are taken off."""
        words = list(words)
        for w, ids in zip(words, self.library.encode([_LINE + w for w in words], num_threads=1)):
            self.counts[w] = len(ids) - 2

    def count(self, texts: list[str]) -> list[int]:
        if not self.separable:
            return [len(x) for x in self.library.encode(texts, num_threads=1)]
        out: list[int] = []
        for part in self.parts(texts):
            split = [_PRETOKEN.findall(" " + t.replace(BLANK, " ")) if t else [] for t in part]
            needed = set().union(*split)
            new = needed.difference(self.counts)
            if len(self.counts) + len(new) > REMEMBERED:  # those that were known are forgotten with the rest
                self.counts = dict(self.single)
                new = needed.difference(self.counts)
            self.remember(new)
            out.extend(sum(map(self.counts.__getitem__, words)) for words in split)
        return out

    @staticmethod
    def parts(texts: list[str]) -> Iterator[list[str]]:
        """Runs of texts of about ``TOGETHER`` characters, so that few pre-tokens are held at once."""
        part, size = [], 0
        for t in texts:
            part.append(t)
            size += len(t)
            if size > TOGETHER:
                yield part
                part, size = [], 0
        if part:
            yield part


@cache
def counter(model: str) -> TokenCounter:
    return TokenCounter(model)


def token_counts(docs: DataFrame, model: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every document; ``model`` is a path on every executor."""

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(counter(model).count([t or "" for t in texts]), dtype="int64")

    return (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), tokens("text").alias("n_tokens"))
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )
