"""Text expressions the operators share. Nothing here runs Python on the executors."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

# A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words as a long; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def byte_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def row_key(doc_id: Column, text: Column) -> Column:
    """A 60-bit key of a document's id and whole text, the same in every run and on every engine with MD5."""
    whole = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(whole), 1, 15), 16, 10).cast("long")


def packed(df: DataFrame) -> Column:
    """All columns of a table as one struct, so that helper columns cannot clash with theirs."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)
