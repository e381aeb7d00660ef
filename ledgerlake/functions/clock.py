"""The reference date of a run. ``None`` means the wall clock; tests and backfills pass a value."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, functions as F

AsOf = date | datetime | str | None


def today(as_of: AsOf = None) -> Column:
    return F.current_date() if as_of is None else F.lit(str(as_of)[:10]).cast("date")


def now(as_of: AsOf = None) -> Column:
    """Zone-less like the fact timestamps, so that the comparison needs no cast of the column."""
    return F.localtimestamp() if as_of is None else F.lit(str(as_of)).cast("timestamp_ntz")
