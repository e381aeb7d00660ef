"""Column expressions shared by the operators; all of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

MONEY = "decimal(15,2)"


def money(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(MONEY)


def month_of(c: Column | str) -> Column:
    return F.trunc(F.col(c).cast("date") if isinstance(c, str) else c.cast("date"), "month")


def quarter_of(c: Column | str) -> Column:
    return F.trunc(F.col(c).cast("date") if isinstance(c, str) else c.cast("date"), "quarter")


def year_of(c: Column | str) -> Column:
    return F.trunc(F.col(c).cast("date") if isinstance(c, str) else c.cast("date"), "year")


def weekday(c: Column | str) -> Column:
    """0 = Sunday … 6 = Saturday."""
    return F.dayofweek(c) - 1


def years_between(start: Column | str, end: Column) -> Column:
    """Number of year boundaries crossed, not of whole years."""
    return F.year(end) - F.year(start)


def initcap_trim(c: str) -> Column:
    return F.initcap(F.trim(c))


def amount_in(c: str) -> Column:
    return F.expr(f"if({c} > 0, {c}, cast(0 as {MONEY}))")


def amount_out(c: str) -> Column:
    return F.expr(f"if({c} < 0, abs({c}), cast(0 as {MONEY}))")


def ratio(part: Column, whole: Column) -> Column:
    return part.cast("double") / F.nullif(whole, F.lit(0))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """Percentage in decimal arithmetic, so that a tie rounds up whatever its binary form is."""
    scaled = part.cast("decimal(18,0)") * F.lit(100).cast("decimal(3,0)")
    return F.round(scaled / F.nullif(whole, F.lit(0)).cast("decimal(18,0)"), digits)


def banded(c: Column, cuts: Sequence[tuple], otherwise, at_least: bool = False) -> Column:
    """First label whose lower bound the value exceeds (or reaches); nulls get ``otherwise``."""
    out = F.lit(otherwise)
    for bound, label in reversed(cuts):
        out = F.when(c >= F.lit(bound) if at_least else c > F.lit(bound), F.lit(label)).otherwise(out)
    return out
