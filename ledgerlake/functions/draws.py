"""Repeatable uniform draws.

``rand(seed)`` depends on how the rows are partitioned, so a retried or re-planned task would
give other values. These draws depend on the row's own number only.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

PRIME = 2147483647  # 2**31 - 1: the square of a residue still fits in a long


def draw(seq: Column, salt: int, lo: int | Column, hi: int | Column) -> Column:
    """Uniform integer in [lo, hi] from a row number, by modular arithmetic (no strings, no hashing).

    The bounds may differ by row. Ranges wider than the prime would leave gaps. Row numbers beyond
    the prime are two limbs; the upper one is weighed differently per salt, so two rows that agree
    in one draw differ in the others.
    """
    if isinstance(lo, int) and isinstance(hi, int) and hi - lo >= PRIME:
        raise ValueError("range too wide for one draw")
    lo, hi = (F.lit(b).cast("long") if isinstance(b, int) else b for b in (lo, hi))
    upper = F.floor((seq - seq % F.lit(PRIME)) / F.lit(PRIME)) % F.lit(PRIME)
    weight = (104729 + salt * salt * 7368787 + salt * 179424673) % PRIME
    folded = (seq % F.lit(PRIME) + upper * F.lit(weight) % F.lit(PRIME) + F.lit(salt * 15485863)) % F.lit(PRIME)
    mixed = (folded * F.lit(48271) + F.lit(salt * 7919 + 1)) % F.lit(PRIME)
    squared = (mixed * mixed) % F.lit(PRIME)
    return (squared * F.lit(69621) + mixed) % F.lit(PRIME) % (hi - lo + F.lit(1)) + lo


def md5_draw(key: Column, salt: str, n: int) -> Column:
    """Uniform integer in [0, n) from the first 32 bits of an MD5."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{salt}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % F.lit(n)
