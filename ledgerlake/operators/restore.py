"""State of a table at an earlier moment, from its append-only history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ledgerlake.operators.scale import newest_per_key


def restore_as_of(
    change_log: DataFrame, keys: Sequence[str], moment: str, offset_seconds: int = 0, at: str = "_loaded_at"
) -> DataFrame:
    """Newest version of every key loaded up to the moment, or some seconds before it."""
    until = F.lit(moment).cast("timestamp_ntz") - F.make_dt_interval(secs=F.lit(offset_seconds))
    ties = [F.col(c).asc_nulls_last() for c in sorted(change_log.columns) if c not in (*keys, at)]
    return newest_per_key(change_log.filter(F.col(at) <= until), keys, [F.col(at).desc_nulls_last(), *ties])
