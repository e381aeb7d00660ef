"""Reports over log tables: query history, logins, metering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlake.functions import now
from ledgerlake.functions.clock import AsOf


def _ties(df: DataFrame) -> list[Column]:
    return [F.col("event_id").desc_nulls_last()] if "event_id" in df.columns else []


def history(
    log: DataFrame, as_of: AsOf = None, hours: int = 1, limit: int | None = 100, at: str = "start_time"
) -> DataFrame:
    """The newest entries of a log in the hours before ``as_of``, at most ``limit`` if that is given."""
    end = now(as_of)
    start = end - F.make_dt_interval(hours=F.lit(hours))
    recent = log.filter((F.col(at) >= start) & (F.col(at) <= end)).orderBy(F.col(at).desc_nulls_last(), *_ties(log))
    return recent if limit is None else recent.limit(limit)


def etl_timings(
    log: DataFrame, tag: str, as_of: AsOf = None, hours: int = 1, limit: int | None = None
) -> DataFrame:
    """Seconds and rows of the tagged queries in the recent history, by start time.

    The tag is tested first, so other queries of a busy hour push none out.
    """
    seconds = F.round(F.col("total_elapsed_time").cast("decimal(18,0)") / 1000, 2)
    return (
        history(log.filter(F.col("query_tag") == tag), as_of, hours, limit)
        .orderBy("start_time")
        .select("query_text", seconds.alias("seconds"), "rows_produced")
    )


def pii_access_report(
    log: DataFrame, mentions: str, as_of: AsOf = None, query_type: str = "SELECT", hours: int = 24
) -> DataFrame:
    """Who queried the named table (case-insensitive text match) in the last hours."""
    start = now(as_of) - F.make_dt_interval(hours=F.lit(hours))
    return (
        log.filter(
            (F.col("start_time") >= start)
            & F.col("query_text").ilike(f"%{mentions}%")
            & (F.col("query_type") == query_type)
        )
        .groupBy("user_name", "role_name", "query_type")
        .agg(
            F.count("*").alias("num_queries"),
            (F.sum("bytes_scanned") / 1024 / 1024).alias("mb_scanned"),
            F.min("start_time").alias("primera_query"),
            F.max("start_time").alias("ultima_query"),
        )
        .orderBy(F.col("num_queries").desc(), "user_name", "role_name")
    )


def login_attempts(log: DataFrame, as_of: AsOf = None, days: int = 7, limit: int = 50) -> DataFrame:
    """The newest login attempts."""
    recent = log.filter(F.col("event_timestamp") >= now(as_of) - F.make_dt_interval(days=F.lit(days)))
    return recent.orderBy(F.col("event_timestamp").desc_nulls_last(), *_ties(log)).limit(limit).select(
        "user_name", "client_ip", "reported_client_type", "is_success", "error_code", "error_message",
        "event_timestamp",
    )


def usage_by_group(metering: DataFrame, prefix: str, as_of: AsOf = None, days: int = 7) -> DataFrame:
    """Credits per compute group whose name starts with the prefix: total, active days, mean per day."""
    start = now(as_of) - F.make_dt_interval(days=F.lit(days))
    total = F.sum(F.col("credits_used").cast("decimal(18,4)"))
    active = F.count_distinct(F.col("start_time").cast("date"))
    return (
        metering.filter(F.col("warehouse_name").startswith(prefix) & (F.col("start_time") >= start))
        .groupBy("warehouse_name")
        .agg(
            F.round(total, 2).alias("total_credits"),
            active.alias("dias_activo"),
            F.round(total / F.nullif(active, F.lit(0)), 2).alias("credits_por_dia"),
        )
        .orderBy(F.col("total_credits").desc_nulls_last(), "warehouse_name")
    )
