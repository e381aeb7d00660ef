"""Registry of the runnable queries and of their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerlake.plans.fixtures import VIEWS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Columns that hold the moment of the run and so cannot be compared.
RUN_TIME = ("_silver_processed_at", "_gold_processed_at", "etl_timestamp", "ultimo_check")


def comparable(df: DataFrame) -> DataFrame:
    """Cast to types both engines share: bigint, double, zone-less timestamp, string."""
    out = []
    for field in df.schema.fields:
        if field.name in RUN_TIME:
            continue
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(field.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.ArrayType):
            c = F.array_join(c, ",")
        out.append(c.alias(field.name))
    return df.select(*out)


def with_views(sql: str, views: tuple[str, ...]) -> str:
    """Put the fixture views in front of the query as common table expressions."""
    parts: dict[str, str] = {}

    def need(name: str) -> None:
        if name not in parts:
            before, text = VIEWS[name]
            for other in before:
                need(other)
            parts[name] = f"{name} as ({text})"

    for name in views:
        need(name)
    body = sql.strip()
    if not parts:
        return body
    head = "with " + ",\n".join(parts.values())
    return head + (",\n" + body[5:] if body[:5].lower() == "with " else "\n" + body)


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, sf: comparable(fn(spark, sf))
        if sql is not None:
            ORACLES[name] = with_views(sql, views)
        return fn

    return register


def half_up(num: str, den: str) -> str:
    """Integer division rounded half away from zero, as SQL text; null or zero denominators give null."""
    return (
        f"(sign({num}) * ((abs({num})::hugeint * 2 + abs({den})::hugeint) // (2 * nullif(abs({den}), 0)::hugeint)))"
    )


def cents(expr: str) -> str:
    return f"(({expr}) * 100)::hugeint"


def avg6(total: str, n: str) -> str:
    """Mean of a two-decimal amount, rounded half up to six decimals like a decimal average."""
    return f"({half_up(cents(total) + ' * 10000', n)}::double / 1000000)"
