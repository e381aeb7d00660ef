"""Masks and metrics as functions of the SQL session, each with the body of its Column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, SparkSession, functions as F

from ledgerlake.functions.clock import AsOf
from ledgerlake.functions.masking import MASKS, PRIVILEGED_ROLES
from ledgerlake.operators import quality


def sql_of(spark: SparkSession, column: Column, arguments: str) -> str:
    """SQL text of a Column over the named arguments, as the analyzer resolves it."""
    frame = spark.createDataFrame([], arguments).select(column.alias("x"))
    return frame._jdf.queryExecution().analyzed().expressions().head().child().sql()


def create_function(spark: SparkSession, name: str, arguments: str, returns: str, column: Column) -> None:
    """A temporary scalar function whose body is the Column."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {returns} RETURN {sql_of(spark, column, arguments)}")


def register_masks(spark: SparkSession, privileged: Sequence[str] = PRIVILEGED_ROLES) -> list[str]:
    """``mask_rut(valor, rol)`` and so on: the value for privileged roles, else its mask."""
    names = []
    for policy, mask in MASKS.items():
        seen = F.when(F.col("rol").isin(*privileged), F.col("valor")).otherwise(mask(F.col("valor")))
        create_function(spark, f"mask_{policy}", "valor STRING, rol STRING", "STRING", seen)
        names.append(f"mask_{policy}")
    return names


def register_checks(spark: SparkSession) -> list[str]:
    """``rut_invalido(valor)``: whether an identifier breaks the format."""
    create_function(spark, "rut_invalido", "valor STRING", "BOOLEAN", quality.invalid_rut("valor"))
    return ["rut_invalido"]


def register_metrics(
    spark: SparkSession, name: str, view: str, specs: Sequence[tuple[str, str]], as_of: AsOf = None
) -> None:
    """A table function without arguments: (metrica, columna, valor) of a view, from one pass of each kind."""
    fields = spark.table(view).schema
    arguments = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    selects = []
    for metric, column in specs:
        value = quality.freshness(column, as_of) if metric == "FRESHNESS" else quality.METRICS[metric](column)
        body = sql_of(spark, value.cast("long"), arguments)
        selects.append(f"SELECT '{metric}' AS metrica, '{column}' AS columna, {body} AS valor FROM {view}")
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}() RETURNS TABLE(metrica STRING, columna STRING, valor BIGINT) RETURN "
        + " UNION ALL ".join(selects)
    )
