"""Silver: cleaned, deduplicated and flagged tables built from the landing tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlake import params
from ledgerlake.functions import banded, initcap_trim, month_of, now, quarter_of, today, weekday, years_between
from ledgerlake.functions.clock import AsOf
from ledgerlake.operators.scale import newest_per_key


def newest_client_first(columns: Sequence[str]) -> list[Column]:
    """The one total order of a client's versions, for the batch and the incremental job alike."""
    ties = [F.col(c).asc_nulls_last() for c in sorted(columns) if c != "_loaded_at"]
    return [F.col("_loaded_at").desc_nulls_last(), *ties]


def newest_balance_first(columns: Sequence[str]) -> list[Column]:
    """The one total order of a key's balances: cut date, balance id, then all other columns."""
    first = ["fecha_corte", "saldo_id", "saldo_contable"]
    return [F.col(c).desc_nulls_last() for c in [*first, *sorted(set(columns) - set(first))]]


def silver_dim_clientes(bronze: DataFrame, sucursales: DataFrame, as_of: AsOf = None, reduced: bool = False) -> DataFrame:
    """Newest version of every client, cleaned, with the branch's place and the client's tenure.

    ``reduced``: only the newest versions are given, a row per client.
    """
    newest = bronze if reduced else newest_per_key(bronze, ["client_id"], newest_client_first(bronze.columns))
    places = sucursales.select(
        "sucursal_id", F.col("comuna").alias("sucursal_comuna"), F.col("region").alias("sucursal_region")
    )
    years = years_between(F.col("fecha_registro"), today(as_of))
    return (
        newest.join(places, "sucursal_id", "left")
        .select(
            "client_id",
            "rut",
            initcap_trim("nombre").alias("nombre"),
            initcap_trim("apellido").alias("apellido"),
            F.concat(initcap_trim("nombre"), F.lit(" "), initcap_trim("apellido")).alias("nombre_completo"),
            F.lower(F.trim("email")).alias("email"),
            "telefono",
            "direccion",
            "fecha_registro",
            "segmento",
            "sucursal_id",
            "sucursal_comuna",
            "sucursal_region",
            F.datediff(today(as_of), "fecha_registro").alias("dias_antiguedad"),
            banded(years, params.ANTIGUEDAD, params.ANTIGUEDAD_RESTO, at_least=True).alias(
                "categoria_antiguedad"
            ),
            F.lit(False).alias("pseudonymized"),
            F.lit(None).cast("timestamp_ntz").alias("pseudonymized_at"),
            "_loaded_at",
            F.current_timestamp().alias("_silver_processed_at"),
        )
    )


def silver_fact_transacciones(bronze: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Transactions with calendar columns and a row-level quality flag; no shuffle, also on a stream."""
    flag = (
        F.when(F.col("monto").isNull(), "MONTO_NULL")
        .when(F.col("client_id").isNull(), "CLIENT_NULL")
        .when(F.col("fecha") > now(as_of), "FECHA_FUTURA")
        .otherwise(params.OK)
    )
    return bronze.filter(F.col("estado").isNotNull()).select(
        "txn_id",
        "client_id",
        "producto_id",
        "sucursal_id",
        "fecha",
        F.col("fecha").cast("date").alias("fecha_date"),
        month_of("fecha").alias("mes"),
        quarter_of("fecha").alias("trimestre"),
        F.year("fecha").alias("anio"),
        weekday("fecha").alias("dia_semana"),
        F.coalesce(weekday("fecha").isin(0, 6), F.lit(False)).alias("es_fin_semana"),
        "tipo",
        "monto",
        F.abs("monto").alias("monto_absoluto"),
        "moneda",
        "estado",
        flag.alias("_quality_flag"),
        "referencia",
        "_loaded_at",
        F.current_timestamp().alias("_silver_processed_at"),
    )


def silver_fact_movimientos(bronze: DataFrame, monto_anomalo: int = params.MONTO_ANOMALO) -> DataFrame:
    """Movements with their month and an anomaly flag; no shuffle."""
    unusual_debt = (F.col("saldo_posterior") < 0) & ~F.col("tipo_movimiento").isin(
        *params.TIPOS_CON_SALDO_NEGATIVO
    )
    flag = (
        F.when(unusual_debt, "SALDO_NEGATIVO_ANOMALO")
        .when(F.col("monto") > monto_anomalo, "MONTO_ANOMALO")
        .otherwise(params.OK)
    )
    return bronze.select(
        "movimiento_id",
        "client_id",
        "producto_id",
        "sucursal_id",
        "fecha",
        month_of("fecha").alias("mes"),
        "tipo_movimiento",
        "monto",
        "saldo_posterior",
        flag.alias("_quality_flag"),
        "referencia",
        "_loaded_at",
        F.current_timestamp().alias("_silver_processed_at"),
    )


def newest_saldo(saldos: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Newest balance per key by cut date; the balance id, then the other columns break ties."""
    return newest_per_key(saldos, keys, newest_balance_first(saldos.columns))


def silver_saldos_actuales(
    bronze: DataFrame, rangos: Sequence[tuple] = params.RANGOS_SALDO, reduced: bool = False
) -> DataFrame:
    """Current balance per client and product (older ones are overwritten); ``reduced``: only those are given."""
    return (bronze if reduced else newest_saldo(bronze, ["client_id", "producto_id"])).select(
        "client_id",
        "producto_id",
        F.col("fecha_corte").alias("fecha_ultimo_saldo"),
        "saldo_contable",
        "saldo_disponible",
        "saldo_promedio_mes",
        "estado_cuenta",
        (F.col("saldo_contable") - F.col("saldo_disponible")).alias("saldo_retenido"),
        banded(F.col("saldo_contable"), rangos, params.RANGO_SALDO_RESTO).alias("rango_saldo"),
        F.current_timestamp().alias("_silver_processed_at"),
    )
