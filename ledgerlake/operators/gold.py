"""Gold: customer profile, monthly branch summary, quality alerts and layer reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerlake import params
from ledgerlake.functions import amount_in, amount_out, ratio, today
from ledgerlake.functions.clock import AsOf
from ledgerlake.operators.scale import aggregate_apart, mean_of


def _zero(name: str, alias: str | None = None):
    return F.coalesce(F.col(name), F.lit(0)).alias(alias or name)


def gold_perfil_360(
    dim: DataFrame,
    txn: DataFrame,
    saldos: DataFrame,
    as_of: AsOf = None,
    cortes: params.CortesValor = params.CortesValor(),
) -> DataFrame:
    """One row per client: transactions, current balances, last 90 days and a value class."""
    return profile(dim, client_activity(txn, as_of), saldos, cortes)


def client_activity(txn: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Transactions per client; the 90-day measures are conditional aggregates of the same pass.

    A client's products are counted apart: their pairs are nearly as many as the rows, and so carry no measures.
    """
    recent = F.col("fecha_date") >= F.date_sub(today(as_of), 90)
    return aggregate_apart(
        txn.filter(F.col("_quality_flag") == params.OK),
        ["client_id"],
        {
            "total_txn": F.count("*"),
            "aprobadas": F.count_if(F.col("estado") == params.APROBADA),
            "ingresos": F.sum(amount_in("monto")),
            "egresos": F.sum(amount_out("monto")),
            "neto": F.sum("monto"),
            "_con_monto": F.count("monto"),
            "primera_txn": F.min("fecha"),
            "ultima_txn": F.max("fecha"),
            "txn_90d": F.count_if(recent),
            "volumen_90d": F.sum(F.when(recent, F.col("monto"))),
        },
        {"productos": "producto_id"},
        drop_null_keys=True,
    )


def profile(dim: DataFrame, activity: DataFrame, saldos: DataFrame, cortes: params.CortesValor = params.CortesValor()) -> DataFrame:
    """The profile from each client's activity and current balances."""
    activity = activity.withColumn("ticket", mean_of("neto", "_con_monto"))
    balance = (
        saldos.filter(F.col("estado_cuenta") == params.ACTIVA)
        .groupBy("client_id")
        .agg(F.sum("saldo_contable").alias("saldo"), F.count_distinct("producto_id").alias("activos"))
    )
    n, b = F.coalesce("total_txn", F.lit(0)), F.coalesce("saldo", F.lit(0))
    value_class = (
        F.when((n > cortes.a[0]) & (b > cortes.a[1]), "A - Premium")
        .when((n > cortes.b[0]) | (b > cortes.b[1]), "B - Alto")
        .when(n > cortes.c, "C - Medio")
        .otherwise("D - Bajo")
    )
    return (
        dim.join(activity, "client_id", "left")
        .join(balance, "client_id", "left")
        .select(
            "client_id",
            "nombre_completo",
            "segmento",
            "categoria_antiguedad",
            "sucursal_comuna",
            "sucursal_region",
            "dias_antiguedad",
            _zero("total_txn", "total_transacciones"),
            _zero("aprobadas", "transacciones_aprobadas"),
            _zero("ingresos", "total_ingresos"),
            _zero("egresos", "total_egresos"),
            _zero("neto", "balance_neto"),
            _zero("ticket", "ticket_promedio"),
            _zero("productos", "productos_utilizados"),
            "primera_txn",
            "ultima_txn",
            _zero("saldo", "saldo_total"),
            _zero("activos", "productos_activos"),
            _zero("txn_90d", "transacciones_90d"),
            _zero("volumen_90d"),
            value_class.alias("categoria_valor"),
            F.current_timestamp().alias("_gold_processed_at"),
        )
    )


def gold_resumen_mensual_sucursal(txn: DataFrame, sucursales: DataFrame) -> DataFrame:
    """Month × branch. The branch names join after the aggregation, on a few rows."""
    return named_months(branch_months(txn), sucursales)


def branch_months(txn: DataFrame) -> DataFrame:
    return aggregate_apart(
        txn.filter((F.col("_quality_flag") == params.OK) & F.col("sucursal_id").isNotNull()),
        ["mes", "sucursal_id"],
        {
            "total_operaciones": F.count("*"),
            "captaciones": F.sum(amount_in("monto")),
            "colocaciones": F.sum(amount_out("monto")),
            "neto": F.sum("monto"),
            "_absoluto": F.sum("monto_absoluto"),
            "_con_monto": F.count("monto_absoluto"),
            "_aprobadas": F.count_if(F.col("estado") == params.APROBADA),
            "_fin_semana": F.count_if("es_fin_semana"),
        },
        {"clientes_activos": "client_id", "productos_operados": "producto_id"},
    )


def named_months(months: DataFrame, sucursales: DataFrame) -> DataFrame:
    months = months.withColumns({
        "ticket_promedio": mean_of("_absoluto", "_con_monto"),
        "tasa_aprobacion": ratio(F.col("_aprobadas"), F.col("total_operaciones")),
        "pct_fin_semana": ratio(F.col("_fin_semana"), F.col("total_operaciones")),
    })
    places = sucursales.select("sucursal_id", "comuna", "region")
    return months.join(places, "sucursal_id").select(
        "mes", "sucursal_id", "comuna", "region", "total_operaciones", "clientes_activos", "captaciones",
        "colocaciones", "neto", "ticket_promedio", "tasa_aprobacion", "productos_operados", "pct_fin_semana",
        F.current_timestamp().alias("_gold_processed_at"),
    )


def gold_quality_alerts(txn: DataFrame, mov: DataFrame) -> DataFrame:
    """Rows per table and flag, for flags other than OK."""

    def alerts(df: DataFrame) -> DataFrame:
        return (
            df.filter(F.col("_quality_flag") != params.OK)
            .groupBy("_quality_flag")
            .agg(F.count("*").alias("registros"), F.max("_silver_processed_at").alias("ultimo_check"))
        )

    return named_alerts(alerts(txn), alerts(mov))


def named_alerts(txn: DataFrame, mov: DataFrame) -> DataFrame:
    """Both tables' (flag, registros, ultimo_check) as one."""
    both = {"FACT_TRANSACCIONES": txn, "FACT_MOVIMIENTOS": mov}
    parts = [df.select(F.lit(name).alias("tabla"), "_quality_flag", "registros", "ultimo_check") for name, df in both.items()]
    return parts[0].unionByName(parts[1])


def row_counts(tables: dict[str, DataFrame], label: str = "tabla") -> DataFrame:
    """(table, rows) over the named tables, sorted by name."""
    counts = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("filas")).select(F.lit(name).alias(label), "filas")
        counts = one if counts is None else counts.unionByName(one)
    return counts.orderBy(label)


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """Row counts across the layers."""
    return row_counts(layers, "capa")


def refresh_report(log: DataFrame, n: int = 20) -> DataFrame:
    """The newest refreshes with target and actual lag in minutes."""
    ties = [F.col(c).asc_nulls_last() for c in ("name", "event_id") if c in log.columns]
    return (
        log.orderBy(F.col("last_completed_refresh_time").desc_nulls_last(), *ties)
        .limit(n)
        .select(
            "name",
            "schema_name",
            (F.col("target_lag_sec") / 60).alias("target_lag_min"),
            F.round(F.col("actual_lag_sec") / 60, 1).alias("actual_lag_min"),
            "refresh_trigger",
            "refresh_status",
            "last_completed_refresh_time",
        )
    )
