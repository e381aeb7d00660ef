"""Client scoring, balance reconciliation and monthly trends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ledgerlake import params
from ledgerlake.functions import amount_in, amount_out, banded, month_of, today
from ledgerlake.functions.clock import AsOf
from ledgerlake.operators.marts import approved
from ledgerlake.operators.scale import dense_ranks_desc, join_null_safe, materialize
from ledgerlake.operators.silver import newest_saldo


def scoring_clientes(
    dim: DataFrame,
    fact: DataFrame,
    saldos: DataFrame,
    as_of: AsOf = None,
    cortes: params.CortesScore = params.CortesScore(),
) -> DataFrame:
    """Score per client from activity, volume, balance and tenure.

    ``meses_activo`` counts dated transactions, not months: that is the measure's definition here.
    """
    activity = approved(fact).groupBy("client_id").agg(
        F.count("txn_id").alias("total_txn"),
        F.sum(amount_in("monto")).alias("total_ingresos"),
        F.sum(amount_out("monto")).alias("total_egresos"),
        F.avg("monto").alias("monto_promedio"),
        F.count("fecha").alias("meses_activo"),
        F.max("fecha").alias("ultima_txn"),
    )
    balance = newest_saldo(saldos, ["client_id"]).select("client_id", "saldo_contable", "saldo_disponible")

    def points(name: str, cuts: tuple) -> Column:
        return F.when(F.col(name).isNull(), F.lit(0)).otherwise(banded(F.col(name), cuts, cortes.minimo))

    parts = ["score_actividad", "score_volumen", "score_saldo", "score_antiguedad"]
    total = sum((F.col(p) for p in parts[1:]), F.col(parts[0]))
    return (
        dim.select("client_id", "segmento", "sucursal_comuna", "fecha_registro")
        .join(activity, "client_id", "left")
        .join(balance, "client_id", "left")
        .withColumn("antiguedad_dias", F.datediff(today(as_of), "fecha_registro"))
        .withColumns({
            "score_actividad": points("total_txn", cortes.actividad),
            "score_volumen": points("total_ingresos", cortes.volumen),
            "score_saldo": points("saldo_contable", cortes.saldo),
            # An unknown tenure gets the minimum, not zero.
            "score_antiguedad": banded(F.col("antiguedad_dias"), cortes.antiguedad, cortes.minimo),
        })
        .withColumn("score_total", total)
        .withColumn(
            "categoria_score",
            banded(F.col("score_total"), params.CATEGORIAS_SCORE, params.CATEGORIA_SCORE_RESTO, at_least=True),
        )
    )


def distribucion_scores(scoring: DataFrame) -> DataFrame:
    return scoring.groupBy("categoria_score").agg(F.count("client_id").alias("clientes")).orderBy("categoria_score")


def reconciliacion_saldos(movimientos: DataFrame, saldos: DataFrame, tolerancia: int = params.TOLERANCIA) -> DataFrame:
    """Sum of movements against the newest reported balance, per client and product.

    The tolerance is tested first, so a small one-sided balance is OK.
    """
    keys = ["client_id", "producto_id"]
    computed = movimientos.groupBy(*keys).agg(
        F.sum("monto").alias("saldo_calculado"),
        F.count("movimiento_id").alias("num_movimientos"),
        F.max("fecha").alias("ultimo_movimiento"),
    )
    # Balances that tie in these columns are the same to the result, so the others need not be carried.
    reported = newest_saldo(saldos.select(*keys, "fecha_corte", "saldo_id", "saldo_contable"), keys).select(*keys, "saldo_contable", "fecha_corte")
    zero = F.lit(0)
    state = (
        F.when(F.col("abs_diferencia") <= tolerancia, params.OK)
        .when(F.col("saldo_calculado").isNull(), "SIN_MOVIMIENTOS")
        .when(F.col("saldo_contable").isNull(), "SIN_SALDO_REPORTADO")
        .otherwise("DISCREPANCIA")
    )
    return (
        computed.join(reported, keys, "full")
        .withColumn("diferencia", F.coalesce("saldo_calculado", zero) - F.coalesce("saldo_contable", zero))
        .withColumn("abs_diferencia", F.abs("diferencia"))
        .withColumn("estado_reconciliacion", state)
    )


def excepciones_reconciliacion(reconciliacion: DataFrame) -> DataFrame:
    return reconciliacion.filter(F.col("estado_reconciliacion") != params.OK)


def resumen_reconciliacion(reconciliacion: DataFrame) -> DataFrame:
    return (
        reconciliacion.groupBy("estado_reconciliacion")
        .agg(F.count("*").alias("registros"))
        .orderBy("estado_reconciliacion")
    )


def mensual_clientes(fact: DataFrame) -> DataFrame:
    """Approved activity per client and month."""
    return (
        approved(fact).select("client_id", month_of("fecha").alias("mes"), "txn_id", "monto")
        .groupBy("client_id", "mes")
        .agg(
            F.count("txn_id").alias("num_txn"),
            F.sum(amount_in("monto")).alias("ingresos"),
            F.sum(amount_out("monto")).alias("egresos"),
            F.sum("monto").alias("neto"),
            F.avg("monto").alias("ticket_promedio"),
        )
    )


def _trend(mensual: DataFrame) -> DataFrame:
    """Running sums, moving mean and change on the month before; a client has one row per month."""
    by_client = W.partitionBy("client_id").orderBy(F.col("mes").asc_nulls_last())
    previous = F.col("mes_anterior_neto")
    change = (F.col("neto") - previous) / F.abs(F.nullif(previous, F.lit(0))) * 100
    return mensual.withColumns({
        "ingresos_acum": F.sum("ingresos").over(by_client),
        "egresos_acum": F.sum("egresos").over(by_client),
        "neto_acum": F.sum("neto").over(by_client),
        "promedio_movil_3m": F.round(F.avg("neto").over(by_client.rowsBetween(-2, 0)), 2),
        "mes_anterior_neto": F.lag("neto", 1).over(by_client),
    }).withColumn("variacion_mom", F.round(change, 2))


def agregacion_mensual_clientes(fact: DataFrame) -> DataFrame:
    """Monthly activity per client with running sums, trend and the client's rank in the month.

    A month may hold every client, so the rank is taken in bands of the value. The monthly table is
    written once, because trend and rank both read it.
    """
    mensual = materialize(mensual_clientes(fact))
    ranks = dense_ranks_desc(mensual, ["mes"], "neto", "ranking_mes")
    return join_null_safe(_trend(mensual), ranks, ["neto", "mes"])


def serie_cliente(agregacion: DataFrame, client_id: int = 1, n: int = 12) -> DataFrame:
    """One client's first months."""
    return agregacion.filter(F.col("client_id") == client_id).orderBy("mes").limit(n)
