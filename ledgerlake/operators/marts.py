"""Star schema and the business summaries built on it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ledgerlake import params
from ledgerlake.functions import amount_in, amount_out, month_of, percent, today, year_of
from ledgerlake.functions.clock import AsOf
from ledgerlake.operators.scale import (
    Measure, added, aggregate_apart, aggregate_once, exact_median, highest, lowest, mean_of,
)
from ledgerlake.operators.silver import newest_saldo


def dwh_dim_clientes(clientes: DataFrame, sucursales: DataFrame) -> DataFrame:
    """Clients as loaded (no deduplication, no case folding) with the branch's place."""
    places = sucursales.select(
        "sucursal_id", F.col("comuna").alias("sucursal_comuna"), F.col("region").alias("sucursal_region")
    )
    return clientes.join(places, "sucursal_id", "left").select(
        "client_id", "rut", "nombre", "apellido",
        F.concat("nombre", F.lit(" "), "apellido").alias("nombre_completo"),
        "email", "telefono", "direccion", "fecha_registro", "segmento",
        "sucursal_comuna", "sucursal_region", "pseudonymized", "pseudonymized_at",
        F.current_timestamp().alias("etl_timestamp"),
    )


def dwh_dim_productos(productos: DataFrame) -> DataFrame:
    return productos.select(
        "producto_id", "codigo", "tipo", "segmento", "tasa_anual", "es_credito", "activo",
        F.current_timestamp().alias("etl_timestamp"),
    )


def dwh_dim_sucursales(sucursales: DataFrame) -> DataFrame:
    return sucursales.select("*", F.current_timestamp().alias("etl_timestamp"))


def dwh_fact_transacciones(transacciones: DataFrame) -> DataFrame:
    """Transactions with month and year as first-of-period dates."""
    return transacciones.select(
        "txn_id", "client_id", "producto_id", "sucursal_id", "fecha",
        month_of("fecha").alias("mes"), year_of("fecha").alias("anio"),
        "tipo", "monto", "moneda", "estado", "referencia",
        F.current_timestamp().alias("etl_timestamp"),
    )


def approved(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("estado") == params.APROBADA)


def resumen_actividad(dim: DataFrame, fact: DataFrame) -> DataFrame:
    """Approved activity per client. The fact is reduced to clients before the dimension joins."""
    ok = approved(fact).filter(F.col("client_id").isNotNull())
    measures = {
        "total_ingresos": added(F.sum(amount_in("monto"))),
        "total_egresos": added(F.sum(amount_out("monto"))),
        "balance_neto": added(F.sum("monto")),
        "_con_monto": added(F.count("monto")),
        "primera_transaccion": lowest("fecha"),
        "ultima_transaccion": highest("fecha"),
        "meses_activo": Measure(F.bit_or(F.expr("shiftleft(1L, _mes)")), lambda months: F.sum(F.bit_count(months))),
    }
    # A client's months are bits of a few words, one for 64 months, so that they need no pass of their own.
    words = (
        ok.withColumn("_mes", F.year("fecha") * 12 + F.month("fecha"))
        .groupBy("client_id", F.shiftright("_mes", 6).alias("_word"))
        .agg(*[m.first.alias(name) for name, m in measures.items()])
    )
    per_client = words.groupBy("client_id").agg(*[
        F.coalesce(m.then(F.col(name)), F.lit(0)).alias(name) if name == "meses_activo"
        else m.then(F.col(name)).cast(words.schema[name].dataType).alias(name)
        for name, m in measures.items()
    ])
    for name, column in (("productos_utilizados", "producto_id"), ("total_transacciones", "txn_id")):
        per_client = per_client.join(ok.groupBy("client_id").agg(F.count_distinct(column).alias(name)), "client_id")
    per_client = per_client.withColumns({
        "dias_actividad": F.datediff("ultima_transaccion", "primera_transaccion"),
        "monto_promedio": mean_of("balance_neto", "_con_monto"),
    })
    median = exact_median(ok, ["client_id"], "monto", "monto_mediana")
    return (
        per_client.join(median, "client_id", "left")
        .join(dim.select("client_id", "segmento", "sucursal_comuna"), "client_id")
        .select(
            "client_id", "segmento", "sucursal_comuna", "total_transacciones", "productos_utilizados",
            "total_ingresos", "total_egresos", "balance_neto", "primera_transaccion", "ultima_transaccion",
            "dias_actividad", "monto_promedio", "monto_mediana", "meses_activo",
        )
    )


def top_clientes_sucursal(fact: DataFrame, dim: DataFrame, sucursales: DataFrame, n: int = 10) -> DataFrame:
    """Top approved clients per branch by turnover; the reported volume counts income only.

    Ties go to the lower client id. Ranking sends at most ``n`` rows per task and branch.
    """
    turnover = approved(fact).groupBy("sucursal_id", "client_id").agg(
        F.sum(amount_in("monto")).alias("volumen_total"),
        F.count("*").alias("num_transacciones"),
        F.sum(F.abs("monto")).alias("_turnover"),
    )
    names = dim.select("client_id", "nombre_completo", "segmento")
    places = sucursales.select("sucursal_id", "comuna")
    named = turnover.join(names, "client_id").join(places, "sucursal_id")
    window = W.partitionBy("sucursal_id").orderBy(F.col("_turnover").desc_nulls_last(), F.col("client_id").asc())
    return (
        named.withColumn("ranking", F.row_number().over(window))
        .filter(F.col("ranking") <= n)
        .select("sucursal_id", "comuna", "client_id", "nombre_completo", "segmento",
                "volumen_total", "num_transacciones", "ranking")
    )


def metricas_productos(productos: DataFrame, fact: DataFrame) -> DataFrame:
    """Activity per product over all statuses; products without activity stay with count 0.

    A product's clients are counted apart: their pairs are nearly as many as the rows, and so carry no measures.
    """
    activity = aggregate_apart(
        fact,
        ["producto_id"],
        {
            "total_operaciones": F.count("txn_id"),
            "volumen_total": F.sum("monto"),
            "_con_monto": F.count("monto"),
            "primera_operacion": F.min("fecha"),
            "ultima_operacion": F.max("fecha"),
        },
        {"clientes_activos": "client_id"},
        drop_null_keys=True,
    ).select(
        "producto_id", "total_operaciones", "volumen_total", mean_of("volumen_total", "_con_monto").alias("ticket_promedio"),
        "primera_operacion", "ultima_operacion", "clientes_activos",
    )
    joined = productos.select("producto_id", "tipo", "segmento", "tasa_anual").join(activity, "producto_id", "left")
    return joined.fillna(0, ["clientes_activos", "total_operaciones"])


def resumen_mensual(fact: DataFrame, sucursales: DataFrame) -> DataFrame:
    """Month × type × region with the approval percentage."""
    regions = sucursales.select("sucursal_id", "region")
    joined = fact.withColumn("mes", month_of("fecha")).join(regions, "sucursal_id")
    is_ok, is_rejected = F.col("estado") == params.APROBADA, F.col("estado") == params.RECHAZADA
    return aggregate_once(
        joined,
        ["mes", "tipo", "region"],
        {
            "num_transacciones": added(F.count("*")),
            "volumen_total": added(F.sum("monto")),
            "_con_monto": added(F.count("monto")),
            "aprobadas": added(F.count_if(is_ok)),
            "rechazadas": added(F.count_if(is_rejected)),
        },
        {"clientes_unicos": "client_id"},
    ).select(
        "mes", "tipo", "region", "num_transacciones", "volumen_total",
        mean_of("volumen_total", "_con_monto").alias("ticket_promedio"), "aprobadas", "rechazadas",
        percent(F.col("aprobadas"), F.col("num_transacciones")).alias("tasa_aprobacion"), "clientes_unicos",
    )


def posicion_cliente(
    dim: DataFrame, saldos: DataFrame, fact: DataFrame, movimientos: DataFrame, as_of: AsOf = None
) -> DataFrame:
    """Newest balance of any product and this month's activity, per client."""
    month_start = F.trunc(today(as_of), "month")
    this_month = fact.filter(F.col("fecha") >= month_start.cast("timestamp_ntz"))
    if "mes" in fact.columns:
        this_month = this_month.filter(F.col("mes") >= month_start)
    balance = newest_saldo(saldos, ["client_id"]).select("client_id", F.col("saldo_contable").alias("saldo_actual"))
    activity = this_month.groupBy("client_id").agg(
        F.count("*").alias("transacciones_mes_actual"), F.sum("monto").alias("volumen_mes_actual")
    )
    moves = movimientos.filter(F.col("fecha") >= month_start).groupBy("client_id").agg(
        F.count("*").alias("movimientos_mes_actual")
    )
    out = dim.select("client_id", "segmento", "sucursal_comuna")
    measures = ["saldo_actual", "transacciones_mes_actual", "volumen_mes_actual", "movimientos_mes_actual"]
    for part in (balance, activity, moves):
        out = out.join(part, "client_id", "left")
    return out.withColumns({m: F.coalesce(F.col(m), F.lit(0)) for m in measures})


def newest_months(resumen: DataFrame, n: int = 20) -> DataFrame:
    """Newest rows of the monthly summary."""
    return resumen.orderBy(
        F.col("mes").desc_nulls_last(), F.col("tipo").asc_nulls_last(), F.col("region").asc_nulls_last()
    ).limit(n)


def sample_positions(posicion: DataFrame, n: int = 20) -> DataFrame:
    """The first client positions by id."""
    return posicion.orderBy("client_id").limit(n)
