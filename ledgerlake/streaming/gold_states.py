"""Gold from counted states, so that a refresh reads the new rows and the states, not the fact.

States of the Silver fact, folded from the files appended to it: client, with sums and first and last time;
client by product; client by day, for the recent measures; month by branch, with sums, month by branch by client
and month by branch by product for the summary, of which only the months that changed are computed again; rows
per flag. States that are there for a distinct count are as long as the fact at worst and carry no sums. Rows
dated in the future when they arrived are kept as rows and join the states, when these are read, once
their time has come. They are few and never merged away.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlake import params
from ledgerlake.functions import amount_in, amount_out, now, today
from ledgerlake.functions.clock import AsOf
from ledgerlake.operators.scale import added, highest, join_null_safe, lowest
from ledgerlake.sources.tables import latest_version, read_version, versions, write_version
from ledgerlake.streaming.states import CountedState

FUTURE = "FECHA_FUTURA"
_SUM, _LONG, _TIME = "decimal(25,2)", "bigint", "timestamp_ntz"


def _approved():
    return added(F.count_if(F.col("estado") == params.APROBADA))


def client_product() -> CountedState:
    return CountedState({"client_id": _LONG, "producto_id": _LONG})


def client_total() -> CountedState:
    return CountedState(
        {"client_id": _LONG},
        {"aprobadas": _approved(), "ingresos": added(F.sum(amount_in("monto"))), "egresos": added(F.sum(amount_out("monto"))),
         "neto": added(F.sum("monto")), "_con_monto": added(F.count("monto")), "primera_txn": lowest("fecha"), "ultima_txn": highest("fecha")},
        {"aprobadas": _LONG, "ingresos": _SUM, "egresos": _SUM, "neto": _SUM, "_con_monto": _LONG, "primera_txn": _TIME, "ultima_txn": _TIME},
    )


def client_day() -> CountedState:
    return CountedState(
        {"mes": "date", "client_id": _LONG, "fecha_date": "date"}, {"volumen": added(F.sum("monto"))}, {"volumen": _SUM}, "mes"
    )


def month_client() -> CountedState:
    return CountedState({"mes": "date", "sucursal_id": _LONG, "client_id": _LONG}, partition="mes")


def month_product() -> CountedState:
    return CountedState({"mes": "date", "sucursal_id": _LONG, "producto_id": _LONG}, partition="mes")


def month_total() -> CountedState:
    return CountedState(
        {"mes": "date", "sucursal_id": _LONG},
        {"captaciones": added(F.sum(amount_in("monto"))), "colocaciones": added(F.sum(amount_out("monto"))),
         "neto": added(F.sum("monto")), "_absoluto": added(F.sum("monto_absoluto")), "_con_monto": added(F.count("monto_absoluto")),
         "_aprobadas": _approved(), "_fin_semana": added(F.count_if("es_fin_semana"))},
        {"captaciones": _SUM, "colocaciones": _SUM, "neto": _SUM, "_absoluto": _SUM, "_con_monto": _LONG, "_aprobadas": _LONG, "_fin_semana": _LONG},
        "mes",
    )


def flags() -> CountedState:
    return CountedState({"_quality_flag": "string"}, {"ultimo_check": highest("_silver_processed_at")}, {"ultimo_check": "timestamp"})


# Name of the state's folder, the state, and which rows of the fact it counts.
def _fact_states() -> dict[str, tuple[CountedState, str]]:
    ok = f"_quality_flag = '{params.OK}'"
    return {
        "cliente": (client_total(), ok),
        "cliente_producto": (client_product(), ok),
        "cliente_dia": (client_day(), ok),
        "mes_cliente": (month_client(), f"{ok} and sucursal_id is not null"),
        "mes_sucursal": (month_total(), f"{ok} and sucursal_id is not null"),
        "mes_producto": (month_product(), f"{ok} and sucursal_id is not null"),
        "flags": (flags(), "true"),
    }


def fold_fact(path: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` sink of appended Silver transactions."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        batch.filter(F.col("_quality_flag") == FUTURE).write.mode("overwrite").parquet(f"{path}/futuras/v={batch_id}")
        for name, (state, counted) in _fact_states().items():
            state.fold(batch.filter(counted), f"{path}/{name}", batch_id)

    return apply


def fold_flags(path: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` sink of appended rows of which only the flags are counted."""
    return lambda batch, batch_id: flags().fold(batch, f"{path}/flags", batch_id)


def _future(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """Rows dated in the future on arrival, as committed batch by batch."""
    numbers = versions(spark, f"{path}/futuras")
    if not numbers:
        raise FileNotFoundError(f"no batch in {path}")
    return spark.read.schema(like.schema).parquet(*[f"{path}/futuras/v={v}" for v in numbers])


def _due(future: DataFrame, as_of: AsOf, where: str = "true") -> DataFrame | None:
    """The rows whose time has come, or None if there are none."""
    due = future.filter(F.col("fecha") <= now(as_of)).filter(where).withColumn("_quality_flag", F.lit(params.OK))
    return None if due.isEmpty() else due


def activity(spark: SparkSession, path: str, like: DataFrame, as_of: AsOf = None) -> DataFrame:
    """``gold.client_activity`` from the states; ``like`` has the fact's columns."""
    due = _due(_future(spark, path, like), as_of)
    total = (
        client_total().read(spark, f"{path}/cliente", extra=due).groupBy("client_id").agg(
            F.sum("n").alias("total_txn"), *[F.sum(c).alias(c) for c in ("aprobadas", "ingresos", "egresos", "neto", "_con_monto")],
            F.min("primera_txn").alias("primera_txn"), F.max("ultima_txn").alias("ultima_txn"),
        )
    )
    products = client_product().read(spark, f"{path}/cliente_producto", extra=due)
    total = join_null_safe(total, products.groupBy("client_id").agg(F.count("producto_id").alias("productos")), ["client_id"])
    since = F.date_sub(today(as_of), 90)
    days = client_day().read(
        spark, f"{path}/cliente_dia", extra=due, where=(F.col("mes") >= F.trunc(since, "month")) & (F.col("fecha_date") >= since)
    )
    recent = days.groupBy("client_id").agg(F.sum("n").alias("txn_90d"), F.sum("volumen").alias("volumen_90d"))
    return total.join(recent, "client_id", "left")


def months(spark: SparkSession, path: str, like: DataFrame, as_of: AsOf = None) -> DataFrame:
    """``gold.branch_months`` as the next version of its table: only months with new rows are computed.

    Months of rows dated in the future are always among them, as such a row may have come due. The
    list of months is as long as the calendar at most.
    """
    clients, products, totals = month_client(), month_product(), month_total()
    out_path = f"{path}/meses"
    newest = products.last_batch(spark, f"{path}/mes_producto")
    if newest is None:
        raise FileNotFoundError(f"no batch in {path}")
    last = latest_version(spark, out_path)
    changed = None if last is None else products.changed(spark, f"{path}/mes_producto", last - 1)
    due = _due(_future(spark, path, like), as_of, "sucursal_id is not null")
    if changed is None:
        where = None
    else:
        touched = [r[0] for r in changed.select("mes").union(_future(spark, path, like).select("mes")).distinct().collect()]
        dates = [m for m in touched if m is not None]
        where = F.col("mes").isin(dates) if dates else F.lit(False)
        if None in touched:
            where = where | F.col("mes").isNull()
    measures = totals.read(spark, f"{path}/mes_sucursal", extra=due, where=where).groupBy("mes", "sucursal_id").agg(
        F.sum("n").alias("total_operaciones"), *[F.sum(m).alias(m) for m in totals.measures]
    )
    operated = products.read(spark, f"{path}/mes_producto", extra=due, where=where).groupBy("mes", "sucursal_id").agg(
        F.count("producto_id").alias("productos_operados")
    )
    active = clients.read(spark, f"{path}/mes_cliente", extra=due, where=where).groupBy("mes", "sucursal_id").agg(F.count("client_id").alias("clientes_activos"))
    made = join_null_safe(join_null_safe(measures, operated, ["mes", "sucursal_id"]), active, ["mes", "sucursal_id"])
    if where is not None:
        before = read_version(spark, out_path, last)
        made = before.filter(~F.coalesce(where, F.lit(False))).unionByName(made)
    # Without new batches nothing is stored: what has come due since is joined when read.
    return made if newest + 1 == last else write_version(made, out_path, newest + 1)


def fact_alerts(spark: SparkSession, path: str, like: DataFrame, as_of: AsOf = None) -> DataFrame:
    """(flag, registros, ultimo_check) of the fact for flags other than OK."""
    still = _future(spark, path, like).filter(F.col("fecha") > now(as_of))
    others = flags().read(spark, f"{path}/flags").filter((F.col("_quality_flag") != params.OK) & (F.col("_quality_flag") != FUTURE))
    return others.unionByName(flags().reduced(still)).withColumnRenamed("n", "registros")


def flag_alerts(spark: SparkSession, path: str) -> DataFrame:
    """(flag, registros, ultimo_check) of a table without rows that change their flag."""
    return flags().read(spark, f"{path}/flags").filter(F.col("_quality_flag") != params.OK).withColumnRenamed("n", "registros")


def row_total(spark: SparkSession, path: str) -> int:
    """Rows folded so far, whatever their flag."""
    return flags().read(spark, f"{path}/flags").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
