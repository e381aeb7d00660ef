"""Queries over the marts and the three processes."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ledgerlake.operators import marts, monitoring, processes
from ledgerlake.operators.scale import exact_median
from ledgerlake.plans import fixtures as fx
from ledgerlake.plans.registry import avg6, cents, half_up, query
from ledgerlake.session import shared_dir
from ledgerlake.sources import tables


def dim(spark, sf):
    return marts.dwh_dim_clientes(fx.clientes(spark, sf), fx.sucursales(spark, sf))


def fact(spark, sf, branch=True):
    return marts.dwh_fact_transacciones(fx.transacciones(spark, sf, branch))


DIM = """dim as (select client_id, rut, nombre, apellido, nombre || ' ' || apellido nombre_completo, email, telefono,
  direccion, fecha_registro, segmento, comuna sucursal_comuna, region sucursal_region, pseudonymized, pseudonymized_at
  from cli left join suc using (sucursal_id))"""
IN, OUT = "sum(case when monto > 0 then monto else 0 end)", "sum(case when monto < 0 then -monto else 0 end)"


@query("d1_dwh_dim_clientes", f"with {DIM} select * from dim", ("cli", "suc"))
def d1(spark, sf):
    return dim(spark, sf)


@query("d2_dwh_dim_productos", "select * replace (tasa_anual::double as tasa_anual) from prod", ("prod",))
def d2(spark, sf):
    return marts.dwh_dim_productos(fx.productos(spark, sf))


@query("d3_dwh_dim_sucursales", "select * from suc", ("suc",))
def d3(spark, sf):
    return marts.dwh_dim_sucursales(fx.sucursales(spark, sf))


@query("d4_dwh_fact_transacciones", """select txn_id, client_id, producto_id, sucursal_id, fecha,
  date_trunc('month', fecha)::date mes, date_trunc('year', fecha)::date anio, tipo, monto::double monto, moneda,
  estado, referencia from txn""", ("txn",))
def d4(spark, sf):
    return fact(spark, sf)


D5_SQL = f"""with {DIM}
select client_id, segmento, sucursal_comuna, count(distinct txn_id) total_transacciones,
  count(distinct producto_id) productos_utilizados, {IN}::double total_ingresos, {OUT}::double total_egresos,
  sum(monto)::double balance_neto, min(fecha) primera_transaccion, max(fecha) ultima_transaccion,
  (max(fecha)::date - min(fecha)::date)::bigint dias_actividad, {avg6('sum(monto)', 'count(monto)')} monto_promedio,
  median((monto * 100)::bigint::double) / 100 monto_mediana, count(distinct date_trunc('month', fecha)) meses_activo
from dim join txn using (client_id) where estado = 'Aprobada' group by 1, 2, 3"""


@query("d5_resumen_actividad", D5_SQL, ("cli", "suc", "txn"))
def d5(spark, sf):
    return marts.resumen_actividad(dim(spark, sf), fact(spark, sf, branch=False))


D6_SQL = f"""with {DIM}
select t.sucursal_id, comuna, t.client_id, nombre_completo, segmento, {IN}::double volumen_total,
  count(*) num_transacciones,
  row_number() over (partition by t.sucursal_id order by sum(abs(monto)) desc, t.client_id) ranking
from txn t join dim on t.client_id = dim.client_id join suc s on t.sucursal_id = s.sucursal_id
where estado = 'Aprobada' group by 1, 2, 3, 4, 5 qualify ranking <= 10"""


@query("d6_top_clientes_sucursal", D6_SQL, ("cli", "suc", "txn"))
def d6(spark, sf):
    return marts.top_clientes_sucursal(fact(spark, sf), dim(spark, sf), fx.sucursales(spark, sf))


D7_SQL = f"""
select p.producto_id, p.tipo, segmento, tasa_anual::double tasa_anual, count(distinct client_id) clientes_activos,
  count(txn_id) total_operaciones, sum(monto)::double volumen_total,
  {avg6('sum(monto)', 'count(monto)')} ticket_promedio, min(fecha) primera_operacion, max(fecha) ultima_operacion
from prod p left join txn t on p.producto_id = t.producto_id group by 1, 2, 3, 4"""


@query("d7_metricas_productos", D7_SQL, ("prod", "txn"))
def d7(spark, sf):
    return marts.metricas_productos(fx.productos(spark, sf), fact(spark, sf, branch=False))


D8_SQL = f"""select date_trunc('month', fecha)::date mes, tipo, region, count(*) num_transacciones,
  count(distinct client_id) clientes_unicos, sum(monto)::double volumen_total,
  {avg6('sum(monto)', 'count(monto)')} ticket_promedio, count(*) filter (where estado = 'Aprobada')::bigint aprobadas,
  count(*) filter (where estado = 'Rechazada')::bigint rechazadas,
  {half_up("(count(*) filter (where estado = 'Aprobada') * 10000)", 'count(*)')}::double / 100 tasa_aprobacion
from txn t join suc s on t.sucursal_id = s.sucursal_id group by 1, 2, 3"""


@query("d8_resumen_mensual", D8_SQL, ("txn", "suc"))
def d8(spark, sf):
    return marts.resumen_mensual(fact(spark, sf), fx.sucursales(spark, sf))


D9_SQL = f"""with {DIM},
s as (select client_id, saldo_contable from sal qualify row_number() over (partition by client_id
      order by fecha_corte desc, saldo_id desc, saldo_contable desc) = 1),
t as (select client_id, count(*) n, sum(monto) v from txn where fecha >= date '{fx.AS_OF}' group by 1),
m as (select client_id, count(*) n from mov where fecha >= date '{fx.AS_OF}' group by 1)
select client_id, segmento, sucursal_comuna, coalesce(saldo_contable, 0)::double saldo_actual,
  coalesce(t.n, 0)::bigint transacciones_mes_actual, coalesce(t.v, 0)::double volumen_mes_actual,
  coalesce(m.n, 0)::bigint movimientos_mes_actual
from dim left join s using (client_id) left join t using (client_id) left join m using (client_id)"""


def position(spark, sf):
    return marts.posicion_cliente(
        dim(spark, sf), fx.saldos(spark, sf), fact(spark, sf, branch=False), fx.movimientos(spark, sf), fx.AS_OF
    )


@query("d9_posicion_cliente", D9_SQL, ("cli", "suc", "txn", "mov", "sal"))
def d9(spark, sf):
    return position(spark, sf)


@query("d10_tiempos_etl", f"""
select query_text, {half_up('total_elapsed_time * 100', '1000')}::double / 100 "seconds", rows_produced from (
  select * from query_log where start_time between timestamp '{fx.EVENTS_AS_OF}' - interval 24 hour
    and timestamp '{fx.EVENTS_AS_OF}')
where query_tag = 'BENCH_NO_CLUSTER'""", ("query_log",))
def d10(spark, sf):
    return monitoring.etl_timings(fx.query_log(spark, sf), "BENCH_NO_CLUSTER", fx.EVENTS_AS_OF, hours=24)


@query("d12_newest_months", D8_SQL + " order by mes desc, tipo, region limit 20", ("txn", "suc"))
def d12(spark, sf):
    return marts.newest_months(d8(spark, sf))


@query("d12_sample_positions", D9_SQL + " order by client_id limit 20", ("cli", "suc", "txn", "mov", "sal"))
def d12_positions(spark, sf):
    return marts.sample_positions(position(spark, sf))


def _case(column, cuts, least):
    return "case " + " ".join(f"when {column} > {b} then {p}" for b, p in cuts) + f" else {least} end"


def _points(column, cuts):
    return f"(case when {column} is null then 0 else {_case(column, cuts, 5)} end)::bigint"


SC = fx.CORTES_SCORE
E1_SQL = f"""with {DIM},
t as (select client_id, count(txn_id) total_txn, {IN} total_ingresos, {OUT} total_egresos,
  {avg6('sum(monto)', 'count(monto)')} monto_promedio, count(fecha) meses_activo, max(fecha) ultima_txn
  from txn where estado = 'Aprobada' group by 1),
s as (select client_id, saldo_contable, saldo_disponible from sal qualify row_number() over (partition by client_id
      order by fecha_corte desc, saldo_id desc, saldo_contable desc) = 1),
scored as (select client_id, segmento, sucursal_comuna, fecha_registro, total_txn,
  total_ingresos::double total_ingresos, total_egresos::double total_egresos, monto_promedio, meses_activo, ultima_txn,
  saldo_contable::double saldo_contable, saldo_disponible::double saldo_disponible,
  (date '{fx.AS_OF}' - fecha_registro)::bigint antiguedad_dias,
  {_points('total_txn', SC.actividad)} score_actividad, {_points('total_ingresos', SC.volumen)} score_volumen,
  {_points('saldo_contable', SC.saldo)} score_saldo,
  ({_case(f"(date '{fx.AS_OF}' - fecha_registro)", SC.antiguedad, 5)})::bigint score_antiguedad
  from dim left join t using (client_id) left join s using (client_id)),
total as (select *, (score_actividad + score_volumen + score_saldo + score_antiguedad)::bigint score_total from scored),
scoring as (select *, case when score_total >= 80 then 'A - Excelente' when score_total >= 60 then 'B - Bueno'
  when score_total >= 40 then 'C - Regular' else 'D - Básico' end categoria_score from total)"""


def scoring(spark, sf):
    return processes.scoring_clientes(
        dim(spark, sf), fact(spark, sf, branch=False), fx.saldos(spark, sf), fx.AS_OF, fx.CORTES_SCORE
    )


@query("e1_scoring_clientes", E1_SQL + " select * from scoring", ("cli", "suc", "txn", "sal"))
def e1(spark, sf):
    return scoring(spark, sf)


def bucketed(spark, sf, buckets=8):
    """Dimension, fact and balances as catalog tables in buckets of the client."""
    tag = uuid.uuid4().hex
    made = {"dim_clientes": dim(spark, sf), "fact_transacciones": fact(spark, sf, branch=False), "saldos": fx.saldos(spark, sf)}
    return {
        name: tables.save_bucketed(df, f"{name}_{tag}", f"{shared_dir(spark)}/ledgerlake-{name}-{tag}", "client_id", buckets)
        for name, df in made.items()
    }


@query("e1_scoring_bucketed", E1_SQL + " select * from scoring", ("cli", "suc", "txn", "sal"))
def e1_bucketed(spark, sf):
    t = bucketed(spark, sf)
    return processes.scoring_clientes(t["dim_clientes"], t["fact_transacciones"], t["saldos"], fx.AS_OF, fx.CORTES_SCORE)


@query("e1d_distribucion_scores", E1_SQL + """
select categoria_score, count(client_id) clientes from scoring group by 1""", ("cli", "suc", "txn", "sal"))
def e1d(spark, sf):
    return processes.distribucion_scores(scoring(spark, sf))


@query("e1m_meses_activo", """select client_id, count(date_trunc('month', fecha)) meses_activo,
  count(distinct date_trunc('month', fecha)) meses_distintos from txn where estado = 'Aprobada' group by 1""", ("txn",))
def e1m(spark, sf):
    ok = marts.approved(fact(spark, sf, branch=False))
    return ok.groupBy("client_id").agg(
        F.count("mes").alias("meses_activo"), F.count_distinct("mes").alias("meses_distintos")
    )


E2_SQL = """with c as (select client_id, producto_id, sum(monto) saldo_calculado, count(movimiento_id) num_movimientos,
  max(fecha) ultimo_movimiento from mov group by 1, 2),
r as (select client_id, producto_id, saldo_contable, fecha_corte from sal qualify row_number() over
  (partition by client_id, producto_id order by fecha_corte desc, saldo_id desc, saldo_contable desc) = 1),
rec as (select client_id, producto_id, saldo_calculado::double saldo_calculado, num_movimientos, ultimo_movimiento,
  saldo_contable::double saldo_contable, fecha_corte,
  (coalesce(saldo_calculado, 0) - coalesce(saldo_contable, 0))::double diferencia,
  abs(coalesce(saldo_calculado, 0) - coalesce(saldo_contable, 0))::double abs_diferencia,
  case when abs(coalesce(saldo_calculado, 0) - coalesce(saldo_contable, 0)) <= 1000 then 'OK'
       when saldo_calculado is null then 'SIN_MOVIMIENTOS' when saldo_contable is null then 'SIN_SALDO_REPORTADO'
       else 'DISCREPANCIA' end estado_reconciliacion
  from c full join r using (client_id, producto_id))"""


def reconciliation(spark, sf):
    return processes.reconciliacion_saldos(fx.movimientos(spark, sf), fx.saldos(spark, sf))


@query("e2_reconciliacion_saldos", E2_SQL + " select * from rec", ("mov", "sal"))
def e2(spark, sf):
    return reconciliation(spark, sf)


@query("e2x_excepciones_reconciliacion", E2_SQL + " select * from rec where estado_reconciliacion <> 'OK'",
       ("mov", "sal"))
def e2x(spark, sf):
    return processes.excepciones_reconciliacion(reconciliation(spark, sf))


@query("e2s_resumen_reconciliacion", E2_SQL + """
select estado_reconciliacion, count(*) registros from rec group by 1""", ("mov", "sal"))
def e2s(spark, sf):
    return processes.resumen_reconciliacion(reconciliation(spark, sf))


E3_SQL = f"""with m as (select client_id, date_trunc('month', fecha)::date mes, count(txn_id) num_txn, {IN} ingresos,
  {OUT} egresos, sum(monto) neto, {avg6('sum(monto)', 'count(monto)')} ticket_promedio
  from txn where estado = 'Aprobada' group by 1, 2),
w as (select *, sum(ingresos) over c ingresos_acum, sum(egresos) over c egresos_acum, sum(neto) over c neto_acum,
  sum(neto) over (partition by client_id order by mes rows between 2 preceding and current row) suma3,
  count(neto) over (partition by client_id order by mes rows between 2 preceding and current row) n3,
  lag(neto) over c prev, dense_rank() over (partition by mes order by neto desc) ranking_mes
  from m window c as (partition by client_id order by mes)),
agg as (select client_id, mes, num_txn, ingresos::double ingresos, egresos::double egresos, neto::double neto,
  ticket_promedio, ingresos_acum::double ingresos_acum, egresos_acum::double egresos_acum,
  neto_acum::double neto_acum, {half_up(cents('suma3'), 'n3')}::double / 100 promedio_movil_3m,
  prev::double mes_anterior_neto,
  {half_up(f"({cents('neto - prev')} * 10000)", cents('prev'))}::double / 100 variacion_mom, ranking_mes from w)"""


def monthly(spark, sf):
    return processes.agregacion_mensual_clientes(fact(spark, sf, branch=False))


@query("e3_agregacion_mensual_clientes", E3_SQL + " select * from agg", ("txn",))
def e3(spark, sf):
    return monthly(spark, sf)


@query("e3_ranking_en_bandas", E3_SQL + " select mes, client_id, ranking_mes from agg", ("txn",))
def e3_banded(spark, sf):
    """The ranks alone."""
    return processes.agregacion_mensual_clientes(fact(spark, sf, branch=False)).select("mes", "client_id", "ranking_mes")


@query("d5_mediana_en_bandas", """select client_id, median((monto * 100)::bigint::double) / 100 monto_mediana
  from txn where estado = 'Aprobada' group by 1""", ("txn",))
def d5_banded(spark, sf):
    """The median alone."""
    ok = marts.approved(fact(spark, sf, branch=False))
    return exact_median(ok, ["client_id"], "monto", "monto_mediana")


@query("d5_mediana_cuatro_decimales", """select l_partkey producto_id,
  median((l_extendedprice::decimal(15,2) * l_discount::decimal(4,2) * 10000)::bigint::double) / 10000 mediana
  from lineitem group by 1""")
def d5_four_decimals(spark, sf):
    """Amounts with four decimals keep them: the median has a fifth."""
    rows = fx.table(spark, sf, "lineitem")
    discount = F.col("l_extendedprice").cast("decimal(15,2)") * F.col("l_discount").cast("decimal(4,2)")
    return exact_median(
        rows.select(F.col("l_partkey").alias("producto_id"), discount.cast("decimal(18,4)").alias("descuento")),
        ["producto_id"], "descuento", "mediana",
    )


@query("e3s_serie_cliente", E3_SQL + " select * from agg where client_id = 1 order by mes limit 12", ("txn",))
def e3s(spark, sf):
    return processes.serie_cliente(monthly(spark, sf), 1)
