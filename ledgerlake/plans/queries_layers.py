"""Queries over the Silver and Gold operators."""

from __future__ import annotations

from ledgerlake.operators import gold, silver
from ledgerlake.plans import fixtures as fx
from ledgerlake.plans.registry import avg6, query

LOADED = "2001-07-01 00:00:00"


def bronze_txn(spark, sf):
    return fx.with_load(fx.transacciones(spark, sf), LOADED, "initial_load")


def bronze_mov(spark, sf):
    return fx.with_load(fx.movimientos(spark, sf), LOADED, "initial_load")


def silver_txn(spark, sf):
    return silver.silver_fact_transacciones(bronze_txn(spark, sf), fx.AS_OF)


def silver_mov(spark, sf):
    return silver.silver_fact_movimientos(bronze_mov(spark, sf), fx.MONTO_ANOMALO)


def silver_cli(spark, sf):
    return silver.silver_dim_clientes(fx.bronze_clientes(spark, sf), fx.sucursales(spark, sf), fx.AS_OF)


def silver_sal(spark, sf):
    return silver.silver_saldos_actuales(fx.saldos(spark, sf), fx.RANGOS_SALDO)


# The oracle twins of the Silver tables, as common table expressions.
S_CLI = f"""s_cli as (
  select client_id, rut, upper(nombre[1]) || lower(nombre[2:]) nombre,
    upper(apellido[1]) || lower(apellido[2:]) apellido,
    upper(nombre[1]) || lower(nombre[2:]) || ' ' || upper(apellido[1]) || lower(apellido[2:]) nombre_completo,
    lower(trim(email)) email, telefono, direccion, fecha_registro, segmento, sucursal_id, comuna sucursal_comuna,
    region sucursal_region, (date '{fx.AS_OF}' - fecha_registro)::bigint dias_antiguedad,
    case when 2001 - year(fecha_registro) >= 5 then 'Veterano' when 2001 - year(fecha_registro) >= 2 then 'Establecido'
         when 2001 - year(fecha_registro) >= 1 then 'Regular' else 'Nuevo' end categoria_antiguedad,
    false pseudonymized, null::timestamp pseudonymized_at, _loaded_at
  from (select * replace (trim(nombre) as nombre, trim(apellido) as apellido) from bcli
        qualify row_number() over (partition by client_id order by _loaded_at desc) = 1)
  left join suc using (sucursal_id))"""
S_TXN = f"""s_txn as (
  select txn_id, client_id, producto_id, sucursal_id, fecha, fecha::date fecha_date,
    date_trunc('month', fecha)::date mes, date_trunc('quarter', fecha)::date trimestre, year(fecha)::bigint anio,
    dayofweek(fecha)::bigint dia_semana, dayofweek(fecha) in (0, 6) es_fin_semana, tipo, monto,
    abs(monto)::decimal(15,2) monto_absoluto, moneda, estado,
    case when monto is null then 'MONTO_NULL' when client_id is null then 'CLIENT_NULL'
         when fecha > timestamp '{fx.AS_OF}' then 'FECHA_FUTURA' else 'OK' end _quality_flag,
    referencia, timestamp '{LOADED}' _loaded_at
  from txn where estado is not null)"""
S_MOV = f"""s_mov as (
  select movimiento_id, client_id, producto_id, sucursal_id, fecha, date_trunc('month', fecha)::date mes,
    tipo_movimiento, monto, saldo_posterior,
    case when saldo_posterior < 0 and tipo_movimiento not in ('Cargo', 'Comisión') then 'SALDO_NEGATIVO_ANOMALO'
         when monto > {fx.MONTO_ANOMALO} then 'MONTO_ANOMALO' else 'OK' end _quality_flag,
    referencia, timestamp '{LOADED}' _loaded_at
  from mov)"""
S_SAL = """s_sal as (
  select client_id, producto_id, fecha_corte fecha_ultimo_saldo, saldo_contable, saldo_disponible,
    saldo_promedio_mes, estado_cuenta, saldo_contable - saldo_disponible saldo_retenido,
    case when saldo_contable > 50000 then 'Alto' when saldo_contable > 5000 then 'Medio'
         when saldo_contable > 0 then 'Bajo' else 'Sin saldo' end rango_saldo
  from sal qualify row_number() over (partition by client_id, producto_id
    order by fecha_corte desc, saldo_id desc, saldo_contable desc) = 1)"""

_MONEY = ("monto", "monto_absoluto", "saldo_posterior", "saldo_contable", "saldo_disponible", "saldo_promedio_mes",
          "saldo_retenido")


def doubles(name: str, columns: tuple[str, ...]) -> str:
    """Select a view whole, with its amounts as doubles."""
    return f"select * replace ({', '.join(f'{c}::double as {c}' for c in columns)}) from {name}"


@query("b1_silver_dim_clientes", f"with {S_CLI} select * from s_cli", ("bcli", "suc"))
def b1(spark, sf):
    return silver_cli(spark, sf)


@query("b2_silver_fact_transacciones", f"with {S_TXN} {doubles('s_txn', _MONEY[:2])}", ("txn",))
def b2(spark, sf):
    return silver_txn(spark, sf)


@query("b3_silver_fact_movimientos", f"with {S_MOV} {doubles('s_mov', ('monto', 'saldo_posterior'))}", ("mov",))
def b3(spark, sf):
    return silver_mov(spark, sf)


@query("b4_silver_saldos_actuales", f"with {S_SAL} {doubles('s_sal', _MONEY[3:])}", ("sal",))
def b4(spark, sf):
    return silver_sal(spark, sf)


C1_SQL = f"""with {S_CLI}, {S_TXN}, {S_SAL},
t as (select client_id, count(*) n, count(*) filter (where estado = 'Aprobada') ap,
        sum(case when monto > 0 then monto else 0 end) ing, sum(case when monto < 0 then -monto else 0 end) egr,
        sum(monto) neto, {avg6('sum(monto)', 'count(*)')} ticket, count(distinct producto_id) prods,
        min(fecha) primera, max(fecha) ultima from s_txn where _quality_flag = 'OK' group by 1),
s as (select client_id, sum(saldo_contable) saldo, count(distinct producto_id) n from s_sal
      where estado_cuenta = 'Activa' group by 1),
r as (select client_id, count(*) n, sum(monto) v from s_txn
      where _quality_flag = 'OK' and fecha_date >= date '{fx.AS_OF}' - 90 group by 1)
select c.client_id, nombre_completo, segmento, categoria_antiguedad, sucursal_comuna, sucursal_region,
  dias_antiguedad, coalesce(t.n, 0)::bigint total_transacciones, coalesce(ap, 0)::bigint transacciones_aprobadas,
  coalesce(ing, 0)::double total_ingresos, coalesce(egr, 0)::double total_egresos,
  coalesce(neto, 0)::double balance_neto, coalesce(ticket, 0)::double ticket_promedio,
  coalesce(prods, 0)::bigint productos_utilizados, primera primera_txn, ultima ultima_txn,
  coalesce(saldo, 0)::double saldo_total, coalesce(s.n, 0)::bigint productos_activos,
  coalesce(r.n, 0)::bigint transacciones_90d, coalesce(r.v, 0)::double volumen_90d,
  case when coalesce(t.n, 0) > 45 and coalesce(saldo, 0) > 300000 then 'A - Premium'
       when coalesce(t.n, 0) > 42 or coalesce(saldo, 0) > 320000 then 'B - Alto'
       when coalesce(t.n, 0) > 30 then 'C - Medio' else 'D - Bajo' end categoria_valor
from s_cli c left join t using (client_id) left join s using (client_id) left join r using (client_id)"""


@query("c1_gold_perfil_360", C1_SQL, ("bcli", "suc", "txn", "sal"))
def c1(spark, sf):
    txn = silver.silver_fact_transacciones(
        fx.with_load(fx.transacciones(spark, sf, branch=False), LOADED, "initial_load"), fx.AS_OF
    )
    return gold.gold_perfil_360(silver_cli(spark, sf), txn, silver_sal(spark, sf), fx.AS_OF, fx.CORTES_VALOR)


C2_SQL = f"""with {S_TXN}
select mes, t.sucursal_id, comuna, region, count(*) total_operaciones, count(distinct client_id) clientes_activos,
  sum(case when monto > 0 then monto else 0 end)::double captaciones,
  sum(case when monto < 0 then -monto else 0 end)::double colocaciones, sum(monto)::double neto,
  {avg6('sum(monto_absoluto)', 'count(*)')} ticket_promedio,
  count(*) filter (where estado = 'Aprobada')::double / count(*) tasa_aprobacion, count(distinct producto_id) productos_operados,
  count(*) filter (where es_fin_semana)::double / count(*) pct_fin_semana
from s_txn t join suc s on t.sucursal_id = s.sucursal_id where _quality_flag = 'OK'
group by mes, t.sucursal_id, comuna, region"""


@query("c2_resumen_mensual_sucursal", C2_SQL, ("txn", "suc"))
def c2(spark, sf):
    return gold.gold_resumen_mensual_sucursal(silver_txn(spark, sf), fx.sucursales(spark, sf))


@query("c3_quality_alerts", f"""with {S_TXN}, {S_MOV}
select 'FACT_TRANSACCIONES' tabla, _quality_flag, count(*) registros from s_txn where _quality_flag <> 'OK' group by 2
union all select 'FACT_MOVIMIENTOS', _quality_flag, count(*) from s_mov where _quality_flag <> 'OK' group by 2""",
       ("txn", "mov"))
def c3(spark, sf):
    txn = silver.silver_fact_transacciones(
        fx.with_load(fx.transacciones(spark, sf, branch=False), LOADED, "initial_load"), fx.AS_OF
    )
    return gold.gold_quality_alerts(txn, silver_mov(spark, sf))


@query("c4_layer_counts", f"""with {S_TXN}, {S_SAL}
select 'BRONZE.TRANSACCIONES' capa, count(*) filas from txn union all select 'SILVER.FACT_TRANSACCIONES', count(*) from s_txn
union all select 'BRONZE.SALDOS', count(*) from sal union all select 'SILVER.DIM_SALDOS_ACTUALES', count(*) from s_sal
union all select 'GOLD.RESUMEN_MENSUAL_SUCURSAL', count(*) from (select distinct mes, sucursal_id from s_txn where _quality_flag = 'OK')
""", ("txn", "sal"))
def c4(spark, sf):
    txn = silver_txn(spark, sf)
    return gold.layer_counts({
        "BRONZE.TRANSACCIONES": bronze_txn(spark, sf),
        "SILVER.FACT_TRANSACCIONES": txn,
        "BRONZE.SALDOS": fx.saldos(spark, sf),
        "SILVER.DIM_SALDOS_ACTUALES": silver_sal(spark, sf),
        "GOLD.RESUMEN_MENSUAL_SUCURSAL": gold.gold_resumen_mensual_sucursal(txn, fx.sucursales(spark, sf)),
    })


@query("c5_refresh_report", """
select name, schema_name, target_lag_sec / 60 target_lag_min,
  (floor((actual_lag_sec * 100)::bigint * 10 / 6000 + 0.5) / 10)::double actual_lag_min,
  refresh_trigger, refresh_status, last_completed_refresh_time
from refresh_log order by last_completed_refresh_time desc, name, event_id limit 20""", ("refresh_log",))
def c5(spark, sf):
    return gold.refresh_report(fx.refresh_log(spark, sf))
