"""Queries over ranges, physical order and scan reports."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ledgerlake.operators import clustered as clustered_files, layout
from ledgerlake.plans import fixtures as fx
from ledgerlake.plans.queries_marts import fact
from ledgerlake.plans.registry import avg6, half_up, query
from ledgerlake.session import shared_dir

Q1, Q2, Q5, CLIENT = ("1996-01-01", "1996-03-31"), ("1996-06-01", "1996-07-01"), ("1996-06-01", "1996-06-30"), 123


def scratch(spark, name):
    return f"{shared_dir(spark)}/ledgerlake-{name}-{uuid.uuid4().hex}"


F1_SQL = f"""select date_trunc('month', fecha)::date mes, tipo, count(*) num_txn,
  sum(monto)::double volumen from txn where fecha between '{Q1[0]}' and '{Q1[1]}' group by 1, 2"""


@query("f1_q1_rango_fechas", F1_SQL, ("txn",))
def f1(spark, sf):
    return layout.q1_rango_fechas(fact(spark, sf, branch=False), *Q1)


F2_SQL = f"""select t.sucursal_id, comuna, count(*) num_txn, sum(monto)::double volumen,
  count(distinct client_id) clientes_unicos from txn t join suc s on t.sucursal_id = s.sucursal_id
  where fecha >= '{Q2[0]}' and fecha < '{Q2[1]}' and t.sucursal_id in (1, 5, 10, 15, 20) group by 1, 2"""


@query("f2_q2_fecha_sucursal", F2_SQL,
       ("txn", "suc"))
def f2(spark, sf):
    return layout.q2_fecha_sucursal(fact(spark, sf), fx.sucursales(spark, sf), *Q2)


F3_SQL = f"""select client_id, tipo, count(*) num_txn, sum(monto)::double volumen,
  min(fecha) primera_txn, max(fecha) ultima_txn from txn where client_id = {CLIENT} group by 1, 2"""


@query("f3_q3_point_lookup", F3_SQL, ("txn",))
def f3(spark, sf):
    return layout.q3_point_lookup(fact(spark, sf, branch=False), CLIENT)


@query("f4_q4_agregacion_mensual", f"""select date_trunc('month', fecha)::date mes, count(*) total_txn,
  count(distinct client_id) clientes_activos, sum(monto)::double volumen_total,
  {avg6('sum(monto)', 'count(monto)')} ticket_promedio from txn where estado = 'Aprobada' group by 1""", ("txn",))
def f4(spark, sf):
    return layout.q4_agregacion_mensual(fact(spark, sf, branch=False))


F5_SQL = """select t.client_id, count(distinct txn_id) num_txn, count(distinct movimiento_id) num_mov,
  sum(t.monto)::double volumen_txn, sum(m.monto)::double volumen_mov
  from txn t join mov m on t.client_id = m.client_id and date_trunc('month', t.fecha) = date_trunc('month', m.fecha)
  where t.fecha between '{0}' and '{1}' group by 1 order by sum(t.monto) desc, t.client_id limit 100"""


@query("f5_q5_join_pesado", F5_SQL.format(*Q5), ("txn", "mov"))
def f5(spark, sf):
    return layout.q5_join_pesado(fact(spark, sf, branch=False), fx.movimientos(spark, sf), *Q5)


@query("f5_q5_join_pesado_anual", F5_SQL.format("1996-01-01", "1996-12-31"), ("txn", "mov"))
def f5_year(spark, sf):
    return layout.q5_join_pesado(
        fact(spark, sf, branch=False), fx.movimientos(spark, sf), "1996-01-01", "1996-12-31"
    )


def clustered(spark, sf, n_files=8):
    path = scratch(spark, "fact")
    return path, layout.cluster_table(fx.transacciones(spark, sf), path, ["fecha", "sucursal_id"], n_files)


@query("f6_cluster_table", "select *, fecha::date fecha_date from (select * replace (monto::double as monto) from txn)",
       ("txn",))
def f6(spark, sf):
    return clustered(spark, sf)[1]


@query("f6_cluster_movimientos", """select * replace (monto::double as monto, saldo_posterior::double as saldo_posterior)
  from mov""", ("mov",))
def f6_moves(spark, sf):
    return layout.cluster_table(fx.movimientos(spark, sf), scratch(spark, "mov"), ["fecha", "client_id"], 8)


@query("f7_clustering_information")
def f7(spark, sf):
    path, _ = clustered(spark, sf)
    return layout.clustering_information(spark, path, ["fecha_date", "sucursal_id"])


@query("f7_file_statistics")
def f7_files(spark, sf):
    path, _ = clustered(spark, sf)
    return layout.file_statistics(spark, path, ["fecha_date", "sucursal_id"])


@query("f7_file_totals", """select count(*) filas, min(fecha)::date min_fecha_date, max(fecha)::date max_fecha_date,
  min(sucursal_id) min_sucursal_id, max(sucursal_id) max_sucursal_id from txn""", ("txn",))
def f7_totals(spark, sf):
    """The bounds of all files taken together are those of the table."""
    path, _ = clustered(spark, sf)
    columns = ["fecha_date", "sucursal_id"]
    totals = [F.sum("filas").alias("filas")] + [
        f(f"{n}_{c}").alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))
    ]
    return layout.file_statistics(spark, path, columns).agg(*totals)


@query("f10_scan_report")
def f10(spark, sf):
    path, _ = clustered(spark, sf)
    stats = layout.file_statistics(spark, path, ["fecha_date"])
    return layout.scan_report(stats, "fecha_date", F.lit(Q1[0]).cast("date"), F.lit(Q1[1]).cast("date"))


PAIRS = """with r as (select *, row_number() over (partition by query_tag order by start_time, event_id) q
  from query_log where query_type = 'view' and bytes_scanned > 0),
nc as (select * from r where query_tag = 'BENCH_NO_CLUSTER'), wc as (select * from r where query_tag = 'BENCH_WITH_CLUSTER')
"""


@query("f8_compare_scans", PAIRS + f"""select nc.q query,
  {half_up('(nc.bytes_scanned * 10)', '1048576')}::double / 10 mb_sin_cluster,
  {half_up('(wc.bytes_scanned * 10)', '1048576')}::double / 10 mb_con_cluster,
  nc.partitions_scanned || '/' || nc.partitions_total partitions_sin,
  wc.partitions_scanned || '/' || wc.partitions_total partitions_con,
  {half_up('((nc.bytes_scanned - wc.bytes_scanned) * 1000)', 'nc.bytes_scanned')}::double / 10 reduccion_pct,
  {half_up('(nc.total_elapsed_time * 100)', '1000')}::double / 100 seg_sin_cluster,
  {half_up('(wc.total_elapsed_time * 100)', '1000')}::double / 100 seg_con_cluster
  from nc join wc on nc.q = wc.q""", ("query_log",))
def f8(spark, sf):
    return layout.compare_scans(fx.query_log(spark, sf), query_type="view")


@query("f9_extrapolate", PAIRS + """select 260::bigint tb_mes_actual,
  round(260 * (1 - avg(1 - wc.bytes_scanned::double / nc.bytes_scanned)), 1) tb_mes_estimado,
  round(avg(1 - wc.bytes_scanned::double / nc.bytes_scanned) * 100, 1) reduccion_promedio_pct
  from nc join wc on nc.q = wc.q""", ("query_log",))
def f9(spark, sf):
    return layout.extrapolate(fx.query_log(spark, sf), query_type="view")


def z_ordered(spark, sf):
    """The fact in z-order over date, branch and client, with Bloom filters on the client."""
    path = scratch(spark, "fact")
    rows = fact(spark, sf).withColumn("fecha_date", F.col("fecha").cast("date"))
    return clustered_files.write_clustered(rows, path, ["fecha_date", "sucursal_id", "client_id"], 16, "z", ["client_id"])


@query("f1_z_order", F1_SQL, ("txn",))
def f1_z(spark, sf):
    return layout.q1_rango_fechas(z_ordered(spark, sf), *Q1)


@query("f2_z_order", F2_SQL, ("txn", "suc"))
def f2_z(spark, sf):
    return layout.q2_fecha_sucursal(z_ordered(spark, sf), fx.sucursales(spark, sf), *Q2)


@query("f3_z_order", F3_SQL, ("txn",))
def f3_z(spark, sf):
    return layout.q3_point_lookup(z_ordered(spark, sf), CLIENT)


def sorted_again(spark, sf):
    """A clustered table, a load appended over its range, and the table sorted again from itself."""
    path, keys = scratch(spark, "fact"), ["fecha_date", "sucursal_id"]
    rows = fx.transacciones(spark, sf).withColumn("fecha_date", F.col("fecha").cast("date"))
    clustered_files.write_clustered(rows.filter("txn_id % 10 <> 0"), path, keys, 8)
    late = "txn_id % 10 = 0 and fecha_date >= date '1997-01-01'"
    clustered_files.append_load(rows.filter(f"txn_id % 10 = 0 and not ({late})"), path, keys, 4)
    clustered_files.recluster(spark, path, keys, target_bytes=1 << 20)
    clustered_files.append_load(rows.filter(late), path, keys)
    clustered_files.recluster(spark, path, keys, target_bytes=1 << 20)
    return path, rows.schema


@query("f6_sorted_again", "select *, fecha::date fecha_date from (select * replace (monto::double as monto) from txn)", ("txn",))
def f6_again(spark, sf):
    path, schema = sorted_again(spark, sf)
    return clustered_files.read_clustered(spark, path, schema)


@query("f7_listed_totals", """select count(*) filas, min(fecha)::date min_fecha_date, max(fecha)::date max_fecha_date,
  min(sucursal_id) min_sucursal_id, max(sucursal_id) max_sucursal_id, 0::bigint solapados from txn""", ("txn",))
def f7_listed(spark, sf):
    """Bounds from the list of files, no data read, and the number of files whose ranges overlap after the sort."""
    path, _ = sorted_again(spark, sf)
    listed = clustered_files.clustering_report(spark, path)
    bounds = [f(f"{n}_{c}").alias(f"{n}_{c}") for c in ("fecha_date", "sucursal_id") for n, f in (("min", F.min), ("max", F.max))]
    mixed = clustered_files.overlapping(listed, "fecha_date").withColumn("_mixed", F.lit(1))
    return listed.join(mixed, "archivo", "left").agg(F.sum("filas").alias("filas"), *bounds, F.count("_mixed").alias("solapados"))


# Files of known bounds: a file for each month and branch of the fact.
KNOWN = """known as (select strftime(date_trunc('month', fecha), '%Y-%m') || '-' || coalesce(sucursal_id, 0) archivo, count(*) filas,
  count(*) * 100 bytes, min(fecha)::date min_fecha_date, max(fecha)::date max_fecha_date, min(sucursal_id) min_sucursal_id,
  max(sucursal_id) max_sucursal_id from txn group by 1)"""


def known_files(spark, sf):
    rows = fact(spark, sf).withColumn("fecha_date", F.col("fecha").cast("date"))
    name = F.concat_ws("-", F.date_format("fecha", "yyyy-MM"), F.coalesce("sucursal_id", F.lit(0)))
    bounds = [f(c).alias(f"{n}_{c}") for c in ("fecha_date", "sucursal_id") for n, f in (("min", F.min), ("max", F.max))]
    return rows.groupBy(name.alias("archivo")).agg(F.count("*").alias("filas"), (F.count("*") * 100).alias("bytes"), *bounds)


def _information(column):
    return f"""select '{column}' columna, count(*) archivos, avg(d - 1) solapes_promedio, avg(d) profundidad_promedio,
  max(d) profundidad_maxima, count(*) filter (where d = 1) archivos_sin_solape from (
  select a.archivo, count(*) d from known a join known b on b.min_{column} <= a.max_{column} and b.max_{column} >= a.min_{column}
  group by 1)"""


@query("f7_clustering_of_known_files", f"with {KNOWN} {_information('fecha_date')} union all {_information('sucursal_id')}", ("txn",))
def f7_known(spark, sf):
    return layout.clustering_of(known_files(spark, sf), ["fecha_date", "sucursal_id"])


@query("f10_scan_of_known_files", f"""with {KNOWN}, t as (select *, max_fecha_date >= date '{Q1[0]}' and min_fecha_date <= date '{Q1[1]}' leido
  from known) select count(*) archivos_total, count(*) filter (where leido) archivos_leidos, sum(filas)::bigint filas_total,
  coalesce(sum(filas) filter (where leido), 0)::bigint filas_leidas, sum(bytes)::bigint bytes_total,
  coalesce(sum(bytes) filter (where leido), 0)::bigint bytes_leidos,
  round((1 - count(*) filter (where leido)::double / count(*)) * 100, 1) reduccion_pct from t""", ("txn",))
def f10_known(spark, sf):
    return layout.scan_report(known_files(spark, sf), "fecha_date", F.lit(Q1[0]).cast("date"), F.lit(Q1[1]).cast("date"))
