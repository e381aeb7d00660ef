"""Queries that run streaming jobs and whole refreshes over the fixture tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake.operators import privacy, silver
from ledgerlake.plans import fixtures as fx, jobs
from ledgerlake.plans.queries_governance import BAD_RUT, REQ, SALT
from ledgerlake.plans.queries_layers import _MONEY, C1_SQL, C2_SQL, S_CLI, S_MOV, S_SAL, S_TXN, doubles
from ledgerlake.plans.queries_layout import scratch
from ledgerlake.plans.queries_sources import (
    BAD, EVENT_SCHEMA, GOOD, MOV_LOADS, first_load, json_rows, second_load,
)
from ledgerlake.plans.registry import query
from ledgerlake.plans.queries_marts import D5_SQL, D6_SQL, D7_SQL, dim
from ledgerlake.sources import landing, ledger
from ledgerlake.sources.tables import read_version, save_table, write_version
from ledgerlake.streaming import jobs as streams



@query("a10_read_changes", f"select *, (fecha >= date '1998-01-01')::bigint corrida from ({MOV_LOADS} from mov)",
       ("mov",))
def a10(spark, sf):
    """Two loads, a run of the consumer after each: the second run delivers the second load only."""
    path, out, checkpoint = (scratch(spark, n) for n in ("bronze", "out", "checkpoint"))

    def deliver(batch, batch_id):
        batch.withColumn("corrida", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(f"{out}/{batch_id}")

    for load in (first_load, second_load):
        load(spark, sf, path)
        changes = streams.read_changes(spark, path, landing.bronze_schema("movimientos"))
        streams.run(changes.writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint)
                    .trigger(availableNow=True).start())
    return spark.read.parquet(f"{out}/*")


@query("a10b_stream_has_data", "select count(*) > 0 has_data from mov where fecha >= date '1998-01-01'", ("mov",))
def a10b(spark, sf):
    path = scratch(spark, "bronze")
    first_load(spark, sf, path)
    consumed = spark.read.schema(landing.bronze_schema("movimientos")).parquet(path).select("_source_file").checkpoint()
    second_load(spark, sf, path)
    return streams.stream_has_data(spark.read.schema(landing.bronze_schema("movimientos")).parquet(path), consumed)


def _loads(spark, sf):
    """The client loads one after the other."""
    rows = fx.bronze_clientes(spark, sf)
    return [rows.filter(F.col("_source_file") == n) for n in ("initial_load", "daily_load_2001-07-15")]


def _by_load():
    return [F.col("_loaded_at").desc_nulls_last(), F.col("_source_file").asc_nulls_last()]


@query("a10b_same_name", "select count(*) > 0 has_data from mov where fecha >= date '1998-01-01'", ("mov",))
def a10b_same_name(spark, sf):
    """Two loads under one name, the first of them read: the second is still found."""
    path = scratch(spark, "bronze")
    schema = landing.bronze_schema("movimientos")

    def load(part):
        rows = fx.with_load(fx.movimientos(spark, sf).filter(part), "2001-08-01 00:00:00", "daily_load_2001-08-01")
        rows.select(*schema.fieldNames()).write.mode("append").parquet(path)

    load("fecha < date '1998-01-01'")
    consumed = spark.read.schema(schema).parquet(path).select("_source_file").checkpoint()
    load("fecha >= date '1998-01-01'")
    return streams.stream_has_data(spark.read.schema(schema).parquet(path), consumed)


def _ledgered_loads(spark, sf, runs):
    """Two noted loads under one name and ``runs`` runs of the counting consumer: the first between the loads."""
    path, out, landed, taken, checkpoint = (scratch(spark, n) for n in ("bronze", "out", "landed", "taken", "checkpoint"))
    rows = fx.movimientos(spark, sf)
    for k, part in enumerate(("fecha < date '1998-01-01'", "fecha >= date '1998-01-01'")):
        ledger.land(rows.filter(part), path, "movimientos", landed, "daily_load", fx.AS_OF)
        if k < runs:
            changes = streams.read_changes(spark, path, landing.bronze_schema("movimientos"))
            streams.run(ledger.consume_counted(changes, checkpoint, out, taken, streams.AVAILABLE_NOW))
    return landed, taken


@query("a10b_ledger", "select count(*) > 0 has_data from mov where fecha >= date '1998-01-01'", ("mov",))
def a10b_ledger(spark, sf):
    """From the notes of the loads and of the consumer; the second load is unread."""
    return ledger.has_data(spark, *_ledgered_loads(spark, sf, 1))


@query("a10b_ledger_pending", """select 'daily_load' _source_file, count(*) llegadas,
  count(*) filter (where fecha < date '1998-01-01') leidas, 0::bigint sin_terminar from mov
  having count(*) filter (where fecha >= date '1998-01-01') > 0""", ("mov",))
def a10b_pending(spark, sf):
    return ledger.pending_loads(spark, *_ledgered_loads(spark, sf, 1))


@query("s3_incremental_dedup", """select * from bcli
  qualify row_number() over (partition by client_id order by _loaded_at desc) = 1""", ("cli", "bcli"))
def s3(spark, sf):
    path, state, checkpoint = (scratch(spark, n) for n in ("bronze", "silver", "checkpoint"))
    for load in _loads(spark, sf):
        load.write.mode("append").parquet(path)
        changes = streams.read_changes(spark, path, landing.bronze_schema("clientes"))
        streams.run(streams.dedup_stream(changes, checkpoint, state, ["client_id"], _by_load))
    return streams.read_newest(spark, state, ["client_id"], _by_load)


@query("s4_quality_gate", f"""with {S_MOV} select _quality_flag, count(*) registros from s_mov
  where _quality_flag <> 'OK' group by 1""", ("mov",))
def s4(spark, sf):
    path, alerts, checkpoint = (scratch(spark, n) for n in ("bronze", "alerts", "checkpoint"))
    for load in (first_load, second_load):
        load(spark, sf, path)
        flagged = silver.silver_fact_movimientos(streams.read_changes(spark, path, landing.bronze_schema("movimientos")), fx.MONTO_ANOMALO)
        streams.run(streams.alerts_stream(flagged, checkpoint, alerts))
    return streams.read_alerts(spark, alerts)


@query("s4_silver_append", f"""with {S_MOV} select * replace (monto::double as monto,
  saldo_posterior::double as saldo_posterior, case when fecha < date '1998-01-01' then timestamp '2001-07-01'
  else timestamp '2001-07-02' end as _loaded_at) from s_mov""", ("mov",))
def s4_append(spark, sf):
    path, out, checkpoint = (scratch(spark, n) for n in ("bronze", "silver", "checkpoint"))
    for load in (first_load, second_load):
        load(spark, sf, path)
        flagged = silver.silver_fact_movimientos(streams.read_changes(spark, path, landing.bronze_schema("movimientos")), fx.MONTO_ANOMALO)
        streams.run(streams.consume(flagged, checkpoint, out))
    return spark.read.parquet(out)


@query("i7_metrics_on_change", f"""select 'CLIENTES' tabla, 'NULL_COUNT' metrica, 'email' columna,
    count(*) filter (where email is null)::bigint valor, timestamp '{fx.AS_OF}' medido_en from bcli
  union all select 'CLIENTES', 'DUPLICATE_COUNT', 'client_id', count(client_id) - count(distinct client_id),
    timestamp '{fx.AS_OF}' from bcli
  union all select 'CLIENTES', 'INVALID_RUT_COUNT', 'rut', count(*), timestamp '{fx.AS_OF}' from bcli where {BAD_RUT}""",
       ("cli", "bcli"))
def i7(spark, sf):
    return read_version(spark, _measured_loads(spark, sf))


def _measured_loads(spark, sf):
    """Results folder of the metrics after each of the two client loads."""
    path, state, results, checkpoint = (scratch(spark, n) for n in ("bronze", "state", "results", "checkpoint"))
    specs = [("NULL_COUNT", "email"), ("DUPLICATE_COUNT", "client_id"), ("INVALID_RUT_COUNT", "rut")]
    for load in _loads(spark, sf):
        load.write.mode("append").parquet(path)
        changes = streams.read_changes(spark, path, landing.bronze_schema("clientes"))
        streams.run(streams.metrics_on_change(changes, checkpoint, state, results, "CLIENTES", specs, fx.AS_OF))
    return results


@query("i7_metrics_history", f"""with m as (select 1::bigint medicion, * from bcli where _source_file = 'initial_load'
  union all select 2, * from bcli)
  select medicion, 'CLIENTES' tabla, 'NULL_COUNT' metrica, 'email' columna,
    count(*) filter (where email is null)::bigint valor, timestamp '{fx.AS_OF}' medido_en from m group by 1
  union all select medicion, 'CLIENTES', 'DUPLICATE_COUNT', 'client_id', count(client_id) - count(distinct client_id),
    timestamp '{fx.AS_OF}' from m group by 1
  union all select medicion, 'CLIENTES', 'INVALID_RUT_COUNT', 'rut', count(*) filter (where {BAD_RUT}), timestamp '{fx.AS_OF}'
  from m group by 1""", ("cli", "bcli"))
def i7_history(spark, sf):
    """The measurements after the first and after the second load, read as one table."""
    return streams.metrics_history(spark, _measured_loads(spark, sf))


@query("s6_ingest_json_stream", f"""with {GOOD}, {BAD[len(BAD.split(', bad as')[0]) + 2:]}
  select event_id, value, k, extra, null::varchar error from good
  union all select event_id, value, k, null, error from bad""")
def s6(spark, sf):
    source, good, dead, checkpoint = (scratch(spark, n) for n in ("json", "good", "dead", "checkpoint"))
    json_rows(spark, sf).write.parquet(source)
    schema = "event_id long, value string"
    raw = spark.readStream.schema(schema).parquet(source)
    streams.run(streams.ingest_json_stream(raw, "value", EVENT_SCHEMA, good, dead, checkpoint))
    return spark.read.parquet(f"{good}/*").unionByName(spark.read.parquet(f"{dead}/*"), allowMissingColumns=True)


@query("s7_windowed_counts", """with e as (select date_trunc('hour', ts) desde, event_type, count(*) eventos,
    sum(value::decimal(15,2))::double valor from events group by 1, 2)
  select * from e where desde + interval 1 hour <= (select max(ts) - interval 10 minute from events)""")
def s7(spark, sf):
    out, checkpoint = scratch(spark, "windows"), scratch(spark, "checkpoint")
    events = streams.read_changes(spark, sf, fx.table(spark, sf, "events").schema, glob="events.parquet")
    streams.run(streams.consume(streams.windowed_counts(events), checkpoint, out))
    return spark.read.parquet(out)


def _land(spark, sf, root):
    save_table(fx.sucursales(spark, sf), root, "raw/sucursales")
    landing.bronze_append(fx.transacciones(spark, sf), f"{root}/bronze/transacciones", "transacciones", as_of=fx.AS_OF)
    landing.bronze_append(fx.saldos(spark, sf), f"{root}/bronze/saldos", "saldos", as_of=fx.AS_OF)
    first_load(spark, sf, f"{root}/bronze/movimientos")
    _loads(spark, sf)[0].write.mode("append").parquet(f"{root}/bronze/clientes")


def _land_more(spark, sf, root):
    second_load(spark, sf, f"{root}/bronze/movimientos")
    _loads(spark, sf)[1].write.mode("append").parquet(f"{root}/bronze/clientes")


@query("c7_refresh_layers", f"""with {S_TXN}, {S_MOV}, {S_SAL}
select 'SILVER' schema_name, 'dim_clientes' as name, count(*) filas from cli
union all select 'SILVER', 'fact_transacciones', count(*) from s_txn
union all select 'SILVER', 'fact_movimientos', count(*) from s_mov
union all select 'SILVER', 'dim_saldos_actuales', count(*) from s_sal
union all select 'GOLD', 'perfil_cliente_360', count(*) from cli
union all select 'GOLD', 'resumen_mensual_sucursal',
  count(*) from (select distinct mes, sucursal_id from s_txn where _quality_flag = 'OK')
union all select 'GOLD', 'quality_alerts', (select count(distinct _quality_flag) from s_txn where _quality_flag <> 'OK')
  + (select count(distinct _quality_flag) from s_mov where _quality_flag <> 'OK')""", ("cli", "txn", "mov", "sal"))
def c7(spark, sf):
    """Refresh after a first and after a second load; the log of the second run."""
    root = scratch(spark, "layers")
    given = {"monto_anomalo": fx.MONTO_ANOMALO, "rangos": fx.RANGOS_SALDO, "cortes": fx.CORTES_VALOR}
    _land(spark, sf, root)
    jobs.refresh_layers(spark, root, fx.AS_OF, **given)
    _land_more(spark, sf, root)
    return jobs.refresh_layers(spark, root, fx.AS_OF, **given).select("schema_name", "name", "filas")


def refreshed(spark, sf):
    """The root of layers refreshed after a first and after a second load."""
    root = scratch(spark, "layers")
    given = {"monto_anomalo": fx.MONTO_ANOMALO, "rangos": fx.RANGOS_SALDO, "cortes": fx.CORTES_VALOR}
    for land in (_land, _land_more):
        land(spark, sf, root)
        jobs.refresh_layers(spark, root, fx.AS_OF, **given)
    return root


@query("c7_dim_clientes", f"with {S_CLI} select * from s_cli", ("bcli", "suc"))
def c7_clients(spark, sf):
    return read_version(spark, f"{refreshed(spark, sf)}/silver/dim_clientes")


@query("c7_dim_saldos", f"with {S_SAL} {doubles('s_sal', _MONEY[3:])}", ("sal",))
def c7_balances(spark, sf):
    return read_version(spark, f"{refreshed(spark, sf)}/silver/dim_saldos_actuales")


@query("c7_perfil_360", C1_SQL, ("bcli", "suc", "txn", "sal"))
def c7_profile(spark, sf):
    return read_version(spark, f"{refreshed(spark, sf)}/gold/perfil_cliente_360")


@query("c7_resumen_mensual", C2_SQL, ("txn", "suc"))
def c7_months(spark, sf):
    return read_version(spark, f"{refreshed(spark, sf)}/gold/resumen_mensual_sucursal")


@query("d11_run_marts", """select 'resumen_actividad_cliente' tabla,
    'OK: ' || count(distinct client_id) || ' clientes procesados' mensaje from txn where estado = 'Aprobada'
  union all select 'top_clientes_sucursal', 'OK: Top 10 clientes por sucursal calculados'
  union all select 'metricas_productos', 'OK: ' || count(*) || ' productos analizados' from prod""", ("txn", "prod"))
def d11(spark, sf):
    return spark.createDataFrame(list(_marts(spark, sf)[1].items()), "tabla string, mensaje string")


def _marts(spark, sf):
    """The root of the stored marts, and the messages of the run."""
    root = scratch(spark, "marts")
    save_table(fx.clientes(spark, sf), root, "raw/clientes")
    save_table(fx.productos(spark, sf), root, "raw/productos")
    save_table(fx.sucursales(spark, sf), root, "raw/sucursales")
    save_table(fx.transacciones(spark, sf), root, "raw/transacciones")
    jobs.build_warehouse(spark, root)
    return root, jobs.run_marts(spark, root)


@query("d11_resumen_actividad", D5_SQL, ("cli", "suc", "txn"))
def d11_activity(spark, sf):
    return read_version(spark, f"{_marts(spark, sf)[0]}/dwh/resumen_actividad_cliente")


@query("d11_top_clientes", D6_SQL, ("cli", "suc", "txn"))
def d11_top(spark, sf):
    return read_version(spark, f"{_marts(spark, sf)[0]}/dwh/top_clientes_sucursal")


@query("d11_metricas_productos", D7_SQL, ("prod", "txn"))
def d11_products(spark, sf):
    return read_version(spark, f"{_marts(spark, sf)[0]}/dwh/metricas_productos")


@query("h7_one_request", f"""with {REQ}, one as (select max(request_id) id from reqs),
  hit as (select request_id, user_id, case when client_id is null then 0 else 2 end filas
    from reqs left join cli on user_id = client_id)
  select 'pending' caso, 'OK: Usuario ' || user_id || ' pseudonimizado. ' || filas || ' filas afectadas.' mensaje
  from hit join one on id = request_id
  union all select 'again', 'ERROR: Solicitud ' || id || ' tiene status "COMPLETED"' from one
  union all select 'unknown', 'ERROR: Solicitud -1 no existe'
  union all select 'left', count(*) - 1 || ' pendientes' from reqs""", ("cli", "req"))
def h7_one(spark, sf):
    """One request by its id, the same again, an unknown one; the others are left alone."""
    root = scratch(spark, "compliance")
    write_version(dim(spark, sf), f"{root}/dwh/dim_clientes")
    write_version(fx.clientes(spark, sf), f"{root}/raw/clientes")
    requests = privacy.new_requests(fx.requests(spark, sf), read_version(spark, f"{root}/dwh/dim_clientes"))
    path = f"{root}/compliance/deletion_requests"
    last = write_version(requests, path).agg(F.max("request_id")).first()[0]
    tables = {"dwh/dim_clientes": privacy.DIM_COLUMNS, "raw/clientes": privacy.RAW_COLUMNS}
    said = [(case, jobs.run_deletion(spark, root, number, tables, privacy.salt_table(spark, SALT), "2001-08-10"))
            for case, number in (("pending", last), ("again", last), ("unknown", -1))]
    left = read_version(spark, path).filter("status = 'PENDING'").count()
    return spark.createDataFrame([*said, ("left", f"{left} pendientes")], "caso string, mensaje string")


@query("h7_run_deletions", """select 'COMPLETED' status, count(*) solicitudes,
  sum(case when user_id >= 0 then 2 else 0 end)::bigint filas from req""", ("req",))
def h7_run(spark, sf):
    root = scratch(spark, "compliance")
    write_version(dim(spark, sf), f"{root}/dwh/dim_clientes")
    write_version(fx.clientes(spark, sf), f"{root}/raw/clientes")
    requests = privacy.new_requests(fx.requests(spark, sf), read_version(spark, f"{root}/dwh/dim_clientes"))
    write_version(requests, f"{root}/compliance/deletion_requests")
    tables = {"dwh/dim_clientes": privacy.DIM_COLUMNS, "raw/clientes": privacy.RAW_COLUMNS}
    done = jobs.run_deletions(spark, root, tables, privacy.salt_table(spark, SALT), "2001-08-10")
    return done.groupBy("status").agg(F.count("*").alias("solicitudes"), F.sum("rows_affected").alias("filas"))


