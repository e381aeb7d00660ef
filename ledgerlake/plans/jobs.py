"""Ordered runs that read and write tables: layer refresh, marts, deletion requests."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ledgerlake import params
from ledgerlake.functions import now
from ledgerlake.functions.clock import AsOf
from ledgerlake.operators import gold, marts, privacy, processes, silver
from ledgerlake.operators.restore import restore_as_of
from ledgerlake.sources.landing import bronze_schema
from ledgerlake.sources.tables import drop_versions, latest_version, read_table, read_version, save_table, write_version
from ledgerlake.streaming import gold_states as states, jobs as streams

LAG_SECONDS = {"SILVER": 600, "GOLD": 1800, "DWH": 3600}
REFRESH_LOG = (
    "name string, schema_name string, target_lag_sec long, actual_lag_sec double, refresh_trigger string, "
    "refresh_status string, last_completed_refresh_time timestamp_ntz, filas long"
)


def write_counted(df: DataFrame, path: str) -> int:
    """Write a new version and count its rows in the same pass."""
    seen = Observation()
    write_version(df.observe(seen, F.count(F.lit(1)).alias("n")), path)
    return seen.get["n"]


def _newest_client():
    return silver.newest_client_first(bronze_schema("clientes").fieldNames())


def _newest_balance():
    return silver.newest_balance_first(bronze_schema("saldos").fieldNames())


def current_flags(txn: DataFrame, as_of: AsOf = None) -> DataFrame:
    """A row that was in the future when it arrived is OK once its time has come."""
    due = (F.col("_quality_flag") == "FECHA_FUTURA") & (F.col("fecha") <= now(as_of))
    return txn.withColumn("_quality_flag", F.when(due, params.OK).otherwise(F.col("_quality_flag")))


def refresh_layers(
    spark: SparkSession,
    root: str,
    as_of: AsOf = None,
    only: Sequence[str] | None = None,
    trigger: str = "SCHEDULED",
    monto_anomalo: int = params.MONTO_ANOMALO,
    rangos: Sequence[tuple] = params.RANGOS_SALDO,
    cortes: params.CortesValor = params.CortesValor(),
) -> DataFrame:
    """Bring Silver, then Gold, up to date with Bronze; returns the rows added to the refresh log.

    Silver reads only what arrived since its last run: facts are appended, the newest client and
    balance versions are upserted. Gold comes from counted states that the new rows are folded into,
    so no run reads the facts again.
    ``only`` forces single tables. A failing table is logged and stops the run; the next run goes
    on from the checkpoints and the last committed versions.
    """
    checkpoints, bronze, problem = f"{root}/_checkpoints", f"{root}/bronze", None

    def changes(name: str) -> DataFrame:
        return streams.read_changes(spark, f"{bronze}/{name}", bronze_schema(name))

    def append(name: str, source: str, build: Callable[[DataFrame], DataFrame]) -> int:
        path = f"{root}/silver/{name}"
        new = build(changes(source))
        streams.run(streams.consume(new, f"{checkpoints}/{name}", path))
        fold = states.fold_fact if name == "fact_transacciones" else states.fold_flags
        folded = streams.read_changes(spark, path, new.schema).writeStream.foreachBatch(fold(f"{root}/states/{name}"))
        streams.run(folded.option("checkpointLocation", f"{checkpoints}/states_{name}").trigger(availableNow=True).start())
        return states.row_total(spark, f"{root}/states/{name}")

    def newest(source: str, keys: Sequence[str], order) -> DataFrame:
        path = f"{root}/silver/_{source}"
        streams.run(streams.dedup_stream(changes(source), f"{checkpoints}/_{source}", path, keys, order))
        return streams.read_newest(spark, path, keys, order, bronze_schema(source))

    def branches() -> DataFrame:
        return read_table(spark, root, "raw/sucursales")

    def counted(build: Callable[..., DataFrame]) -> DataFrame:
        like = silver.silver_fact_transacciones(spark.createDataFrame([], bronze_schema("transacciones")), as_of)
        return build(spark, f"{root}/states/fact_transacciones", like, as_of)

    def version(layer: str, name: str) -> DataFrame:
        return read_version(spark, f"{root}/{layer}/{name}")

    steps: dict[tuple[str, str], Callable[[], DataFrame | int]] = {
        ("SILVER", "dim_clientes"): lambda: silver.silver_dim_clientes(
            newest("clientes", ["client_id"], _newest_client), branches(), as_of, reduced=True),
        ("SILVER", "fact_transacciones"): lambda: append(
            "fact_transacciones", "transacciones", lambda d: silver.silver_fact_transacciones(d, as_of)),
        ("SILVER", "fact_movimientos"): lambda: append(
            "fact_movimientos", "movimientos", lambda d: silver.silver_fact_movimientos(d, monto_anomalo)),
        ("SILVER", "dim_saldos_actuales"): lambda: silver.silver_saldos_actuales(
            newest("saldos", ["client_id", "producto_id"], _newest_balance), rangos, reduced=True),
        ("GOLD", "perfil_cliente_360"): lambda: gold.profile(
            version("silver", "dim_clientes"), counted(states.activity), version("silver", "dim_saldos_actuales"), cortes),
        ("GOLD", "resumen_mensual_sucursal"): lambda: gold.named_months(counted(states.months), branches()),
        ("GOLD", "quality_alerts"): lambda: gold.named_alerts(
            counted(states.fact_alerts), states.flag_alerts(spark, f"{root}/states/fact_movimientos")),
    }
    log = []
    for (layer, name), build in steps.items():
        if only is not None and name not in only:
            continue
        began, rows, problem = time.time(), None, None
        try:
            result = build()
            path = f"{root}/{layer.lower()}/{name}"
            rows = result if isinstance(result, int) else write_counted(result, path)
        except Exception as exc:
            problem = exc
        done = datetime.now(timezone.utc).replace(tzinfo=None)
        status = "FAILED" if problem else "SUCCEEDED"
        log.append((name, layer, LAG_SECONDS[layer], time.time() - began, trigger, status, done, rows))
        if problem:
            break
    entries = spark.createDataFrame(log, REFRESH_LOG)
    save_table(entries, root, "log/refresh", "append")
    if problem:
        raise problem
    return entries


def build_warehouse(spark: SparkSession, root: str) -> None:
    """The star schema from the raw tables."""
    raw = {n: read_table(spark, root, f"raw/{n}") for n in ("clientes", "productos", "sucursales", "transacciones")}
    save_table(marts.dwh_dim_clientes(raw["clientes"], raw["sucursales"]), root, "dwh/dim_clientes")
    save_table(marts.dwh_dim_productos(raw["productos"]), root, "dwh/dim_productos")
    save_table(marts.dwh_dim_sucursales(raw["sucursales"]), root, "dwh/dim_sucursales")
    save_table(marts.dwh_fact_transacciones(raw["transacciones"]), root, "dwh/fact_transacciones")


def run_marts(spark: SparkSession, root: str) -> dict[str, str]:
    """The three summaries, submitted together because none needs another; returns their messages."""
    dim, products, branches, fact = (
        read_table(spark, root, f"dwh/{n}")
        for n in ("dim_clientes", "dim_productos", "dim_sucursales", "fact_transacciones")
    )
    work: dict[str, tuple[Callable[[], DataFrame], str]] = {
        "resumen_actividad_cliente": (lambda: marts.resumen_actividad(dim, fact), "OK: {} clientes procesados"),
        "top_clientes_sucursal": (
            lambda: marts.top_clientes_sucursal(fact, dim, branches), "OK: Top 10 clientes por sucursal calculados"),
        "metricas_productos": (lambda: marts.metricas_productos(products, fact), "OK: {} productos analizados"),
    }

    def one(name: str) -> str:
        build, message = work[name]
        return message.format(write_counted(build(), f"{root}/dwh/{name}"))

    with ThreadPoolExecutor(len(work)) as pool:
        return dict(zip(work, pool.map(one, work)))


def run_processes(spark: SparkSession, root: str, as_of: AsOf = None) -> dict[str, int]:
    """Scoring, reconciliation exceptions and the monthly aggregation, stored; returns their row counts."""
    dim, fact = read_table(spark, root, "dwh/dim_clientes"), read_table(spark, root, "dwh/fact_transacciones")
    saldos, movimientos = read_table(spark, root, "raw/saldos"), read_table(spark, root, "raw/movimientos")
    work = {
        "scoring_clientes": processes.scoring_clientes(dim, fact, saldos, as_of),
        "excepciones_reconciliacion": processes.excepciones_reconciliacion(
            processes.reconciliacion_saldos(movimientos, saldos)),
        "agregacion_mensual_clientes": processes.agregacion_mensual_clientes(fact),
    }
    return {name: write_counted(df, f"{root}/dwh/{name}") for name, df in work.items()}


def refresh_marts(spark: SparkSession, root: str, as_of: AsOf = None) -> DataFrame:
    """The two marts that follow their sources within ``LAG_SECONDS["DWH"]``; returns the log rows."""
    dim, branches, fact = (
        read_table(spark, root, f"dwh/{n}") for n in ("dim_clientes", "dim_sucursales", "fact_transacciones")
    )
    saldos, movimientos = read_table(spark, root, "raw/saldos"), read_table(spark, root, "raw/movimientos")
    work = {
        "resumen_mensual": lambda: marts.resumen_mensual(fact, branches),
        "posicion_cliente": lambda: marts.posicion_cliente(dim, saldos, fact, movimientos, as_of),
    }
    log = []
    for name, build in work.items():
        began = time.time()
        rows = write_counted(build(), f"{root}/dwh/{name}")
        done = datetime.now(timezone.utc).replace(tzinfo=None)
        log.append((name, "DWH", LAG_SECONDS["DWH"], time.time() - began, "SCHEDULED", "SUCCEEDED", done, rows))
    entries = spark.createDataFrame(log, REFRESH_LOG)
    save_table(entries, root, "log/refresh", "append")
    return entries


def restore_table(
    spark: SparkSession, root: str, source: str, target: str, keys: Sequence[str], moment: str, offset_seconds: int = 0
) -> DataFrame:
    """The state of a table's history at a moment, written as the next version of ``target``."""
    rows = restore_as_of(spark.read.parquet(f"{root}/{source}"), keys, moment, offset_seconds)
    return write_version(rows, f"{root}/{target}")


def run_deletions(
    spark: SparkSession,
    root: str,
    tables: dict[str, Sequence[str]],
    salt: DataFrame | None = None,
    as_of: AsOf = None,
    executed_by: str = "ledgerlake",
    resume: bool = False,
    only: Sequence[int] | None = None,
) -> DataFrame:
    """Process the pending requests (or ``only`` those ids among them) of ``compliance/deletion_requests``; returns the request table.

    Each table gets a new version and then its log rows; the requests come last and stay in
    PROCESSING until then. An error leaves them FAILED with its text. ``resume`` takes up what a
    broken run left: tables that the log names are not hashed again, and the run's secret, which is
    kept next to the requests until they are done, makes the other tables agree with them.
    """
    path, log_path = f"{root}/compliance/deletion_requests", f"{root}/compliance/deletion_log"
    requests = read_version(spark, path)
    others = requests.limit(0) if only is None else requests.filter(~F.col("request_id").isin(*only))
    if only is not None:
        requests = requests.filter(F.col("request_id").isin(*only))
    if resume:
        left = F.col("status").isin("PROCESSING", "FAILED")
        requests = requests.withColumns({
            "notes": F.when(left, F.lit(None).cast("string")).otherwise(F.col("notes")),
            "status": F.when(left, "PENDING").otherwise(F.col("status")),
        })
    secret_path = f"{root}/compliance/_secret"
    if salt is None:
        kept = resume and latest_version(spark, secret_path) is not None
        salt = read_version(spark, secret_path) if kept else write_version(privacy.new_salt(spark), secret_path)
    running = privacy.mark_processing(requests)
    write_version(running.unionByName(others), path)
    try:
        sources = {n: (read_version(spark, f"{root}/{n}"), columns) for n, columns in tables.items()}
        last, earlier = 0, None
        if latest_version(spark, log_path) is not None:
            log = read_version(spark, log_path)
            last = log.agg(F.coalesce(F.max("log_id"), F.lit(0))).first()[0]
            earlier = log if resume else None
        result = privacy.process_deletion_requests(requests, sources, salt, as_of, executed_by, last, earlier)
        for name, df in result.tables.items():
            write_version(df, f"{root}/{name}")
            entries = result.log.filter(F.col("table_name") == name)
            if latest_version(spark, log_path) is not None:
                entries = read_version(spark, log_path).unionByName(entries)
            write_version(entries, log_path)
        done = write_version(result.requests.unionByName(others), path)
        drop_versions(spark, secret_path, latest_version(spark, secret_path) or 0)
        return done
    except Exception as exc:
        return write_version(privacy.mark_failed(running, str(exc)).unionByName(others), path)


def run_deletion(
    spark: SparkSession,
    root: str,
    request_id: int,
    tables: dict[str, Sequence[str]],
    salt: DataFrame | None = None,
    as_of: AsOf = None,
    executed_by: str = "ledgerlake",
) -> str:
    """Process one request and return its message; an unknown id, or one that is not pending, is refused."""
    path = f"{root}/compliance/deletion_requests"
    asked = spark.createDataFrame([(request_id,)], "request_id long")
    known = read_version(spark, path).filter(F.col("request_id") == request_id)
    if known.filter("status = 'PENDING'").isEmpty():
        return privacy.deletion_messages(known, asked, refuse_done=True).first()["mensaje"]
    done = run_deletions(spark, root, tables, salt, as_of, executed_by, only=[request_id])
    return privacy.deletion_messages(done, asked).first()["mensaje"]
