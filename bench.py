"""Benchmark: headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line.

The banking tables are first derived from the given tables and stored, as the lab stores them;
that set-up is timed on its own. Every query then reads stored tables, runs to the end of its
plan (no-op sink) and counts with its median of $BENCH_REPEATS runs. The range queries run on the
fact as it arrived and on a copy in ranges of date and branch; ``files`` tells how many files
each touches. ``generate`` is rows per second of the synthetic transactions.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from ledgerlake.operators import gold, layout, marts, privacy, processes, quality, silver  # noqa: E402
from ledgerlake.plans import fixtures as fx, jobs  # noqa: E402
from ledgerlake.plans.all_queries import QUERIES  # noqa: E402
from ledgerlake.plans.queries_governance import CLI_SPECS  # noqa: E402
from ledgerlake.plans.queries_layout import CLIENT, Q1, Q2, Q5  # noqa: E402
from ledgerlake.plans.registry import RUN_TIME  # noqa: E402
from ledgerlake.session import local_session, shared_dir  # noqa: E402
from ledgerlake.sources import generators  # noqa: E402

N_FILES = 8


def store(df, path):
    df.repartition(N_FILES).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def seconds(build, repeats: int) -> float:
    took = []
    for _ in range(repeats):
        start = time.perf_counter()
        # The stamp of the run is a new constant in the generated code every time.
        build().drop(*RUN_TIME).write.format("noop").mode("overwrite").save()
        took.append(time.perf_counter() - start)
    return round(statistics.median(took), 3)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = local_session("bench", cpus, int(cpus) if cpus.isdigit() else 8)
    root = f"{shared_dir(spark)}/ledgerlake-bench-{uuid.uuid4().hex}"

    start = time.perf_counter()
    suc = store(fx.sucursales(spark, sf), f"{root}/raw/sucursales")
    prod = store(fx.productos(spark, sf), f"{root}/raw/productos")
    cli = store(fx.clientes(spark, sf), f"{root}/raw/clientes")
    txn = store(fx.transacciones(spark, sf), f"{root}/raw/transacciones")
    mov = store(fx.movimientos(spark, sf), f"{root}/raw/movimientos")
    sal = store(fx.saldos(spark, sf), f"{root}/raw/saldos")
    jobs.build_warehouse(spark, root)
    dim, fact = (spark.read.parquet(f"{root}/dwh/{n}") for n in ("dim_clientes", "fact_transacciones"))
    loaded = "2001-07-01 00:00:00"
    b_cli, b_txn = fx.with_load(cli, loaded, "initial_load"), fx.with_load(txn, loaded, "initial_load")
    s_txn = store(silver.silver_fact_transacciones(b_txn, fx.AS_OF), f"{root}/silver/txn")
    s_cli = store(silver.silver_dim_clientes(b_cli, suc, fx.AS_OF), f"{root}/silver/cli")
    s_sal = store(silver.silver_saldos_actuales(sal, fx.RANGOS_SALDO), f"{root}/silver/sal")
    setup = round(time.perf_counter() - start, 3)

    targets = dim.filter("client_id % 10 = 0").select("client_id")
    salt = privacy.salt_table(spark, "sal-de-prueba")
    runs = {
        "b1_silver_dim_clientes": lambda: silver.silver_dim_clientes(b_cli, suc, fx.AS_OF),
        "b2_silver_fact_transacciones": lambda: silver.silver_fact_transacciones(b_txn, fx.AS_OF),
        "b4_silver_saldos_actuales": lambda: silver.silver_saldos_actuales(sal, fx.RANGOS_SALDO),
        "c1_gold_perfil_360": lambda: gold.gold_perfil_360(s_cli, s_txn, s_sal, fx.AS_OF, fx.CORTES_VALOR),
        "c2_resumen_mensual_sucursal": lambda: gold.gold_resumen_mensual_sucursal(s_txn, suc),
        "d5_resumen_actividad": lambda: marts.resumen_actividad(dim, fact),
        "d6_top_clientes_sucursal": lambda: marts.top_clientes_sucursal(fact, dim, suc),
        "d7_metricas_productos": lambda: marts.metricas_productos(prod, fact),
        "d8_resumen_mensual": lambda: marts.resumen_mensual(fact, suc),
        "d9_posicion_cliente": lambda: marts.posicion_cliente(dim, sal, fact, mov, fx.AS_OF),
        "e1_scoring_clientes": lambda: processes.scoring_clientes(dim, fact, sal, fx.AS_OF, fx.CORTES_SCORE),
        "e2_reconciliacion_saldos": lambda: processes.reconciliacion_saldos(mov, sal),
        "e3_agregacion_mensual_clientes": lambda: processes.agregacion_mensual_clientes(fact),
        "f8_compare_scans": lambda: QUERIES["f8_compare_scans"](spark, sf),
        "h6_pseudonymize": lambda: privacy.pseudonymize(dim, targets, privacy.DIM_COLUMNS, salt, fx.AS_OF),
        "i5_run_metrics": lambda: quality.run_metrics(dim, "DIM_CLIENTES", CLI_SPECS, fx.AS_OF),
        "i9_pii_in_text": lambda: QUERIES["i9_pii_in_text"](spark, sf),
    }
    out: dict[str, float] = {}
    for run in runs.values():  # warm-up
        run().drop(*RUN_TIME).write.format("noop").mode("overwrite").save()
    for name, run in runs.items():
        out[name] = seconds(run, repeats)

    layout.cluster_table(fact.drop("etl_timestamp"), f"{root}/clustered/fact", ["fecha", "sucursal_id"], N_FILES)
    layout.cluster_table(mov, f"{root}/clustered/mov", ["fecha", "client_id"], N_FILES)
    store(fact.drop("etl_timestamp"), f"{root}/plain/fact")
    files = {}
    for kind, fact_path, mov_path in (
        ("plain", "plain/fact", "raw/movimientos"), ("clustered", "clustered/fact", "clustered/mov"),
    ):
        t, m = spark.read.parquet(f"{root}/{fact_path}"), spark.read.parquet(f"{root}/{mov_path}")
        ranges = {
            "f1": lambda: layout.q1_rango_fechas(t, *Q1),
            "f2": lambda: layout.q2_fecha_sucursal(t, suc, *Q2),
            "f3": lambda: layout.q3_point_lookup(t, CLIENT),
            "f4": lambda: layout.q4_agregacion_mensual(t),
            "f5": lambda: layout.q5_join_pesado(t, m, *Q5),
        }
        for name, run in ranges.items():
            run().write.format("noop").mode("overwrite").save()
            out[f"{name}_{kind}"] = seconds(run, repeats)
        stats = layout.file_statistics(spark, f"{root}/{fact_path}", ["fecha"])
        for name, (lo, hi) in (("f1", Q1), ("f2", Q2), ("f5", Q5)):
            report = layout.scan_report(
                stats, "fecha", F.lit(lo).cast("timestamp_ntz"), F.lit(hi).cast("timestamp_ntz")
            ).first()
            files[f"{name}_{kind}"] = f"{report['archivos_leidos']}/{report['archivos_total']}"

    rows = int(os.environ.get("BENCH_GENERATE_ROWS", "50000000"))
    generated = seconds(lambda: generators.gen_transactions(generators.sequence(spark, rows), fx.AS_OF), 1)

    print(json.dumps({
        "metric": "headline queries on stored tables, sum of medians", "value": round(sum(out.values()), 3),
        "unit": "sec", "queries": out, "files": files, "setup": setup,
        "generate": {"rows": rows, "seconds": generated}, "sf": sf, "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
