"""The lab at its own volume: generate, refine, build marts, run the processes; seconds per step.

    LEDGERLAKE_DRIVER_MEMORY=20g python bench_lab.py [scale, default 1.0 = 70 million rows] [skew]

With ``skew`` a third of all facts go to one client and one branch. Tables are written as Parquet under the shared folder (about 4 GB at scale 1).
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from ledgerlake.operators import gold, layout, marts, processes, silver  # noqa: E402
from ledgerlake.plans import jobs  # noqa: E402
from ledgerlake.session import local_session, shared_dir  # noqa: E402
from ledgerlake.sources import generators, landing  # noqa: E402
from ledgerlake.sources.tables import read_table, save_table  # noqa: E402

AS_OF = "2024-12-31"


def main() -> None:
    scale = float(sys.argv[1]) if len(sys.argv) > 1 else 1.0
    spark = local_session("lab", os.environ.get("BENCH_CPUS", "*"), 64)
    root = f"{shared_dir(spark)}/ledgerlake-lab-{uuid.uuid4().hex}"
    out: dict[str, float] = {}

    def step(name, run):
        start = time.perf_counter()
        run()
        out[name] = round(time.perf_counter() - start, 1)
        print(name, out[name], file=sys.stderr, flush=True)

    def save(df, name):
        return lambda: save_table(df, root, name)

    made = generators.generate_all(spark, scale, AS_OF)
    if "skew" in sys.argv[2:]:
        for name, key in (("transacciones", "txn_id"), ("movimientos", "movimiento_id"), ("saldos", "saldo_id")):
            third = F.col(key) % 3 == 0
            hot = [c for c in ("client_id", "sucursal_id") if c in made[name].columns]
            made[name] = made[name].withColumns(
                {c: F.when(third, F.lit(1).cast("long")).otherwise(F.col(c)) for c in hot}
            )
    for name, df in made.items():
        step(f"generate {name}", save(df, f"raw/{name}"))
    raw = {n: read_table(spark, root, f"raw/{n}") for n in made}
    step("warehouse", lambda: jobs.build_warehouse(spark, root))
    dim, fact = read_table(spark, root, "dwh/dim_clientes"), read_table(spark, root, "dwh/fact_transacciones")

    bronze = {n: landing.to_bronze(raw[n], n, as_of=AS_OF) for n in ("clientes", "transacciones", "movimientos", "saldos")}
    step("silver clientes", save(silver.silver_dim_clientes(bronze["clientes"], raw["sucursales"], AS_OF), "silver/cli"))
    step("silver transacciones", save(silver.silver_fact_transacciones(bronze["transacciones"], AS_OF), "silver/txn"))
    step("silver movimientos", save(silver.silver_fact_movimientos(bronze["movimientos"]), "silver/mov"))
    step("silver saldos", save(silver.silver_saldos_actuales(bronze["saldos"]), "silver/sal"))
    s = {n: read_table(spark, root, f"silver/{n}") for n in ("cli", "txn", "mov", "sal")}
    step("gold perfil 360", save(gold.gold_perfil_360(s["cli"], s["txn"], s["sal"], AS_OF), "gold/perfil"))
    step("gold resumen mensual", save(gold.gold_resumen_mensual_sucursal(s["txn"], raw["sucursales"]), "gold/resumen"))
    step("gold alertas", save(gold.gold_quality_alerts(s["txn"], s["mov"]), "gold/alertas"))

    step("resumen actividad", save(marts.resumen_actividad(dim, fact), "dwh/actividad"))
    step("top clientes", save(marts.top_clientes_sucursal(fact, dim, raw["sucursales"]), "dwh/top"))
    step("metricas productos", save(marts.metricas_productos(raw["productos"], fact), "dwh/productos"))
    step("resumen mensual", save(marts.resumen_mensual(fact, raw["sucursales"]), "dwh/mensual"))
    step("posicion cliente", save(
        marts.posicion_cliente(dim, raw["saldos"], fact, raw["movimientos"], AS_OF), "dwh/posicion"))
    step("scoring", save(processes.scoring_clientes(dim, fact, raw["saldos"], AS_OF), "dwh/scoring"))
    step("reconciliacion", save(processes.excepciones_reconciliacion(
        processes.reconciliacion_saldos(raw["movimientos"], raw["saldos"])), "dwh/excepciones"))
    step("agregacion mensual", lambda: save_table(
        processes.agregacion_mensual_clientes(fact), root, "dwh/agregacion"))

    step("cluster fact", lambda: layout.cluster_table(
        fact.drop("etl_timestamp"), f"{root}/clustered/fact", ["fecha", "sucursal_id"], 64))
    step("cluster movimientos", lambda: layout.cluster_table(
        raw["movimientos"], f"{root}/clustered/mov", ["fecha", "client_id"], 16))
    files = {}
    for kind, f_path, m_path in (
        ("plain", "dwh/fact_transacciones", "raw/movimientos"), ("clustered", "clustered/fact", "clustered/mov"),
    ):
        t, m = read_table(spark, root, f_path), read_table(spark, root, m_path)
        for name, run in {
            "q1": lambda: layout.q1_rango_fechas(t, "2024-01-01", "2024-03-31"),
            "q2": lambda: layout.q2_fecha_sucursal(t, raw["sucursales"], "2024-06-01", "2024-07-01"),
            "q3": lambda: layout.q3_point_lookup(t, 12345),
            "q4": lambda: layout.q4_agregacion_mensual(t),
            "q5": lambda: layout.q5_join_pesado(t, m, "2024-06-01", "2024-06-30"),
        }.items():
            step(f"{name} {kind}", lambda: run().write.format("noop").mode("overwrite").save())
        stats = layout.file_statistics(spark, f"{root}/{f_path}", ["fecha"])
        for name, lo, hi in (("q1", "2024-01-01", "2024-03-31"), ("q2", "2024-06-01", "2024-07-01")):
            r = layout.scan_report(stats, "fecha", F.lit(lo).cast("timestamp_ntz"), F.lit(hi).cast("timestamp_ntz")).first()
            files[f"{name} {kind}"] = f"{r['archivos_leidos']}/{r['archivos_total']}"
    print(json.dumps({"scale": scale, "total": round(sum(out.values()), 1), "seconds": out, "files": files}))


if __name__ == "__main__":
    main()
