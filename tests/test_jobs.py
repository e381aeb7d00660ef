"""Jobs that store tables: each table against its batch operator, which SQL checks elsewhere."""

from __future__ import annotations

from collections import Counter

import pytest

from ledgerlake.operators import marts, processes
from ledgerlake.plans import jobs
from ledgerlake.sources import generators
from ledgerlake.sources.tables import read_table, read_version, save_table

AS_OF = "2024-01-01"


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("jobs"))
    for name, df in generators.generate_all(spark, scale=0.0001, as_of=AS_OF).items():
        save_table(df, path, f"raw/{name}")
    jobs.build_warehouse(spark, path)
    return path


def rows(df):
    """The rows without the times at which they were made."""
    kept = [c for c in sorted(df.columns) if c != "v" and not c.startswith(("etl_", "fecha_actualizacion", "fecha_calculo"))]
    assert kept
    return Counter(map(tuple, df.select(*kept).collect()))


def check(spark, root, name, want, n):
    got = read_version(spark, f"{root}/dwh/{name}")
    assert rows(got) == rows(want) and got.count() == n > 0


def test_run_processes(spark, root):
    counts = jobs.run_processes(spark, root, AS_OF)
    dim, fact = read_table(spark, root, "dwh/dim_clientes"), read_table(spark, root, "dwh/fact_transacciones")
    saldos, movimientos = read_table(spark, root, "raw/saldos"), read_table(spark, root, "raw/movimientos")
    check(spark, root, "scoring_clientes", processes.scoring_clientes(dim, fact, saldos, AS_OF), counts["scoring_clientes"])
    check(spark, root, "excepciones_reconciliacion", processes.excepciones_reconciliacion(
        processes.reconciliacion_saldos(movimientos, saldos)), counts["excepciones_reconciliacion"])
    check(spark, root, "agregacion_mensual_clientes", processes.agregacion_mensual_clientes(fact), counts["agregacion_mensual_clientes"])
    assert len(counts) == 3


def test_refresh_marts(spark, root):
    log = {r[0]: r[-1] for r in jobs.refresh_marts(spark, root, AS_OF).collect()}
    dim, branches, fact = (read_table(spark, root, f"dwh/{n}") for n in ("dim_clientes", "dim_sucursales", "fact_transacciones"))
    saldos, movimientos = read_table(spark, root, "raw/saldos"), read_table(spark, root, "raw/movimientos")
    check(spark, root, "resumen_mensual", marts.resumen_mensual(fact, branches), log["resumen_mensual"])
    check(spark, root, "posicion_cliente", marts.posicion_cliente(dim, saldos, fact, movimientos, AS_OF), log["posicion_cliente"])
    assert read_table(spark, root, "log/refresh").count() == 2


def test_restore_table(spark, root):
    history = spark.sql("""select * from values (1, 'a', timestamp_ntz'2024-01-01 10:00:00'), (1, 'b', timestamp_ntz'2024-01-01 12:00:00'),
        (2, 'c', timestamp_ntz'2024-01-01 11:00:00'), (3, 'd', timestamp_ntz'2024-01-02 00:00:00') as t(k, x, _loaded_at)""")
    save_table(history, root, "raw/history")
    for moment, offset, want in (("2024-01-01 12:00:00", 0, {(1, "b"), (2, "c")}), ("2024-01-01 12:00:00", 1, {(1, "a"), (2, "c")})):
        out = jobs.restore_table(spark, root, "raw/history", "dwh/restored", ["k"], moment, offset)
        assert {(r["k"], r["x"]) for r in out.collect()} == want
        assert {(r["k"], r["x"]) for r in read_version(spark, f"{root}/dwh/restored").collect()} == want
