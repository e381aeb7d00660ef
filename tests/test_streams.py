"""Streaming and job behaviour: nothing twice, late rows, repeated batches, failures."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import privacy, restore
from ledgerlake.plans import jobs
from ledgerlake.sources import generators, ingest, landing, tables
from ledgerlake.streaming import jobs as streams

ROW = "k long, v string, _loaded_at timestamp_ntz, _source_file string"


def rows(spark, *data):
    return spark.createDataFrame([(k, v, datetime(2024, 1, d), f"load{d}") for k, v, d in data], ROW)


def newest():
    return [F.col("_loaded_at").desc()]


def test_second_run_delivers_only_what_is_new(spark, folder):
    source, sink, checkpoint = (f"{folder}/{n}" for n in ("in", "out", "cp"))
    rows(spark, (1, "a", 1)).write.mode("append").parquet(source)
    schema = spark.read.parquet(source).schema
    for extra in (None, None, (2, "b", 2)):
        if extra:
            rows(spark, extra).write.mode("append").parquet(source)
        streams.run(streams.consume(streams.read_changes(spark, source, schema), checkpoint, sink))
    assert sorted(r["k"] for r in spark.read.parquet(sink).collect()) == [1, 2]


def test_stream_has_data(spark):
    table = rows(spark, (1, "a", 1), (2, "b", 2))
    assert streams.stream_has_data(table, rows(spark, (1, "a", 1))).first()["has_data"]
    assert not streams.stream_has_data(table, table).first()["has_data"]


@pytest.mark.parametrize("compact_every", [1, 2, 24])
def test_newest_wins_also_when_old_rows_come_late(spark, folder, compact_every):
    sink = streams.upsert_newest(folder, ["k"], newest, compact_every)
    sink(rows(spark, (1, "new", 5), (2, "x", 1), (2, "y", 2)), 0)
    sink(rows(spark, (1, "late", 3), (3, "z", 4)), 1)
    sink(rows(spark, (3, "zz", 6)), 2)
    got = {r["k"]: r["v"] for r in streams.read_newest(spark, folder, ["k"], newest).collect()}
    assert got == {1: "new", 2: "y", 3: "zz"}


def test_a_repeated_batch_changes_nothing(spark, folder):
    sink = streams.upsert_newest(folder, ["k"], newest, 2)
    for batch_id in (0, 1, 1):
        sink(rows(spark, (batch_id, "a", batch_id + 1)), batch_id)
    assert streams.read_newest(spark, folder, ["k"], newest).count() == 2


def test_versions_ignore_unfinished_writes(spark, folder):
    import os

    tables.write_version(spark.range(3), f"{folder}/t")
    os.makedirs(f"{folder}/t/v=2")
    assert tables.latest_version(spark, f"{folder}/t") == 1
    tables.write_version(spark.range(4), f"{folder}/t")
    assert tables.read_version(spark, f"{folder}/t").count() == 4


def test_json_rows(spark):
    from pyspark.sql import types as T

    raw = spark.createDataFrame([(1, '{"k": 1}'), (2, '{"k": 2, "nuevo": "x"}'), (3, '{"k": 3'), (4, "nada"),
                                 (5, '{"k": "texto"}'), (6, None)], "id long, value string")
    parsed = ingest.parse_json(raw, "value", T.StructType([T.StructField("k", T.LongType())]))
    good = {r["id"]: (r["k"], r["extra"]) for r in ingest.good_rows(parsed).collect()}
    dead = {r["id"] for r in ingest.dead_letters(parsed, "value").collect()}
    assert good[1] == (1, None) and good[2] == (2, {"nuevo": "x"})
    assert {3, 4, 5} <= dead and dead | set(good) == {1, 2, 3, 4, 5, 6} and not dead & set(good)


def test_a_failing_run_marks_its_requests(spark, folder):
    dim = spark.createDataFrame([(1, "r1")], "client_id long, rut string")
    asked = spark.createDataFrame([(1,)], "user_id long")
    tables.write_version(privacy.new_requests(asked, dim), f"{folder}/compliance/deletion_requests")
    out = jobs.run_deletions(spark, folder, {"dwh/falta": ("rut",)}).first()
    assert out["status"] == "FAILED" and out["notes"]


def test_a_lost_run_is_resumed(spark, folder):
    dim = spark.createDataFrame([(1, "r1", False)], "client_id long, rut string, pseudonymized boolean")
    tables.write_version(dim, f"{folder}/dwh/dim")
    path = f"{folder}/compliance/deletion_requests"
    stuck = privacy.mark_processing(privacy.new_requests(spark.createDataFrame([(1,)], "user_id long"), dim))
    tables.write_version(stuck, path)
    assert jobs.run_deletions(spark, folder, {"dwh/dim": ("rut",)}).first()["status"] == "PROCESSING"
    assert jobs.run_deletions(spark, folder, {"dwh/dim": ("rut",)}, resume=True).first()["status"] == "COMPLETED"


def test_a_failing_refresh_is_logged(spark, folder):
    with pytest.raises(Exception):
        jobs.refresh_layers(spark, folder, "2024-01-01", only=["resumen_mensual_sucursal"])
    log = spark.read.parquet(f"{folder}/log/refresh")
    assert [(r["name"], r["refresh_status"]) for r in log.collect()] == [("resumen_mensual_sucursal", "FAILED")]


def test_deletions_are_logged_in_turn(spark, folder):
    dim = spark.createDataFrame([(1, "r1", False), (2, "r2", False)], "client_id long, rut string, pseudonymized boolean")
    tables.write_version(dim, f"{folder}/dwh/dim")
    path = f"{folder}/compliance/deletion_requests"
    tables.write_version(privacy.new_requests(spark.createDataFrame([(1,)], "user_id long"), dim), path)
    jobs.run_deletions(spark, folder, {"dwh/dim": ("rut",)})
    more = privacy.new_requests(spark.createDataFrame([(2,)], "user_id long"), dim, last_id=1)
    tables.write_version(tables.read_version(spark, path).unionByName(more), path)
    done = jobs.run_deletions(spark, folder, {"dwh/dim": ("rut",)})
    assert [r["status"] for r in done.collect()] == ["COMPLETED"] * 2
    log = tables.read_version(spark, f"{folder}/compliance/deletion_log")
    assert log.count() == 2 and log.select("log_id").distinct().count() == 2
    hidden = tables.read_version(spark, f"{folder}/dwh/dim")
    assert hidden.filter("pseudonymized and length(rut) = 8").count() == 2


def test_future_rows_become_ok_in_time(spark):
    df = spark.createDataFrame([(datetime(2024, 5, 1), "FECHA_FUTURA"), (datetime(2024, 5, 1), "MONTO_NULL")],
                               "fecha timestamp_ntz, _quality_flag string")
    flags = [r["_quality_flag"] for r in jobs.current_flags(df, "2024-06-01").collect()]
    assert flags == ["OK", "MONTO_NULL"]
    assert jobs.current_flags(df, "2024-04-01").first()["_quality_flag"] == "FECHA_FUTURA"


def test_restore(spark):
    log = rows(spark, (1, "a", 1), (1, "b", 3), (2, "c", 2))
    then = {r["k"]: r["v"] for r in restore.restore_as_of(log, ["k"], "2024-01-02").collect()}
    last = {r["k"]: r["v"] for r in restore.restore_as_of(log, ["k"], "2024-01-09").collect()}
    back = {r["k"]: r["v"] for r in restore.restore_as_of(log, ["k"], "2024-01-03", 86400).collect()}
    assert then == {1: "a", 2: "c"} == back and last == {1: "b", 2: "c"}


def test_generators(spark):
    made = generators.generate_all(spark, 0.0002, "2024-01-01")
    counts = {n: df.count() for n, df in made.items()}
    assert counts == {"sucursales": 1, "productos": 1, "clientes": 100, "transacciones": 10_000,
                      "movimientos": 2_000, "saldos": 1_600}
    txn = made["transacciones"]
    # Status and type follow the same row number: only three types are ever rejected.
    assert {r["tipo"] for r in txn.filter("estado = 'Rechazada'").select("tipo").distinct().collect()} == {
        "Retiro", "Pago", "Comisión"}
    signs = txn.groupBy("tipo").agg(F.min("monto").alias("lo"), F.max("monto").alias("hi")).collect()
    limits = {r["tipo"]: (r["lo"], r["hi"]) for r in signs}
    assert limits["Depósito"][0] >= 10_000 and limits["Retiro"][1] <= -5_000
    assert limits["Transferencia"][0] < 0 < limits["Transferencia"][1]
    assert txn.filter("client_id not between 1 and 100").count() == 0
    assert made["clientes"].filter(~F.col("rut").rlike(r"^[0-9]{2}\.[0-9]{3}\.[0-9]{3}-[0-9K]$")).count() == 0
    again = generators.gen_transactions(generators.sequence(spark, 10_000, 3), "2024-01-01", 100, 1, 1)
    assert again.exceptAll(txn).count() == 0


def test_draws_are_even(spark):
    from ledgerlake.functions import draw

    counts = spark.range(200_000).groupBy(draw(F.col("id"), 5, 0, 9).alias("d")).count().collect()
    assert len(counts) == 10 and all(abs(r["count"] - 20_000) < 700 for r in counts)


def test_daily_load(spark, folder):
    raw = generators.gen_transactions(generators.sequence(spark, 3000, 2), "2024-01-01")
    landing.bronze_append(raw, f"{folder}/t", "transacciones", as_of="2024-01-01")
    bronze = spark.read.schema(landing.bronze_schema("transacciones")).parquet(f"{folder}/t")
    day = landing.simulate_daily_load(bronze, 500, "2024-01-02")
    assert day.count() == 500 and day.columns == bronze.columns
    joined = day.alias("d").join(bronze.alias("b"), F.col("d.txn_id") == F.col("b.txn_id") + 100_000_000)
    change = F.col("d.monto") / F.col("b.monto")
    assert joined.filter(change.between(0.89, 1.11)).count() == 500
    assert day.select("_source_file").distinct().first()[0] == "daily_load_2024-01-02"
