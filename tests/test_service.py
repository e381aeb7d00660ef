"""Ledger of loads, alerts in update mode, lag from events, SQL functions, growing schemas, bucketed tables."""

from __future__ import annotations

import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions import sql
from ledgerlake.operators import gold, processes, quality
from ledgerlake.plans import fixtures as fx, queries_marts
from ledgerlake.sources import evolution, generators, landing, ledger, tables
from ledgerlake.streaming import gold_states, jobs as streams, service

SMALL = "k long, _loaded_at timestamp_ntz, _source_file string"


def load(spark, folder, name, *keys):
    rows = spark.createDataFrame([(k, datetime(2024, 1, 1), name) for k in keys], SMALL)
    ledger.append(rows, f"{folder}/in", f"{folder}/landed", name)


def consume(spark, folder):
    schema = spark.read.parquet(f"{folder}/in").schema
    changes = streams.read_changes(spark, f"{folder}/in", schema)
    streams.run(ledger.consume_counted(changes, f"{folder}/cp", f"{folder}/out", f"{folder}/taken", streams.AVAILABLE_NOW))


def unread(spark, folder):
    return ledger.has_data(spark, f"{folder}/landed", f"{folder}/taken").first()["has_data"]


def test_the_ledger_tells_unread_loads_without_reading_data(spark, folder):
    load(spark, folder, "a", 1, 2)
    assert unread(spark, folder)
    consume(spark, folder)
    assert not unread(spark, folder)
    load(spark, folder, "a", 3)  # the same name again
    load(spark, folder, "b")  # no rows
    pending = ledger.pending_loads(spark, f"{folder}/landed", f"{folder}/taken")
    assert [tuple(r) for r in pending.collect()] == [("a", 3, 2, 0)]
    read = pending.inputFiles()
    assert read and not any(f"{folder}/in" in f or f"{folder}/out" in f for f in read)
    consume(spark, folder)
    assert not unread(spark, folder)
    assert sorted(r["k"] for r in spark.read.parquet(f"{folder}/out/*").collect()) == [1, 2, 3]


def test_a_repeated_batch_is_counted_once(spark, folder):
    load(spark, folder, "a", 1, 2)
    batch = spark.read.parquet(f"{folder}/in")
    for _ in range(2):
        ledger.take(f"{folder}/out", f"{folder}/taken")(batch, 0)
    assert not unread(spark, folder)
    load(spark, folder, "a", 3)
    assert unread(spark, folder)


def test_a_load_that_stopped_is_unread_until_settled(spark, folder, monkeypatch):
    load(spark, folder, "a", 1)
    noted = ledger._note
    with monkeypatch.context() as m:
        m.setattr(ledger, "_note", lambda *a: noted(*a) if a[4] == ledger.BEGUN else (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            load(spark, folder, "a", 2, 3)
    consume(spark, folder)
    pending = ledger.pending_loads(spark, f"{folder}/landed", f"{folder}/taken").first()
    assert pending["sin_terminar"] == 1
    ledger.settle(spark, spark.read.parquet(f"{folder}/in"), f"{folder}/landed")
    assert not unread(spark, folder)


def test_alerts_in_update_mode(spark, folder):
    def flagged(*flags):
        return spark.createDataFrame([(f,) for f in flags], "_quality_flag string")

    flagged("A", "A", "OK").write.parquet(f"{folder}/in")
    for more in (None, flagged("B", "A"), flagged("OK")):
        if more is not None:
            more.write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema("_quality_flag string").parquet(f"{folder}/in")
        streams.run(streams.alerts_stream(stream, f"{folder}/cp", f"{folder}/alerts"))
    assert {tuple(r) for r in streams.read_alerts(spark, f"{folder}/alerts").collect()} == {("A", 3), ("B", 1)}
    # The second batch stored the changed flags only; storing it again changes nothing.
    second = spark.read.parquet(f"{folder}/alerts/delta/v=1")
    assert {r["_quality_flag"] for r in second.collect()} == {"A", "B"}
    again = spark.createDataFrame(second.select("_quality_flag", "registros", "_batch").collect(), second.schema)
    streams.upsert_newest(f"{folder}/alerts", ["_quality_flag"], streams._latest_count)(again, 1)
    assert {tuple(r) for r in streams.read_alerts(spark, f"{folder}/alerts").collect()} == {("A", 3), ("B", 1)}


def test_lag_comes_from_the_streams_events(spark, folder):
    listener = service.LagListener()
    spark.streams.addListener(listener)
    try:
        txn = generators.gen_transactions(generators.sequence(spark, 300, 2), "2024-01-01")
        mov = generators.gen_movements(generators.sequence(spark, 200, 2), "2024-01-01")
        # Loaded an hour ago, as the load column says.
        ago = (datetime.now(timezone.utc) - timedelta(hours=1)).strftime("%Y-%m-%d %H:%M:%S")
        landing.bronze_append(txn, f"{folder}/bronze/transacciones", "transacciones", as_of=ago)
        landing.bronze_append(mov, f"{folder}/bronze/movimientos", "movimientos", as_of=ago)
        running = service.start_facts(spark, folder, every="1 second")
        service.stop(running)
        deadline = time.time() + 20
        while len(listener._entries) < 4 and time.time() < deadline:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    assert listener.write(spark, folder) >= 4 and listener.write(spark, folder) == 0
    log = spark.read.parquet(f"{folder}/log/refresh")
    by_name = {r["name"]: r for r in log.collect()}
    assert set(by_name) == {"fact_transacciones", "states_fact_transacciones", "fact_movimientos", "states_fact_movimientos"}
    assert by_name["fact_transacciones"]["filas"] == 300 and by_name["fact_movimientos"]["filas"] == 200
    assert all(3600 <= r["actual_lag_sec"] < 3800 for r in by_name.values())
    report = gold.refresh_report(log).collect()
    assert len(report) == log.count() and all(r["actual_lag_min"] >= 60 for r in report)
    assert gold_states.row_total(spark, f"{folder}/states/fact_transacciones") == 300


def test_masks_and_metrics_as_sql_functions(spark):
    assert sql.register_masks(spark) == ["mask_rut", "mask_email", "mask_telefono", "mask_nombre"]
    row = spark.sql("""SELECT mask_rut('11.111.111-1', 'ANALYST_ROLE') a, mask_rut('11.111.111-1', 'SYSADMIN') b,
        mask_telefono('+56912345678', 'X') c, mask_email(null, 'X') d, mask_nombre('Ana', null) e""").first()
    assert tuple(row) == ("**.***.***-*", "11.111.111-1", "+569*****678", "***@masked.local", "***")
    sql.register_checks(spark)
    assert tuple(spark.sql("SELECT rut_invalido('x'), rut_invalido('11.111.111-1'), rut_invalido(null)").first()) == (True, False, False)
    df = spark.createDataFrame([(1, "x", datetime(2024, 1, 1)), (1, None, datetime(2024, 1, 2))], "id long, rut string, at timestamp_ntz")
    df.createOrReplaceTempView("medidos")
    specs = [("NULL_COUNT", "rut"), ("DUPLICATE_COUNT", "id"), ("INVALID_RUT_COUNT", "rut"), ("FRESHNESS", "at")]
    sql.register_metrics(spark, "metricas_medidos", "medidos", specs, "2024-01-03")
    got = sorted(map(tuple, spark.sql("SELECT * FROM metricas_medidos()").collect()))
    assert got == sorted(map(tuple, quality.run_metrics(df, "T", specs, "2024-01-03").select("metrica", "columna", "valor").collect()))


def test_schema_grows_with_the_source(spark, folder):
    payloads = ['{"k": 1}', '{"k": 2, "canal": "web", "o\'x": [1, 2]}', '{"k": "x7"}', '{"k": 1.5}', "nada", None, "", "[1]",
                '{"k": null}', "{}", '{"q": {"a": 1}, "z": null}', '{"a\'b\\"c": 1}']
    raw = spark.createDataFrame(list(enumerate(payloads)), "id long, value string")
    docs = evolution.as_variant(raw, "value")
    evolution.store_schema(spark, folder, {"k": "bigint"})
    first = evolution.read_under(docs, evolution.stored_schema(spark, folder))
    good = {r["id"]: (r["k"], r["extra"]) for r in evolution.good_rows(first).collect()}
    assert good[0] == (1, None) and good[8] == (None, None) and good[9] == (None, None) and '"canal":"web"' in good[1][1]
    dead = {r["id"]: r["error"] for r in evolution.dead_letters(first, ["id", "value"]).collect()}
    assert dead == {2: "wrong type: k", 3: "wrong type: k", **{i: "no JSON object" for i in (4, 5, 6, 7)}}
    proposals = evolution.propose({"k": "bigint"}, docs)
    assert proposals == {"k": "string", "canal": "string", "o'x": "variant", "q": "variant"}
    fields = evolution.promote(spark, folder, proposals)
    assert list(fields)[0] == "k" and evolution.stored_schema(spark, folder) == fields
    assert evolution.stored_schema(spark, folder, 1) == {"k": "bigint"}
    again = evolution.read_under(evolution.as_variant(evolution.dead_letters(first, ["id", "value"]), "value"), fields)
    assert {(r["id"], r["k"]) for r in evolution.good_rows(again).collect()} == {(2, "x7"), (3, "1.5")}
    assert evolution.propose(fields, docs) == {}
    numbers = evolution.as_variant(spark.createDataFrame([(1, '{"k": 1}'), (2, '{"k": 2.5}')], "id long, value string"), "value")
    assert evolution.propose({"k": "bigint"}, numbers) == {"k": "double"}
    assert evolution.observed_types(docs.limit(0)) == {}


def test_bucketed_tables_join_without_a_shuffle(spark, sf):
    t = queries_marts.bucketed(spark, sf, 4)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = processes.scoring_clientes(t["dim_clientes"], t["fact_transacciones"], t["saldos"], fx.AS_OF, fx.CORTES_SCORE)
        plan = out._jdf.queryExecution().executedPlan().toString()
        plain = queries_marts.scoring(spark, sf)
        assert "Exchange" not in plan and "Exchange" in plain._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert out.exceptAll(plain.select(out.columns)).isEmpty() and out.count() == plain.count()
    assert tables.read_table
