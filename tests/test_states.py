"""Counted states, incremental Gold and metrics by batch against the same over all rows."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from ledgerlake.operators import gold, quality
from ledgerlake.operators.scale import added, highest
from ledgerlake.plans import jobs
from ledgerlake.streaming import gold_states, jobs as streams
from ledgerlake.streaming.states import CountedState

ROWS = "k long, u long, w long"


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), ROWS)


def values(df):
    return sorted(tuple(r) for r in df.collect())


def state():
    return CountedState({"k": "bigint", "u": "bigint"}, {"w": added(F.sum("w"))}, {"w": "bigint"}, "k")


@pytest.mark.parametrize("compact_every", [1, 2, 24])
def test_state_adds_up_over_batches_and_repeats(spark, folder, compact_every):
    first, second, third = batch(spark, (1, 1, 5), (1, 1, 6), (None, 2, 1)), batch(spark, (1, 2, 7), (None, 2, 3)), batch(spark, (2, None, 1))
    for number, rows in ((0, first), (1, second), (1, second), (2, third)):
        state().fold(rows, folder, number, compact_every=compact_every)
    every = first.union(second).union(third)
    want = values(every.groupBy("k", "u").agg(F.count("*"), F.sum("w")).na.fill(-1))
    assert values(state().read(spark, folder).na.fill(-1)) == want
    assert values(state().read(spark, folder, where=F.col("k") == 1)) == [(1, 1, 2, 11), (1, 2, 1, 7)]


def test_state_forgets_keys_whose_rows_are_gone(spark, folder):
    state().fold(batch(spark, (1, 1, 5), (1, 1, 6), (2, 1, 1)), folder, 0)
    state().fold(batch(spark, (3, 1, 1)), folder, 1, removed=batch(spark, (1, 1, 5), (2, 1, 1)))
    assert values(state().read(spark, folder)) == [(1, 1, 1, 6), (3, 1, 1, 1)]
    assert values(state().read(spark, folder, upto=0)) == [(1, 1, 2, 11), (2, 1, 1, 1)]
    with pytest.raises(ValueError):
        CountedState({"v": "bigint"})
    top = CountedState({"k": "bigint"}, {"w": highest("w")}, {"w": "bigint"})
    with pytest.raises(ValueError):
        top.reduced(batch(spark, (1, 1, 1)), -1)


def test_one_batch_alone_is_read_as_written_and_may_be_repeated(spark, folder):
    """No second grouping of rows that have a row per key; a repeated batch leaves the base that it was merged into."""
    plain = CountedState({"k": "bigint"}, {"w": added(F.sum("w"))}, {"w": "bigint"})
    for number in (0, 0, 1, 1):
        plain.fold(batch(spark, (1, 1, 5), (number, 2, 6)), folder, number, compact_every=2)
        if not number:
            assert "Exchange" not in plan_of(plain.read(spark, folder))
    assert values(plain.read(spark, folder)) == [(0, 1, 6), (1, 3, 16)]


def test_newest_rows_of_one_batch_are_not_sorted_again(spark, folder):
    order = lambda: [F.col("w").desc_nulls_last()]
    streams.upsert_newest(folder, ["k"], order)(batch(spark, (1, 1, 5), (1, 2, 6), (None, 1, 1)), 0)
    one = streams.read_newest(spark, folder, ["k"], order)
    assert "Window" not in plan_of(one) and sorted(r["w"] for r in one.collect()) == [1, 6]


def test_states_for_distinct_counts_carry_no_sums():
    assert not gold_states.client_product().measures and not gold_states.month_product().measures


def test_state_reads_the_partitions_asked_for(spark, folder):
    state().fold(batch(spark, *[(k, 1, 1) for k in range(6)]), folder, 0)
    plan = state().read(spark, folder, where=F.col("k") == 3)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(k" in plan or "PartitionFilters: [(k" in plan


def facts(spark, *rows):
    df = spark.createDataFrame(list(rows), "txn_id long, client_id long, producto_id long, sucursal_id long, fecha timestamp_ntz, estado string, monto double, flag string")
    return df.select(
        "txn_id", "client_id", "producto_id", "sucursal_id", "fecha", F.col("fecha").cast("date").alias("fecha_date"),
        F.trunc(F.col("fecha").cast("date"), "month").alias("mes"), F.dayofweek("fecha").isin(1, 7).alias("es_fin_semana"),
        "estado", F.col("monto").cast("decimal(15,2)").alias("monto"), F.abs(F.col("monto").cast("decimal(15,2)")).alias("monto_absoluto"),
        F.col("flag").alias("_quality_flag"), F.lit(datetime(2024, 1, 1)).cast("timestamp").alias("_silver_processed_at"),
    )


def test_gold_from_states_equals_gold_from_the_fact(spark, folder):
    """Three batches, one repeated; a row of the future comes due later; a later run reads no fact."""
    day = lambda m, d: datetime(2024, m, d, 12)
    first = facts(spark, (1, 1, 10, 5, day(1, 3), "Aprobada", 100.0, "OK"), (2, 1, 10, 5, day(1, 9), "Rechazada", -50.5, "OK"),
                  (3, 2, 11, None, day(2, 1), "Aprobada", 7.0, "OK"), (4, 2, 11, 6, day(5, 20), "Aprobada", 9.0, "FECHA_FUTURA"),
                  (5, None, 11, 6, day(2, 1), "Aprobada", 9.0, "CLIENT_NULL"))
    second = facts(spark, (6, 1, 12, 5, day(2, 3), "Aprobada", 1.0, "OK"), (7, 2, None, 6, day(2, 4), "Aprobada", None, "MONTO_NULL"),
                   (8, 3, None, 6, day(2, 4), "Aprobada", 3.0, "OK"))
    third = facts(spark, (9, 3, 10, 6, day(2, 10), "Aprobada", 2.0, "OK"))
    sink = gold_states.fold_fact(folder)
    every = None
    for number, rows, as_of in ((0, first, "2024-02-05"), (1, second, "2024-02-06"), (1, None, "2024-03-01"), (2, third, "2024-06-01"),
                                (2, None, "2024-08-01")):
        if rows is None:
            rows = (first, second, third)[number]
        else:
            every = rows if every is None else every.unionByName(rows)
        sink(rows, number)
        now_flagged = jobs.current_flags(every, as_of)
        want = gold.client_activity(now_flagged, as_of).select(
            "client_id", "total_txn", "aprobadas", "neto", "_con_monto", "primera_txn", "ultima_txn", "productos",
            F.coalesce("txn_90d", F.lit(0)), F.coalesce(F.col("volumen_90d"), F.lit(0)))
        got = gold_states.activity(spark, folder, every, as_of)
        assert not any("fact" in f for f in got.inputFiles())
        assert values(got.select(*[F.col(c) for c in ("client_id", "total_txn", "aprobadas", "neto", "_con_monto", "primera_txn", "ultima_txn", "productos")],
                                 F.coalesce("txn_90d", F.lit(0)), F.coalesce(F.col("volumen_90d"), F.lit(0)))) == values(want)
        measures = ["mes", "sucursal_id", "total_operaciones", "captaciones", "colocaciones", "neto", "_absoluto", "_con_monto", "_aprobadas",
                    "_fin_semana", "clientes_activos", "productos_operados"]
        assert values(gold_states.months(spark, folder, every, as_of).select(*measures)) == values(
            gold.branch_months(now_flagged).select(*measures))
        alerts = now_flagged.filter("_quality_flag <> 'OK'").groupBy("_quality_flag").count()
        assert values(gold_states.fact_alerts(spark, folder, every, as_of).select("_quality_flag", "registros")) == values(alerts)


def test_only_changed_months_are_computed(spark, folder):
    sink = gold_states.fold_fact(folder)
    rows = [(i, 1, 1, 1, datetime(2024, m, 3), "Aprobada", 1.0, "OK") for i, m in enumerate(range(1, 9))]
    sink(facts(spark, *rows), 0)
    like = facts(spark, *rows)
    gold_states.months(spark, folder, like, "2024-12-01")
    sink(facts(spark, (99, 2, 1, 1, datetime(2024, 4, 7), "Aprobada", 1.0, "OK")), 1)
    changed = gold_states.month_product().changed(spark, f"{folder}/mes_producto", 0)
    assert [str(r[0]) for r in changed.select("mes").collect()] == ["2024-04-01"]
    out = {str(r["mes"]): r["clientes_activos"] for r in gold_states.months(spark, folder, like, "2024-12-01").collect()}
    assert out == {f"2024-{m:02d}-01": 2 if m == 4 else 1 for m in range(1, 9)}


def test_metrics_by_batch_equal_metrics_over_all_rows(spark, folder):
    specs = [("NULL_COUNT", "rut"), ("DUPLICATE_COUNT", "id"), ("INVALID_RUT_COUNT", "rut"), ("FRESHNESS", "at"), ("DUPLICATE_COUNT", "rut")]
    schema = "id long, rut string, at timestamp_ntz"
    made = [
        [(1, "11.111.111-1", datetime(2024, 1, 1)), (1, None, datetime(2024, 1, 3)), (None, "malo", None)],
        [(2, "malo", datetime(2024, 1, 2)), (1, "11.111.111-1", None)],
        [(3, None, datetime(2024, 2, 1))],
    ]
    sink = streams.measure_batch(f"{folder}/state", f"{folder}/results", "T", specs, "2024-03-01")
    for number in (0, 1, 1, 2, 0):
        sink(spark.createDataFrame(made[number], schema), number)
        every = spark.createDataFrame([r for part in made[: number + 1] for r in part], schema)
        got = spark.read.parquet(f"{folder}/results/v={number + 1}")
        assert values(got) == values(quality.run_metrics(every, "T", specs, "2024-03-01"))
    history = streams.metrics_history(spark, f"{folder}/results")
    assert sorted({r["medicion"] for r in history.collect()}) == [1, 2, 3] and history.count() == 15
