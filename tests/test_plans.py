"""Plans: what reaches the scan, what is broadcast, and what must not appear."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from ledgerlake.operators import layout, marts
from ledgerlake.plans import all_queries, fixtures as fx

WRITES = re.compile(r"^(a9|a1[0-9]|s[0-9]|c7|d11|h7_run|i7|f6|f7|f10|f8|f9|h[79]|h8|h10|i14)")


@pytest.mark.parametrize("name", sorted(n for n in all_queries.QUERIES if not WRITES.match(n)))
def test_no_cross_join_and_no_python(spark, sf, name):
    plan = plan_of(all_queries.QUERIES[name](spark, sf))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert word not in plan
    # Windows never run over a whole table in one task.
    assert not re.search(r"Window \[[^\n]*\], \[[^\n]*\](?=\n)[\s\S]{0,400}SinglePartition", plan) or "c4" in name


@pytest.fixture(scope="module")
def stored(spark, sf, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("layout"))
    fact = marts.dwh_fact_transacciones(fx.transacciones(spark, sf)).drop("etl_timestamp")
    fact.repartition(8).write.parquet(f"{path}/plain")
    layout.cluster_table(fact, f"{path}/clustered", ["fecha", "sucursal_id"], 8)
    return path


def test_filters_and_columns_reach_the_scan(spark, stored):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = plan_of(layout.q1_rango_fechas(spark.read.parquet(f"{stored}/clustered"), "1996-01-01", "1996-03-31"))
    assert "GreaterThanOrEqual(fecha_date,1996-01-01)" in plan
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "client_id" not in schema and "referencia" not in schema


def test_point_lookup_is_pushed(spark, stored):
    assert "EqualTo(client_id,123)" in plan_of(layout.q3_point_lookup(spark.read.parquet(f"{stored}/plain"), 123))


def test_branches_join_after_the_aggregation(spark, sf, stored):
    plan = plan_of(layout.q2_fecha_sucursal(
        spark.read.parquet(f"{stored}/plain"), fx.sucursales(spark, sf), "1996-06-01", "1996-07-01"))
    assert re.search("(BroadcastHash|SortMerge)Join", plan).start() < plan.index("HashAggregate")


@pytest.mark.parametrize("run", [
    lambda t, s: layout.q1_rango_fechas(t, "1996-01-01", "1996-03-31"),
    lambda t, s: layout.q2_fecha_sucursal(t, s, "1996-06-01", "1996-07-01"),
    lambda t, s: layout.q3_point_lookup(t, 23),
    lambda t, s: layout.q4_agregacion_mensual(t),
])
def test_same_results_on_both_layouts(spark, sf, stored, run):
    branches = fx.sucursales(spark, sf)
    plain, clustered = (
        sorted(map(tuple, run(spark.read.parquet(f"{stored}/{n}"), branches).collect()), key=repr)
        for n in ("plain", "clustered"))
    assert plain == clustered


def test_clustered_files_are_skipped(spark, stored):
    lo, hi = F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("1996-03-31").cast("timestamp_ntz")
    touched = {
        n: layout.scan_report(layout.file_statistics(spark, f"{stored}/{n}", ["fecha"]), "fecha", lo, hi).first()
        for n in ("plain", "clustered")}
    assert touched["plain"]["archivos_leidos"] == 8
    assert touched["clustered"]["archivos_leidos"] <= 2 and touched["clustered"]["reduccion_pct"] >= 75
    assert touched["clustered"]["filas_total"] == touched["plain"]["filas_total"]


def test_unknown_bounds_are_read(spark):
    stats = spark.createDataFrame([("a", 10, 100, None, None), ("b", 10, 100, 7, 9)],
                                  "archivo string, filas long, bytes long, min_x int, max_x int")
    assert layout.scan_report(stats, "x", F.lit(1), F.lit(2)).first()["archivos_leidos"] == 1
    assert layout.scan_report(stats, "x", F.lit(8), F.lit(8)).first()["archivos_leidos"] == 2


def test_clustering_information(spark, stored):
    info = {r["columna"]: r for r in layout.clustering_information(
        spark, f"{stored}/clustered", ["fecha_date", "sucursal_id"]).collect()}
    # Eight files in order meet their neighbours at most, in a day that both hold; where borders fall depends on a sample.
    assert info["fecha_date"]["profundidad_promedio"] <= (2 * 2 + 6 * 3) / 8
    assert info["sucursal_id"]["profundidad_promedio"] == info["sucursal_id"]["archivos"] == 8


def test_depths_by_brute_force(spark):
    ranges = [(1, 5), (2, 3), (5, 9), (6, 6), (10, 12), (12, 13), (20, 20)]
    stats = spark.createDataFrame([(f"f{i}", a, b) for i, (a, b) in enumerate(ranges)],
                                  "archivo string, min_x int, max_x int")
    got = {r["archivo"]: r["profundidad"] for r in layout._depths(stats, "x").collect()}
    assert got == {f"f{i}": sum(c <= b and d >= a for c, d in ranges) for i, (a, b) in enumerate(ranges)}


def test_a_hot_day_is_split_over_files(spark, folder):
    rows = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("2024-01-01")).otherwise(
            F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 300).cast("int")).cast("string")
        ).cast("date").alias("fecha"))
    layout.cluster_table(rows, f"{folder}/t", ["fecha"], 9)
    stats = layout.file_statistics(spark, f"{folder}/t", ["fecha"])
    assert stats.agg(F.max("filas")).first()[0] < 700
    assert spark.read.parquet(f"{folder}/t").count() == 3000
