"""The skew-proof building blocks against plain windows and brute force, with hot keys."""

from __future__ import annotations

import random
import statistics
from collections import Counter, defaultdict
from decimal import Decimal as D

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import Window as W, functions as F

from conftest import plan_of
from ledgerlake.operators import layout, processes, scale
from ledgerlake.plans import fixtures as fx
from ledgerlake.plans.queries_marts import fact
from ledgerlake.sources import landing

VALUE = "k string, v decimal(15,2)"


def skewed_rows(n=6000, seed=1):
    """A third of the rows under one key, a third of its values equal, and nulls."""
    rnd, rows = random.Random(seed), []
    for i in range(n):
        key = "hot" if i % 3 == 0 else f"k{rnd.randrange(200)}"
        value = None if i % 50 == 0 else D("7.00") if i % 9 == 0 else D(rnd.randrange(-10**6, 10**8)) / 100
        rows.append((key, value))
    return rows + [(None, D("3.00")), (None, D("4.01"))]


def test_median(spark):
    rows = skewed_rows()
    groups = defaultdict(list)
    for k, v in rows:
        if v is not None:
            groups[k].append(v)
    df = spark.createDataFrame(rows, VALUE)
    got = {r["k"]: r["m"] for r in scale.exact_median(df, ["k"], "v", "m").collect()}
    assert got == {k: statistics.median(v) for k, v in groups.items()}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(-10**14, 10**14), min_size=1, max_size=30))
def test_median_of_any_amounts(spark, cents):
    df = spark.createDataFrame([("k", D(c) / 100) for c in cents], VALUE)
    want = D(statistics.median(D(c) for c in cents)) / 100
    assert scale.exact_median(df, ["k"], "v", "m").first()["m"] == want


def test_median_keeps_the_decimals_of_the_amount(spark):
    df = spark.createDataFrame([(D("1.2345"),), (D("1.2399"),)], "v decimal(18,4)").withColumn("k", F.lit(1))
    assert scale.exact_median(df, ["k"], "v", "m").first()["m"] == D("1.23720")
    with pytest.raises(TypeError):
        scale.exact_median(df.withColumn("v", F.col("v").cast("double")), ["k"], "v", "m")


def test_dense_rank(spark):
    df = spark.createDataFrame(skewed_rows() + [(None, D(2)), (None, D(2)), (None, None)], VALUE)
    plain = df.withColumn("r", F.dense_rank().over(W.partitionBy("k").orderBy(F.col("v").desc_nulls_last())))
    banded = scale.join_null_safe(df, scale.dense_ranks_desc(df, ["k"], "v", "r"), ["k", "v"])
    assert Counter(map(tuple, plain.collect())) == Counter(map(tuple, banded.select("k", "v", "r").collect()))


def test_bands_are_monotone(spark):
    values = sorted({D(random.Random(2).randrange(-10**15, 10**15)) / 100 for _ in range(10)} | {
        D(x) / 100 for x in range(-300, 300)})
    df = spark.createDataFrame([(v,) for v in values], "v decimal(15,2)")
    bands = [r["b"] for r in df.select("v", scale.value_band(F.col("v")).alias("b")).orderBy("v").collect()]
    assert bands == sorted(bands)


def test_positions(spark):
    df = spark.range(5000).repartition(7).select((F.col("id") * 7919 % 5000).alias("x"))
    out = scale.with_position(df, [F.col("x").asc()], "n")
    assert {r["n"]: r["x"] for r in out.collect()} == {i + 1: i for i in range(5000)}
    assert "SinglePartition" not in plan_of(out.select("x"))


@pytest.mark.parametrize("n", [0, 1, 37, 5000, 9000])
def test_sample_is_exact_and_repeatable(spark, n):
    df = spark.range(6000).select(F.col("id").alias("txn_id"))
    first = {r[0] for r in landing.sample_rows(df, n, ["txn_id"], 3).collect()}
    again = {r[0] for r in landing.sample_rows(df.repartition(5), n, ["txn_id"], 3).collect()}
    assert len(first) == min(n, 6000) and first == again


def test_newest_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    out = scale.newest_per_key(df, ["k"], [F.col("id").desc()])
    assert {tuple(r) for r in out.collect()} == {(0, 99), (1, 97), (2, 98)}
    plan = plan_of(out)
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange")


def test_monthly_ranks_are_dense_ranks(spark, sf):
    out = processes.agregacion_mensual_clientes(fact(spark, sf, branch=False))
    rank = F.dense_rank().over(W.partitionBy("mes").orderBy(F.col("neto").desc_nulls_last()))
    assert out.withColumn("r", rank).filter("r <> ranking_mes").isEmpty()


def test_files_of_a_joined_input(spark, sf):
    assert layout.file_count(fact(spark, sf)) == 1


def test_heavy_join_equals_the_pairs(spark, folder):
    """A third of both sides in one client and month; ids repeat, also across months."""
    rnd = random.Random(5)

    def side(n, ids):
        return [(rnd.randrange(ids), 1 if i % 3 == 0 else rnd.randrange(6),
                 f"2024-0{1 if i % 3 == 0 else rnd.randrange(1, 4)}-1{rnd.randrange(9)}", D(rnd.randrange(-500, 900)))
                for i in range(n)]

    t = spark.createDataFrame(side(300, 120), "txn_id long, client_id long, f string, monto decimal(15,2)").select(
        "txn_id", "client_id", F.col("f").cast("timestamp_ntz").alias("fecha"), "monto")
    m = spark.createDataFrame(side(200, 90), "movimiento_id long, client_id long, f string, monto decimal(15,2)").select(
        "movimiento_id", "client_id", F.col("f").cast("date").alias("fecha"), "monto")
    t.createOrReplaceTempView("t_pairs")
    m.createOrReplaceTempView("m_pairs")
    want = spark.sql("""
        select t.client_id, count(distinct txn_id) num_txn, count(distinct movimiento_id) num_mov,
               sum(t.monto) volumen_txn, sum(m.monto) volumen_mov
        from t_pairs t join m_pairs m on t.client_id = m.client_id and trunc(t.fecha, 'month') = trunc(m.fecha, 'month')
        where t.fecha between timestamp_ntz'2024-01-01' and timestamp_ntz'2024-03-01' group by 1""")
    got = layout.q5_join_pesado(t, m, "2024-01-01", "2024-03-01")
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()}
