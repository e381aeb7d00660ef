"""Clustered tables under versioned lists of files: what is skipped, what is rewritten, what survives a stop."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import clustered, layout

KEYS = ["dia", "sucursal", "client_id"]


@pytest.fixture(scope="module")
def rows(spark):
    n = F.col("id")
    return spark.range(60_000).select(
        n.alias("txn"), F.date_add(F.lit("2024-01-01").cast("date"), (F.xxhash64(n, F.lit(1)) % 180 + 180).cast("int")).alias("dia"),
        F.pmod(F.xxhash64(n, F.lit(2)), F.lit(40)).alias("sucursal"), F.pmod(F.xxhash64(n, F.lit(3)), F.lit(30_000)).alias("client_id"),
        F.col("id").cast("double").alias("monto"),
    )


def same(a, b):
    return a.count() == b.count() and a.exceptAll(b.select(a.columns)).isEmpty()


def test_a_large_table_gets_more_files_than_asked_for(spark, folder, monkeypatch):
    """A task writes one file; with the given number alone, it would grow with the table."""
    monkeypatch.setattr(layout, "TARGET_FILE_BYTES", 4_000)
    rows = spark.range(3000).select("id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 300).cast("int")).alias("fecha"))
    layout.cluster_table(rows, f"{folder}/a", ["fecha"], 2)
    clustered.write_clustered(rows, f"{folder}/b", ["fecha"], 2)
    clustered.append_load(rows, f"{folder}/b", ["fecha"])
    for stats, loads in ((layout.file_statistics(spark, f"{folder}/a", ["fecha"]), 1), (clustered.clustering_report(spark, f"{folder}/b"), 2)):
        assert stats.count() == 12 * loads and stats.agg(F.sum("filas")).first()[0] == 3000 * loads
    monkeypatch.undo()
    layout.cluster_table(rows, f"{folder}/c", ["fecha"], 2)
    assert layout.file_statistics(spark, f"{folder}/c", ["fecha"]).count() == 2


def test_z_order_lets_every_key_skip(spark, rows, folder):
    plain = f"{folder}/plain"
    rows.repartition(64).write.parquet(plain)
    stored = clustered.write_clustered(rows, f"{folder}/z", KEYS, 64, "z", ["client_id"])
    assert same(stored, rows)
    one = rows.filter("client_id % 7 = 3").first()["client_id"]
    for condition in ("dia between date '2024-07-01' and date '2024-07-20'", "sucursal = 5", f"client_id = {one}"):
        before = clustered.scanned(spark.read.parquet(plain).filter(condition).groupBy().sum("monto"))
        after = clustered.scanned(stored.filter(condition).groupBy().sum("monto"))
        assert before["files"] == after["files"] == 64 and before["rows"] >= 55_000
        assert after["rows"] < 0.6 * before["rows"], condition
    listed = clustered.clustering_report(spark, f"{folder}/z")
    touched = listed.filter("min_dia <= date '2024-07-20' and max_dia >= date '2024-07-01'").count()
    assert touched < 40


def test_bloom_filters_skip_row_groups_for_single_values(spark, folder):
    """Of so many values that Parquet keeps no dictionary, which would tell as well."""
    many = spark.range(800_000).select(F.col("id").alias("dia"), F.xxhash64("id").alias("client_id"))
    one = many.filter("dia = 77").first()["client_id"]
    read = {}
    for name, bloom in (("without", []), ("with", ["client_id"])):
        stored = clustered.write_clustered(many, f"{folder}/{name}", ["dia"], 4, bloom=bloom)
        lookup = stored.filter(F.col("client_id") == one)
        read[name] = clustered.scanned(lookup)["rows"]
        assert lookup.count() == 1
    assert read["with"] <= 0.4 * read["without"]


def brute_z(ranks, bits):
    out = 0
    for b in reversed(range(bits)):
        for rank in ranks:
            out = out * 2 + (rank >> b & 1)
    return out


def test_z_value_interleaves_ranks(spark):
    bounds = {"a": [10, 20, 30], "b": [5]}
    df = spark.createDataFrame([(a, b) for a in (None, 0, 10, 15, 30, 99) for b in (None, 4, 5)], "a long, b long")
    for r in df.withColumn("z", clustered.z_value(df, bounds, 2)).collect():
        ranks = [sum(r[k] is not None and r[k] >= c for c in cuts) for k, cuts in bounds.items()]
        assert r["z"] == brute_z(ranks, 2)
    with pytest.raises(TypeError):
        clustered.rank_bounds(spark.createDataFrame([("x",)], "s string"), ["s"])


def test_overlapping_by_brute_force(spark):
    rnd = random.Random(4)
    for _ in range(6):
        ranges = [(lambda a, w: (a, a + w))(rnd.randint(0, 30), rnd.choice([0, 0, 1, 4, 9])) for _ in range(rnd.randint(1, 12))]
        listed = spark.createDataFrame([(str(i), a, b) for i, (a, b) in enumerate(ranges)] + [("n", None, None)],
                                       "archivo string, min_k long, max_k long")
        want = {
            str(i) for i, (a, b) in enumerate(ranges)
            if any(j != i and ((c < b and a < d) if c < d or a < b else False) for j, (c, d) in enumerate(ranges))
        }
        assert {r["archivo"] for r in clustered.overlapping(listed, "k").collect()} == want


def test_sorting_again_rewrites_only_what_overlaps(spark, rows, folder):
    early, late = rows.filter("dia < date '2024-10-01'"), rows.filter("dia >= date '2024-10-01'")
    clustered.write_clustered(early.unionByName(late.filter("txn % 3 > 0")), folder, ["dia"], 10)
    before = {r["archivo"] for r in clustered.clustering_report(spark, folder).collect()}
    clustered.append_load(late.filter("txn % 3 = 0"), folder, ["dia"], 2)
    replaced = {r["archivo"] for r in clustered.recluster(spark, folder, ["dia"], target_bytes=100_000).collect()}
    after = {r["archivo"] for r in clustered.clustering_report(spark, folder).collect()}
    untouched = before & after
    assert len(untouched) >= 4 and replaced & before and not replaced & after
    assert same(clustered.read_clustered(spark, folder), rows)
    assert clustered.overlapping(clustered.clustering_report(spark, folder), "dia").isEmpty()
    assert clustered.recluster(spark, folder, ["dia"]).isEmpty()
    assert same(clustered.read_clustered(spark, folder, version=1), early.unionByName(late.filter("txn % 3 > 0")))


def test_new_files_do_not_span_kept_ones(spark, folder):
    """Overlaps at both ends of the range with a file in order between them."""
    ends = [(1, 30), (20, 40), (50, 60), (70, 90), (80, 100)]
    made = [spark.range(a, b + 1).select(F.col("id").alias("k"), F.lit(i).alias("u")) for i, (a, b) in enumerate(ends)]
    clustered.write_clustered(made[0], folder, ["k"], 1)
    for df in made[1:]:
        clustered.append_load(df, folder, ["k"])
    clustered.recluster(spark, folder, ["k"], target_bytes=1 << 30)
    assert clustered.overlapping(clustered.clustering_report(spark, folder), "k").isEmpty()
    want = made[0].unionByName(made[1]).unionByName(made[2]).unionByName(made[3]).unionByName(made[4])
    assert same(clustered.read_clustered(spark, folder), want)


def test_a_run_stopped_before_its_commit_changes_nothing(spark, rows, folder, monkeypatch):
    clustered.write_clustered(rows, folder, ["dia"], 4)
    clustered.append_load(rows.limit(100), folder, ["dia"])
    was = clustered.read_clustered(spark, folder).count()

    def stop(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(clustered, "write_version", stop)
        with pytest.raises(RuntimeError):
            clustered.recluster(spark, folder, ["dia"])
    assert clustered.read_clustered(spark, folder).count() == was
    clustered.recluster(spark, folder, ["dia"])
    clustered.drop_unlisted(spark, folder, keep=1)
    assert clustered.read_clustered(spark, folder).count() == was


def test_a_hot_value_is_spread_and_left_alone(spark, rows, folder):
    hot = rows.withColumn("dia", F.when(F.col("txn") % 3 == 0, F.lit("2024-05-05").cast("date")).otherwise(F.col("dia")))
    clustered.write_clustered(hot, folder, ["dia"], 12)
    report = clustered.clustering_report(spark, folder)
    assert report.filter("min_dia = max_dia").count() >= 2
    assert report.agg(F.max("filas")).first()[0] < 12_000
    assert clustered.overlapping(report, "dia").isEmpty()


def test_an_empty_table(spark, rows, folder):
    assert clustered.write_clustered(rows.limit(0), folder, ["dia"], 3).count() == 0
    assert clustered.recluster(spark, folder, ["dia"]).isEmpty()
