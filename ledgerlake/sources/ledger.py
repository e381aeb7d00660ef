"""Which loads have arrived and which rows a consumer has taken, kept as two small tables.

A load notes itself before it writes and again, with its rows, when it is done. A consumer notes with each
batch the rows it took per load name, under the batch's number. Whether there is unread data
is a comparison of these two tables; the data are not read. A load that began and was never done
counts as unread until ``settle`` has counted what it left behind.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlake.functions.clock import AsOf
from ledgerlake.sources.landing import INITIAL_LOAD, to_bronze
from ledgerlake.sources.tables import versions

BEGUN, DONE = "BEGUN", "DONE"
LANDED = "load_id string, _source_file string, estado string, filas long"
TAKEN = "_source_file string, filas long"


def _note(spark: SparkSession, ledger: str, load_id: str, source_file: str | None, state: str, rows: int | None) -> None:
    spark.createDataFrame([(load_id, source_file, state, rows)], LANDED).coalesce(1).write.mode("append").parquet(ledger)


def land(df: DataFrame, path: str, table: str, ledger: str, source_file: str = INITIAL_LOAD, as_of: AsOf = None) -> None:
    """Append a load to a landing table and note it; its rows are counted as they are written."""
    append(to_bronze(df, table, source_file, as_of), path, ledger, source_file)


def append(rows: DataFrame, path: str, ledger: str, source_file: str) -> None:
    """Append rows that carry their load columns already; all must have this ``_source_file``."""
    spark, load_id, seen = rows.sparkSession, uuid.uuid4().hex, Observation()
    _note(spark, ledger, load_id, source_file, BEGUN, None)
    rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(path)
    _note(spark, ledger, load_id, source_file, DONE, seen.get["n"])


def take(path: str, taken: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` sink that stores a batch and notes its rows per load name, both under its number."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        here = f"{path}/batch={batch_id}"
        batch.write.mode("overwrite").parquet(here)
        stored = batch.sparkSession.read.schema(batch.schema).parquet(here)
        counts = stored.groupBy("_source_file").agg(F.count("*").alias("filas"))
        counts.coalesce(1).write.mode("overwrite").parquet(f"{taken}/v={batch_id}")

    return apply


def consume_counted(changes: DataFrame, checkpoint: str, path: str, taken: str, trigger: dict) -> StreamingQuery:
    return (
        changes.writeStream.foreachBatch(take(path, taken)).option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def pending_loads(spark: SparkSession, ledger: str, taken: str) -> DataFrame:
    """Load names with rows that were not taken: rows landed and taken, and loads that were never done.

    Loads may share a name, so rows are compared, not names.
    """
    landed = spark.read.schema(LANDED).parquet(ledger)
    open_loads = landed.groupBy("load_id", "_source_file").agg(
        F.max(F.when(F.col("estado") == DONE, F.col("filas"))).alias("filas"), F.count_if(F.col("estado") == DONE).alias("_done")
    )
    there = open_loads.groupBy("_source_file").agg(
        F.coalesce(F.sum("filas"), F.lit(0)).alias("llegadas"), F.count_if(F.col("_done") == 0).alias("sin_terminar")
    )
    numbers = versions(spark, taken)
    read = spark.read.schema(TAKEN).parquet(*[f"{taken}/v={v}" for v in numbers]) if numbers else spark.createDataFrame([], TAKEN)
    read = read.groupBy(F.col("_source_file").alias("_read_file")).agg(F.sum("filas").alias("_read"))
    both = there.join(read, F.col("_source_file").eqNullSafe(F.col("_read_file")), "left")
    return both.select("_source_file", "llegadas", F.coalesce("_read", F.lit(0)).alias("leidas"), "sin_terminar").filter(
        "llegadas > leidas or sin_terminar > 0"
    )


def has_data(spark: SparkSession, ledger: str, taken: str) -> DataFrame:
    return pending_loads(spark, ledger, taken).agg((F.count("*") > 0).alias("has_data"))


def settle(spark: SparkSession, table: DataFrame, ledger: str) -> None:
    """After a load that stopped: note what its name has in the table beyond the loads that were done.

    Reads the load column of the table, once per failure, and closes every open load.
    """
    landed = spark.read.schema(LANDED).parquet(ledger)
    done = landed.filter(F.col("estado") == DONE)
    known = done.groupBy(F.col("_source_file").alias("_name")).agg(F.sum("filas").alias("_known"))
    open_loads = landed.join(done.select("load_id"), "load_id", "left_anti").select("load_id", "_source_file")
    found = table.groupBy(F.col("_source_file").alias("_file")).agg(F.count("*").alias("_there"))
    left = (
        open_loads.join(found, F.col("_source_file").eqNullSafe(F.col("_file")), "left")
        .join(known, F.col("_source_file").eqNullSafe(F.col("_name")), "left")
    )
    # Several open loads of one name: the first gets what is there beyond the known rows, the others none.
    rows = {}
    for r in left.orderBy("load_id").collect():
        over = (r["_there"] or 0) - (r["_known"] or 0)
        _note(spark, ledger, r["load_id"], r["_source_file"], DONE, 0 if r["_source_file"] in rows else over)
        rows[r["_source_file"]] = over
