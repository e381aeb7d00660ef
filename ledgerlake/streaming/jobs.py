"""Structured Streaming jobs: change reading, Silver refresh, quality gate, ingest.

``AVAILABLE_NOW`` processes what has arrived and stops (tests, scheduled runs); a service passes
``{"processingTime": "10 minutes"}`` for the Silver lag target and 30 minutes for Gold.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerlake.functions.clock import AsOf
from ledgerlake.operators.quality import METRICS, measured_rows, newest, seconds_since
from ledgerlake.operators.scale import Measure, added, newest_per_key
from ledgerlake.sources import ingest
from ledgerlake.sources.tables import drop_versions, latest_version, read_version, versions, write_version
from ledgerlake.streaming.states import CountedState

AVAILABLE_NOW = {"availableNow": True}


def read_changes(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None, glob: str | None = None
) -> DataFrame:
    """Rows appended to a directory since the consumer's position, which its checkpoint holds."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def run(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def consume(changes: DataFrame, checkpoint: str, path: str, trigger: dict = AVAILABLE_NOW) -> StreamingQuery:
    """Append the changes, whatever was derived from them, to a directory exactly once."""
    return (
        changes.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", path)
        .outputMode("append").trigger(**trigger).start()
    )


def stream_has_data(table: DataFrame, consumed: DataFrame, batch: str = "_source_file") -> DataFrame:
    """Whether rows exist that the consumer has not read.

    Loads may share a name, so the rows per name are compared: a table that only grows, read
    exactly once, has unread rows if and only if some name has more rows than were read. Both
    sides are reduced to a row per name before they meet.
    """
    there = table.groupBy(F.col(batch).alias("_load")).agg(F.count("*").alias("_n"))
    read = consumed.groupBy(F.col(batch).alias("_load_read")).agg(F.count("*").alias("_n_read"))
    both = there.join(read, F.col("_load").eqNullSafe(F.col("_load_read")), "left")
    return both.agg((F.count_if(F.col("_n") > F.coalesce("_n_read", F.lit(0))) > 0).alias("has_data"))


COMPACT_EVERY = 24


def upsert_newest(
    path: str, keys: Sequence[str], order: Callable[[], Sequence[Column]], compact_every: int = COMPACT_EVERY
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` sink that keeps the newest row per key.

    A batch is reduced and written on its own, so a small batch costs a small write; every few
    batches all is merged into a new base. A repeated batch overwrites its own files, and a late,
    older row never hides a newer one, because readers compare the rows, not the batches.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        newest_per_key(batch, keys, order()).write.mode("overwrite").parquet(f"{path}/delta/v={batch_id}")
        spark = batch.sparkSession
        # A repeated batch finds its base, which has its rows already; it could not be read and replaced at once.
        if (batch_id + 1) % compact_every == 0 and (last := latest_version(spark, f"{path}/base")) != batch_id:
            merged = read_newest(spark, path, keys, order)
            write_version(merged, f"{path}/base", batch_id)
            # Readers of the base before may still need the deltas after it; older ones are done with.
            if last is not None:
                drop_versions(spark, f"{path}/delta", last)

    return apply


def read_newest(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    order: Callable[[], Sequence[Column]],
    schema: T.StructType | None = None,
) -> DataFrame:
    """Newest row per key over the last base and the batches after it; empty before the first batch,
    with the given schema. A single batch or base holds one row per key as written, and is read as it is."""
    base = latest_version(spark, f"{path}/base")
    parts = [] if base is None else [read_version(spark, f"{path}/base", base)]
    later = [v for v in versions(spark, f"{path}/delta") if base is None or v > base]
    parts += [read_version(spark, f"{path}/delta", v) for v in later]
    if not parts:
        if schema is None:
            raise FileNotFoundError(f"no batch in {path} and no schema given")
        return spark.createDataFrame([], schema)
    if len(parts) == 1:
        return parts[0]
    return newest_per_key(reduce(DataFrame.unionByName, parts), keys, order())


def dedup_stream(
    changes: DataFrame,
    checkpoint: str,
    path: str,
    keys: Sequence[str],
    order: Callable[[], Sequence[Column]],
    trigger: dict = AVAILABLE_NOW,
) -> StreamingQuery:
    """Incremental deduplication: newest row per key wins; read the result with ``read_newest``."""
    return (
        changes.writeStream.foreachBatch(upsert_newest(path, keys, order))
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def quality_alert_counts(flagged: DataFrame) -> DataFrame:
    """Running count per flag on a stream of flagged rows, for update or complete mode."""
    return flagged.filter(F.col("_quality_flag") != "OK").groupBy("_quality_flag").agg(F.count("*").alias("registros"))


def _latest_count():
    return [F.col("_batch").desc()]


def alerts_stream(flagged: DataFrame, checkpoint: str, path: str, trigger: dict = AVAILABLE_NOW) -> StreamingQuery:
    """Keep the alert counts in update mode: a batch stores the flags that changed, under its own number.

    The state is one row per flag. A repeated batch overwrites what it stored; read with ``read_alerts``.
    """
    merge = upsert_newest(path, ["_quality_flag"], _latest_count)

    def apply(batch: DataFrame, batch_id: int) -> None:
        merge(batch.withColumn("_batch", F.lit(batch_id).cast("long")), batch_id)

    return (
        quality_alert_counts(flagged).writeStream.outputMode("update").foreachBatch(apply)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """The newest count of each flag."""
    empty = T.StructType.fromDDL("_quality_flag string, registros long, _batch long")
    return read_newest(spark, path, ["_quality_flag"], _latest_count, empty).drop("_batch")


def metrics_on_change(
    changes: DataFrame,
    checkpoint: str,
    state_path: str,
    results_path: str,
    table: str,
    specs: Sequence[tuple[str, str]],
    as_of: AsOf = None,
    trigger: dict = AVAILABLE_NOW,
) -> StreamingQuery:
    """Measure the table whenever rows arrive, from the new rows and counted states; one result version per batch."""
    sink = measure_batch(state_path, results_path, table, specs, as_of)
    return changes.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def measure_batch(
    state_path: str, results_path: str, table: str, specs: Sequence[tuple[str, str]], as_of: AsOf = None
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` sink for the same values as ``run_metrics`` over all rows up to the batch.

    Null and invalid counts and newest values add up in a state of one row; a duplicate count comes from a
    state of rows per value. A repeated batch overwrites its own change and result, and its result
    does not look at later batches.
    """

    def state(metric: str, column: str, schema: T.StructType) -> tuple[str, CountedState]:
        if metric == "DUPLICATE_COUNT":
            return f"valores_{column}", CountedState({"valor": schema[column].dataType.simpleString()})
        if metric == "FRESHNESS":
            return f"{metric}_{column}", CountedState({}, {"m": Measure(newest(column), F.max)}, {"m": "timestamp_ntz"})
        return f"{metric}_{column}", CountedState({}, {"m": added(METRICS[metric](column))}, {"m": "bigint"})

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark, measured = batch.sparkSession, []
        for metric, column in specs:
            name, counted = state(metric, column, batch.schema)
            present = batch.filter(F.col(column).isNotNull()).select(F.col(column).alias("valor"))
            rows = present if metric == "DUPLICATE_COUNT" else batch
            counted.fold(rows, f"{state_path}/{name}", batch_id)
            after = counted.read(spark, f"{state_path}/{name}", upto=batch_id)
            value = {
                "DUPLICATE_COUNT": F.coalesce(F.sum(F.col("n") - 1), F.lit(0)), "FRESHNESS": seconds_since(F.max("m"), as_of),
            }.get(metric, F.coalesce(F.sum("m"), F.lit(0)))
            measured.append(measured_rows(after.agg(value.cast("long").alias("_m0")), table, [(metric, column)], as_of))
        write_version(reduce(DataFrame.unionByName, measured), results_path, batch_id + 1)

    return apply


def metrics_history(spark: SparkSession, results_path: str) -> DataFrame:
    """All measurements of a table, with the number of the version that holds them as ``medicion``."""
    numbers = versions(spark, results_path)
    if not numbers:
        raise FileNotFoundError(f"no committed version in {results_path}")
    every = spark.read.option("basePath", results_path).parquet(*[f"{results_path}/v={v}" for v in numbers])
    return every.withColumn("medicion", F.col("v").cast("long")).drop("v")


def ingest_json_stream(
    raw: DataFrame,
    value: str,
    schema: T.StructType,
    good_path: str,
    dead_letter_path: str,
    checkpoint: str,
    trigger: dict = AVAILABLE_NOW,
) -> StreamingQuery:
    """Readable rows to one table, unreadable ones to another, each batch under its own number.

    The batch number makes a repeated batch overwrite its own files.
    """

    def split(batch: DataFrame, batch_id: int) -> None:
        parsed = ingest.parse_json(batch, value, schema).persist()  # two outputs, one parse
        good = ingest.good_rows(parsed).withColumn("extra", F.to_json("extra"))
        good.write.mode("overwrite").parquet(f"{good_path}/batch={batch_id}")
        ingest.dead_letters(parsed, value).write.mode("overwrite").parquet(f"{dead_letter_path}/batch={batch_id}")
        parsed.unpersist()

    return raw.writeStream.foreachBatch(split).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def windowed_counts(events: DataFrame, lateness: str = "10 minutes", window: str = "1 hour") -> DataFrame:
    """Events per type and window, duplicates removed, late rows accepted up to the watermark."""
    return (
        events.withColumn("ts", F.col("ts").cast("timestamp"))
        .withWatermark("ts", lateness)
        .dropDuplicatesWithinWatermark(["event_id"])
        .groupBy(F.window("ts", window).alias("w"), "event_type")
        .agg(F.count("*").alias("eventos"), F.sum(F.col("value").cast("decimal(15,2)")).alias("valor"))
        .select(F.col("w.start").alias("desde"), "event_type", "eventos", "valor")
    )
