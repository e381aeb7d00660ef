"""Refresh as a service: streams with a trigger each, and a log of their lag taken from their own events.

A stream observes the newest ``_loaded_at`` of its batches. The listener gets it with each batch's
progress and takes the time from there to the end of the batch: the lag from source to commit. Entries
wait in the listener until ``write`` appends them to the refresh log that ``gold.refresh_report`` reads.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone
from threading import Lock

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from ledgerlake.operators import silver
from ledgerlake.sources.landing import bronze_schema
from ledgerlake.sources.tables import save_table
from ledgerlake.streaming import jobs as streams
from ledgerlake.streaming.gold_states import fold_fact, fold_flags

TARGET_LAG = {"SILVER": 600, "GOLD": 1800}
SEEN = "source"  # name of the observation
LOG = (
    "name string, schema_name string, target_lag_sec long, actual_lag_sec double, refresh_trigger string, "
    "refresh_status string, last_completed_refresh_time timestamp_ntz, filas long"
)


class LagListener(StreamingQueryListener):
    """Keeps an entry per batch with rows of the streams named ``LAYER.table``."""

    def __init__(self) -> None:
        self._entries: list[tuple] = []
        self._names: dict[str, str] = {}
        self._lock = Lock()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        with self._lock:
            self._names[str(event.runId)] = event.name or ""

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        seen = (progress.observedMetrics or {}).get(SEEN)
        layer, _, table = (progress.name or "").partition(".")
        if layer not in TARGET_LAG or seen is None or not seen["n"]:
            return
        began = datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00"))
        done = began + timedelta(milliseconds=progress.durationMs.get("triggerExecution", 0))
        done = done.astimezone(timezone.utc).replace(tzinfo=None)
        lag = (done - seen["newest"]).total_seconds() if seen["newest"] is not None else None
        with self._lock:
            self._entries.append((table, layer, TARGET_LAG[layer], lag, "STREAM", "SUCCEEDED", done, seen["n"]))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        with self._lock:
            layer, _, table = self._names.pop(str(event.runId), "").partition(".")
            if layer in TARGET_LAG and event.exception:
                done = datetime.now(timezone.utc).replace(tzinfo=None)
                self._entries.append((table, layer, TARGET_LAG[layer], None, "STREAM", "FAILED", done, None))

    def write(self, spark: SparkSession, root: str) -> int:
        """Append the waiting entries to the refresh log; returns how many."""
        with self._lock:
            entries, self._entries = self._entries, []
        if entries:
            save_table(spark.createDataFrame(entries, LOG).coalesce(1), root, "log/refresh", "append")
        return len(entries)


def observed(changes: DataFrame) -> DataFrame:
    return changes.observe(SEEN, F.max("_loaded_at").alias("newest"), F.count(F.lit(1)).alias("n"))


def start_facts(
    spark: SparkSession, root: str, builds: dict[str, Callable[[DataFrame], DataFrame]] | None = None, every: str = "10 minutes"
) -> list[StreamingQuery]:
    """Silver facts and the Gold states behind them as running streams, triggered every so often.

    ``builds`` gives the Silver step of each landing table. A stopped service goes on from its checkpoints.
    """
    builds = builds or {"transacciones": silver.silver_fact_transacciones, "movimientos": silver.silver_fact_movimientos}
    trigger, running = {"processingTime": every}, []
    for source, build in builds.items():
        name = f"fact_{source}"
        changes = streams.read_changes(spark, f"{root}/bronze/{source}", bronze_schema(source))
        new = build(observed(changes))
        running.append(
            new.writeStream.format("parquet").queryName(f"SILVER.{name}").option("path", f"{root}/silver/{name}")
            .option("checkpointLocation", f"{root}/_checkpoints/{name}").outputMode("append").trigger(**trigger).start()
        )
        fold = fold_fact if source == "transacciones" else fold_flags
        spark.createDataFrame([], new.schema).write.mode("ignore").parquet(f"{root}/silver/{name}")
        silver_rows = streams.read_changes(spark, f"{root}/silver/{name}", new.schema)
        running.append(
            observed(silver_rows).writeStream.queryName(f"GOLD.states_{name}").foreachBatch(fold(f"{root}/states/{name}"))
            .option("checkpointLocation", f"{root}/_checkpoints/states_{name}").trigger(**trigger).start()
        )
    return running


def stop(running: list[StreamingQuery]) -> None:
    """Let every stream finish what has arrived, then stop it."""
    for query in running:
        query.processAllAvailable()
    for query in running:
        query.stop()
