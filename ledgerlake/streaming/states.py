"""Counted states: per key the number of rows and mergeable measures, folded batch by batch.

A distinct count does not add up over batches, but the rows per value do: a value counts while it
has rows. Each batch is reduced to its keys and written under its own number, so a repeated
batch overwrites what it wrote; every few batches all is merged into a new base. A reader adds up the
last base and the batches after it, and leaves out keys whose rows are gone. One base or batch alone has a
row per key as written, and is not grouped again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlake.operators.scale import Measure
from ledgerlake.sources.tables import drop_versions, latest_version, versions

COMPACT_EVERY = 24


@dataclass(frozen=True)
class CountedState:
    """``keys`` and ``types`` (of the measures) are SQL types by name; ``partition`` is a key that files are kept apart by.

    No column may be called ``v``, which numbers the batches' folders.
    """

    keys: dict[str, str]
    measures: dict[str, Measure] = field(default_factory=dict)
    types: dict[str, str] = field(default_factory=dict)
    partition: str | None = None

    def __post_init__(self) -> None:
        if "v" in {c.lower() for c in (*self.keys, *self.measures)}:
            raise ValueError("v is the number of the batch")

    @property
    def schema(self) -> str:
        columns = {**self.keys, "n": "bigint", **{m: self.types[m] for m in self.measures}}
        return ", ".join(f"{name} {kind}" for name, kind in columns.items())

    def _typed(self, df: DataFrame) -> DataFrame:
        kinds = {**self.keys, "n": "bigint", **self.types}
        return df.select(*[F.col(c).cast(kinds[c]).alias(c) for c in (*self.keys, "n", *self.measures)])

    def reduced(self, rows: DataFrame, sign: int = 1) -> DataFrame:
        """Rows as a change of the state; with ``sign`` -1 they are taken away."""
        change = {"n": F.count("*"), **{name: m.first for name, m in self.measures.items()}}
        if sign < 0 and any(m.then is not F.sum for m in self.measures.values()):
            raise ValueError("a lowest or highest value cannot be taken back")
        return self._typed(rows.groupBy(*self.keys).agg(*[(sign * c if sign < 0 else c).alias(name) for name, c in change.items()]))

    def merged(self, changes: DataFrame) -> DataFrame:
        then = [F.sum("n").alias("n"), *[m.then(F.col(name)).alias(name) for name, m in self.measures.items()]]
        return self._typed(changes.groupBy(*self.keys).agg(*then)).filter("n <> 0")

    def fold(
        self, rows: DataFrame, path: str, batch_id: int, removed: DataFrame | None = None, compact_every: int = COMPACT_EVERY
    ) -> None:
        """Add a batch (and take ``removed`` rows away) under its number; merge all every few batches."""
        change = self.reduced(rows)
        if removed is not None:
            change = self.merged(change.unionByName(self.reduced(removed, -1)))
        self._write(change, f"{path}/delta/v={batch_id}")
        if (batch_id + 1) % compact_every == 0:
            spark = rows.sparkSession
            last = latest_version(spark, f"{path}/base", before=batch_id)
            if batch_id not in versions(spark, f"{path}/base"):  # a repeated batch finds its base, which has its rows
                self._write(self.read(spark, path, upto=batch_id), f"{path}/base/v={batch_id}")
            if last is not None:  # readers of the base before may still need what came after it
                drop_versions(spark, f"{path}/delta", last)
                drop_versions(spark, f"{path}/base", last - 1)

    def _write(self, df: DataFrame, where: str) -> None:
        if self.partition:
            df = df.hint("rebalance", self.partition)  # few files a partition, a hot one split by its size
        writer = df.write.mode("overwrite")
        (writer.partitionBy(self.partition) if self.partition else writer).parquet(where)

    def _stored(self, spark: SparkSession, path: str, kind: str, numbers: Sequence[int]) -> DataFrame:
        paths = [f"{path}/{kind}/v={v}" for v in numbers]
        reader = spark.read.schema(f"{self.schema}, v bigint").option("basePath", f"{path}/{kind}")
        return self._typed(reader.parquet(*paths))

    def read(
        self, spark: SparkSession, path: str, upto: int | None = None, extra: DataFrame | None = None, where: Column | None = None
    ) -> DataFrame:
        """The state after the batch ``upto`` (or the last), with ``extra`` rows added, of the keys that pass ``where``."""
        known = [v for v in versions(spark, f"{path}/base") if upto is None or v <= upto]
        base = max(known, default=None)
        later = [v for v in versions(spark, f"{path}/delta") if (base is None or v > base) and (upto is None or v <= upto)]
        if base is None and not later:
            raise FileNotFoundError(f"no batch in {path}")
        parts = [self._stored(spark, path, kind, numbers) for kind, numbers in (("base", [] if base is None else [base]), ("delta", later)) if numbers]
        if extra is not None:
            parts.append(self.reduced(extra))
        changes = parts[0]
        for more in parts[1:]:
            changes = changes.unionByName(more)
        changes = changes if where is None else changes.filter(where)
        alone = len(later) + (base is not None) == 1 and extra is None
        return changes.filter("n <> 0") if alone else self.merged(changes)

    def changed(self, spark: SparkSession, path: str, after: int) -> DataFrame | None:
        """The changes of the batches after a number, or None if some of them have been merged away."""
        there, base = versions(spark, f"{path}/delta"), latest_version(spark, f"{path}/base")
        newest = max([*there, *([] if base is None else [base])], default=after)
        wanted = list(range(after + 1, newest + 1))
        if not set(wanted) <= set(there):
            return None
        return self._stored(spark, path, "delta", wanted) if wanted else spark.createDataFrame([], self.schema)

    def last_batch(self, spark: SparkSession, path: str) -> int | None:
        numbers = versions(spark, f"{path}/delta") + versions(spark, f"{path}/base")
        return max(numbers, default=None)
