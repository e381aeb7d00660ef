"""Written intermediates, and a note of those that a stage of a pipeline is done with."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.operators import scale

_notes: ContextVar[list[str] | None] = ContextVar("notes", default=None)


def materialize(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read back; within ``noted`` the folder is noted."""
    out = scale.materialize(df)
    if (notes := _notes.get()) is not None:
        notes.extend({path.rsplit("/", 1)[0] for path in out.inputFiles()})
    return out


@contextmanager
def noted() -> Iterator[list[str]]:
    """Collects the folders written inside, for ``drop`` once what was built from them is written."""
    notes: list[str] = []
    token = _notes.set(notes)
    try:
        yield notes
    finally:
        _notes.reset(token)


@contextmanager
def _set(spark: SparkSession, setting: str, value: str) -> Iterator[None]:
    before = spark.conf.get(setting)
    spark.conf.set(setting, value)
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def small_batches(spark: SparkSession, size: str = "4m"):
    """What is run inside sends rows to Python in batches of about so many bytes, as texts may be of any length."""
    return _set(spark, "spark.sql.execution.arrow.maxBytesPerBatch", size)


def short_shuffles(spark: SparkSession):
    """What is run inside has its shuffle files deleted when its result is there, not when the driver happens to collect its garbage."""
    return _set(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def drop(spark: SparkSession, folders: list[str]) -> None:
    """Delete noted folders through the file system that Spark wrote them to."""
    while folders:
        where = spark._jvm.org.apache.hadoop.fs.Path(folders.pop())
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
