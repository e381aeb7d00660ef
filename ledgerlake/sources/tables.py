"""Tables as Parquet directories, some of them versioned.

A versioned table keeps ``v=N`` directories. A version counts once Spark has committed it
(``_SUCCESS``), so readers never see half a write and a repeated batch overwrites its own version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}")


def save_table(df: DataFrame, root: str, name: str, mode: str = "overwrite") -> None:
    """Write a result; it must not be read from the directory it replaces."""
    df.write.mode(mode).parquet(f"{root}/{name}")


def create_table_as(spark: SparkSession, root: str, name: str, sql: str) -> DataFrame:
    """CREATE OR REPLACE TABLE name AS sql: a new version, registered under the name."""
    out = write_version(spark.sql(sql), f"{root}/{name}")
    register_view(name, out)
    return out


def register_view(name: str, df: DataFrame) -> None:
    df.createOrReplaceTempView(name)


def save_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """A catalog table in sorted buckets of a key, one file each, kept under ``path``.

    Joins and groupings by the key of tables with as many buckets need no shuffle. A key with
    a large share of the rows makes a large bucket; such tables are better left to shuffle joins.
    """
    (
        df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
        .option("path", path).saveAsTable(name)
    )
    return df.sparkSession.table(name)


def versions(spark: SparkSession, path: str) -> list[int]:
    """Committed versions in order, from one listing of their commit marks."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/v=*/_SUCCESS")
    marks = where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where) or []
    return sorted(int(m.getPath().getParent().getName()[2:]) for m in marks)


def drop_versions(spark: SparkSession, path: str, up_to: int) -> None:
    """Delete the versions up to a number, which a later table holds."""
    for version in versions(spark, path):
        if version <= up_to:
            where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/v={version}")
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def latest_version(spark: SparkSession, path: str, before: int | None = None) -> int | None:
    """Newest committed version, or the newest below ``before``."""
    return max((v for v in versions(spark, path) if before is None or v < before), default=None)


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    version = latest_version(spark, path) if version is None else version
    if version is None:
        raise FileNotFoundError(f"no committed version in {path}")
    return spark.read.parquet(f"{path}/v={version}")


def write_version(df: DataFrame, path: str, version: int | None = None) -> DataFrame:
    """Write the next version (or a given one) and read it back."""
    spark = df.sparkSession
    if version is None:
        version = (latest_version(spark, path) or 0) + 1
    df.write.mode("overwrite").parquet(f"{path}/v={version}")
    return read_version(spark, path, version)
