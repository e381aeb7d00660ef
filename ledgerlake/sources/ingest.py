"""JSON ingest with schema evolution and a dead-letter output, for batches and streams alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

CORRUPT = "_corrupt"


def parse_json(raw: DataFrame, value: str, schema: T.StructType) -> DataFrame:
    """Known fields as columns, unknown ones kept in ``extra``, and ``_corrupt`` for unreadable rows.

    Unreadable are payloads that are null or empty, that are no JSON object, and those with a field
    that does not fit its type.

    A source that starts to send a new field needs no change here: the field shows up in
    ``extra`` until the schema names it.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    known = [F.lit(n) for n in schema.fieldNames()]
    parsed = raw.withColumns({
        "_row": F.from_json(F.col(value), with_corrupt, options),
        "_all": F.from_json(F.col(value), T.MapType(T.StringType(), T.StringType()), {"mode": "PERMISSIVE"}),
    })
    extra = F.map_filter("_all", lambda k, v: ~k.isin(*known))
    return parsed.select(
        *raw.columns,
        *[F.col(f"_row.{n}").alias(n) for n in schema.fieldNames()],
        F.when(F.size(extra) > 0, extra).alias("extra"),
        F.when(_empty(value) | F.col("_row").isNull(), F.coalesce(F.col(value), F.lit("")))
        .otherwise(F.col(f"_row.{CORRUPT}")).alias(CORRUPT),
    )


def _empty(value: str) -> Column:
    return F.col(value).isNull() | (F.trim(value) == "")


def good_rows(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def dead_letters(parsed: DataFrame, value: str) -> DataFrame:
    """Unreadable rows with the reason, for inspection and replay."""
    readable = F.from_json(F.col(value), T.MapType(T.StringType(), T.StringType()), {"mode": "PERMISSIVE"})
    reason = (
        F.when(_empty(value), "empty payload")
        .when(readable.isNull() | (F.size(readable) == 0), "malformed JSON")
        .otherwise("wrong type of a field")
    )
    return parsed.filter(F.col(CORRUPT).isNotNull()).withColumn("error", reason).select(
        *[c for c in parsed.columns if c not in (CORRUPT, "extra")], "error"
    )


def kafka_source(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Stream of (key, value, timestamp) from Kafka; needs the Kafka package on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .load()
        .select(F.col("key").cast("string"), F.col("value").cast("string"), F.col("timestamp"))
    )


def json_file_source(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """Stream of text lines from a directory that files are dropped into."""
    return spark.readStream.option("maxFilesPerTrigger", max_files).text(path)
