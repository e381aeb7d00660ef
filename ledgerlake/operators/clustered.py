"""Tables of sorted files under a versioned list of files, for skipping, appending and sorting again.

A table is a folder of data files and a list of those that count, with each file's rows, bytes and
bounds of the clustering keys. The list is a versioned table, so a load or a re-sort is seen in
whole or not at all: files that no committed list names are nobody's, and a run that stops before its commit
leaves the table as it was. Rows of one key value spread over several files where they are many.

Two orders: ``range`` (by the keys in turn: best for the first key) and ``z`` (the keys' ranks, bits interleaved: all
keys skip some). Columns named in ``bloom`` get Parquet Bloom filters, by which lookups of
single values skip row groups whatever the order.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from ledgerlake.operators.layout import TARGET_FILE_BYTES, files_for
from ledgerlake.sources.tables import read_version, versions, write_version

Z_BITS = 6  # of each key's rank, so 63 bounds a key
_RANKED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def rank_bounds(df: DataFrame, keys: Sequence[str], bits: int = Z_BITS) -> dict[str, list]:
    """Bounds that cut each key's values into about equal parts; at most ``2**bits - 1`` a key, from one scan."""
    for k in keys:
        if not isinstance(df.schema[k].dataType, _RANKED):
            raise TypeError(f"a z-order needs numbers, dates or times, and {k} is none")
    parts = 1 << bits
    shares = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    row = df.agg(*[F.percentile_approx(_number(df, k), shares, 10_000).alias(k) for k in keys]).first()
    return {k: sorted(set(row[k] or [])) for k in keys}


def _number(df: DataFrame, key: str) -> Column:
    kind = df.schema[key].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(key)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(key).cast("timestamp"))
    return F.col(key)


def _rank(number: Column, bounds: list, below: int = 0) -> Column:
    """Number of bounds at or below the value, by halving; null ranks first."""
    if not bounds:
        return F.lit(below)
    half = len(bounds) // 2
    upper = _rank(number, bounds[half + 1 :], below + half + 1)
    return F.when(number >= F.lit(bounds[half]), upper).otherwise(_rank(number, bounds[:half], below))


def z_value(df: DataFrame, bounds: dict[str, list], bits: int = Z_BITS) -> Column:
    """The keys' ranks with their bits interleaved, the first key's highest bit first."""
    value = F.lit(0).cast("long")
    for j, (key, cuts) in enumerate(bounds.items()):
        rank = _rank(_number(df, key), cuts).cast("long")
        for b in range(bits):
            bit = F.shiftright(rank, b).bitwiseAND(F.lit(1))
            value = value.bitwiseOR(F.shiftleft(bit.cast("long"), b * len(bounds) + len(bounds) - 1 - j))
    return value


def write_files(
    df: DataFrame, path: str, keys: Sequence[str], n_files: int, order: str = "range", bloom: Sequence[str] = (), distinct: int = 1_000_000
) -> DataFrame:
    """Write sorted files beside those of the table, and list them with their statistics.

    ``n_files`` is the least number of files; large tables get more (``layout.files_for``).
    """
    spread = F.xxhash64(*[c for c in df.columns if c not in keys])
    by = [F.col(k) for k in keys] if order == "range" else [F.col("_z")]
    ordered = df if order == "range" else df.withColumn("_z", z_value(df, rank_bounds(df, keys)))
    ranged = ordered.withColumn("_spread", spread).repartitionByRange(files_for(df, n_files), *by, F.col("_spread"))
    files = f"{path}/files/{uuid.uuid4().hex}"
    writer = ranged.sortWithinPartitions(*by, *([] if order == "range" else keys)).drop("_spread", "_z").write
    for column in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true").option(
            f"parquet.bloom.filter.expected.ndv#{column}", distinct)
    writer.parquet(files)
    return _listed(df.sparkSession.read.schema(df.schema).parquet(files), keys)


def _listed(stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    bounds = [f(k).alias(f"{n}_{k}") for k in keys for n, f in (("min", F.min), ("max", F.max))]
    size, name = F.col("_metadata.file_size").alias("_size"), F.col("_metadata.file_path").alias("archivo")
    return stored.select(name, size, *keys).groupBy("archivo").agg(F.count("*").alias("filas"), F.max("_size").alias("bytes"), *bounds)


def write_clustered(df: DataFrame, path: str, keys: Sequence[str], n_files: int, order: str = "range", bloom: Sequence[str] = ()) -> DataFrame:
    """Replace the table; it may be read from itself. Returns it as read back."""
    write_version(write_files(df, path, keys, n_files, order, bloom), f"{path}/lists")
    return read_clustered(df.sparkSession, path, df.schema)


def append_load(df: DataFrame, path: str, keys: Sequence[str], n_files: int = 1, bloom: Sequence[str] = ()) -> None:
    """Add a load as files of its own, whatever the others hold."""
    before = read_version(df.sparkSession, f"{path}/lists")
    write_version(before.unionByName(write_files(df, path, keys, n_files, bloom=bloom)), f"{path}/lists")


def read_clustered(spark: SparkSession, path: str, schema: T.StructType | None = None, version: int | None = None) -> DataFrame:
    """The table as a version lists it. The list has a row per file, as Spark's own listing would."""
    names = [r["archivo"] for r in read_version(spark, f"{path}/lists", version).select("archivo").collect()]
    if not names:
        return spark.createDataFrame([], schema)
    return (spark.read if schema is None else spark.read.schema(schema)).parquet(*names)


def overlapping(listed: DataFrame, key: str) -> DataFrame:
    """The files whose range of the key meets another's in more than an end, from a sweep over the range ends.

    Files of one value only overlap with ranges that have the value inside, not with each other, so a
    hot value that was spread over files is left alone. The sweep has two rows a file, not data rows.
    """
    low, high = F.col(f"min_{key}"), F.col(f"max_{key}")
    known = listed.filter(low.isNotNull())
    wide = F.when(low < high, 1).otherwise(0)
    opens = known.select("archivo", low.alias("_at"), F.when(low < high, 3).otherwise(1).alias("_turn"), wide.alias("_wide"))
    closes = known.select("archivo", high.alias("_at"), F.when(low < high, 0).otherwise(2).alias("_turn"), wide.alias("_wide"))
    upto = W.orderBy("_at", "_turn").rowsBetween(W.unboundedPreceding, 0)
    opening = F.col("_turn").isin(1, 3).cast("int")
    seen = opens.unionByName(closes).withColumns({
        "_opened": F.sum(opening).over(upto), "_closed": F.sum(1 - opening).over(upto),
        "_open_wide": F.sum(opening * F.col("_wide")).over(upto) - F.sum((1 - opening) * F.col("_wide")).over(upto),
    })
    at_end = F.max(F.when(F.col("_turn").isin(0, 2), F.col("_opened")))
    at_start = F.max(F.when(F.col("_turn").isin(1, 3), F.col("_closed")))
    found = seen.groupBy("archivo").agg(
        F.max("_wide").alias("_wide"), (at_end - at_start - 1).alias("_others"), F.max("_open_wide").alias("_around")
    )
    met = F.when(F.col("_wide") == 1, F.col("_others") > 0).otherwise(F.col("_around") > 0)
    return found.filter(met).select("archivo")


def recluster(
    spark: SparkSession, path: str, keys: Sequence[str], order: str = "range", bloom: Sequence[str] = (), target_bytes: int = TARGET_FILE_BYTES
) -> DataFrame:
    """Sort the table again where it has lost its order, and return the files that were replaced.

    With ``range`` only files whose ranges of the first key overlap are read and rewritten, the others stay in
    the next list; with ``z`` all are, as a new order's ranks fit no earlier file. A new file may span a gap in which
    a kept file lies; then both are sorted again, so fewer files are kept each time.
    """
    listed = read_version(spark, f"{path}/lists")
    replaced = (overlapping(listed, keys[0]) if order == "range" else listed.select("archivo")).join(listed, "archivo").select(*listed.columns)
    rows = [(r["archivo"], r["bytes"]) for r in replaced.select("archivo", "bytes").collect()]
    if rows:
        schema = read_clustered(spark, path).schema
        old = spark.read.schema(schema).parquet(*[name for name, _ in rows])
        n_files = max(1, -(-sum(size for _, size in rows) // target_bytes))
        made = write_files(old, path, keys, n_files, order, bloom)
        replaced = spark.createDataFrame(replaced.collect(), listed.schema)  # as many rows as files; their list changes
        after = write_version(listed.join(replaced.select("archivo"), "archivo", "left_anti").unionByName(made), f"{path}/lists")
        if order == "range" and not overlapping(after, keys[0]).isEmpty():
            return replaced.unionByName(recluster(spark, path, keys, order, bloom, target_bytes))
    return replaced


def drop_unlisted(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Delete folders of files that none of the last ``keep`` lists names, and the lists before."""
    numbers = versions(spark, f"{path}/lists")[-keep:]
    named = {
        r["archivo"].rsplit("/", 2)[1]
        for v in numbers for r in read_version(spark, f"{path}/lists", v).select("archivo").collect()
    }
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    folder = fs_path(f"{path}/files")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(folder):
        if status.getPath().getName() not in named:
            fs.delete(status.getPath(), True)
    for v in versions(spark, f"{path}/lists")[:-keep]:
        fs.delete(fs_path(f"{path}/lists/v={v}"), True)


def clustering_report(spark: SparkSession, path: str) -> DataFrame:
    """The current list: a row per file with rows, bytes and bounds, without reading data files."""
    return read_version(spark, f"{path}/lists")


def scanned(df: DataFrame) -> dict[str, int]:
    """Files and rows that the scans of a query read, by Spark's own metrics; runs the query."""
    df.collect()
    out = {"files": 0, "rows": 0}
    waiting = [df._jdf.queryExecution().executedPlan()]
    while waiting:
        node = waiting.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            waiting.append(node.executedPlan())
            continue
        if kind.endswith("QueryStageExec"):
            waiting.append(node.plan())
            continue
        if kind == "FileSourceScanExec":
            metrics = node.metrics()
            out["files"] += metrics.apply("numFiles").value()
            out["rows"] += metrics.apply("numOutputRows").value()
        children = node.children()
        waiting.extend(children.apply(i) for i in range(children.size()))
    return out
