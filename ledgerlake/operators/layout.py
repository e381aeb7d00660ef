"""Range queries, physical ordering of tables, and reports on what a query can skip."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ledgerlake.functions import month_of
from ledgerlake.operators.marts import approved
from ledgerlake.operators.scale import added, aggregate_once, mean_of, with_position

TARGET_FILE_BYTES = 256 * 1024 * 1024


def in_period(df: DataFrame, lo: str, hi: str, closed: bool = True) -> DataFrame:
    """Rows with ``lo <= fecha <= hi`` (or ``< hi``); a closed day bound ends at its midnight.

    Parquet filters are not applied to zone-less timestamps, so the bound is repeated on the
    date columns of the table, where it skips files and row groups.
    """
    at = F.col("fecha")
    first, last = F.lit(lo).cast("timestamp_ntz"), F.lit(hi).cast("timestamp_ntz")
    keep = (at >= first) & ((at <= last) if closed else (at < last))
    if "fecha_date" in df.columns:
        keep = keep & F.col("fecha_date").between(first.cast("date"), last.cast("date"))
    elif "mes" in df.columns:
        keep = keep & F.col("mes").between(month_of(first), month_of(last))
    return df.filter(keep)


def q1_rango_fechas(fact: DataFrame, desde: str, hasta: str) -> DataFrame:
    """Count and volume by month and type in a closed date range."""
    return (
        in_period(fact, desde, hasta)
        .groupBy("mes", "tipo")
        .agg(F.count("*").alias("num_txn"), F.sum("monto").alias("volumen"))
        .orderBy("mes", "tipo")
    )


def q2_fecha_sucursal(
    fact: DataFrame, sucursales: DataFrame, desde: str, hasta: str, ids: Sequence[int] = (1, 5, 10, 15, 20)
) -> DataFrame:
    """A half-open period in a few branches."""
    per_branch = (
        in_period(fact, desde, hasta, closed=False)
        .filter(F.col("sucursal_id").isin(*ids))
        .groupBy("sucursal_id")
        .agg(
            F.count("*").alias("num_txn"),
            F.sum("monto").alias("volumen"),
            F.count_distinct("client_id").alias("clientes_unicos"),
        )
    )
    names = sucursales.select("sucursal_id", "comuna")
    return per_branch.join(names, "sucursal_id").select(
        "sucursal_id", "comuna", "num_txn", "volumen", "clientes_unicos"
    )


def q3_point_lookup(fact: DataFrame, client_id: int) -> DataFrame:
    """One client by type."""
    return fact.filter(F.col("client_id") == client_id).groupBy("client_id", "tipo").agg(
        F.count("*").alias("num_txn"),
        F.sum("monto").alias("volumen"),
        F.min("fecha").alias("primera_txn"),
        F.max("fecha").alias("ultima_txn"),
    )


def q4_agregacion_mensual(fact: DataFrame) -> DataFrame:
    """Approved activity by month."""
    return aggregate_once(
        approved(fact).withColumn("mes", month_of("fecha")),
        ["mes"],
        {"total_txn": added(F.count("*")), "volumen_total": added(F.sum("monto")), "_con_monto": added(F.count("monto"))},
        {"clientes_activos": "client_id"},
    ).select(
        "mes", "total_txn", "volumen_total", mean_of("volumen_total", "_con_monto").alias("ticket_promedio"), "clientes_activos"
    ).orderBy("mes")


def _reduced(df: DataFrame, key: str) -> DataFrame:
    """Row count and sum per client, month and id: all that the join needs of a side."""
    return df.groupBy("client_id", "_mes", F.col(key).alias("_id")).agg(
        F.count("*").alias("_n"), F.sum("monto").alias("_total")
    )


def _client_months(reduced: DataFrame, name: str) -> DataFrame:
    return reduced.groupBy("client_id", "_mes").agg(F.sum("_n").alias(f"{name}_n"), F.sum("_total").alias(name))


def q5_join_pesado(fact: DataFrame, movimientos: DataFrame, desde: str, hasta: str, n: int = 100) -> DataFrame:
    """Transactions joined to the movements of the same client and month; top by volume.

    The sums count every pair, so a transaction weighs as often as its month has movements. No
    pair is built: each side is reduced to client and month, and a sum over pairs is one side's
    sum times the other side's count. Distinct ids are counted on their own side.
    """
    t = in_period(fact, desde, hasta).withColumn("_mes", month_of("fecha"))
    first = F.trunc(F.lit(desde).cast("date"), "month")
    after = F.add_months(F.trunc(F.lit(hasta).cast("date"), "month"), 1)
    m = movimientos.filter((F.col("fecha") >= first) & (F.col("fecha") < after)).withColumn("_mes", month_of("fecha"))

    sides = {"num_txn": _reduced(t, "txn_id"), "num_mov": _reduced(m, "movimiento_id")}
    both = _client_months(sides["num_txn"], "_t").join(_client_months(sides["num_mov"], "_m"), ["client_id", "_mes"])
    out = both.groupBy("client_id").agg(
        F.sum(F.col("_t") * F.col("_m_n")).alias("volumen_txn"), F.sum(F.col("_m") * F.col("_t_n")).alias("volumen_mov")
    )
    for name, side in sides.items():
        ids = side.join(both.select("client_id", "_mes"), ["client_id", "_mes"], "left_semi")
        out = out.join(ids.groupBy("client_id").agg(F.count_distinct("_id").alias(name)), "client_id", "left")
    return (
        out.select("client_id", F.coalesce("num_txn", F.lit(0)).alias("num_txn"),
                   F.coalesce("num_mov", F.lit(0)).alias("num_mov"), "volumen_txn", "volumen_mov")
        .orderBy(F.col("volumen_txn").desc_nulls_last(), F.col("client_id").asc())
        .limit(n)
    )


def file_count(df: DataFrame) -> int:
    """Files of about 256 MB for the table, from the sizes of the files it is read from."""
    listed = df.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("b")) if _stored(df) else None
    total = listed.groupBy("f").agg(F.max("b").alias("b")).agg(F.sum("b")).first()[0] if listed is not None else _row_bytes(df)
    return max(1, -(-(total or 0) // TARGET_FILE_BYTES))


def files_for(df: DataFrame, least: int) -> int:
    """At least so many files, and more where a file would have over 256 MB of rows.

    A file is written by one task, so a fixed number would let that task grow with the table.
    """
    return max(least, -(-_row_bytes(df) // TARGET_FILE_BYTES))


def _stored(df: DataFrame) -> bool:
    """Whether the table is read from files as it is, with no operator between."""
    try:
        return df.select("_metadata.file_path") is not None
    except AnalysisException:
        return False


def _row_bytes(df: DataFrame) -> int:
    """Bytes of a derived table: its rows times the schema's row size, both known without guesses."""
    return df.count() * sum(20 if f.dataType.simpleString() == "string" else 8 for f in df.schema.fields)


def cluster_table(df: DataFrame, path: str, keys: Sequence[str], n_files: int | None = None) -> DataFrame:
    """Write the table in ranges of the keys, sorted inside each file, and read it back.

    A row hash is the last range key, so one key value with a large share of the rows is split
    over several files. A zone-less ``fecha`` gets a date twin that files can be skipped on.
    ``n_files`` is the least number of files; large tables get more (``files_for``).
    """
    if "fecha" in df.columns and "fecha_date" not in df.columns and dict(df.dtypes)["fecha"] != "date":
        df = df.withColumn("fecha_date", F.col("fecha").cast("date"))
    spread = F.xxhash64(*[c for c in df.columns if c not in keys])
    ranged = df.withColumn("_spread", spread).repartitionByRange(
        files_for(df, n_files) if n_files else file_count(df), *[F.col(k) for k in keys], F.col("_spread")
    )
    ranged.sortWithinPartitions(*keys).drop("_spread").write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_statistics(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Rows, bytes and the bounds of the columns per file, by a scan of these columns.

    Bounds are null where a file holds no value.
    """
    bounds = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))]
    return (
        spark.read.parquet(path)
        .select(F.col("_metadata.file_path").alias("archivo"), F.col("_metadata.file_size").alias("_size"), *columns)
        .groupBy("archivo")
        .agg(F.count("*").alias("filas"), F.max("_size").alias("bytes"), *bounds)
    )


def _depths(stats: DataFrame, column: str) -> DataFrame:
    """How many files' ranges meet each file's range, from a sweep over the range ends.

    The sweep holds two rows per file, not data rows; no pairs of files are formed.
    """
    low, high = F.col(f"min_{column}"), F.col(f"max_{column}")
    ends = stats.select("archivo", low.alias("_at"), F.lit(0).alias("_end")).unionByName(
        stats.select("archivo", high.alias("_at"), F.lit(1).alias("_end"))
    )
    sweep = W.orderBy("_at", "_end").rowsBetween(W.unboundedPreceding, 0)
    seen = ends.withColumns({
        "_opened": F.sum(F.lit(1) - F.col("_end")).over(sweep),
        "_closed": F.sum("_end").over(sweep),
    })
    # Opened up to its own end, less those closed before its own start.
    return seen.groupBy("archivo").agg(
        (F.max(F.when(F.col("_end") == 1, F.col("_opened"))) - F.max(F.when(F.col("_end") == 0, F.col("_closed"))))
        .alias("profundidad")
    )


def clustering_information(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Quality of the order per column: number of files, mean overlaps and depth."""
    return clustering_of(file_statistics(spark, path, columns), columns)


def clustering_of(stats: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same from a table of bounds per file."""
    out = None
    for column in columns:
        depth = _depths(stats.filter(F.col(f"min_{column}").isNotNull()), column)
        one = depth.agg(
            F.lit(column).alias("columna"),
            F.count("*").alias("archivos"),
            F.avg(F.col("profundidad") - 1).alias("solapes_promedio"),
            F.avg("profundidad").alias("profundidad_promedio"),
            F.max("profundidad").alias("profundidad_maxima"),
            F.count_if(F.col("profundidad") == 1).alias("archivos_sin_solape"),
        )
        out = one if out is None else out.unionByName(one)
    return out


def scan_report(stats: DataFrame, column: str, lo: Column, hi: Column) -> DataFrame:
    """Files, rows and bytes that ``lo <= column <= hi`` cannot skip; unknown bounds cannot be skipped."""
    touched = F.coalesce((F.col(f"max_{column}") >= lo) & (F.col(f"min_{column}") <= hi), F.lit(True))
    share = F.count_if(touched) / F.nullif(F.count("*"), F.lit(0))
    return stats.agg(
        F.count("*").alias("archivos_total"),
        F.count_if(touched).alias("archivos_leidos"),
        F.sum("filas").alias("filas_total"),
        F.coalesce(F.sum(F.when(touched, F.col("filas"))), F.lit(0)).alias("filas_leidas"),
        F.sum("bytes").alias("bytes_total"),
        F.coalesce(F.sum(F.when(touched, F.col("bytes"))), F.lit(0)).alias("bytes_leidos"),
        F.round((1 - share) * 100, 1).alias("reduccion_pct"),
    )


def _paired_runs(log: DataFrame, before: str, after: str, query_type: str) -> DataFrame:
    """The k-th query before next to the k-th query after, by start time."""
    runs = log.filter(
        F.col("query_tag").isin(before, after) & (F.col("query_type") == query_type) & (F.col("bytes_scanned") > 0)
    )
    ties = [c for c in ("event_id", "query_text") if c in log.columns]
    order = [F.col(c).asc_nulls_last() for c in ("start_time", *ties)]
    measures = ["bytes_scanned", "partitions_scanned", "partitions_total", "total_elapsed_time"]
    # Each tag is numbered on its own; a single tag may hold most of the log.
    numbered = reduce(DataFrame.unionByName, [
        with_position(runs.filter(F.col("query_tag") == tag).select("query_tag", "start_time", *ties, *measures),
                      order, "query")
        for tag in (before, after)
    ])
    sides = [
        F.max(F.when(F.col("query_tag") == tag, F.col(m))).alias(f"{side}_{m}")
        for side, tag in (("nc", before), ("wc", after)) for m in measures
    ]
    return numbered.groupBy("query").agg(*sides).filter(
        F.col("nc_bytes_scanned").isNotNull() & F.col("wc_bytes_scanned").isNotNull()
    )


def _exact(c: str) -> Column:
    return F.col(c).cast("decimal(18,0)")


def _reduction() -> Column:
    return (_exact("nc_bytes_scanned") - _exact("wc_bytes_scanned")) / F.nullif(
        _exact("nc_bytes_scanned"), F.lit(0).cast("decimal(18,0)")
    )


def compare_scans(
    log: DataFrame, before: str = "BENCH_NO_CLUSTER", after: str = "BENCH_WITH_CLUSTER", query_type: str = "SELECT"
) -> DataFrame:
    """Bytes, partitions and seconds of each query before and after the re-ordering."""
    mega = F.lit(1024 * 1024).cast("decimal(7,0)")
    side = {"nc": "sin", "wc": "con"}
    mb = [F.round(_exact(f"{s}_bytes_scanned") / mega, 1).alias(f"mb_{n}_cluster") for s, n in side.items()]
    parts = [
        F.concat_ws("/", f"{s}_partitions_scanned", f"{s}_partitions_total").alias(f"partitions_{n}")
        for s, n in side.items()
    ]
    seconds = [F.round(_exact(f"{s}_total_elapsed_time") / 1000, 2).alias(f"seg_{n}_cluster") for s, n in side.items()]
    return (
        _paired_runs(log, before, after, query_type)
        .select("query", *mb, *parts, F.round(_reduction() * 100, 1).alias("reduccion_pct"), *seconds)
        .orderBy("query")
    )


def extrapolate(
    log: DataFrame,
    current_tb: int = 260,
    before: str = "BENCH_NO_CLUSTER",
    after: str = "BENCH_WITH_CLUSTER",
    query_type: str = "SELECT",
) -> DataFrame:
    """The mean reduction applied to a monthly scanning volume."""
    mean = F.avg(_reduction().cast("decimal(28,12)"))
    return _paired_runs(log, before, after, query_type).agg(
        F.lit(current_tb).alias("tb_mes_actual"),
        F.round(current_tb * (1 - mean), 1).alias("tb_mes_estimado"),
        F.round(mean * 100, 1).alias("reduccion_promedio_pct"),
    )
