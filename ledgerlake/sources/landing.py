"""Landing (Bronze) tables: declared schemas, appends with load columns, simulated daily loads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerlake.functions import money, now, today
from ledgerlake.functions.clock import AsOf

LOAD_COLUMNS = "_loaded_at timestamp_ntz, _source_file string"
BRONZE = {
    "transacciones": "txn_id long, client_id long, producto_id long, sucursal_id long, fecha timestamp_ntz, "
                     "tipo string, monto decimal(15,2), moneda string, estado string, referencia string",
    "clientes": "client_id long, rut string, nombre string, apellido string, email string, telefono string, "
                "direccion string, fecha_registro date, segmento string, sucursal_id long",
    "movimientos": "movimiento_id long, client_id long, producto_id long, sucursal_id long, fecha date, "
                   "tipo_movimiento string, monto decimal(15,2), saldo_posterior decimal(15,2), referencia string",
    "saldos": "saldo_id long, client_id long, producto_id long, fecha_corte date, saldo_contable decimal(15,2), "
              "saldo_disponible decimal(15,2), saldo_promedio_mes decimal(15,2), estado_cuenta string",
}
INITIAL_LOAD = "initial_load"
DAILY_KEY_SHIFT = 100_000_000


def bronze_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(f"{BRONZE[table]}, {LOAD_COLUMNS}")


def to_bronze(df: DataFrame, table: str, source_file: str = INITIAL_LOAD, as_of: AsOf = None) -> DataFrame:
    """Project onto the landing schema; the load columns get their defaults."""
    declared = T.StructType.fromDDL(BRONZE[table])
    return df.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in declared.fields],
        now(as_of).alias("_loaded_at"),
        F.lit(source_file).alias("_source_file"),
    )


def bronze_append(
    df: DataFrame, path: str, table: str, source_file: str = INITIAL_LOAD, as_of: AsOf = None
) -> None:
    """Append a load to the table's directory."""
    to_bronze(df, table, source_file, as_of).write.mode("append").parquet(path)


def _hash32(keys: Sequence[str], salt: str) -> Column:
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(salt)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def sample_rows(df: DataFrame, n: int, keys: Sequence[str], seed: int = 0) -> DataFrame:
    """Exactly ``n`` rows (or all, if fewer), the same ones for the same seed.

    Rows are ordered by a hash of the columns that identify them. A first pass counts rows per
    power of two of the hash, which gives a bound that at least ``n`` rows and few more pass;
    only those rows are sorted, whatever the table's size.
    """
    hashed = df.withColumn("_hash", _hash32(keys, str(seed)))
    sizes = {
        r["_bits"]: r["count"]
        for r in hashed.groupBy(F.length(F.bin("_hash")).alias("_bits")).count().collect()  # at most 32 rows
    }
    seen, bits = 0, 0
    while seen < n and bits < 32:
        bits += 1
        seen += sizes.get(bits, 0)
    ties = [F.col(c).asc_nulls_last() for c in sorted(df.columns)]
    return hashed.filter(F.col("_hash") < (1 << bits)).orderBy("_hash", *ties).limit(n).drop("_hash")


def simulate_daily_load(
    bronze_txn: DataFrame,
    n: int = 100_000,
    as_of: AsOf = None,
    seed: int = 0,
    keys: Sequence[str] = ("txn_id", "client_id", "producto_id"),
) -> DataFrame:
    """A day's new transactions: sampled rows with shifted keys, the present time, amounts changed
    by up to a tenth, a new reference and the day's source file."""

    change = F.lit(900_000) + _hash32(keys, f"f{seed}") % 200_001  # millionths
    factor = (change.cast("decimal(9,0)") / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(7,6)")
    source = F.concat(F.lit("daily_load_"), today(as_of).cast("string"))
    return (
        sample_rows(bronze_txn, n, keys, seed)
        .withColumns({
            "referencia": F.concat(F.lit("REF-"), (_hash32(keys, f"r{seed}") % 999_999 + 1).cast("string")),
            "monto": money(F.col("monto") * factor),
            "fecha": now(as_of),
            "_loaded_at": now(as_of),
            "_source_file": source,
        })
        .withColumn("txn_id", F.col("txn_id") + DAILY_KEY_SHIFT)
    )
