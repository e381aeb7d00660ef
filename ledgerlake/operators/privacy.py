"""Masking by role, pseudonyms on request, and the audit of deletion requests."""

from __future__ import annotations

import secrets
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ledgerlake.functions import MASKS, PRIVILEGED_ROLES, now, short_hash
from ledgerlake.functions.clock import AsOf
from ledgerlake.functions.masking import DELETED_EMAIL_SUFFIX
from ledgerlake.operators.scale import with_position

# Which mask each column gets, and the columns that hold personal data.
POLICIES = {"rut": "rut", "email": "email", "telefono": "telefono", "nombre": "nombre", "apellido": "nombre"}
# Also hides the full name and the address, which the default map leaves readable.
STRICT_POLICIES = {**POLICIES, "nombre_completo": "nombre", "direccion": "nombre"}
DIM_COLUMNS = ("nombre", "apellido", "nombre_completo", "email", "rut", "telefono", "direccion")
RAW_COLUMNS = ("nombre", "apellido", "email", "rut", "telefono", "direccion")

DELETION_REQUESTS = T.StructType([
    T.StructField("request_id", T.LongType(), False),
    T.StructField("user_id", T.LongType(), False),
    T.StructField("user_identifier", T.StringType()),
    T.StructField("request_source", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("requested_at", T.TimestampNTZType()),
    T.StructField("processed_at", T.TimestampNTZType()),
    T.StructField("status", T.StringType()),
    T.StructField("processed_by", T.StringType()),
    T.StructField("tables_affected", T.ArrayType(T.StringType())),
    T.StructField("rows_affected", T.LongType()),
    T.StructField("hash_algorithm", T.StringType()),
    T.StructField("notes", T.StringType()),
])
DELETION_LOG = T.StructType([
    T.StructField("log_id", T.LongType()),
    T.StructField("request_id", T.LongType(), False),
    T.StructField("table_name", T.StringType(), False),
    T.StructField("rows_updated", T.LongType()),
    T.StructField("columns_hashed", T.ArrayType(T.StringType())),
    T.StructField("executed_at", T.TimestampNTZType()),
    T.StructField("executed_by", T.StringType()),
])


def mask(column: str, policy: str, role: str, privileged: Sequence[str] = PRIVILEGED_ROLES) -> Column:
    """The column as the role may see it."""
    value = F.col(column)
    return value if role in privileged else MASKS[policy](value)


def apply_masking(
    df: DataFrame,
    role: str,
    policies: dict[str, str] = POLICIES,
    privileged: Sequence[str] = PRIVILEGED_ROLES,
) -> DataFrame:
    """Mask the columns of the policy map that the table has, in one projection."""
    return df.withColumns({c: mask(c, p, role, privileged) for c, p in policies.items() if c in df.columns})


def clients_view(df: DataFrame, ids: Sequence[int], columns: Sequence[str]) -> DataFrame:
    """Chosen clients, before or after a change."""
    return df.filter(F.col("client_id").isin(*ids)).select(*columns).orderBy("client_id")


def new_salt(spark: SparkSession) -> DataFrame:
    """A fresh random salt as a one-row table: it never shows in a plan and is never stored."""
    return salt_table(spark, secrets.token_hex(16))


def salt_table(spark: SparkSession, salt: str) -> DataFrame:
    return spark.createDataFrame([(salt,)], "salt string")


def pseudonymize(
    df: DataFrame,
    targets: DataFrame,
    columns: Sequence[str],
    salt: DataFrame | None = None,
    as_of: AsOf = None,
    key: str = "client_id",
    width: int = 8,
) -> DataFrame:
    """Replace the columns of the target clients by short salted hashes; other rows stay as they are.

    ``targets`` holds the keys, one row each, and either a ``_salt`` column of their own or the
    shared one-row ``salt``. A small target list is broadcast, so the table is not shuffled; a
    large one joins by shuffle.
    """
    if "_salt" not in targets.columns:
        targets = targets.withColumn("_salt", salt.scalar())
    marked = df.join(targets.select(key, "_salt"), key, "left")
    hit = F.col("_salt").isNotNull()
    changes = {}
    for c in columns:
        hashed = short_hash(F.col(c), F.col("_salt"), width)
        if c == "email":
            hashed = F.concat(hashed, F.lit(DELETED_EMAIL_SUFFIX))
        changes[c] = F.when(hit, hashed).otherwise(F.col(c))
    if "pseudonymized" in df.columns:
        changes["pseudonymized"] = hit | F.col("pseudonymized")
    if "pseudonymized_at" in df.columns:
        stamp = now(as_of).cast(df.schema["pseudonymized_at"].dataType)
        changes["pseudonymized_at"] = F.when(hit, stamp).otherwise(F.col("pseudonymized_at"))
    return marked.withColumns(changes).select(*df.columns)


def new_requests(requests: DataFrame, dim: DataFrame, last_id: int = 0, as_of: AsOf = None) -> DataFrame:
    """Request rows with their defaults, the identifier looked up in the dimension, and new ids.

    Ids follow the highest one in use, in order of the client id.
    """
    given = set(requests.columns)
    identifiers = dim.select(F.col("client_id").alias("user_id"), F.col("rut").alias("user_identifier"))
    rows = requests.join(identifiers, "user_id", "left")
    defaults = {
        "request_source": F.lit("web_form"),
        "reason": F.lit(None).cast("string"),
        "requested_at": now(as_of),
        "processed_at": F.lit(None).cast("timestamp_ntz"),
        "status": F.lit("PENDING"),
        "processed_by": F.lit(None).cast("string"),
        "tables_affected": F.lit(None).cast("array<string>"),
        "rows_affected": F.lit(None).cast("long"),
        "hash_algorithm": F.lit("SHA2-256"),
        "notes": F.lit(None).cast("string"),
    }
    rows = rows.withColumns({c: v for c, v in defaults.items() if c not in given})
    order = [F.col("user_id").asc(), F.col("requested_at").asc(), F.col("reason").asc_nulls_last()]
    numbered = with_position(rows, order, "_n").withColumn("request_id", F.col("_n") + last_id)
    return numbered.select(*DELETION_REQUESTS.fieldNames())


@dataclass
class DeletionResult:
    """What one deletion run produces; nothing is written yet."""

    tables: dict[str, DataFrame]
    requests: DataFrame
    log: DataFrame


def process_deletion_requests(
    requests: DataFrame,
    tables: dict[str, tuple[DataFrame, Sequence[str]]],
    salt: DataFrame,
    as_of: AsOf = None,
    executed_by: str = "ledgerlake",
    last_log_id: int = 0,
    earlier: DataFrame | None = None,
) -> DeletionResult:
    """Process every pending request in one run: one rewrite per table, not one per request.

    Each request has its own salt, derived from the run's secret. A client asked for twice is
    hashed once. A request whose client is in no table completes with zero rows. ``earlier`` is the
    log of a run that broke off: what it says of a pending request and a table is not done again.
    """
    pending = requests.filter("status = 'PENDING'")
    per_request = F.left(F.sha2(F.concat_ws(":", salt.scalar(), F.col("request_id").cast("string")), 256), F.lit(32))
    # The lowest pending request of a client gives the salt; aggregated, so a flood of requests
    # for one client is reduced before the shuffle.
    targets = (
        pending.groupBy(F.col("user_id").alias("client_id"))
        .agg(F.min("request_id").alias("request_id"))
        .select("client_id", per_request.alias("_salt"))
    )
    changed, logs, all_targets = {}, None, targets
    asked = pending.select("request_id", F.col("user_id").alias("client_id"))
    for name, (df, columns) in tables.items():
        open_, targets = asked, all_targets
        if earlier is not None:
            done = asked.join(earlier.filter(F.col("table_name") == name).select("request_id"), "request_id", "left_semi")
            open_ = asked.join(done.select("request_id"), "request_id", "left_anti")
            targets = all_targets.join(done.select("client_id").distinct(), "client_id", "left_anti")
        changed[name] = pseudonymize(df, targets, columns, as_of=as_of)
        per_client = (
            df.join(targets.select("client_id"), "client_id", "left_semi")
            .groupBy("client_id").agg(F.count("*").alias("rows_updated"))
        )
        one = open_.join(
            per_client, "client_id", "left"
        ).select(
            "request_id",
            F.lit(name).alias("table_name"),
            F.coalesce("rows_updated", F.lit(0)).alias("rows_updated"),
            F.array(*[F.lit(c) for c in columns]).alias("columns_hashed"),
            now(as_of).alias("executed_at"),
            F.lit(executed_by).alias("executed_by"),
        )
        logs = one if logs is None else logs.unionByName(one)
    counted = logs.select("request_id", "rows_updated")
    if earlier is not None:
        counted = counted.unionByName(earlier.join(asked, "request_id", "left_semi").select("request_id", "rows_updated"))
    totals = counted.groupBy("request_id").agg(F.sum("rows_updated").alias("_rows"))
    # Two log rows per table and request: ids from the request keep the numbering free of a sort.
    names = list(tables)
    place = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("table_name"))
    log = logs.withColumn(
        "log_id", (F.col("request_id") - 1) * len(names) + place + F.lit(last_log_id)
    ).select(*DELETION_LOG.fieldNames())
    done = F.col("_rows").isNotNull()
    updated = (
        requests.join(totals, "request_id", "left")
        .withColumns({
            "status": F.when(done, "COMPLETED").otherwise(F.col("status")),
            "processed_at": F.when(done, now(as_of)).otherwise(F.col("processed_at")),
            "processed_by": F.when(done, executed_by).otherwise(F.col("processed_by")),
            "tables_affected": F.when(done, F.array(*[F.lit(n) for n in names])).otherwise(F.col("tables_affected")),
            "rows_affected": F.when(done, F.col("_rows")).otherwise(F.col("rows_affected")),
        })
        .select(*requests.columns)
    )
    return DeletionResult(changed, updated, log)


def mark_processing(requests: DataFrame) -> DataFrame:
    status = F.when(F.col("status") == "PENDING", "PROCESSING").otherwise(F.col("status"))
    return requests.withColumn("status", status)


def mark_failed(requests: DataFrame, error: str) -> DataFrame:
    """Pending or running requests of a run that broke, with the error text."""
    open_ = F.col("status").isin("PENDING", "PROCESSING")
    return requests.withColumns({
        "notes": F.when(open_, F.lit(error)).otherwise(F.col("notes")),
        "status": F.when(open_, "FAILED").otherwise(F.col("status")),
    })


def deletion_messages(requests: DataFrame, ids: DataFrame, refuse_done: bool = False) -> DataFrame:
    """The answer to each asked request id: done, refused for its status, or unknown.

    With ``refuse_done`` the request was asked for anew: whatever its status, it is not processed again.
    """
    asked = ids.select("request_id").distinct()
    ended = F.lit(not refuse_done)
    text = (
        F.when(F.col("status").isNull(), F.concat(F.lit("ERROR: Solicitud "), F.col("request_id"), F.lit(" no existe")))
        .when(ended & (F.col("status") == "COMPLETED"), F.concat(
            F.lit("OK: Usuario "), F.col("user_id"), F.lit(" pseudonimizado. "), F.col("rows_affected"),
            F.lit(" filas afectadas.")))
        .when(ended & (F.col("status") == "FAILED"), F.concat(F.lit("ERROR: "), F.coalesce("notes", F.lit(""))))
        .otherwise(F.concat(F.lit("ERROR: Solicitud "), F.col("request_id"), F.lit(' tiene status "'),
                            F.col("status"), F.lit('"')))
    )
    known = requests.select("request_id", "user_id", "status", "rows_affected", "notes")
    return asked.join(known, "request_id", "left").select("request_id", text.alias("mensaje"))


def deletion_audit(requests: DataFrame, log: DataFrame) -> DataFrame:
    """Requests with their log rows and the seconds they took, newest first."""
    entries = log.select("request_id", "table_name", "rows_updated", "columns_hashed")
    took = F.timestamp_diff("SECOND", F.col("requested_at"), F.col("processed_at"))
    return (
        requests.join(entries, "request_id", "left")
        .select(
            "request_id", "user_id", "user_identifier", "request_source", "reason", "requested_at", "processed_at",
            took.alias("seconds_to_process"), "status", "processed_by", "tables_affected", "rows_affected",
            "table_name", "rows_updated", "columns_hashed",
        )
        .orderBy(F.col("requested_at").desc_nulls_last(), "request_id", "table_name")
    )


def requests_report(requests: DataFrame) -> DataFrame:
    return requests.select(
        "request_id", "user_id", "request_source", "reason", "status", "rows_affected", "processed_at"
    ).orderBy("request_id")
