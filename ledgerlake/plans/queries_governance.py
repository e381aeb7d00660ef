"""Queries over masking, pseudonyms, deletion requests, quality, tags and monitoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake.operators import monitoring, privacy, quality, restore
from ledgerlake.functions import sql
from ledgerlake.plans import fixtures as fx
from ledgerlake.plans.queries_marts import DIM, dim, fact
from ledgerlake.plans.registry import half_up, query

ANALYST, COMPLIANCE, SALT = "ANALYST_ROLE", "COMPLIANCE_ROLE", "sal-de-prueba"
EV = fx.EVENTS_AS_OF


def _mask_query(name, column, policy, masked_sql):
    sql = f"with {DIM} select client_id, {masked_sql} analista, {column} cumplimiento from dim"

    @query(name, sql, ("cli", "suc"))
    def run(spark, sf):
        return dim(spark, sf).select(
            "client_id",
            privacy.mask(column, policy, ANALYST).alias("analista"),
            privacy.mask(column, policy, COMPLIANCE).alias("cumplimiento"),
        )

    return run


_mask_query("h1_mask_rut", "rut", "rut", "'**.***.***-*'")
_mask_query("h2_mask_email", "email", "email", "'***@masked.local'")
_mask_query("h3_mask_telefono", "telefono", "telefono", "'+569*****' || right(telefono, 3)")
_mask_query("h4_mask_nombre", "apellido", "nombre", "'***'")

_REPLACE = """'**.***.***-*' as rut, '***@masked.local' as email, '+569*****' || right(telefono, 3) as telefono,
  '***' as nombre, '***' as apellido"""


@query("h1_h4_masks_in_sql", f"with {DIM} select * replace ({_REPLACE}) from dim", ("cli", "suc"))
def h_sql(spark, sf):
    """The masks as functions of the SQL session."""
    sql.register_masks(spark)
    dim(spark, sf).createOrReplaceTempView("dim_clientes_sin_mascara")
    masked = ", ".join(f"mask_{policy}({c}, '{ANALYST}') AS {c}" for c, policy in privacy.POLICIES.items())
    others = ", ".join(c for c in dim(spark, sf).columns if c not in privacy.POLICIES)
    return spark.sql(f"SELECT {others}, {masked} FROM dim_clientes_sin_mascara")


@query("h5_apply_masking", f"with {DIM} select * replace ({_REPLACE}) from dim", ("cli", "suc"))
def h5(spark, sf):
    return privacy.apply_masking(dim(spark, sf), ANALYST)


@query("h5_apply_masking_strict", f"""with {DIM}
select * replace ({_REPLACE}, '***' as nombre_completo, '***' as direccion) from dim""", ("cli", "suc"))
def h5_strict(spark, sf):
    return privacy.apply_masking(dim(spark, sf), ANALYST, privacy.STRICT_POLICIES)


@query("h5_apply_masking_privileged", f"with {DIM} select * from dim", ("cli", "suc"))
def h5_clear(spark, sf):
    return privacy.apply_masking(dim(spark, sf), COMPLIANCE)


def _hash(column, salt):
    short = f"left(sha256({column} || {salt}), 8)"
    if column == "email":
        short += " || '@del.local'"
    return f"case when {salt} is not null then {short} else {column} end as {column}"


def _pseudonyms(columns, salt):
    cases = ", ".join(_hash(c, salt) for c in columns)
    return (f"{cases}, {salt} is not null as pseudonymized, "
            f"case when {salt} is not null then timestamp '{fx.AS_OF}' end as pseudonymized_at")


@query("h6_pseudonymize", f"""with {DIM},
t as (select c_custkey client_id, '{SALT}' salt from customer where c_acctbal < 0)
select * exclude (salt) replace ({_pseudonyms(privacy.DIM_COLUMNS, 'salt')}) from dim left join t using (client_id)""",
       ("cli", "suc"))
def h6(spark, sf):
    targets = fx.requests(spark, sf).filter("user_id >= 0").select(F.col("user_id").alias("client_id"))
    return privacy.pseudonymize(
        dim(spark, sf), targets, privacy.DIM_COLUMNS, privacy.salt_table(spark, SALT), fx.AS_OF
    )


DONE = "2001-08-10"
REQ = """reqs as (select row_number() over (order by user_id, requested_at, reason) request_id, user_id,
  rut user_identifier, request_source, reason, requested_at from req left join cli on user_id = client_id)"""
TARGET = f"""targets as (select user_id client_id, left(sha256('{SALT}:' || min(request_id)), 32) salt
  from reqs group by 1)"""
LOG = f"""log as (
  select request_id, tabla table_name, case when client_id is null then 0 else 1 end::bigint rows_updated,
    columnas columns_hashed, n from reqs left join cli on user_id = client_id, (values
    ('DWH.DIM_CLIENTES', '{",".join(privacy.DIM_COLUMNS)}', 1),
    ('RAW.CLIENTES', '{",".join(privacy.RAW_COLUMNS)}', 2)) v(tabla, columnas, n))"""
FINAL = f"""final as (select request_id, user_id, user_identifier, request_source, reason, requested_at,
  timestamp '{DONE}' processed_at, 'COMPLETED' status, 'ledgerlake' processed_by,
  'DWH.DIM_CLIENTES,RAW.CLIENTES' tables_affected, rows_affected, 'SHA2-256' hash_algorithm, null::varchar notes
  from reqs join (select request_id, sum(rows_updated)::bigint rows_affected from log group by 1) using (request_id))"""


def pending(spark, sf):
    return privacy.new_requests(fx.requests(spark, sf), dim(spark, sf), as_of=fx.AS_OF)


def processed(spark, sf):
    tables = {
        "DWH.DIM_CLIENTES": (dim(spark, sf), privacy.DIM_COLUMNS),
        "RAW.CLIENTES": (fx.clientes(spark, sf), privacy.RAW_COLUMNS),
    }
    return privacy.process_deletion_requests(
        pending(spark, sf), tables, privacy.salt_table(spark, SALT), DONE
    )


@query("a16_insert_requests", f"""with {REQ} select request_id, user_id, user_identifier, request_source, reason,
  requested_at, null::timestamp processed_at, 'PENDING' status, null::varchar processed_by,
  null::varchar tables_affected, null::bigint rows_affected, 'SHA2-256' hash_algorithm, null::varchar notes from reqs""",
       ("cli", "req"))
def a16(spark, sf):
    return pending(spark, sf)


@query("h7_deletion_requests", f"with {REQ}, {LOG}, {FINAL} select * from final", ("cli", "req"))
def h7(spark, sf):
    return processed(spark, sf).requests


@query("h8_deletion_log", f"""with {REQ}, {LOG} select (request_id - 1) * 2 + n log_id, request_id, table_name,
  rows_updated, columns_hashed, timestamp '{DONE}' executed_at, 'ledgerlake' executed_by from log""", ("cli", "req"))
def h8(spark, sf):
    return processed(spark, sf).log


@query("h7_dim_clientes_after", f"""with {DIM}, {REQ}, {TARGET} select * exclude (salt) replace (
  {_pseudonyms(privacy.DIM_COLUMNS, 'salt').replace(fx.AS_OF, DONE)}) from dim left join targets using (client_id)""",
       ("cli", "suc", "req"))
def h7_dim(spark, sf):
    return processed(spark, sf).tables["DWH.DIM_CLIENTES"]


@query("h7_messages", f"""with {REQ}, {LOG}, {FINAL}
select request_id, 'OK: Usuario ' || user_id || ' pseudonimizado. ' || rows_affected || ' filas afectadas.' mensaje
from final union all select 1000000 + n_nationkey, 'ERROR: Solicitud ' || (1000000 + n_nationkey) || ' no existe'
from nation""", ("cli", "req"))
def h7_messages(spark, sf):
    requests = processed(spark, sf).requests
    unknown = fx.table(spark, sf, "nation").select((F.lit(1_000_000).cast("long") + F.col("n_nationkey")).alias("request_id"))
    return privacy.deletion_messages(requests, requests.select("request_id").unionByName(unknown))


@query("h9_deletion_audit", f"""with {REQ}, {LOG}, {FINAL}
select request_id, user_id, user_identifier, request_source, reason, requested_at, processed_at,
  floor(epoch(processed_at - requested_at))::bigint seconds_to_process, status, processed_by, tables_affected,
  rows_affected, table_name, rows_updated, columns_hashed from final left join log using (request_id)""",
       ("cli", "req"))
def h9(spark, sf):
    done = processed(spark, sf)
    return privacy.deletion_audit(done.requests, done.log)


@query("a15_register_view", f"""with {REQ}, {LOG}, {FINAL}
select status, table_name, count(*) solicitudes, sum(rows_updated)::bigint filas
from final left join log using (request_id) group by 1, 2""", ("cli", "req"))
def a15(spark, sf):
    from ledgerlake.sources.tables import register_view

    done = processed(spark, sf)
    register_view("v_deletion_audit", privacy.deletion_audit(done.requests, done.log))
    return spark.sql("""select status, table_name, count(*) as solicitudes, sum(rows_updated) as filas
                        from v_deletion_audit group by status, table_name""")


@query("h10_requests_report", f"""with {REQ}, {LOG}, {FINAL}
select request_id, user_id, request_source, reason, status, rows_affected, processed_at from final""", ("cli", "req"))
def h10(spark, sf):
    return privacy.requests_report(processed(spark, sf).requests)


VIEW = ["client_id", "rut", "nombre", "apellido", "email", "telefono", "segmento"]


@query("h11_clients_view", f"with {DIM} select {', '.join(VIEW)} from dim where client_id in (1, 2, 3, 4, 5)",
       ("cli", "suc"))
def h11(spark, sf):
    return privacy.clients_view(dim(spark, sf), [1, 2, 3, 4, 5], VIEW)


# Quality -----------------------------------------------------------------------------------

CLI_SPECS = [("NULL_COUNT", "email"), ("NULL_COUNT", "rut"), ("NULL_COUNT", "telefono"),
             ("DUPLICATE_COUNT", "client_id"), ("INVALID_RUT_COUNT", "rut")]
TXN_SPECS = [("DUPLICATE_COUNT", "txn_id"), ("FRESHNESS", "fecha")]
BAD_RUT = r"rut is not null and not regexp_matches(rut, '^[0-9]{2}\.[0-9]{3}\.[0-9]{3}-[0-9K]$') and length(rut) < 20"


@query("i1_null_count", """select count(*) filter (where email is null)::bigint email, count(*) filter (where rut is null)::bigint rut,
  count(*) filter (where telefono is null)::bigint telefono from cli""", ("cli",))
def i1(spark, sf):
    return fx.clientes(spark, sf).agg(*[quality.null_count(c).alias(c) for c in ("email", "rut", "telefono")])


@query("i2_duplicate_count", "select count(txn_id) - count(distinct txn_id) duplicados from txn", ("txn",))
def i2(spark, sf):
    return fact(spark, sf, branch=False).agg(quality.duplicate_count("txn_id").alias("duplicados"))


@query("i3_freshness", f"""select floor(epoch(timestamp '{fx.AS_OF}' - max(fecha)))::bigint segundos from mov""",
       ("mov",))
def i3(spark, sf):
    return fx.movimientos(spark, sf).agg(quality.freshness("fecha", fx.AS_OF).alias("segundos"))


@query("i4_invalid_rut_count", f"select count(*) invalidos from cli where {BAD_RUT}", ("cli",))
def i4(spark, sf):
    return fx.clientes(spark, sf).agg(quality.invalid_rut_count("rut").alias("invalidos"))


@query("i4_invalid_rut_in_sql", f"select count(*) invalidos from cli where {BAD_RUT}", ("cli",))
def i4_sql(spark, sf):
    sql.register_checks(spark)
    fx.clientes(spark, sf).createOrReplaceTempView("clientes_medidos")
    return spark.sql("SELECT count_if(rut_invalido(rut)) AS invalidos FROM clientes_medidos")


METRICS_SQL = f"""metrics as (
  select 'DIM_CLIENTES' tabla, 'NULL_COUNT' metrica, 'email' columna, count(*) filter (where email is null)::bigint valor from cli
  union all select 'DIM_CLIENTES', 'NULL_COUNT', 'rut', count(*) filter (where rut is null)::bigint from cli
  union all select 'DIM_CLIENTES', 'NULL_COUNT', 'telefono', count(*) filter (where telefono is null)::bigint from cli
  union all select 'DIM_CLIENTES', 'DUPLICATE_COUNT', 'client_id', count(client_id) - count(distinct client_id) from cli
  union all select 'DIM_CLIENTES', 'INVALID_RUT_COUNT', 'rut', count(*) from cli where {BAD_RUT}
  union all select 'FACT_TRANSACCIONES', 'DUPLICATE_COUNT', 'txn_id', count(txn_id) - count(distinct txn_id) from txn
  union all select 'FACT_TRANSACCIONES', 'FRESHNESS', 'fecha',
    (sign(s) * floor(abs(s)))::bigint from (select epoch(timestamp '{fx.AS_OF}' - max(fecha)) s from txn))"""


def metrics(spark, sf):
    return quality.run_metrics(dim(spark, sf), "DIM_CLIENTES", CLI_SPECS, fx.AS_OF).unionByName(
        quality.run_metrics(fact(spark, sf, branch=False), "FACT_TRANSACCIONES", TXN_SPECS, fx.AS_OF)
    )


@query("i5_metrics_in_sql", f"with {METRICS_SQL} select metrica, columna, valor from metrics where tabla = 'DIM_CLIENTES'", ("cli", "txn"))
def i5_sql(spark, sf):
    """The metrics of a view as a table function of the SQL session."""
    fx.clientes(spark, sf).createOrReplaceTempView("clientes_medidos")
    sql.register_metrics(spark, "metricas_clientes", "clientes_medidos", CLI_SPECS)
    return spark.sql("SELECT * FROM metricas_clientes()")


@query("i5_run_metrics", f"with {METRICS_SQL} select *, timestamp '{fx.AS_OF}' medido_en from metrics", ("cli", "txn"))
def i5(spark, sf):
    return metrics(spark, sf)


@query("i6_metric_results", f"""with {METRICS_SQL} select *, timestamp '{fx.AS_OF}' medido_en from metrics
  order by medido_en desc, tabla, metrica, columna limit 20""", ("cli", "txn"))
def i6(spark, sf):
    return quality.metric_results(metrics(spark, sf))


# One tag per document source and language, by what its texts hold.
TAGS_SQL = r"""tags as (select source objeto, lang columna, 'DATA_CLASSIFICATION' tag,
  case when bool_or(regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}')) then 'PII'
       when count(*) > 20 then 'PUBLIC' else 'SIN CLASIFICAR' end valor from documents group by 1, 2
  union all select source, lang, case when count(*) > 30 then 'DATA_OWNER' else 'SIN_DUENO' end, lang
  from documents group by 1, 2)"""


def tags(spark, sf):
    docs = fx.table(spark, sf, "documents")
    groups = quality.pii_in_text(docs, "text", ["source", "lang"], {"EMAIL": quality.PII_IN_TEXT["EMAIL"]})
    value = (
        F.when(F.col("email_filas") > 0, "PII").when(F.col("filas") > 20, "PUBLIC").otherwise("SIN CLASIFICAR")
    )
    kind = F.when(F.col("filas") > 30, "DATA_OWNER").otherwise("SIN_DUENO")
    head = [F.col("source").alias("objeto"), F.col("lang").alias("columna")]
    return groups.select(*head, F.lit("DATA_CLASSIFICATION").alias("tag"), value.alias("valor")).unionByName(
        groups.select(*head, kind.alias("tag"), F.col("lang").alias("valor"))
    )


@query("i8_tag_violations", f"""with {TAGS_SQL} select * from tags where tag = 'SIN_DUENO'
  or (tag = 'DATA_CLASSIFICATION' and valor not in ('PII', 'FINANCIAL', 'CONFIDENTIAL', 'PUBLIC'))""")
def i8(spark, sf):
    return quality.tag_violations(tags(spark, sf))


@query("i10_tag_references", f"with {TAGS_SQL} select * from tags where objeto = 'src1'")
def i10(spark, sf):
    return quality.tag_references(tags(spark, sf), "src1")


def _rates(column, pattern):
    return f"avg(regexp_matches({column}, '{pattern}')::int)"


_P = quality.PII_PATTERNS
PII_SQL = f"""rates as (
  select 'rut' columna, 'NATIONAL_ID' categoria, {_rates('rut', _P['NATIONAL_ID'])} tasa from cli
  union all select 'email', 'EMAIL', {_rates('email', _P['EMAIL'])} from cli
  union all select 'telefono', 'PHONE_NUMBER', {_rates('telefono', _P['PHONE_NUMBER'])} from cli
  union all select 'nombre', 'NAME', 0 union all select 'apellido', 'NAME', 0
  union all select 'nombre_completo', 'NAME', 0 union all select 'direccion', 'ADDRESS', 0)"""


@query("i9_classify_pii", f"with {PII_SQL} select columna, categoria, tasa::double tasa from rates", ("cli",))
def i9(spark, sf):
    return quality.classify_pii(dim(spark, sf))


@query("i9_auto_tag", f"""with {PII_SQL} select 'DWH.DIM_CLIENTES' objeto, columna, 'DATA_CLASSIFICATION' tag, 'PII' valor
  from rates""", ("cli",))
def i9_tags(spark, sf):
    return quality.auto_tag(quality.classify_pii(dim(spark, sf)), "DWH.DIM_CLIENTES")


def _found(name, pattern):
    hits = f"len(regexp_extract_all(text, '{pattern}'))"
    return f"count(*) filter (where {hits} > 0)::bigint {name}_filas, sum({hits})::bigint {name}_hallazgos"


@query("i9_pii_in_text", f"""select source, lang, count(*) filas,
  {', '.join(_found(k.lower(), p) for k, p in quality.PII_IN_TEXT.items())} from documents group by 1, 2""")
def i9_text(spark, sf):
    return quality.pii_in_text(fx.table(spark, sf, "documents"), "text", ["source", "lang"])


@query("i11_pii_access_report", f"""select user_name, role_name, query_type, count(*) num_queries,
  sum(bytes_scanned)::bigint / 1024 / 1024 mb_scanned, min(start_time) primera_query, max(start_time) ultima_query
  from query_log where start_time >= timestamp '{EV}' - interval 24 hour and query_text ilike '%"K": 1%'
  and query_type = 'view' group by 1, 2, 3""", ("query_log",))
def i11(spark, sf):
    return monitoring.pii_access_report(fx.query_log(spark, sf), '"K": 1', EV, "view")


@query("i12_login_attempts", f"""select user_name, client_ip, reported_client_type, is_success, error_code, error_message,
  event_timestamp from login_log where event_timestamp >= timestamp '{EV}' - interval 7 day
  order by event_timestamp desc, event_id desc limit 50""", ("login_log",))
def i12(spark, sf):
    return monitoring.login_attempts(fx.login_log(spark, sf), EV)


@query("i13_usage_by_group", f"""with u as (select warehouse_name, (sum(credits_used) * 100)::hugeint c,
    count(distinct start_time::date) d from metering
    where warehouse_name like 's%' and start_time >= timestamp '{EV}' - interval 7 day group by 1)
  select warehouse_name, c::double / 100 total_credits, d dias_activo, {half_up('c', 'd')}::double / 100 credits_por_dia
  from u""", ("metering",))
def i13(spark, sf):
    return monitoring.usage_by_group(fx.metering(spark, sf), "s", EV)


@query("i14_governance_dashboard", f"""with {METRICS_SQL}, {REQ}, {LOG}, {FINAL}
select 'Data Quality' categoria, tabla objeto, metrica, valor::varchar valor, timestamp '{fx.AS_OF}' momento from metrics
union all select 'Compliance', 'DELETION_REQUESTS', status, count(*)::varchar, max(requested_at) from final group by 3
union all select 'Compliance', 'DIM_CLIENTES', 'Pseudonimizados', count(*)::varchar, max(timestamp '{DONE}')
  from customer where c_acctbal < 0""", ("cli", "txn", "req"))
def i14(spark, sf):
    done = processed(spark, sf)
    return quality.governance_dashboard(metrics(spark, sf), done.requests, done.tables["DWH.DIM_CLIENTES"])


# Logs and restore --------------------------------------------------------------------------

@query("a18_history", f"""select event_id, query_text, query_tag, query_type, start_time, bytes_scanned from query_log
  where start_time between timestamp '{EV}' - interval 48 hour and timestamp '{EV}'
  order by start_time desc, event_id desc limit 200""", ("query_log",))
def a18(spark, sf):
    return monitoring.history(fx.query_log(spark, sf), EV, 48, 200).select(
        "event_id", "query_text", "query_tag", "query_type", "start_time", "bytes_scanned"
    )


@query("k3_restore_as_of", """select * from bcli where _loaded_at <= timestamp '2001-07-10 00:00:00'
  qualify row_number() over (partition by client_id order by _loaded_at desc) = 1""", ("cli", "bcli"))
def k3(spark, sf):
    return restore.restore_as_of(fx.bronze_clientes(spark, sf), ["client_id"], "2001-07-10 00:00:00")


@query("k3_restore_offset", """select * from bcli where _loaded_at <= timestamp '2001-07-14 23:59:00'
  qualify row_number() over (partition by client_id order by _loaded_at desc) = 1""", ("cli", "bcli"))
def k3_offset(spark, sf):
    return restore.restore_as_of(fx.bronze_clientes(spark, sf), ["client_id"], "2001-07-15 00:04:00", 300)


