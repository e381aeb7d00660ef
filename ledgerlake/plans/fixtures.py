"""Views of the banking model over the star-schema Parquet tables, and their DuckDB twins.

``VIEWS`` holds the mapping as DuckDB SQL for the oracle; the functions say the same in Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerlake.functions import md5_draw, money
from ledgerlake.params import CortesScore, CortesValor

AS_OF = "2001-08-01"
EVENTS_AS_OF = "2024-01-30"

# Thresholds scaled to the fixture amounts.
MONTO_ANOMALO = 250_000
RANGOS_SALDO = ((50_000, "Alto"), (5_000, "Medio"), (0, "Bajo"))
CORTES_VALOR = CortesValor(a=(45, 300_000), b=(42, 320_000), c=30)
CORTES_SCORE = CortesScore(
    actividad=((44, 30), (35, 25), (29, 20), (23, 15), (16, 10)),
    volumen=((1_620_000, 30), (1_250_000, 25), (1_020_000, 20), (817_000, 15), (531_000, 10)),
    saldo=((50_000, 20), (20_000, 15), (5_000, 10)),
)

TIPOS_TXN = ("Depósito", "Retiro", "Transferencia", "Pago", "Inversión", "Comisión")
TIPOS_MOV = ("Cargo", "Abono", "Ajuste", "Interés", "Comisión")


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table; its schema is read from the file footers once, not by a job per query."""
    path = f"{sf}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _pick(index, labels):
    out = None
    for i, label in enumerate(labels):
        out = F.when(index == i, label) if out is None else out.when(index == i, label)
    return out


def sucursales(spark: SparkSession, sf: str) -> DataFrame:
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("long").alias("sucursal_id"),
        F.concat(F.lit("SUC-"), F.lpad(F.col("n_nationkey").cast("string"), 4, "0")).alias("codigo"),
        F.col("n_name").alias("comuna"),
        F.col("r_name").alias("region"),
    )


def productos(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("producto_id"),
        F.concat(F.lit("PRD-"), F.lpad(F.col("p_partkey").cast("string"), 6, "0")).alias("codigo"),
        F.col("p_type").alias("tipo"),
        F.col("p_brand").alias("segmento"),
        (F.col("p_size") % 15 + F.lit(0.5)).cast("decimal(5,2)").alias("tasa_anual"),
        F.col("p_type").isin("PROMO", "ECONOMY", "LARGE").alias("es_credito"),
        F.lit(True).alias("activo"),
    )


def clientes(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")

    def digits(salt, n, base):
        return (md5_draw(key, salt, n) + base).cast("string")

    stem = F.concat_ws(".", F.lpad(digits("r1", 21, 5), 2, "0"), digits("r2", 900, 100), digits("r3", 900, 100))
    check = F.substring(F.lit("0123456789K"), (md5_draw(key, "r4", 11) + 1).cast("int"), F.lit(1))
    return table(spark, sf, "customer").select(
        key.alias("client_id"),
        F.when(key % 50 == 0, stem).otherwise(F.concat(stem, F.lit("-"), check)).alias("rut"),
        F.col("c_name").alias("nombre"),
        F.col("c_mktsegment").alias("apellido"),
        F.when(key % 40 != 0, F.concat(F.lower("c_name"), F.lit("@example.com"))).alias("email"),
        F.concat(F.lit("+569"), F.lpad(md5_draw(key, "tel", 100_000_000).cast("string"), 8, "0")).alias("telefono"),
        F.concat(F.lit("Calle "), (md5_draw(key, "dir", 9999) + 1).cast("string")).alias("direccion"),
        F.date_sub(F.lit(AS_OF).cast("date"), md5_draw(key, "reg", 2500).cast("int")).alias("fecha_registro"),
        F.col("c_mktsegment").alias("segmento"),
        F.col("c_nationkey").cast("long").alias("sucursal_id"),
        F.lit(False).alias("pseudonymized"),
        F.lit(None).cast("timestamp_ntz").alias("pseudonymized_at"),
    )


def transacciones(spark: SparkSession, sf: str, branch: bool = True) -> DataFrame:
    """Line items with their order's client. ``branch=False`` leaves out the branch and its join."""
    lineitem, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    if branch:
        customer = table(spark, sf, "customer")
        orders = orders.join(customer, orders.o_custkey == customer.c_custkey)
        branch_id = F.col("c_nationkey").cast("long")
    else:
        branch_id = F.lit(None).cast("long")
    rows = lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey)
    amount = money(F.col("l_extendedprice"))
    return rows.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("txn_id"),
        F.col("o_custkey").alias("client_id"),
        F.col("l_partkey").alias("producto_id"),
        branch_id.alias("sucursal_id"),
        F.col("l_shipdate").alias("fecha"),
        _pick(F.col("l_partkey") % 6, TIPOS_TXN).alias("tipo"),
        money(F.when(F.col("l_returnflag") == "R", -amount).otherwise(amount)).alias("monto"),
        F.when(F.col("l_linestatus") == "F", "USD").otherwise("CLP").alias("moneda"),
        F.when(F.col("l_orderkey") % 97 != 0,
               F.when(F.col("l_suppkey") % 4 == 3, "Rechazada").otherwise("Aprobada")).alias("estado"),
        F.concat(F.lit("CH-"), F.lpad(F.col("l_orderkey").cast("string"), 8, "0")).alias("referencia"),
    )


def movimientos(spark: SparkSession, sf: str) -> DataFrame:
    """Orders; the product is the order number modulo the number of products."""
    n_parts = table(spark, sf, "part").count()
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("movimiento_id"),
        F.col("o_custkey").alias("client_id"),
        (F.col("o_orderkey") % F.lit(n_parts)).alias("producto_id"),
        F.lit(None).cast("long").alias("sucursal_id"),
        F.col("o_orderdate").cast("date").alias("fecha"),
        _pick(F.col("o_orderkey") % 5, TIPOS_MOV).alias("tipo_movimiento"),
        money("o_totalprice").alias("monto"),
        money(money("o_totalprice") - 60000).alias("saldo_posterior"),
        F.concat(F.lit("MOV-"), F.lpad(F.col("o_orderkey").cast("string"), 10, "0")).alias("referencia"),
    )


def saldos(spark: SparkSession, sf: str) -> DataFrame:
    lineitem, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    rows = lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey)
    price = money(F.col("l_extendedprice"))
    one = F.lit(1).cast("decimal(4,2)")
    net = price * (one - F.col("l_discount").cast("decimal(4,2)")).cast("decimal(4,2)")
    taxed = net * (one - F.col("l_tax").cast("decimal(4,2)")).cast("decimal(4,2)")
    return rows.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("saldo_id"),
        F.col("o_custkey").alias("client_id"),
        F.col("l_partkey").alias("producto_id"),
        F.col("l_shipdate").cast("date").alias("fecha_corte"),
        money(money(net) - 20000).alias("saldo_contable"),
        money(money(taxed) - 20000).alias("saldo_disponible"),
        price.alias("saldo_promedio_mes"),
        F.when(F.col("l_linestatus") == "F", "Bloqueada").when(F.col("l_returnflag") == "N", "Inactiva")
        .otherwise("Activa").alias("estado_cuenta"),
    )


def with_load(df: DataFrame, loaded_at: str, source_file: str) -> DataFrame:
    return df.withColumns({
        "_loaded_at": F.lit(loaded_at).cast("timestamp_ntz"),
        "_source_file": F.lit(source_file),
    })


def bronze_clientes(spark: SparkSession, sf: str) -> DataFrame:
    """The first load of all clients, and a later one that corrects one segment."""
    base = clientes(spark, sf).drop("pseudonymized", "pseudonymized_at")
    later = base.filter("segmento = 'BUILDING'").withColumns({
        "nombre": F.concat(F.lit("  "), F.lower("nombre"), F.lit(" ")),
        "email": F.concat(F.lit(" "), F.upper("email")),
        "segmento": F.lit("PREMIUM"),
    })
    return with_load(base, "2001-07-01 00:00:00", "initial_load").unionByName(
        with_load(later, "2001-07-15 00:00:00", "daily_load_2001-07-15")
    )


def query_log(spark: SparkSession, sf: str) -> DataFrame:
    """Events read as a query history."""
    return table(spark, sf, "events").select(
        F.col("event_id"),
        F.col("props").alias("query_text"),
        F.when(F.col("user_id") % 2 == 0, "BENCH_NO_CLUSTER").otherwise("BENCH_WITH_CLUSTER").alias("query_tag"),
        F.col("event_type").alias("query_type"),
        F.col("user_id").cast("string").alias("user_name"),
        F.concat(F.lit("ROLE_"), (F.col("user_id") % 3).cast("string")).alias("role_name"),
        F.col("ts").alias("start_time"),
        F.round(F.col("value").cast("decimal(15,2)") * 100).cast("long").alias("total_elapsed_time"),
        F.floor(F.col("value").cast("decimal(15,2)") * 1024).cast("long").alias("bytes_scanned"),
        F.floor(F.col("value")).cast("long").alias("partitions_scanned"),
        F.lit(512).cast("long").alias("partitions_total"),
        F.col("event_id").alias("rows_produced"),
    )


def login_log(spark: SparkSession, sf: str) -> DataFrame:
    failed = F.col("event_type") == "error"
    return table(spark, sf, "events").select(
        F.col("event_id"),
        F.col("user_id").cast("string").alias("user_name"),
        F.concat(F.lit("10.0.0."), (F.col("user_id") % 256).cast("string")).alias("client_ip"),
        F.col("event_type").alias("reported_client_type"),
        F.when(failed, "NO").otherwise("YES").alias("is_success"),
        F.when(failed, F.col("event_id") % 10).alias("error_code"),
        F.when(failed, F.col("props")).alias("error_message"),
        F.col("ts").alias("event_timestamp"),
    )


def metering(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("event_type").alias("warehouse_name"),
        F.col("value").cast("decimal(15,2)").alias("credits_used"),
        F.col("ts").alias("start_time"),
    )


def refresh_log(spark: SparkSession, sf: str) -> DataFrame:
    """Events read as a refresh history of derived tables."""
    return table(spark, sf, "events").select(
        F.col("event_id"),
        F.concat(F.lit("TABLA_"), F.col("event_type")).alias("name"),
        F.when(F.col("user_id") % 2 == 0, "SILVER").otherwise("GOLD").alias("schema_name"),
        F.when(F.col("user_id") % 2 == 0, 600).otherwise(1800).cast("long").alias("target_lag_sec"),
        F.col("value").cast("decimal(15,2)").alias("actual_lag_sec"),
        F.lit("SCHEDULED").alias("refresh_trigger"),
        F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCEEDED").alias("refresh_status"),
        F.col("ts").alias("last_completed_refresh_time"),
    )


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """Clients in debt ask for deletion; an unknown client asks through each branch."""
    known = table(spark, sf, "customer").filter("c_acctbal < 0").select(
        F.col("c_custkey").alias("user_id"), F.lit("web_form").alias("request_source"),
        F.lit("Solicitud voluntaria").alias("reason"),
        (F.lit("2001-08-01").cast("timestamp_ntz")
         + F.make_dt_interval(secs=(F.col("c_custkey") % 3600).cast("decimal(18,6)"))).alias("requested_at"),
    )
    unknown = table(spark, sf, "nation").select(
        (F.lit(-1) - F.col("n_nationkey")).cast("long").alias("user_id"), F.lit("email").alias("request_source"),
        F.lit("Cierre de cuenta").alias("reason"),
        F.lit("2001-08-02").cast("timestamp_ntz").alias("requested_at"),
    )
    return known.unionByName(unknown)


def _case(index: str, labels) -> str:
    return "case " + index + " " + " ".join(f"when {i} then '{v}'" for i, v in enumerate(labels)) + " end"


def _h(key: str, salt: str, n: int) -> str:
    return f"(('0x' || substr(md5({key} || ':{salt}'), 1, 8))::bigint % {n})"


_STEM = (
    f"lpad(({_h('c_custkey', 'r1', 21)} + 5)::varchar, 2, '0') || '.' || ({_h('c_custkey', 'r2', 900)} + 100)"
    f" || '.' || ({_h('c_custkey', 'r3', 900)} + 100)"
)

# name -> (views it needs, DuckDB text)
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "suc": ((), """select n_nationkey::bigint sucursal_id, 'SUC-' || lpad(n_nationkey::varchar, 4, '0') codigo,
        n_name comuna, r_name region from nation join region on n_regionkey = r_regionkey"""),
    "prod": ((), """select p_partkey producto_id, 'PRD-' || lpad(p_partkey::varchar, 6, '0') codigo, p_type tipo,
        p_brand segmento, (p_size % 15 + 0.5)::decimal(5,2) tasa_anual,
        p_type in ('PROMO', 'ECONOMY', 'LARGE') es_credito, true activo from part"""),
    "cli": ((), f"""select c_custkey client_id,
        case when c_custkey % 50 = 0 then {_STEM}
             else {_STEM} || '-' || substr('0123456789K', {_h('c_custkey', 'r4', 11)} + 1, 1) end rut,
        c_name nombre, c_mktsegment apellido,
        case when c_custkey % 40 <> 0 then lower(c_name) || '@example.com' end email,
        '+569' || lpad({_h('c_custkey', 'tel', 100_000_000)}::varchar, 8, '0') telefono,
        'Calle ' || ({_h('c_custkey', 'dir', 9999)} + 1) direccion,
        (date '{AS_OF}' - {_h('c_custkey', 'reg', 2500)}::int)::date fecha_registro,
        c_mktsegment segmento, c_nationkey::bigint sucursal_id,
        false pseudonymized, null::timestamp pseudonymized_at from customer"""),
    "txn": ((), f"""select l_orderkey * 10 + l_linenumber txn_id, o_custkey client_id, l_partkey producto_id,
        c_nationkey::bigint sucursal_id, l_shipdate fecha, {_case('l_partkey % 6', TIPOS_TXN)} tipo,
        (case when l_returnflag = 'R' then -(l_extendedprice::decimal(15,2))
              else l_extendedprice::decimal(15,2) end)::decimal(15,2) monto,
        case when l_linestatus = 'F' then 'USD' else 'CLP' end moneda,
        case when l_orderkey % 97 = 0 then null when l_suppkey % 4 = 3 then 'Rechazada' else 'Aprobada' end estado,
        'CH-' || lpad(l_orderkey::varchar, 8, '0') referencia
        from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey"""),
    "mov": ((), f"""select o_orderkey movimiento_id, o_custkey client_id,
        o_orderkey % (select count(*) from part) producto_id, null::bigint sucursal_id, o_orderdate::date fecha,
        {_case('o_orderkey % 5', TIPOS_MOV)} tipo_movimiento, o_totalprice::decimal(15,2) monto,
        (o_totalprice::decimal(15,2) - 60000)::decimal(15,2) saldo_posterior,
        'MOV-' || lpad(o_orderkey::varchar, 10, '0') referencia from orders"""),
    "sal": ((), """select saldo_id, client_id, producto_id, fecha_corte,
        (neto::decimal(15,2) - 20000)::decimal(15,2) saldo_contable,
        ((neto * (1 - l_tax::decimal(4,2))::decimal(4,2))::decimal(15,2) - 20000)::decimal(15,2) saldo_disponible,
        saldo_promedio_mes, estado_cuenta from (
        select l_orderkey * 10 + l_linenumber saldo_id, o_custkey client_id, l_partkey producto_id,
        l_shipdate::date fecha_corte, l_tax,
        l_extendedprice::decimal(15,2) * (1 - l_discount::decimal(4,2))::decimal(4,2) neto,
        l_extendedprice::decimal(15,2) saldo_promedio_mes,
        case when l_linestatus = 'F' then 'Bloqueada' when l_returnflag = 'N' then 'Inactiva' else 'Activa' end estado_cuenta
        from lineitem join orders on l_orderkey = o_orderkey)"""),
    "bcli": (("cli",), """select * exclude (pseudonymized, pseudonymized_at),
        timestamp '2001-07-01 00:00:00' _loaded_at, 'initial_load' _source_file from cli
        union all by name
        select * exclude (pseudonymized, pseudonymized_at) replace ('  ' || lower(nombre) || ' ' as nombre,
        ' ' || upper(email) as email, 'PREMIUM' as segmento),
        timestamp '2001-07-15 00:00:00' _loaded_at, 'daily_load_2001-07-15' _source_file
        from cli where segmento = 'BUILDING'"""),
    "query_log": ((), """select event_id, props query_text,
        case when user_id % 2 = 0 then 'BENCH_NO_CLUSTER' else 'BENCH_WITH_CLUSTER' end query_tag,
        event_type query_type, user_id::varchar user_name, 'ROLE_' || (user_id % 3) role_name, ts start_time,
        (value::decimal(15,2) * 100)::bigint total_elapsed_time,
        floor(value::decimal(15,2) * 1024)::bigint bytes_scanned, floor(value)::bigint partitions_scanned,
        512::bigint partitions_total, event_id rows_produced from events"""),
    "login_log": ((), """select event_id, user_id::varchar user_name, '10.0.0.' || (user_id % 256) client_ip,
        event_type reported_client_type, case when event_type = 'error' then 'NO' else 'YES' end is_success,
        case when event_type = 'error' then event_id % 10 end error_code,
        case when event_type = 'error' then props end error_message, ts event_timestamp from events"""),
    "metering": ((), """select event_type warehouse_name, value::decimal(15,2) credits_used, ts start_time
        from events"""),
    "refresh_log": ((), """select event_id, 'TABLA_' || event_type name,
        case when user_id % 2 = 0 then 'SILVER' else 'GOLD' end schema_name,
        (case when user_id % 2 = 0 then 600 else 1800 end)::bigint target_lag_sec,
        value::decimal(15,2) actual_lag_sec, 'SCHEDULED' refresh_trigger,
        case when event_type = 'error' then 'FAILED' else 'SUCCEEDED' end refresh_status,
        ts last_completed_refresh_time from events"""),
    "req": ((), """select c_custkey user_id, 'web_form' request_source, 'Solicitud voluntaria' reason,
        timestamp '2001-08-01' + to_seconds(c_custkey % 3600) requested_at from customer where c_acctbal < 0
        union all select (-1 - n_nationkey)::bigint, 'email', 'Cierre de cuenta', timestamp '2001-08-02' from nation"""),
}
