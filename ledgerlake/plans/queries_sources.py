"""Queries over generators, landing tables, sinks and JSON ingest."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from ledgerlake.functions.draws import PRIME
from ledgerlake.operators.gold import row_counts
from ledgerlake.operators.scale import materialize
from ledgerlake.plans import fixtures as fx
from ledgerlake.plans.queries_layers import LOADED, S_SAL, silver_sal
from ledgerlake.plans.queries_layout import scratch
from ledgerlake.plans.queries_marts import E2_SQL, reconciliation
from ledgerlake.plans.registry import cents, half_up, query
from ledgerlake.sources import evolution, generators as gen, ingest, landing, tables


def _draw(seq: str, salt: int, lo: int, hi: int) -> str:
    folded = f"(({seq} % {PRIME} + ({seq} // {PRIME}) * 104729 + {salt * 15485863}) % {PRIME})"
    mixed = f"(({folded} * 48271 + {salt * 7919 + 1}) % {PRIME})"
    squared = f"(({mixed} * {mixed}) % {PRIME})"
    return f"((({squared} * 69621 + {mixed}) % {PRIME}) % {hi - lo + 1} + {lo})"


def _turn(labels, seq="seq") -> str:
    return "([" + ", ".join(f"'{v}'" for v in labels) + f"])[({seq} % {len(labels)}) + 1]"


def _back(salt, lo, hi):
    return f"(date '{fx.AS_OF}' - {_draw('seq', salt, lo, hi)}::int)::date"


def _ids(column, table):
    return f"with ids as (select ({column})::bigint seq from {table})"


def ids(spark, sf, table, column):
    """The table's own row numbers, so that the generated volume follows the data."""
    return fx.table(spark, sf, table).select(F.expr(column).cast("long").alias("seq"))


LINE = "l_orderkey * 10 + l_linenumber"


@query("a1_gen_branches", f"""{_ids('n_nationkey', 'nation')} select seq + 1 sucursal_id,
  'SUC-' || lpad((seq + 1)::varchar, 4, '0') codigo, {_turn(gen.COMUNAS)} comuna,
  case seq % 10 when 8 then 'Valparaíso' when 9 then 'Biobío' else 'Región Metropolitana' end region,
  {_back(1, 365, 3650)} fecha_apertura, {_turn(gen.CATEGORIAS)} categoria from ids""")
def a1(spark, sf):
    return gen.gen_branches(ids(spark, sf, "nation", "n_nationkey"), fx.AS_OF)


@query("a2_gen_products", f"""{_ids('p_partkey', 'part')} select seq + 1 producto_id,
  'PRD-' || lpad((seq + 1)::varchar, 6, '0') codigo, {_turn(gen.TIPOS_PRODUCTO)} tipo,
  {_turn(gen.SEGMENTOS_PRODUCTO)} segmento, {_draw('seq', 2, 50, 1500)}::double / 100 tasa_anual,
  seq % 8 in (4, 5, 7) es_credito, true activo from ids""")
def a2(spark, sf):
    return gen.gen_products(ids(spark, sf, "part", "p_partkey"))


@query("a3_gen_customers", f"""{_ids('c_custkey', 'customer')} select seq + 1 client_id,
  lpad(({_draw('seq', 3, 5, 25)})::varchar, 2, '0') || '.' || {_draw('seq', 4, 100, 999)} || '.' ||
  {_draw('seq', 5, 100, 999)} || '-' || substr('{gen.DIGITOS}', {_draw('seq', 6, 1, 11)}, 1) rut,
  {_turn(gen.NOMBRES)} nombre, {_turn(gen.APELLIDOS)} apellido,
  lower({_turn(gen.NOMBRES)}) || '.' || lower({_turn(gen.APELLIDOS)}) || {_draw('seq', 7, 1, 9999)} || '@' ||
  {_turn(gen.DOMINIOS)} email, '+569' || {_draw('seq', 8, 10_000_000, 99_999_999)} telefono,
  'Calle ' || {_draw('seq', 9, 1, 9999)} || ', ' || {_turn(gen.COMUNAS_DIRECCION)} direccion,
  {_back(10, 0, 2500)} fecha_registro, {_turn(gen.SEGMENTOS_CLIENTE)} segmento,
  {_draw('seq', 11, 1, 200)} sucursal_id, false pseudonymized, null::timestamp pseudonymized_at from ids""")
def a3(spark, sf):
    return gen.gen_customers(ids(spark, sf, "customer", "c_custkey"), fx.AS_OF)


def _three(salt):
    return (f"{_draw('seq', salt, 1, 500_000)} client_id, {_draw('seq', salt + 1, 1, 5000)} producto_id, "
            f"{_draw('seq', salt + 2, 1, 200)} sucursal_id")


_COIN = f"(case when {_draw('seq', 26, 0, 1)} = 1 then 1 else -1 end)"
_AMOUNT = "case seq % 6 " + " ".join(
    f"when {i} then {_draw('seq', 25, lo, hi)} * {_COIN if sign is None else sign}"
    for i, ((lo, hi), sign) in enumerate(zip(gen.RANGOS_TXN, gen.SIGNOS_TXN))
) + " end"


@query("a4_gen_transactions", f"""{_ids(LINE, 'lineitem')} select seq + 1 txn_id, {_three(21)},
  timestamp '{fx.AS_OF}' - to_seconds({_draw('seq', 24, 0, gen.FIVE_YEARS_SECONDS)}) fecha, {_turn(gen.TIPOS_TXN)} tipo,
  ({_AMOUNT})::double monto, {_turn(gen.MONEDAS)} moneda, {_turn(gen.ESTADOS)} estado,
  'CH-' || lpad(({_draw('seq', 27, 1, 999_999)})::varchar, 8, '0') referencia from ids""")
def a4(spark, sf):
    return gen.gen_transactions(ids(spark, sf, "lineitem", LINE), fx.AS_OF)


@query("a5_gen_movements", f"""{_ids('o_orderkey', 'orders')} select seq + 1 movimiento_id, {_three(31)},
  {_back(34, 0, 1825)} fecha, {_turn(gen.TIPOS_MOV)} tipo_movimiento,
  {_draw('seq', 35, 100, 10_000_000)}::double monto, {_draw('seq', 36, 0, 100_000_000)}::double saldo_posterior,
  'MOV-' || lpad(({_draw('seq', 37, 1, 99_999_999)})::varchar, 10, '0') referencia from ids""")
def a5(spark, sf):
    return gen.gen_movements(ids(spark, sf, "orders", "o_orderkey"), fx.AS_OF)


@query("a6_gen_balances", f"""{_ids(LINE, 'lineitem')} select seq + 1 saldo_id,
  {_draw('seq', 41, 1, 500_000)} client_id, {_draw('seq', 42, 1, 5000)} producto_id, {_back(44, 0, 1825)} fecha_corte,
  {_draw('seq', 45, -5_000_000, 500_000_000)}::double saldo_contable,
  {_draw('seq', 46, -5_000_000, 500_000_000)}::double saldo_disponible,
  {_draw('seq', 47, 0, 100_000_000)}::double saldo_promedio_mes, {_turn(gen.CUENTAS)} estado_cuenta from ids""")
def a6(spark, sf):
    return gen.gen_balances(ids(spark, sf, "lineitem", LINE), fx.AS_OF)


@query("a7_row_counts", " union all ".join(
    f"select 'RAW.{name}' tabla, count(*) filas from {view}" for name, view in (
        ("CLIENTES", "cli"), ("MOVIMIENTOS", "mov"), ("PRODUCTOS", "prod"), ("SALDOS", "sal"),
        ("SUCURSALES", "suc"), ("TRANSACCIONES", "txn"))), ("cli", "mov", "prod", "sal", "suc", "txn"))
def a7(spark, sf):
    return row_counts({
        "RAW.CLIENTES": fx.clientes(spark, sf), "RAW.MOVIMIENTOS": fx.movimientos(spark, sf),
        "RAW.PRODUCTOS": fx.productos(spark, sf), "RAW.SALDOS": fx.saldos(spark, sf),
        "RAW.SUCURSALES": fx.sucursales(spark, sf), "RAW.TRANSACCIONES": fx.transacciones(spark, sf),
    })


@query("a8_bronze_schema", f"""select * replace (saldo_contable::double as saldo_contable,
  saldo_disponible::double as saldo_disponible, saldo_promedio_mes::double as saldo_promedio_mes),
  timestamp '{LOADED}' _loaded_at, 'initial_load' _source_file from sal""", ("sal",))
def a8(spark, sf):
    return landing.to_bronze(fx.saldos(spark, sf), "saldos", as_of=LOADED)


MOV_LOADS = """select * replace (monto::double as monto, saldo_posterior::double as saldo_posterior),
  case when fecha < date '1998-01-01' then timestamp '2001-07-01' else timestamp '2001-07-02' end _loaded_at,
  case when fecha < date '1998-01-01' then 'initial_load' else 'daily_load_2001-07-02' end _source_file"""


def first_load(spark, sf, path):
    older = fx.movimientos(spark, sf).filter("fecha < date'1998-01-01'")
    landing.bronze_append(older, path, "movimientos", as_of="2001-07-01")


def second_load(spark, sf, path):
    newer = fx.movimientos(spark, sf).filter("fecha >= date'1998-01-01'")
    landing.bronze_append(newer, path, "movimientos", "daily_load_2001-07-02", "2001-07-02")


@query("a9_bronze_append", MOV_LOADS + " from mov", ("mov",))
def a9(spark, sf):
    path = scratch(spark, "bronze")
    first_load(spark, sf, path)
    second_load(spark, sf, path)
    return spark.read.schema(landing.bronze_schema("movimientos")).parquet(path)


_KEY = "concat_ws('|', txn_id, client_id, producto_id, '{}')"


def _hash32(salt):
    return f"('0x' || substr(md5({_KEY.format(salt)}), 1, 8))::bigint"


@query("a11_simulate_daily_load", f"""with b as (select *, timestamp '{LOADED}' _loaded_at, 'initial_load' _source_file
    from txn),
  picked as (select * from b order by {_hash32('0')}, _loaded_at, _source_file, client_id, estado nulls last, fecha,
    moneda, monto, producto_id, referencia, sucursal_id, tipo, txn_id limit 1000)
  select txn_id + 100000000 txn_id, client_id, producto_id, sucursal_id, timestamp '{fx.AS_OF}' fecha, tipo,
    {half_up(f"({cents('monto')} * (900000 + {_hash32('f0')} % 200001))", '1000000')}::double / 100 monto, moneda, estado,
    'REF-' || ({_hash32('r0')} % 999999 + 1) referencia, timestamp '{fx.AS_OF}' _loaded_at,
    'daily_load_{fx.AS_OF}' _source_file from picked""", ("txn",))
def a11(spark, sf):
    return landing.simulate_daily_load(
        landing.to_bronze(fx.transacciones(spark, sf), "transacciones", as_of=LOADED), 1000, fx.AS_OF
    )


@query("a12_read_table", f"with {S_SAL} select rango_saldo, estado_cuenta, count(*) filas from s_sal group by 1, 2",
       ("sal",))
def a12(spark, sf):
    root = scratch(spark, "tables")
    tables.save_table(silver_sal(spark, sf), root, "dim_saldos_actuales")
    saved = tables.read_table(spark, root, "dim_saldos_actuales")
    return saved.groupBy("rango_saldo", "estado_cuenta").agg(F.count("*").alias("filas"))


@query("a13_save_table", E2_SQL + " select * from rec where estado_reconciliacion <> 'OK'", ("mov", "sal"))
def a13(spark, sf):
    root = scratch(spark, "tables")
    result = materialize(reconciliation(spark, sf))  # saved twice, worked out once
    tables.save_table(result, root, "reconciliacion")
    tables.save_table(result.filter("estado_reconciliacion <> 'OK'"), root, "reconciliacion")
    return tables.read_table(spark, root, "reconciliacion")


@query("a14_create_table_as", """select tipo, moneda, count(*) filas, sum(monto)::double volumen
  from txn group by 1, 2""", ("txn",))
def a14(spark, sf):
    tables.register_view("txn_fuente", fx.transacciones(spark, sf, branch=False))
    return tables.create_table_as(
        spark, scratch(spark, "tables"), "volumen_por_tipo",
        "select tipo, moneda, count(*) as filas, sum(monto) as volumen from txn_fuente group by tipo, moneda",
    )


# A stream that gains a field half way and has unreadable rows.
EVENT_SCHEMA = T.StructType([T.StructField("k", T.LongType())])


def json_rows(spark, sf):
    text = F.when(
        F.col("event_type") == "purchase",
        F.concat(F.expr("substr(props, 1, length(props) - 1)"), F.lit(', "canal": "web"}')),
    ).otherwise(F.col("props"))
    cut = F.expr("substr(_t, 1, length(_t) - 1)")
    return fx.table(spark, sf, "events").withColumn("_t", text).select(
        "event_id", F.when(F.col("event_id") % 100 == 0, cut).otherwise(F.col("_t")).alias("value")
    )


JSON = """raw as (select event_id, event_type, case when event_type = 'purchase'
    then substr(props, 1, length(props) - 1) || ', "canal": "web"}' else props end t from events),
  cut as (select event_id, event_type, case when event_id % 100 = 0 then substr(t, 1, length(t) - 1) else t end as value
    from raw)"""
GOOD = JSON + """, good as (select event_id, value, (value::json->>'$.k')::bigint k,
    case when event_type = 'purchase' then '{"canal":"web"}' end extra from cut where json_valid(value))"""
BAD = JSON + """, bad as (select event_id, value, null::bigint k, 'malformed JSON' error from cut
    where not json_valid(value))"""


@query("a17_ingest_json_good", f"with {GOOD} select * from good")
def a17(spark, sf):
    parsed = ingest.parse_json(json_rows(spark, sf), "value", EVENT_SCHEMA)
    return ingest.good_rows(parsed).withColumn("extra", F.to_json("extra"))


@query("a17_ingest_json_dead_letters", f"with {BAD} select event_id, value, error from bad")
def a17_dead(spark, sf):
    parsed = ingest.parse_json(json_rows(spark, sf), "value", EVENT_SCHEMA)
    return ingest.dead_letters(parsed, "value").select("event_id", "value", "error")


def evolving_loads(spark, sf):
    """Two loads of payloads: the second has a new field, and text where there were numbers."""
    rows = json_rows(spark, sf).join(fx.table(spark, sf, "events").select("event_id", "event_type"), "event_id")
    as_text = F.regexp_replace("value", '"k": ([0-9]+)', '"k": "x$1"')
    late = (F.col("event_type") == "purchase") | (F.col("event_id") % 50 == 7)
    value = F.when(F.col("event_id") % 50 == 7, as_text).otherwise(F.col("value"))
    return [evolution.as_variant(rows.filter(part).select("event_id", value.alias("value")), "value") for part in (~late, late)]


EVOLVED = JSON + """, v as (select event_id, event_type, case when event_id % 50 = 7
    then regexp_replace(value, '"k": ([0-9]+)', '"k": "x\\1"') else value end as value from cut)"""


@query("a17_evolved_schema", f"""with {EVOLVED} select event_id, case when json_valid(value) then value::json->>'$.k' end k,
  case when json_valid(value) then value::json->>'$.canal' end canal,
  case when not json_valid(value) then 'no JSON object' end error from v""")
def a17_evolved(spark, sf):
    """A first load, its schema; a second one, whose new field and wider type are proposed and promoted, dead letters read again."""
    registry = scratch(spark, "schemas")
    first, second = evolving_loads(spark, sf)
    evolution.store_schema(spark, registry, evolution.observed_types(first))
    before = evolution.stored_schema(spark, registry)
    read = [evolution.read_under(load, before) for load in (first, second)]
    dead = evolution.dead_letters(read[0].unionByName(read[1]), ["event_id", "value"])
    after = evolution.promote(spark, registry, evolution.propose(before, second))
    good = evolution.good_rows(read[0]).unionByName(evolution.good_rows(evolution.read_under(second, before)))
    good = good.withColumns({f: F.col(f).cast(after[f]) for f in before})
    good = good.withColumn("canal", F.get_json_object("extra", "$.canal")).drop("extra")
    again = evolution.read_under(evolution.as_variant(dead.drop("error"), "value"), after)
    columns = ["event_id", *after]
    left = evolution.dead_letters(again, ["event_id"])
    return good.select(*columns).unionByName(evolution.good_rows(again).select(*columns)).unionByName(left, allowMissingColumns=True)


@query("a17_proposed_fields", f"""with {EVOLVED} select 'k' campo, 'string' tipo from v where json_valid(value) and event_id % 50 = 7
  union select 'canal', 'string' from v where json_valid(value) and event_type = 'purchase'""")
def a17_proposed(spark, sf):
    first, second = evolving_loads(spark, sf)
    found = evolution.propose(evolution.observed_types(first), second)
    return spark.createDataFrame(list(found.items()), "campo string, tipo string")
