"""Hand-made rows for every branch of the business rules and every null rule."""

from __future__ import annotations

import re
from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from conftest import as_dicts, plan_of
from ledgerlake import params
from ledgerlake.functions import banded, percent, years_between
from ledgerlake.operators import gold, marts, monitoring, privacy, processes, quality, silver
from ledgerlake.operators.scale import materialize
from ledgerlake.plans import queries_sources

T0 = datetime(2024, 1, 1)
TXN = ("txn_id long, client_id long, producto_id long, sucursal_id long, fecha timestamp_ntz, tipo string, "
       "monto decimal(15,2), moneda string, estado string, referencia string, _loaded_at timestamp_ntz")
BRANCHES = [(1, "SUC-0001", "Ñuñoa", "Metropolitana")]
BRANCH = "sucursal_id long, codigo string, comuna string, region string"


def txn_row(i, client=1, fecha=T0, monto="10.00", estado="Aprobada", producto=1, tipo="Pago", branch=1):
    return (i, client, producto, branch, fecha, tipo, None if monto is None else D(monto), "CLP", estado, "R", T0)


def txns(spark, *rows):
    return spark.createDataFrame([txn_row(i, **r) for i, r in enumerate(rows)], TXN)


def test_txn_flags_first_match_wins(spark):
    future = datetime(2030, 1, 1)
    df = txns(spark, {"monto": None, "client": None, "fecha": future}, {"client": None, "fecha": future},
              {"fecha": future}, {}, {"estado": None}, {"fecha": None})
    got = {r["txn_id"]: r["_quality_flag"] for r in silver.silver_fact_transacciones(df, "2024-06-01").collect()}
    assert got == {0: "MONTO_NULL", 1: "CLIENT_NULL", 2: "FECHA_FUTURA", 3: "OK", 5: "OK"}


def test_txn_calendar(spark):
    saturday, sunday, monday = datetime(2024, 3, 2), datetime(2024, 3, 3), datetime(2024, 3, 4)
    df = txns(spark, *[{"fecha": d, "monto": "-5.00"} for d in (saturday, sunday, monday)])
    rows = as_dicts(silver.silver_fact_transacciones(df, "2024-06-01"), "txn_id")
    assert [r["dia_semana"] for r in rows] == [6, 0, 1]
    assert [r["es_fin_semana"] for r in rows] == [True, True, False]
    assert {r["mes"] for r in rows} == {date(2024, 3, 1)} and {r["trimestre"] for r in rows} == {date(2024, 1, 1)}
    assert {r["monto_absoluto"] for r in rows} == {D("5.00")}


def test_movement_flags(spark):
    cases = [("Cargo", 1, -1, "OK"), ("Comisión", 1, -1, "OK"), ("Abono", 1, -1, "SALDO_NEGATIVO_ANOMALO"),
             ("Abono", 101, -1, "SALDO_NEGATIVO_ANOMALO"), ("Cargo", 101, -1, "MONTO_ANOMALO"),
             ("Abono", 100, 5, "OK"), ("Abono", 101, None, "MONTO_ANOMALO"), (None, 1, -1, "OK")]
    df = spark.createDataFrame(
        [(i, 1, 1, 1, date(2024, 1, 1), t, D(m), None if s is None else D(s), "R", T0)
         for i, (t, m, s, _) in enumerate(cases)],
        "movimiento_id long, client_id long, producto_id long, sucursal_id long, fecha date, tipo_movimiento string, "
        "monto decimal(15,2), saldo_posterior decimal(15,2), referencia string, _loaded_at timestamp_ntz")
    got = [r["_quality_flag"] for r in as_dicts(silver.silver_fact_movimientos(df, 100), "movimiento_id")]
    assert got == [c[3] for c in cases]


def test_default_thresholds_are_the_lab_ones():
    assert params.MONTO_ANOMALO == 100_000_000 and params.TOLERANCIA == 1000
    assert params.CortesValor() == params.CortesValor((500, 10_000_000), (200, 5_000_000), 50)


CLI = ("client_id long, rut string, nombre string, apellido string, email string, telefono string, direccion string, "
       "fecha_registro date, segmento string, sucursal_id long, _loaded_at timestamp_ntz, _source_file string")


def client(i, nombre="  ana maría ", registro=date(2020, 12, 31), branch=1, loaded=T0, email=" A@B.CL "):
    return (i, "11.111.111-1", nombre, "SOTO", email, "+56912345678", "Calle 1", registro, "VIP", branch, loaded, "f")


def test_dim_clientes_cleans_and_keeps_newest(spark):
    df = spark.createDataFrame(
        [client(1), client(1, nombre="nueva", loaded=datetime(2024, 2, 1)), client(2, branch=9), client(3)], CLI)
    out = as_dicts(silver.silver_dim_clientes(df, spark.createDataFrame(BRANCHES, BRANCH), "2021-01-01"), "client_id")
    assert [r["nombre"] for r in out] == ["Nueva", "Ana María", "Ana María"]
    assert out[2]["nombre_completo"] == "Ana María Soto" and out[2]["email"] == "a@b.cl"
    assert [r["sucursal_comuna"] for r in out] == ["Ñuñoa", None, "Ñuñoa"]
    # One year boundary was crossed although one day has passed.
    assert out[0]["categoria_antiguedad"] == "Regular" and out[0]["dias_antiguedad"] == 1


@pytest.mark.parametrize("year,label", [(2015, "Veterano"), (2016, "Veterano"), (2017, "Establecido"),
                                        (2019, "Establecido"), (2020, "Regular"), (2021, "Nuevo")])
def test_tenure_classes(spark, year, label):
    df = spark.createDataFrame([client(1, registro=date(year, 6, 30))], CLI)
    out = silver.silver_dim_clientes(df, spark.createDataFrame(BRANCHES, BRANCH), "2021-01-01").first()
    assert out["categoria_antiguedad"] == label


def test_unknown_registration_is_new(spark):
    df = spark.createDataFrame([client(1, registro=None)], CLI)
    out = silver.silver_dim_clientes(df, spark.createDataFrame(BRANCHES, BRANCH), "2021-01-01").first()
    assert out["categoria_antiguedad"] == "Nuevo" and out["dias_antiguedad"] is None


SAL = ("saldo_id long, client_id long, producto_id long, fecha_corte date, saldo_contable decimal(15,2), "
       "saldo_disponible decimal(15,2), saldo_promedio_mes decimal(15,2), estado_cuenta string")


def saldos(spark, *rows):
    return spark.createDataFrame(
        [(i, c, p, d, D(b), D(a), D(0), s) for i, (c, p, d, b, a, s) in enumerate(rows)], SAL)


def test_saldos_bands_and_newest(spark):
    day, later = date(2024, 1, 1), date(2024, 2, 1)
    df = saldos(spark, (1, 1, day, 60_000_000, 1, "Activa"), (1, 1, later, 50_000_000, 1, "Activa"),
                (1, 2, day, 50_000_001, 1, "Activa"), (2, 1, day, 1, 1, "Activa"), (3, 1, day, 0, 1, "Activa"),
                (4, 1, day, 5_000_001, 0, "Activa"))
    out = {(r["client_id"], r["producto_id"]): r for r in silver.silver_saldos_actuales(df).collect()}
    assert {k: r["rango_saldo"] for k, r in out.items()} == {
        (1, 1): "Medio", (1, 2): "Alto", (2, 1): "Bajo", (3, 1): "Sin saldo", (4, 1): "Medio"}
    assert out[(1, 1)]["fecha_ultimo_saldo"] == later and out[(1, 1)]["saldo_retenido"] == D(49_999_999)


def profile(spark, n_txn, saldo, **kw):
    dim = silver.silver_dim_clientes(spark.createDataFrame([client(1)], CLI), spark.createDataFrame(BRANCHES, BRANCH),
                                     "2021-01-01")
    txn = silver.silver_fact_transacciones(txns(spark, *[{} for _ in range(n_txn)]), "2024-02-01")
    sal = silver.silver_saldos_actuales(saldos(spark, (1, 1, date(2024, 1, 1), saldo, 0, "Activa")))
    return gold.gold_perfil_360(dim, txn, sal, "2024-02-01", params.CortesValor((5, 1000), (3, 500), 1)).first()


@pytest.mark.parametrize("n,saldo,label", [(6, 1001, "A - Premium"), (6, 1000, "B - Alto"), (4, 0, "B - Alto"),
                                           (0, 501, "B - Alto"), (2, 0, "C - Medio"), (1, 0, "D - Bajo")])
def test_value_classes(spark, n, saldo, label):
    row = profile(spark, n, saldo)
    assert row["categoria_valor"] == label
    assert row["total_transacciones"] == n
    if n == 0:
        assert row["primera_txn"] is None and row["balance_neto"] == 0


def test_profile_counts_rejected_and_recent(spark):
    dim = silver.silver_dim_clientes(spark.createDataFrame([client(1)], CLI), spark.createDataFrame(BRANCHES, BRANCH),
                                     "2021-01-01")
    txn = silver.silver_fact_transacciones(
        txns(spark, {"estado": "Rechazada"}, {"monto": "-4.00"}, {"fecha": datetime(2023, 1, 1)}), "2024-02-01")
    row = gold.gold_perfil_360(dim, txn, saldos(spark, (1, 1, date(2024, 1, 1), 9, 0, "Inactiva")), "2024-02-01").first()
    assert (row["total_transacciones"], row["transacciones_aprobadas"]) == (3, 2)
    assert (row["total_ingresos"], row["total_egresos"], row["balance_neto"]) == (D("20.00"), D("4.00"), D("16.00"))
    assert (row["transacciones_90d"], row["volumen_90d"], row["saldo_total"]) == (2, D("6.00"), 0)


def test_products_without_activity_stay(spark):
    prod = spark.createDataFrame([(1, "Fondo", "VIP", D("1.50")), (2, "Cuenta", "VIP", D("2.50"))],
                                 "producto_id long, tipo string, segmento string, tasa_anual decimal(5,2)")
    out = as_dicts(marts.metricas_productos(prod, txns(spark, {}, {"estado": "Rechazada"})), "producto_id")
    assert (out[0]["total_operaciones"], out[1]["total_operaciones"]) == (2, 0)
    assert out[1]["clientes_activos"] == 0 and out[1]["volumen_total"] is None


def test_top_clients_rank_by_turnover_but_report_income(spark):
    fact = txns(spark, {"client": 1, "monto": "-100.00"}, {"client": 2, "monto": "60.00"},
                {"client": 3, "monto": "60.00"}, {"client": 4, "monto": "999.00", "estado": "Rechazada"})
    dim = spark.createDataFrame([(i, f"N{i}", "VIP") for i in range(1, 5)],
                                "client_id long, nombre_completo string, segmento string")
    out = as_dicts(marts.top_clientes_sucursal(fact, dim, spark.createDataFrame(BRANCHES, BRANCH), 2), "ranking")
    assert [(r["client_id"], r["volumen_total"]) for r in out] == [(1, D("0.00")), (2, D("60.00"))]


def score(spark, n_txn=0, amount="10.00", saldo=None, registro=date(2024, 1, 1)):
    dim = spark.createDataFrame([(1, "VIP", "X", registro)],
                                "client_id long, segmento string, sucursal_comuna string, fecha_registro date")
    fact = txns(spark, *[{"monto": amount} for _ in range(n_txn)] or [{"client": 99}])
    sal = saldos(spark, *([(1, 1, date(2024, 1, 1), saldo, 0, "Activa")] if saldo is not None else
                          [(99, 1, date(2024, 1, 1), 1, 0, "Activa")]))
    return processes.scoring_clientes(dim, fact, sal, "2024-01-31").first()


def test_score_without_anything(spark):
    row = score(spark)
    assert [row[c] for c in ("score_actividad", "score_volumen", "score_saldo", "score_antiguedad")] == [0, 0, 0, 5]
    assert row["categoria_score"] == "D - Básico" and row["total_txn"] is None


def test_score_unknown_tenure_is_minimum(spark):
    assert score(spark, registro=None)["score_antiguedad"] == 5


@pytest.mark.parametrize("n,points", [(10, 5), (11, 10), (51, 15)])
def test_score_activity(spark, n, points):
    row = score(spark, n)
    assert row["score_actividad"] == points and row["meses_activo"] == n


@pytest.mark.parametrize("amount,points", [("100000.00", 5), ("100000.01", 10), ("1000001", 15), ("10000001", 20),
                                           ("50000001", 25), ("100000001", 30), ("-5", 5)])
def test_score_volume(spark, amount, points):
    assert score(spark, 1, amount)["score_volumen"] == points


@pytest.mark.parametrize("saldo,points", [(-1, 5), (1_000_000, 5), (1_000_001, 10), (10_000_001, 15), (100_000_001, 20)])
def test_score_balance(spark, saldo, points):
    assert score(spark, saldo=saldo)["score_saldo"] == points


@pytest.mark.parametrize("days,points", [(365, 5), (366, 10), (1096, 15), (1826, 20)])
def test_score_tenure(spark, days, points):
    row = score(spark, registro=date.fromordinal(date(2024, 1, 31).toordinal() - days))
    assert row["antiguedad_dias"] == days and row["score_antiguedad"] == points


MOV = "movimiento_id long, client_id long, producto_id long, fecha date, monto decimal(15,2)"


def test_reconciliation_states(spark):
    day = date(2024, 1, 1)
    mov = spark.createDataFrame([(1, 1, 1, day, D(5000)), (2, 2, 1, day, D(5000)), (3, 3, 1, day, D(5000)),
                                 (4, 4, 1, day, D(900)), (5, None, 1, day, D(7000))], MOV)
    sal = saldos(spark, (1, 1, day, 4000, 0, "A"), (2, 1, day, 3999, 0, "A"), (5, 1, day, 5000, 0, "A"),
                 (6, 1, day, -1000, 0, "A"))
    out = {r["client_id"]: r["estado_reconciliacion"] for r in processes.reconciliacion_saldos(mov, sal).collect()}
    # One-sided rows within the tolerance are OK; a null client matches nothing.
    assert out == {1: "OK", 2: "DISCREPANCIA", 3: "SIN_SALDO_REPORTADO", 4: "OK", 5: "SIN_MOVIMIENTOS", 6: "OK",
                   None: "SIN_SALDO_REPORTADO"}


def test_month_on_month_guards(spark):
    rows = [{"fecha": datetime(2024, m, 5), "monto": v} for m, v in ((1, "10"), (2, "0"), (3, "-5"), (6, "-10"))]
    out = as_dicts(processes.agregacion_mensual_clientes(txns(spark, *rows)), "mes")
    assert [r["variacion_mom"] for r in out] == [None, D("-100.00"), None, D("-100.00")]
    assert [r["neto_acum"] for r in out] == [D(10), D(10), D(5), D(-5)]
    # Three rows, not three calendar months.
    assert out[3]["promedio_movil_3m"] == D("-5.00")


# Privacy -----------------------------------------------------------------------------------

def people(spark, *rows):
    return spark.createDataFrame(list(rows), "client_id long, rut string, nombre string, email string, telefono string, "
                                             "pseudonymized boolean, pseudonymized_at timestamp_ntz")


def test_masks(spark):
    df = people(spark, (1, "11.111.111-1", "Ana", "a@b.cl", "+56912345678", False, None),
                (2, None, None, None, None, False, None))
    out = as_dicts(privacy.apply_masking(df, "ANALYST_ROLE"), "client_id")
    assert (out[0]["rut"], out[0]["nombre"], out[0]["email"], out[0]["telefono"]) == (
        "**.***.***-*", "***", "***@masked.local", "+569*****678")
    assert (out[1]["rut"], out[1]["email"], out[1]["telefono"]) == ("**.***.***-*", "***@masked.local", None)
    for role in ("COMPLIANCE_ROLE", "ACCOUNTADMIN", "SYSADMIN"):
        assert as_dicts(privacy.apply_masking(df, role), "client_id") == as_dicts(df, "client_id")


def test_pseudonyms(spark):
    df = people(spark, (1, "11.111.111-1", "Ana", "a@b.cl", None, False, None),
                (2, "22.222.222-2", "Ana", "c@d.cl", "x", False, None))
    targets = spark.createDataFrame([(1,), (7,)], "client_id long")
    out = as_dicts(privacy.pseudonymize(df, targets, ["rut", "nombre", "email", "telefono"],
                                        privacy.salt_table(spark, "s"), "2024-01-01"), "client_id")
    assert len(out[0]["rut"]) == 8 and out[0]["email"].endswith("@del.local") and out[0]["telefono"] is None
    assert out[0]["pseudonymized"] and out[0]["pseudonymized_at"] == datetime(2024, 1, 1)
    assert out[1] == as_dicts(df, "client_id")[1]


def test_same_value_same_salt_same_hash(spark):
    df = people(spark, (1, "r", "Ana", None, None, False, None), (2, "r", "Ana", None, None, False, None))
    targets = spark.createDataFrame([(1,), (2,)], "client_id long")
    out = as_dicts(privacy.pseudonymize(df, targets, ["nombre"], privacy.salt_table(spark, "s")), "client_id")
    other = as_dicts(privacy.pseudonymize(df, targets, ["nombre"], privacy.salt_table(spark, "t")), "client_id")
    assert out[0]["nombre"] == out[1]["nombre"] != other[0]["nombre"]


def test_salt_is_not_in_the_plan(spark):
    df = people(spark, (1, "r", "Ana", None, None, False, None))
    out = privacy.pseudonymize(df, spark.createDataFrame([(1,)], "client_id long"), ["nombre"],
                               privacy.salt_table(spark, "very-secret"))
    out.collect()
    assert "very-secret" not in out._jdf.queryExecution().toString()
    assert privacy.new_salt(spark).first()[0] != privacy.new_salt(spark).first()[0]


def deletion_setup(spark):
    dim = people(spark, (1, "r1", "Ana", "a@b", "1", False, None), (2, "r2", "Eva", "e@b", "2", False, None))
    asked = spark.createDataFrame([(1, "x"), (1, "y"), (9, "z")], "user_id long, reason string")
    return dim, privacy.new_requests(asked, dim, last_id=10, as_of="2024-01-01")


def test_new_requests_have_defaults(spark):
    _, requests = deletion_setup(spark)
    rows = as_dicts(requests, "request_id")
    assert [r["request_id"] for r in rows] == [11, 12, 13]
    assert [r["user_identifier"] for r in rows] == ["r1", "r1", None]
    assert {(r["request_source"], r["status"], r["hash_algorithm"]) for r in rows} == {
        ("web_form", "PENDING", "SHA2-256")}


def test_only_pending_requests_run(spark):
    dim, requests = deletion_setup(spark)
    held = requests.withColumn("status", F.when(F.col("request_id") == 12, "FAILED").otherwise(F.col("status")))
    done = privacy.process_deletion_requests(held, {"dim": (dim, ["nombre"])}, privacy.salt_table(spark, "s"),
                                             "2024-01-02")
    rows = {r["request_id"]: r for r in done.requests.collect()}
    assert [(rows[i]["status"], rows[i]["rows_affected"]) for i in (11, 12, 13)] == [
        ("COMPLETED", 1), ("FAILED", None), ("COMPLETED", 0)]
    assert {(r["request_id"], r["rows_updated"]) for r in done.log.collect()} == {(11, 1), (13, 0)}
    after = as_dicts(done.tables["dim"], "client_id")
    assert after[0]["pseudonymized"] and not after[1]["pseudonymized"]
    messages = {r["request_id"]: r["mensaje"] for r in privacy.deletion_messages(
        done.requests, spark.createDataFrame([(11,), (12,), (99,)], "request_id long")).collect()}
    assert messages[11] == "OK: Usuario 1 pseudonimizado. 1 filas afectadas."
    assert messages[12].startswith("ERROR") and messages[99] == "ERROR: Solicitud 99 no existe"


# Quality -----------------------------------------------------------------------------------

def test_metrics(spark):
    df = spark.createDataFrame(
        [(1, "11.111.111-K"), (1, "11.111.111-k"), (2, None), (None, "1.111.111-1"), (3, "ab12cd34"), (4, "x" * 20)],
        "id long, rut string")
    got = {(r["metrica"], r["columna"]): r["valor"] for r in quality.run_metrics(
        df, "t", [("NULL_COUNT", "rut"), ("DUPLICATE_COUNT", "id"), ("INVALID_RUT_COUNT", "rut")], "2024-01-01").collect()}
    # A hashed value of 8 characters counts as invalid, one of 20 does not.
    assert got == {("NULL_COUNT", "rut"): 1, ("DUPLICATE_COUNT", "id"): 1, ("INVALID_RUT_COUNT", "rut"): 3}


def test_invalid_rut_may_skip_pseudonyms(spark):
    df = spark.createDataFrame([("ab12cd34", True), ("bad", False)], "rut string, pseudonymized boolean")
    assert df.agg(quality.invalid_rut_count("rut", F.col("pseudonymized"))).first()[0] == 1


def test_freshness(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 0, 0, 30),), (None,)], "t timestamp_ntz")
    assert df.agg(quality.freshness("t", "2024-01-01 00:01:00")).first()[0] == 30


def test_tags(spark):
    tags = quality.set_tags(spark, [("t", None, "DATA_CLASSIFICATION", "PII"), ("t", "a", "DATA_CLASSIFICATION", "OTRO"),
                                    ("t", "b", "DATA_OWNER", "cualquiera"), ("u", "c", "DESCONOCIDO", "x")])
    assert {(r["objeto"], r["columna"]) for r in quality.tag_violations(tags).collect()} == {("t", "a"), ("u", "c")}
    assert [r["columna"] for r in quality.tag_references(tags, "t").collect()] == [None, "a", "b"]


def test_classify_needs_enough_matches(spark):
    rows = [("a@b.cl", "a@b.cl", None, "x")] * 8 + [("roto", "roto", None, "x")] * 2 + [(None, "roto", None, "x")]
    df = spark.createDataFrame(rows, "c1 string, c2 string, c3 string, nombre string")
    got = {r["columna"]: r["categoria"] for r in quality.classify_pii(df).collect()}
    assert got == {"c1": "EMAIL", "nombre": "NAME"}
    assert "nombre" not in {r["columna"] for r in quality.classify_pii(df, by_name=False).collect()}


def test_usage_prefix_is_literal(spark):
    df = spark.createDataFrame([("A_ETL", D("2.00"), datetime(2024, 1, 2)), ("A_ETL", D("1.00"), datetime(2024, 1, 3)),
                                ("AXETL", D("9.00"), datetime(2024, 1, 3)), ("A_ETL", D("9.00"), datetime(2023, 1, 3))],
                               "warehouse_name string, credits_used decimal(9,2), start_time timestamp_ntz")
    out = as_dicts(monitoring.usage_by_group(df, "A_", "2024-01-04"))
    assert [(r["warehouse_name"], r["total_credits"], r["dias_activo"], r["credits_por_dia"]) for r in out] == [
        ("A_ETL", D("3.00"), 2, D("1.50"))]


# Expressions -------------------------------------------------------------------------------

def test_expressions(spark):
    one = spark.range(1)
    v = one.select(
        percent(F.lit(1), F.lit(800)).alias("tie"), percent(F.lit(1), F.lit(0)).alias("none"),
        banded(F.lit(5), ((5, "a"), (1, "b")), "c").alias("over"),
        banded(F.lit(5), ((5, "a"), (1, "b")), "c", at_least=True).alias("reach"),
        banded(F.lit(None).cast("int"), ((5, "a"),), "c").alias("null"),
        years_between(F.lit("2020-12-31").cast("date"), F.lit("2021-01-01").cast("date")).alias("years"),
    ).first()
    assert (v["tie"], v["none"], v["over"], v["reach"], v["null"], v["years"]) == (D("0.13"), None, "b", "a", "c", 1)


def test_needed_literals_are_in_every_match():
    from ledgerlake.operators.quality import needed_literals

    assert needed_literals(r"a{2,3}?b?c*d+?e[f|(]\.x{0,2}y++") == ["a", "d", "e", ".", "y"]
    assert needed_literals("a|b") == needed_literals("(a)b") == needed_literals("[ab]?") == []
    assert needed_literals(r"\(\d+x") == ["(", "x"]


def test_pii_counts_by_brute_force(spark):
    import re

    from ledgerlake.operators.quality import PII_IN_TEXT, pii_in_text

    texts = ["a@b.cl and x.y@z.org", "11.222.333-4, 1.222.333-K", "+56 9 1234 5678", "no-one. here", None, "", "tel +1", "5.111.222"]
    df = spark.createDataFrame([("k", t) for t in texts], "g string, t string")
    row = pii_in_text(df, "t", ["g"]).first()
    for kind, pattern in PII_IN_TEXT.items():
        found = [len(re.findall(pattern, t or "")) for t in texts]
        assert (row[f"{kind.lower()}_filas"], row[f"{kind.lower()}_hallazgos"]) == (sum(n > 0 for n in found), sum(found))


def test_reconciliation_carries_only_what_it_reports(spark):
    """Balances that tie by date and number still end in the highest one."""
    moves = spark.createDataFrame([(1, 1, 1, 10, date(2024, 1, 1))], "movimiento_id long, client_id long, producto_id long, monto long, fecha date")
    out = processes.reconciliacion_saldos(
        moves.withColumn("monto", F.col("monto").cast("decimal(15,2)")),
        saldos(spark, (1, 1, date(2024, 1, 2), 30.0, 0.0, "Activa"), (1, 1, date(2024, 1, 1), 90.0, 0.0, "Activa"), (None, 2, None, 5.0, 1.0, None)))
    steps = [line for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "LogicalRDD" not in line]
    assert not any("saldo_promedio_mes" in line or "estado_cuenta" in line for line in steps)
    got = {r["producto_id"]: (r["saldo_contable"], r["fecha_corte"], r["diferencia"]) for r in out.collect()}
    assert got[1] == (30, date(2024, 1, 2), -20) and got[2] == (5, None, -5)


def test_a_result_saved_twice_is_worked_out_once(spark, sf, monkeypatch):
    made = []
    monkeypatch.setattr(queries_sources, "materialize", lambda df: made.append(materialize(df)) or made[-1])
    out = queries_sources.a13(spark, sf)
    assert len(made) == 1 and made[0].filter("estado_reconciliacion <> 'OK'").count() == out.count() > 0


def test_pairs_of_a_distinct_count_carry_no_measures(spark):
    """There may be as many pairs as rows; null clients and products, and products without rows, count as before."""
    rows = txns(spark, {}, {"client": 2, "monto": "-4.00"}, {"client": None}, {"producto": None}, {"monto": None, "estado": "Rechazada"}, {"producto": 3})
    products = spark.createDataFrame([(1, "A", "s", D("0.50")), (2, "B", "s", None)], "producto_id long, tipo string, segmento string, tasa_anual decimal(5,2)")
    metrics, activity = marts.metricas_productos(products, rows), gold.client_activity(silver.silver_fact_transacciones(rows, "2024-06-01"), "2024-06-01")
    for df in (metrics, activity):
        pairs = [line for line in plan_of(df).splitlines() if re.search(r"Aggregate\(key[s]?=\[[^\]]*(client_id[^\]]*producto_id|producto_id[^\]]*client_id)", line)]
        assert pairs and not any(word in line for line in pairs for word in ("sum(", "min(", "max("))
    got = {r["producto_id"]: (r["total_operaciones"], r["volumen_total"], r["clientes_activos"]) for r in metrics.collect()}
    assert got == {1: (4, D("16.00"), 2), 2: (0, None, 0)}
    got = {r["client_id"]: (r["total_txn"], r["neto"], r["productos"]) for r in activity.collect()}
    assert got == {1: (3, D("30.00"), 2), 2: (1, D("-4.00"), 1)}


def test_months_of_activity_need_no_pairs_of_client_and_month(spark):
    """Months are bits of 64-month words: across words, repeated, far back and null ones count as distinct months did."""
    at = lambda y, m, d=1: datetime(y, m, d)
    rows = txns(
        spark, {"fecha": at(2024, 1)}, {"fecha": at(2024, 1, 31), "monto": "-4.00"}, {"fecha": at(2023, 12)}, {"fecha": at(2018, 9)},
        {"fecha": at(1, 1)}, {"fecha": None, "producto": None}, {"client": 2, "fecha": None, "monto": None}, {"client": None})
    dim = spark.createDataFrame([(1, "s", "c"), (2, "s", "c")], "client_id long, segmento string, sucursal_comuna string")
    out = marts.resumen_actividad(dim, rows)
    assert not re.search(r"Aggregate\(key[s]?=\[client_id#\d+L?, _mes", plan_of(out))
    got = {r["client_id"]: (r["meses_activo"], r["total_transacciones"], r["productos_utilizados"], r["balance_neto"], r["monto_mediana"])
           for r in out.collect()}
    assert got == {1: (4, 6, 1, D("46.00"), D("10.000")), 2: (0, 1, 1, None, None)}
    assert dict(out.dtypes)["balance_neto"] == "decimal(25,2)" and dict(out.dtypes)["meses_activo"] == "bigint"
