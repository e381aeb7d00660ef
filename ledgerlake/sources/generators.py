"""Synthetic banking tables, computed row by row from a sequence number.

Every generator takes a DataFrame with a ``seq`` column (0-based), so that the caller decides the
volume and the number of partitions; ``sequence`` makes one. No shuffle, no driver data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlake.functions import draw, money, now, today
from ledgerlake.functions.clock import AsOf

# Lab volumes.
ROWS = {
    "sucursales": 200, "productos": 5_000, "clientes": 500_000,
    "transacciones": 50_000_000, "movimientos": 10_000_000, "saldos": 8_000_000,
}
# Word lists, picked by row number.
COMUNAS = ("Providencia", "Las Condes", "Santiago Centro", "Vitacura", "Ñuñoa", "La Florida", "Maipú",
           "Puente Alto", "Valparaíso", "Concepción")
REGIONES = {8: "Valparaíso", 9: "Biobío"}
REGION_RESTO = "Región Metropolitana"
CATEGORIAS = ("Grande", "Mediana", "Pequeña")
TIPOS_PRODUCTO = ("Cuenta Corriente", "Cuenta Ahorro", "Depósito a Plazo", "Fondo Mutuo", "Crédito Consumo",
                  "Crédito Hipotecario", "Tarjeta Crédito", "Línea de Crédito")
SON_CREDITO = (4, 5, 7)  # the credit card, 6, is not flagged
SEGMENTOS_PRODUCTO = ("Personas", "Empresas", "Premium", "Personas")
NOMBRES = ("María", "Juan", "Carolina", "Roberto", "Andrea", "Felipe", "Valentina", "Sebastián", "Catalina",
           "Nicolás", "Javiera", "Diego", "Francisca", "Matías", "Constanza", "Tomás", "Camila", "Ignacio",
           "Josefa", "Fernando")
APELLIDOS = ("González", "Muñoz", "Rojas", "Díaz", "Pérez", "Soto", "Contreras", "Silva", "Martínez", "Sepúlveda",
             "Morales", "Rodríguez", "López", "Fuentes", "Hernández")
DOMINIOS = ("gmail.com", "hotmail.com", "yahoo.cl", "outlook.com", "empresa.cl")
COMUNAS_DIRECCION = ("Providencia", "Las Condes", "Santiago", "Vitacura", "Ñuñoa", "La Florida", "Maipú",
                     "Puente Alto", "Valparaíso", "Concepción")
SEGMENTOS_CLIENTE = ("Standard", "Premium", "VIP", "Standard")
DIGITOS = "0123456789K"
TIPOS_TXN = ("Depósito", "Retiro", "Transferencia", "Pago", "Inversión", "Comisión")
# Amount range per transaction type; transfers have a random sign.
RANGOS_TXN = ((10_000, 5_000_000), (5_000, 2_000_000), (1_000, 10_000_000), (500, 500_000),
              (100_000, 50_000_000), (100, 50_000))
SIGNOS_TXN = (1, -1, None, -1, 1, -1)
MONEDAS = ("CLP", "CLP", "USD")
ESTADOS = ("Aprobada", "Aprobada", "Aprobada", "Rechazada")
TIPOS_MOV = ("Cargo", "Abono", "Ajuste", "Interés", "Comisión")
CUENTAS = ("Activa", "Activa", "Inactiva")
FIVE_YEARS_SECONDS = 157_680_000


def sequence(spark: SparkSession, n: int, partitions: int | None = None) -> DataFrame:
    """Row numbers 0 … n-1, about a million per partition unless told otherwise."""
    return spark.range(0, n, 1, partitions or max(8, -(-n // 1_000_000))).withColumnRenamed("id", "seq")


def _by_turn(labels, seq: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in labels]), (seq % len(labels)).cast("int") + 1)


def _text(number: Column, width: int | None = None) -> Column:
    text = number.cast("string")
    # Numbers longer than the width stay whole.
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0")) if width else text


def _code(prefix: str, number: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), _text(number, width))


def _days_back(seq: Column, salt: int, lo: int, hi: int, as_of: AsOf) -> Column:
    return F.date_sub(today(as_of), draw(seq, salt, lo, hi).cast("int"))


def gen_branches(ids: DataFrame, as_of: AsOf = None) -> DataFrame:
    seq = F.col("seq")
    region = F.lit(REGION_RESTO)
    for turn, name in REGIONES.items():
        region = F.when(seq % len(COMUNAS) == turn, name).otherwise(region)
    return ids.select(
        (seq + 1).alias("sucursal_id"),
        _code("SUC-", seq + 1, 4).alias("codigo"),
        _by_turn(COMUNAS, seq).alias("comuna"),
        region.alias("region"),
        _days_back(seq, 1, 365, 3650, as_of).alias("fecha_apertura"),
        _by_turn(CATEGORIAS, seq).alias("categoria"),
    )


def gen_products(ids: DataFrame) -> DataFrame:
    seq = F.col("seq")
    return ids.select(
        (seq + 1).alias("producto_id"),
        _code("PRD-", seq + 1, 6).alias("codigo"),
        _by_turn(TIPOS_PRODUCTO, seq).alias("tipo"),
        _by_turn(SEGMENTOS_PRODUCTO, seq).alias("segmento"),
        (draw(seq, 2, 50, 1500).cast("decimal(7,2)") / 100).cast("decimal(5,2)").alias("tasa_anual"),
        (seq % len(TIPOS_PRODUCTO)).isin(*SON_CREDITO).alias("es_credito"),
        F.lit(True).alias("activo"),
    )


def gen_customers(ids: DataFrame, as_of: AsOf = None, branches: int = ROWS["sucursales"]) -> DataFrame:
    seq = F.col("seq")
    rut = F.concat(
        _text(draw(seq, 3, 5, 25), 2), F.lit("."), _text(draw(seq, 4, 100, 999)), F.lit("."),
        _text(draw(seq, 5, 100, 999)), F.lit("-"),
        F.substring(F.lit(DIGITOS), draw(seq, 6, 1, len(DIGITOS)).cast("int"), F.lit(1)),
    )
    named = ids.withColumns({"nombre": _by_turn(NOMBRES, seq), "apellido": _by_turn(APELLIDOS, seq)})
    email = F.concat(
        F.lower("nombre"), F.lit("."), F.lower("apellido"), _text(draw(seq, 7, 1, 9999)), F.lit("@"),
        _by_turn(DOMINIOS, seq),
    )
    address = F.concat(F.lit("Calle "), _text(draw(seq, 9, 1, 9999)), F.lit(", "), _by_turn(COMUNAS_DIRECCION, seq))
    return named.select(
        (seq + 1).alias("client_id"),
        rut.alias("rut"),
        "nombre",
        "apellido",
        email.alias("email"),
        F.concat(F.lit("+569"), _text(draw(seq, 8, 10_000_000, 99_999_999))).alias("telefono"),
        address.alias("direccion"),
        _days_back(seq, 10, 0, 2500, as_of).alias("fecha_registro"),
        _by_turn(SEGMENTOS_CLIENTE, seq).alias("segmento"),
        draw(seq, 11, 1, branches).alias("sucursal_id"),
        F.lit(False).alias("pseudonymized"),
        F.lit(None).cast("timestamp_ntz").alias("pseudonymized_at"),
    )


def _keys(seq: Column, salt: int, clients: int, products: int, branches: int) -> list[Column]:
    return [
        draw(seq, salt, 1, clients).alias("client_id"),
        draw(seq, salt + 1, 1, products).alias("producto_id"),
        draw(seq, salt + 2, 1, branches).alias("sucursal_id"),
    ]


def gen_transactions(
    ids: DataFrame,
    as_of: AsOf = None,
    clients: int = ROWS["clientes"],
    products: int = ROWS["productos"],
    branches: int = ROWS["sucursales"],
) -> DataFrame:
    """Type sets the sign and range of the amount. Status and type both follow the row number, so
    only types 1, 3 and 5 are ever rejected."""
    seq = F.col("seq")
    lo, hi, sign = (
        F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), (seq % len(TIPOS_TXN)).cast("int") + 1)
        for values in (*zip(*RANGOS_TXN), SIGNOS_TXN)
    )
    coin = draw(seq, 26, 0, 1) * 2 - 1
    amount = draw(seq, 25, lo, hi) * F.coalesce(sign, coin)
    back = draw(seq, 24, 0, FIVE_YEARS_SECONDS)
    return ids.select(
        (seq + 1).alias("txn_id"),
        *_keys(seq, 21, clients, products, branches),
        (now(as_of) - F.make_dt_interval(secs=back.cast("decimal(18,6)"))).alias("fecha"),
        _by_turn(TIPOS_TXN, seq).alias("tipo"),
        money(amount).alias("monto"),
        _by_turn(MONEDAS, seq).alias("moneda"),
        _by_turn(ESTADOS, seq).alias("estado"),
        _code("CH-", draw(seq, 27, 1, 999_999), 8).alias("referencia"),
    )


def gen_movements(
    ids: DataFrame,
    as_of: AsOf = None,
    clients: int = ROWS["clientes"],
    products: int = ROWS["productos"],
    branches: int = ROWS["sucursales"],
) -> DataFrame:
    seq = F.col("seq")
    return ids.select(
        (seq + 1).alias("movimiento_id"),
        *_keys(seq, 31, clients, products, branches),
        _days_back(seq, 34, 0, 1825, as_of).alias("fecha"),
        _by_turn(TIPOS_MOV, seq).alias("tipo_movimiento"),
        money(draw(seq, 35, 100, 10_000_000)).alias("monto"),
        money(draw(seq, 36, 0, 100_000_000)).alias("saldo_posterior"),
        _code("MOV-", draw(seq, 37, 1, 99_999_999), 10).alias("referencia"),
    )


def gen_balances(
    ids: DataFrame, as_of: AsOf = None, clients: int = ROWS["clientes"], products: int = ROWS["productos"]
) -> DataFrame:
    seq = F.col("seq")
    return ids.select(
        (seq + 1).alias("saldo_id"),
        *_keys(seq, 41, clients, products, 1)[:2],
        _days_back(seq, 44, 0, 1825, as_of).alias("fecha_corte"),
        money(draw(seq, 45, -5_000_000, 500_000_000)).alias("saldo_contable"),
        money(draw(seq, 46, -5_000_000, 500_000_000)).alias("saldo_disponible"),
        money(draw(seq, 47, 0, 100_000_000)).alias("saldo_promedio_mes"),
        _by_turn(CUENTAS, seq).alias("estado_cuenta"),
    )


def generate_all(spark: SparkSession, scale: float = 1.0, as_of: AsOf = None) -> dict[str, DataFrame]:
    """The six tables at a fraction of the lab volume; the dimension ranges shrink with it."""
    n = {name: max(1, round(rows * scale)) for name, rows in ROWS.items()}
    ids = {name: sequence(spark, rows) for name, rows in n.items()}
    span = {"clients": n["clientes"], "products": n["productos"]}
    return {
        "sucursales": gen_branches(ids["sucursales"], as_of),
        "productos": gen_products(ids["productos"]),
        "clientes": gen_customers(ids["clientes"], as_of, n["sucursales"]),
        "transacciones": gen_transactions(ids["transacciones"], as_of, **span, branches=n["sucursales"]),
        "movimientos": gen_movements(ids["movimientos"], as_of, **span, branches=n["sucursales"]),
        "saldos": gen_balances(ids["saldos"], as_of, **span),
    }
