"""Thresholds and labels of the business rules, with the defaults of the lab scale.

Every operator takes them as arguments, because other currencies and data volumes need others.
"""

from __future__ import annotations

from dataclasses import dataclass

APROBADA = "Aprobada"
RECHAZADA = "Rechazada"
ACTIVA = "Activa"
OK = "OK"

# Calendar-year difference at least …
ANTIGUEDAD = ((5, "Veterano"), (2, "Establecido"), (1, "Regular"))
ANTIGUEDAD_RESTO = "Nuevo"

# Movements above this amount are flagged.
MONTO_ANOMALO = 100_000_000
# A negative balance after these movement types is normal.
TIPOS_CON_SALDO_NEGATIVO = ("Cargo", "Comisión")

# Book balance above …
RANGOS_SALDO = ((50_000_000, "Alto"), (5_000_000, "Medio"), (0, "Bajo"))
RANGO_SALDO_RESTO = "Sin saldo"

# Reconciliation tolerance in currency units.
TOLERANCIA = 1000


@dataclass(frozen=True)
class CortesValor:
    """Value classes of the customer profile: A needs both bounds, B either, C the count."""

    a: tuple[int, int] = (500, 10_000_000)
    b: tuple[int, int] = (200, 5_000_000)
    c: int = 50


@dataclass(frozen=True)
class CortesScore:
    """Score points by lower bound (exclusive)."""

    actividad: tuple = ((500, 30), (200, 25), (100, 20), (50, 15), (10, 10))
    volumen: tuple = ((100_000_000, 30), (50_000_000, 25), (10_000_000, 20), (1_000_000, 15), (100_000, 10))
    saldo: tuple = ((100_000_000, 20), (10_000_000, 15), (1_000_000, 10))
    antiguedad: tuple = ((1825, 20), (1095, 15), (365, 10))
    minimo: int = 5


# Total score at least …
CATEGORIAS_SCORE = ((80, "A - Excelente"), (60, "B - Bueno"), (40, "C - Regular"))
CATEGORIA_SCORE_RESTO = "D - Básico"
