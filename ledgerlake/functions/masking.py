"""Masking expressions and the short hash used for pseudonyms."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# Roles that see clear text, and the replacement texts.
PRIVILEGED_ROLES = ("COMPLIANCE_ROLE", "ACCOUNTADMIN", "SYSADMIN")
RUT_MASK = "**.***.***-*"
EMAIL_MASK = "***@masked.local"
PHONE_MASK = "+569*****"
NAME_MASK = "***"
DELETED_EMAIL_SUFFIX = "@del.local"

MASKS: dict[str, Callable[[Column], Column]] = {
    "rut": lambda c: F.lit(RUT_MASK),
    "email": lambda c: F.lit(EMAIL_MASK),
    "telefono": lambda c: F.concat(F.lit(PHONE_MASK), F.right(c, F.lit(3))),
    "nombre": lambda c: F.lit(NAME_MASK),
}


def short_hash(value: Column, salt: Column, width: int = 8) -> Column:
    return F.left(F.sha2(F.concat(value, salt), 256), F.lit(width))
