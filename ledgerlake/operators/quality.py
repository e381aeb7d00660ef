"""Data-quality metrics, tags, and detection of columns with personal data."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlake.functions import now
from ledgerlake.functions.clock import AsOf

# The identity document format and the length from which a value counts as hashed.
RUT_PATTERN = r"^[0-9]{2}\.[0-9]{3}\.[0-9]{3}-[0-9K]$"
HASHED_LENGTH = 20

# Patterns of personal data, in a syntax all engines share, tried on whole values.
PII_PATTERNS = {
    "NATIONAL_ID": r"^[0-9]{1,2}\.?[0-9]{3}\.?[0-9]{3}-[0-9Kk]$",
    "EMAIL": r"^[A-Za-z0-9._%+#-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$",
    "PHONE_NUMBER": r"^\+?[0-9][0-9 ()-]{6,18}[0-9]$",
}
# The same kinds of data inside free text.
PII_IN_TEXT = {
    "NATIONAL_ID": r"[0-9]{1,2}\.[0-9]{3}\.[0-9]{3}-[0-9Kk]",
    "EMAIL": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "PHONE_NUMBER": r"\+[0-9][0-9 ()-]{7,18}[0-9]",
}
# Column names that suggest personal data.
PII_NAMES = {
    "NAME": ("nombre", "apellido", "nombre_completo"),
    "ADDRESS": ("direccion",),
    "NATIONAL_ID": ("rut",),
    "EMAIL": ("email", "correo"),
    "PHONE_NUMBER": ("telefono", "fono"),
}

# What tags may hold, and the tags that may hold anything.
ALLOWED_VALUES = {"DATA_CLASSIFICATION": ("PII", "FINANCIAL", "CONFIDENTIAL", "PUBLIC")}
FREE_TAGS = ("DATA_OWNER", "RETENTION_DAYS")
TAGS_SCHEMA = "objeto string, columna string, tag string, valor string"


def null_count(c: str) -> Column:
    return F.count_if(F.col(c).isNull())


def newest(c: str) -> Column:
    return F.max(F.col(c).cast("timestamp_ntz"))


def duplicate_count(c: str) -> Column:
    """Rows beyond the first of each non-null value."""
    return F.count(c) - F.count_distinct(c)


def freshness(c: str, as_of: AsOf = None) -> Column:
    """Seconds from the newest value to the reference time."""
    return seconds_since(newest(c), as_of)


def seconds_since(moment: Column, as_of: AsOf = None) -> Column:
    return F.timestamp_diff("SECOND", moment, now(as_of))


def invalid_rut(c: str) -> Column:
    return F.col(c).isNotNull() & ~F.col(c).rlike(RUT_PATTERN) & (F.length(c) < HASHED_LENGTH)


def invalid_rut_count(c: str, exclude_pseudonymized: Column | None = None) -> Column:
    """Identifiers that break the format. Short hashes count too, unless their rows are excluded."""
    wrong = invalid_rut(c)
    if exclude_pseudonymized is not None:
        wrong = wrong & ~exclude_pseudonymized
    return F.count_if(wrong)


METRICS = {
    "NULL_COUNT": null_count,
    "DUPLICATE_COUNT": duplicate_count,
    "FRESHNESS": freshness,
    "INVALID_RUT_COUNT": invalid_rut_count,
}


def run_metrics(df: DataFrame, table: str, specs: Sequence[tuple[str, str]], as_of: AsOf = None) -> DataFrame:
    """All (metric, column) pairs of a table; one output row per metric.

    Duplicate counts need a shuffle of their column and get a narrow pass each; all other metrics
    share one pass and reduce to a row per task.
    """
    alone = [[s] for s in specs if s[0] == "DUPLICATE_COUNT"]
    together = [s for s in specs if s[0] != "DUPLICATE_COUNT"]
    parts = [_measured(df, table, part, as_of) for part in ([together] if together else []) + alone]
    return reduce(DataFrame.unionByName, parts)


def _measured(df: DataFrame, table: str, specs: Sequence[tuple[str, str]], as_of: AsOf) -> DataFrame:
    values = []
    for i, (metric, column) in enumerate(specs):
        value = freshness(column, as_of) if metric == "FRESHNESS" else METRICS[metric](column)
        values.append(value.cast("long").alias(f"_m{i}"))
    return measured_rows(df.agg(*values), table, specs, as_of)


def measured_rows(values: DataFrame, table: str, specs: Sequence[tuple[str, str]], as_of: AsOf = None) -> DataFrame:
    """One row of ``_m0, _m1, …`` as one row per (metric, column)."""
    rows = [
        F.struct(F.lit(m).alias("metrica"), F.lit(c).alias("columna"), F.col(f"_m{i}").alias("valor"))
        for i, (m, c) in enumerate(specs)
    ]
    return values.select(F.explode(F.array(*rows)).alias("_r")).select(F.lit(table).alias("tabla"), "_r.*", now(as_of).alias("medido_en"))


def metric_results(results: DataFrame, n: int = 20) -> DataFrame:
    """The newest measurements."""
    return results.orderBy(F.col("medido_en").desc_nulls_last(), "tabla", "metrica", "columna").limit(n)


def set_tags(spark: SparkSession, rows: Sequence[tuple[str, str | None, str, str]]) -> DataFrame:
    """Tags on tables (column null) and columns."""
    return spark.createDataFrame(list(rows), TAGS_SCHEMA)


def tag_violations(tags: DataFrame, allowed: dict[str, Sequence[str]] = ALLOWED_VALUES) -> DataFrame:
    """Tag rows whose value the tag does not allow, or whose tag does not exist."""
    wrong = ~F.col("tag").isin(*allowed, *FREE_TAGS)
    for tag, values in allowed.items():
        wrong = wrong | ((F.col("tag") == tag) & ~F.coalesce(F.col("valor").isin(*values), F.lit(False)))
    return tags.filter(wrong)


def tag_references(tags: DataFrame, table: str) -> DataFrame:
    return tags.filter(F.col("objeto") == table).orderBy(F.col("columna").asc_nulls_first(), "tag")


def classify_pii(
    df: DataFrame,
    patterns: dict[str, str] = PII_PATTERNS,
    threshold: float = 0.8,
    by_name: bool = True,
) -> DataFrame:
    """Category and share of matching values per text column, in one pass over the table.

    A column gets a category when enough of its non-null values match the pattern; failing that,
    when its name is a known one.
    """
    names = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    rates = [F.avg(F.col(n).rlike(p).cast("int")).alias(f"{n}|{k}") for n in names for k, p in patterns.items()]
    hints = {n: next((k for k, known in PII_NAMES.items() if by_name and n.lower() in known), None) for n in names}
    rows = []
    for n in names:
        scored = F.array(*[
            F.struct(F.col(f"`{n}|{k}`").alias("tasa"), F.lit(k).alias("categoria")) for k in patterns
        ])
        best = F.array_max(F.filter(scored, lambda s: s["tasa"] >= threshold))
        rows.append(F.struct(
            F.lit(n).alias("columna"),
            F.coalesce(best["categoria"], F.lit(hints[n])).alias("categoria"),
            F.coalesce(best["tasa"], F.lit(0.0)).alias("tasa"),
        ))
    return df.agg(*rates).select(F.explode(F.array(*rows)).alias("_r")).select("_r.*").filter("categoria is not null")


def auto_tag(classified: DataFrame, table: str) -> DataFrame:
    """Tag the columns found to hold personal data."""
    return classified.select(
        F.lit(table).alias("objeto"), "columna", F.lit("DATA_CLASSIFICATION").alias("tag"), F.lit("PII").alias("valor")
    )


_ATOM = re.compile(r"\[(?:\\.|[^\]])+\]|\\.|.", re.S)
_TIMES = re.compile(r"[?*]|\{0|\+|\{")


def needed_literals(pattern: str) -> list[str]:
    """Characters that every match of a pattern holds: plain ones outside sets that may not be left out.

    Patterns with alternatives or groups promise none.
    """
    if re.search(r"(?<!\\)[|()]", re.sub(r"\[(?:\\.|[^\]])+\]", "", pattern)):
        return []
    out, at = [], 0
    while at < len(pattern):
        atom = _ATOM.match(pattern, at).group()
        at += len(atom)
        times = _TIMES.match(pattern, at)
        if pattern.startswith("{", at):
            at = pattern.index("}", at) + 1
        elif times:
            at += 1
        if times and pattern.startswith(("?", "+"), at):  # lazy or possessive
            at += 1
        escaped = len(atom) == 2 and atom[0] == "\\"
        plain = not atom[1].isalnum() if escaped else len(atom) == 1 and atom not in ".^$"
        literal = atom[-1]
        if plain and (times is None or times.group() in ("+", "{")):
            out.append(literal)
    return list(dict.fromkeys(out))


def pii_in_text(df: DataFrame, text: str, keys: Sequence[str], patterns: dict[str, str] = PII_IN_TEXT) -> DataFrame:
    """Rows and matches per kind of personal data found anywhere in a text column, per key.

    A pattern is tried on texts that have all the characters which its matches must have.
    """
    found = {}
    for kind, pattern in patterns.items():
        count = F.coalesce(F.regexp_count(F.col(text), F.lit(pattern)), F.lit(0))
        needed = needed_literals(pattern)
        if needed:
            possible = reduce(lambda a, b: a & b, [F.contains(F.col(text), F.lit(c)) for c in needed])
            count = F.when(possible, count).otherwise(F.lit(0))
        found[kind] = count
    counts = [F.count_if(F.col(f"_{k}") > 0).alias(f"{k.lower()}_filas") for k in patterns]
    totals = [F.sum(f"_{k}").cast("long").alias(f"{k.lower()}_hallazgos") for k in patterns]
    scanned = df.select(*keys, *[v.alias(f"_{k}") for k, v in found.items()])
    return scanned.groupBy(*keys).agg(F.count("*").alias("filas"), *counts, *totals)


def governance_dashboard(metrics: DataFrame, requests: DataFrame, dim: DataFrame) -> DataFrame:
    """Quality metrics, requests by status and pseudonymised clients in one list of text values."""
    quality = metrics.select(
        F.lit("Data Quality").alias("categoria"), F.col("tabla").alias("objeto"), "metrica",
        F.col("valor").cast("string").alias("valor"), F.col("medido_en").alias("momento"),
    )
    by_status = requests.groupBy("status").agg(F.count("*").alias("n"), F.max("requested_at").alias("momento")).select(
        F.lit("Compliance").alias("categoria"), F.lit("DELETION_REQUESTS").alias("objeto"),
        F.col("status").alias("metrica"), F.col("n").cast("string").alias("valor"), "momento",
    )
    hidden = dim.filter("pseudonymized").agg(
        F.count("*").alias("n"), F.max("pseudonymized_at").cast("timestamp_ntz").alias("momento")
    ).select(
        F.lit("Compliance").alias("categoria"), F.lit("DIM_CLIENTES").alias("objeto"),
        F.lit("Pseudonimizados").alias("metrica"), F.col("n").cast("string").alias("valor"), "momento",
    )
    return quality.unionByName(by_status).unionByName(hidden)
