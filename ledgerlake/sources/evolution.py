"""A JSON source whose schema grows: new fields are seen, proposed, promoted, and dead letters read again.

Payloads are kept as VARIANT, so no field is lost while the schema does not name it. The schema is a
versioned table of (position, field, type). A value that the schema's type cannot hold without loss makes its row a dead
letter with the field's name; after a promotion the dead letters are read under the new
schema, and those that fit now join the good rows.

Null and empty payloads, malformed JSON and JSON that is no object are dead letters for good. A field
that is absent or JSON null is null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ledgerlake.sources.tables import read_version, write_version

DOC = "_doc"
# Column types from narrow to wide, and the types of values that they hold, by how these begin.
HOLDS = {
    "bigint": ("BIGINT",), "double": ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), "boolean": ("BOOLEAN",),
    "string": ("STRING", "BIGINT", "DECIMAL", "DOUBLE", "FLOAT", "BOOLEAN"), "variant": ("",),
}
_FIELDS = "posicion int, campo string, tipo string"


def as_variant(raw: DataFrame, value: str) -> DataFrame:
    """The payload as ``_doc`` where it is a JSON object, else null."""
    doc = F.try_parse_json(F.col(value))
    return raw.withColumn(DOC, F.when(F.schema_of_variant(doc).startswith("OBJECT"), doc))


def _path(field: str) -> str:
    quote = '"' if "'" in field else "'"
    return f"$[{quote}{field}{quote}]"


def _nameable(field: str) -> bool:
    """Paths have no escapes, so a name with both quotation marks stays in ``extra``."""
    return not ("'" in field and '"' in field)


def _kind(field: str) -> Column:
    """The type of a field's own value; null where it is absent, VOID for a JSON null."""
    return F.schema_of_variant(F.variant_get(DOC, _path(field), "variant"))


def _fits(field: str, kind: str) -> Column:
    own = _kind(field)
    held = F.lit(False)
    for prefix in (*HOLDS[kind], "VOID"):
        held = held | own.startswith(prefix)
    return own.isNull() | held


def read_under(variants: DataFrame, fields: dict[str, str]) -> DataFrame:
    """The fields as columns, ``extra`` with those the schema does not name, and ``_wrong``: why a row cannot be read."""
    wrong = F.array_compact(F.array(*[F.when(~_fits(f, k), F.lit(f)) for f, k in fields.items()])) if fields else F.array().cast("array<string>")
    reason = F.when(F.col(DOC).isNull(), "no JSON object").when(F.size(wrong) > 0, F.concat(F.lit("wrong type: "), F.array_join(wrong, ", ")))
    named = F.array(*[F.lit(f) for f in fields]).cast("array<string>")
    every = F.from_json(F.to_json(DOC), "map<string,string>")
    rest = F.map_filter(every, lambda k, v: ~F.array_contains(named, k) & v.isNotNull())
    return variants.withColumns({
        **{f: F.try_variant_get(DOC, _path(f), k) for f, k in fields.items()},
        "extra": F.when(F.size(rest) > 0, F.to_json(rest)), "_wrong": reason,
    })


def good_rows(read: DataFrame) -> DataFrame:
    return read.filter(F.col("_wrong").isNull()).drop("_wrong", DOC)


def dead_letters(read: DataFrame, columns: list[str]) -> DataFrame:
    """The rows that could not be read, as they came, with the reason."""
    return read.filter(F.col("_wrong").isNotNull()).select(*columns, F.col("_wrong").alias("error"))


def fields_seen(variants: DataFrame) -> list[str]:
    """Names of all fields of the payloads that a path can name, from one aggregation."""
    found = variants.agg(F.schema_of_variant_agg(DOC).alias("s")).first()["s"]
    if not found or not found.startswith("OBJECT<") or found == "OBJECT<>":
        return []
    kinds = T.StructType.fromDDL(found[len("OBJECT<") : -1].replace("OBJECT<", "STRUCT<"))
    return [f.name for f in kinds if _nameable(f.name) and not isinstance(f.dataType, T.NullType)]


def narrowest(variants: DataFrame, fields: dict[str, str | None]) -> dict[str, str]:
    """Field -> the first type, from the one given on, that holds every value; from one aggregation."""
    order = list(HOLDS)
    tried = [(f, k) for f, known in fields.items() for k in order[order.index(known) if known else 0 :]]
    if not tried:
        return {}
    row = variants.agg(*[F.count_if(~_fits(f, k)).alias(f"_{i}") for i, (f, k) in enumerate(tried)]).first()
    out: dict[str, str] = {}
    for i, (field, kind) in enumerate(tried):
        if not row[i]:
            out.setdefault(field, kind)
    return out


def observed_types(variants: DataFrame) -> dict[str, str]:
    """Field -> type over all payloads."""
    return narrowest(variants, dict.fromkeys(fields_seen(variants)))


def propose(fields: dict[str, str], variants: DataFrame) -> dict[str, str]:
    """New fields with their types, and wider types for known ones that some payloads do not fit."""
    found = narrowest(variants, {f: fields.get(f) for f in fields_seen(variants)})
    return {f: kind for f, kind in found.items() if fields.get(f) != kind}


def store_schema(spark: SparkSession, path: str, fields: dict[str, str]) -> None:
    rows = [(i, f, k) for i, (f, k) in enumerate(fields.items())]
    write_version(spark.createDataFrame(rows, _FIELDS).coalesce(1), path)


def stored_schema(spark: SparkSession, path: str, version: int | None = None) -> dict[str, str]:
    return {r["campo"]: r["tipo"] for r in read_version(spark, path, version).orderBy("posicion").collect()}


def promote(spark: SparkSession, path: str, proposals: dict[str, str]) -> dict[str, str]:
    """The next version of the schema: widened fields in their places, new ones behind."""
    fields = {**stored_schema(spark, path), **proposals}
    store_schema(spark, path, fields)
    return fields
