"""Nothing personal leaves the library in a published table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketgrain.errors import AnalyticsError
from marketgrain.functions.columns import literal_column

# Fields that must not appear in a publication, compared without
# case and underscores.
FORBIDDEN = (
    "customerId",
    "legalName",
    "tradeName",
    "taxId",
    "stateRegistration",
    "email",
    "phone",
    "address",
    "postalCode",
)


def _plain(name: str) -> str:
    return name.replace("_", "").casefold()


def field_names(schema: T.DataType, prefix: str = "") -> Iterable[str]:
    """All field names of a schema, nested ones included."""
    if isinstance(schema, T.StructType):
        for field in schema.fields:
            yield field.name
            yield from field_names(field.dataType)
    elif isinstance(schema, T.ArrayType):
        yield from field_names(schema.elementType)
    elif isinstance(schema, T.MapType):
        yield from field_names(schema.keyType)
        yield from field_names(schema.valueType)


def forbidden_fields(frame: DataFrame, denied: Iterable[str] = FORBIDDEN) -> list[str]:
    banned = {_plain(name) for name in denied}
    return sorted({n for n in field_names(frame.schema) if _plain(n) in banned})


def report(sections: Mapping[str, DataFrame], denied: Iterable[str] = FORBIDDEN) -> DataFrame:
    """Per section: forbidden fields in the schema and rows whose text holds an
    ``@``. Only text columns are read; nested ones are searched as JSON."""
    rows = []
    for name, frame in sections.items():
        hit = F.lit(False)
        for field in frame.schema.fields:
            value = literal_column(field.name)
            if isinstance(field.dataType, T.StringType):
                hit = hit | F.coalesce(value.contains("@"), F.lit(False))
            elif isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
                as_text = F.to_json(F.struct(value))
                hit = hit | as_text.contains("@")
        rows.append(
            frame.agg(F.count_if(hit).alias("rows_with_at_sign")).select(
                F.lit(name).alias("section"),
                F.lit(", ".join(forbidden_fields(frame, denied))).alias("forbidden_fields"),
                "rows_with_at_sign",
            )
        )
    return reduce(DataFrame.unionByName, rows)


def leaves(text: DataFrame, column: str = "document") -> DataFrame:
    """Every value of JSON documents at any depth: (path, key, kind, text, number).

    The text itself is walked, level by level, so what was really written is judged
    and no schema has to be known. ``key`` is the field that holds the value, for the
    elements of a list the list's. An object or list without entries is one value of
    kind ``empty``; its key counts too.
    """
    level = text.select(F.lit("").alias("path"), F.lit("").alias("key"), F.parse_json(column).alias("value"))
    found = []
    while True:
        shape = F.schema_of_variant("value")
        nested = shape.startswith("OBJECT<") | shape.startswith("ARRAY<")
        level = level.withColumn("kind", F.when(F.col("value").isNull(), "EMPTY").otherwise(shape)).withColumn("nested", F.col("value").isNotNull() & nested)
        flat = level.where(~F.col("nested"))
        kind = (
            F.when(F.col("kind").isin("STRING", "BOOLEAN", "EMPTY"), F.lower("kind"))
            .when(F.col("kind") == "VOID", "null")
            .otherwise("number")
        )
        number = F.when(kind == "number", F.try_variant_get("value", "$", "double"))
        written = F.when(kind.isin("string", "boolean"), F.try_variant_get("value", "$", "string"))
        found.append(flat.select("path", "key", kind.alias("kind"), written.alias("text"), number.alias("number")))
        deeper = level.where("nested")
        if not deeper.take(1):
            return reduce(DataFrame.unionByName, found)
        exploded = deeper.lateralJoin(deeper.sparkSession.tvf.variant_explode_outer(F.col("value").outer()).toDF("pos", "inner_key", "inner"))
        step = F.when(F.col("inner_key").isNotNull(), F.concat(F.lit("."), F.col("inner_key"))).when(
            F.col("pos").isNotNull(), F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("]"))
        )
        path = F.concat(F.col("path"), F.coalesce(step, F.lit("")))
        level = exploded.select(path.alias("path"), F.coalesce("inner_key", "key").alias("key"), F.col("inner").alias("value"))


def document_findings(found: DataFrame, denied: Iterable[str] = FORBIDDEN) -> DataFrame:
    """(path, reason) of forbidden fields anywhere on the path of a value and of texts
    with an ``@``, from ``leaves``."""
    banned = [_plain(name) for name in denied]
    names = F.split(F.lower(F.regexp_replace(F.col("path"), r"_|\[[0-9]+\]", "")), r"\.")
    field = F.arrays_overlap(names, F.array(*[F.lit(name) for name in banned]))
    reasons = F.array_compact(
        F.array(F.when(field, "forbidden field"), F.when(F.coalesce(F.col("text").contains("@"), F.lit(False)), "at sign"))
    )
    return found.select("path", F.explode(reasons).alias("reason"))


def enforce_document(text: DataFrame, column: str = "document") -> None:
    """Refuse a document with a finding at any depth; names at most ten places."""
    found = document_findings(leaves(text, column)).orderBy("path", "reason").limit(10).collect()
    if found:
        raise AnalyticsError("personal data in: " + ", ".join(f"{r['path']} ({r['reason']})" for r in found))


def findings(reported: DataFrame) -> DataFrame:
    return reported.where((F.col("forbidden_fields") != "") | (F.col("rows_with_at_sign") > 0))


def enforce(sections: Mapping[str, DataFrame]) -> None:
    """Refuse to publish; reads one row per section."""
    found = findings(report(sections)).collect()
    if found:
        raise AnalyticsError("personal data in: " + ", ".join(r["section"] for r in found))
