"""Declared, column-pruned reads and the roles the analyses work on.

An analysis never knows the column names of a shop. A role maps them once to
the names used throughout the library; the projection is pushed into the scan,
so columns outside the role are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketgrain.errors import IngestError
from marketgrain.sources import inference
from marketgrain.functions.money import MONEY

# The type each role column is brought to; columns not listed keep their own.
ROLE_TYPES = {
    "total": MONEY,
    "subtotal": MONEY,
    "discount": MONEY,
    "line_total": MONEY,
    "quantity": "bigint",
    "placed_at": "timestamp_ntz",
    "created_at": "timestamp_ntz",
    "updated_at": "timestamp_ntz",
}


def role(frame: DataFrame, **columns: str | Column) -> DataFrame:
    """Project a table to the role columns ``name="source_column"``."""
    picked = []
    for name, source in columns.items():
        value = F.col(source) if isinstance(source, str) else source
        if name in ROLE_TYPES:
            value = value.cast(ROLE_TYPES[name])
        picked.append(value.alias(name))
    return frame.select(*picked)


def read_table(
    spark: SparkSession,
    path: str,
    columns: Iterable[str],
    schema: T.StructType | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Read only the wanted columns; a missing one fails before any scan."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    frame = reader.format(fmt).load(path)
    wanted = list(columns)
    missing = [name for name in wanted if name not in frame.columns]
    if missing:
        raise IngestError(f"{path}: columns not found: {', '.join(missing)}")
    return frame.select(*wanted)


def require_sources(available: Iterable[str], required: Iterable[str]) -> None:
    """Fail with every missing name, not only the first."""
    missing = sorted(set(required) - set(available))
    if missing:
        raise IngestError("required sources are missing: " + ", ".join(missing))


def strict_moment(text: Column, pattern: str | None = None) -> Column:
    """Parse a timestamp without a zone; unparsable text stops the query.

    Without a pattern the text must have one of the shapes that inference takes for a
    day or a moment: a cast alone would accept blanks around it and partial dates. The
    error has the name of the built-in one, but not the text."""
    if pattern is not None:
        return F.to_timestamp_ntz(text, F.lit(pattern))
    kind = T.TimestampNTZType()
    stopped = F.raise_error(F.lit("[CANNOT_PARSE_TIMESTAMP] a text is no timestamp")).cast(kind)
    return F.when(inference.misfit(text, kind), stopped).otherwise(inference.as_type(text, kind))


def quarantine_moments(
    frame: DataFrame, column: str, keys: Iterable[str]
) -> tuple[DataFrame, DataFrame]:
    """Split rows by whether a text column is a timestamp, by the same rule.

    The rejected side carries the row keys and the failing column only, never
    the rejected value.
    """
    kind = T.TimestampNTZType()
    bad = inference.misfit(F.col(column), kind)
    good = frame.where(~bad).withColumn(column, inference.as_type(F.col(column), kind))
    rejected = frame.where(bad).select(*keys, F.lit(column).alias("rejected_column"))
    return good, rejected


def bundle(
    spark: SparkSession, root: str, wanted: Mapping[str, Iterable[str]]
) -> dict[str, DataFrame]:
    """Lazily open several Parquet tables of one folder, pruned."""
    return {
        name: read_table(spark, f"{root.rstrip('/')}/{name}.parquet", columns)
        for name, columns in wanted.items()
    }
