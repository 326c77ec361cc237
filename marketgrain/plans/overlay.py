"""Published sections laid over recomputed ones; published wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def overlay_values(
    base: DataFrame, published: DataFrame, keys: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Value by value: where the publication has one it replaces the base."""
    renamed = published.select(*keys, *[F.col(v).alias(f"_new_{v}") for v in values])
    joined = base.select(*keys, *values).join(renamed, list(keys), "full")
    return joined.select(*keys, *[F.coalesce(f"_new_{v}", v).alias(v) for v in values])


def overlay_sections(base: DataFrame, published: DataFrame, section: str = "section") -> DataFrame:
    """Section by section: a published section replaces the whole base one,
    sections that were not published stay."""
    kept = base.join(published.select(section).distinct(), section, "left_anti")
    return kept.unionByName(published.select(*base.columns))


def published_sections(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """A written document, or ``None`` where there is none that can be read, in
    which case the recomputed sections stand alone."""
    try:
        found = spark.read.schema(schema).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    readable = found.na.drop("all")
    return None if readable.isEmpty() else readable
