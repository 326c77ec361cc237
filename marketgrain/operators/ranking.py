"""Top rows, leaders and positions.

A window over a whole relation would need every row in one task, so it is only
used on relations already cut to a stated length. Others are numbered range by
range, and a leader is found by its value, a plain distributed aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketgrain.operators.summary import materialized


def top(frame: DataFrame, by: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows of an order; each task keeps at most ``n`` rows."""
    return frame.orderBy(*by).limit(n)


def numbered(frame: DataFrame, by: Sequence[Column], name: str = "rank") -> DataFrame:
    """Consecutive positions for a relation cut to a stated length."""
    return frame.withColumn(name, F.row_number().over(Window.orderBy(*by)))


def positions(frame: DataFrame, by: Sequence[Column], name: str = "rank") -> DataFrame:
    """Consecutive positions for a relation of any size.

    The relation is sorted into range partitions and stored, one file per
    range. A row's position is its place in its file plus the rows of the files
    before it, so only the list of files is ever numbered as a whole. The order
    must be total, which also keeps equal values from filling one range.
    """
    stored = materialized(frame.orderBy(*by), "ordered")
    # files are in the order of their part numbers, which may outgrow their padding
    part = F.regexp_extract(F.col("_metadata.file_name"), r"\Apart-([0-9]+)", 1).cast("bigint")
    placed = stored.select("*", part.alias("_file"))
    earlier = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_rows"))
    ahead = files.select("_file", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_ahead"))
    inside = F.row_number().over(Window.partitionBy("_file").orderBy(*by))
    return placed.join(ahead, "_file").select(
        *frame.columns, (F.col("_ahead") + inside).alias(name)
    )


def leaders(frame: DataFrame, measure: str) -> DataFrame:
    """All rows holding the largest value; ties are kept."""
    best = frame.agg(F.max(measure).alias("best"))
    return frame.where(F.col(measure) == best.scalar())


def position_of_best(
    frame: DataFrame, is_member: Column, measure: str, tie: str
) -> DataFrame:
    """Position of the best member of a class in the order ``measure``
    descending, ``tie`` ascending, without numbering the other rows."""
    order = [F.col(measure).desc(), F.col(tie).asc()]
    best = top(frame.where(is_member).select(measure, tie), order, 1)
    best = best.select(F.col(measure).alias("_value"), F.col(tie).alias("_identity"))
    value, identity = F.col("_value"), F.col("_identity")
    ahead = (F.col(measure) > value) | ((F.col(measure) == value) & (F.col(tie) < identity))
    # The one best row stands beside every other.
    return frame.join(F.broadcast(best), how="cross").agg(
        F.min(identity).alias(tie),
        F.min(value).alias(measure),
        F.when(F.min(identity).isNotNull(), F.count_if(ahead) + 1).alias("position"),
    )
