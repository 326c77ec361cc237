"""Exact interpolated quantiles without gathering a column.

The built-in exact percentile keeps every distinct value of a group in one
buffer. Here the column is first collapsed to (value, rows), which is an
ordinary pre-aggregated shuffle, and stored in ranges of the value. The rows of
the ranges are summed up, and only the ranges that hold a wanted position are
sorted out. Ranges are balanced by the values there are, so it does not matter
how they are distributed.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketgrain.operators.summary import materialized


def value_counts(frame: DataFrame, value: str) -> DataFrame:
    """Distinct non-null values with their number of rows, stored in ranges."""
    counts = (
        frame.where(F.col(value).isNotNull())
        .groupBy(F.col(value).alias("value"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return materialized(counts.orderBy("value"), "values")


def range_number() -> Column:
    """Which of the stored ranges of ``value_counts`` a row is in, in their order."""
    return F.regexp_extract(F.col("_metadata.file_name"), r"\Apart-([0-9]+)", 1).cast("bigint")


def quantiles(counts: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """One row ``q0, q1, …`` from ``value_counts``, linearly interpolated.

    The position of probability p among n rows is p·(n−1), counted from zero;
    its two neighbours are order statistics found by cumulative row counts.
    """
    placed = counts.select("value", "rows", range_number().alias("part"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = placed.groupBy("part").agg(F.sum("rows").alias("range_rows"))
    offsets = ranges.select(
        "part",
        "range_rows",
        F.coalesce(F.sum("range_rows").over(ahead), F.lit(0)).alias("offset"),
        F.sum("range_rows").over(Window.partitionBy()).alias("n"),
    )

    def neighbours(p: float) -> tuple[Column, Column]:
        position = F.lit(p) * (F.col("n") - 1).cast("double")
        return F.floor(position), F.ceil(position)

    def inside(rank: Column, start: str, rows: str) -> Column:
        return (rank >= F.col(start)) & (rank < F.col(start) + F.col(rows))

    wanted = F.lit(False)
    for p in probabilities:
        for rank in neighbours(p):
            wanted = wanted | inside(rank, "offset", "range_rows")
    # At most two ranges per probability are left, which bounds the broadcast.
    hit = F.broadcast(offsets.where(wanted))
    before = Window.partitionBy("part").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    opened = placed.join(hit, "part").withColumn(
        "start", F.col("offset") + F.coalesce(F.sum("rows").over(before), F.lit(0))
    )
    value = F.col("value").cast("double")
    picks = []
    for i, p in enumerate(probabilities):
        low, high = neighbours(p)
        picks.append(F.max(F.when(inside(low, "start", "rows"), value)).alias(f"low{i}"))
        picks.append(F.max(F.when(inside(high, "start", "rows"), value)).alias(f"high{i}"))
    found = opened.agg(F.max("n").alias("n"), *picks)
    interpolated = []
    for i, p in enumerate(probabilities):
        position = F.lit(p) * (F.col("n") - 1).cast("double")
        share = position - F.floor(position)
        low, high = F.col(f"low{i}"), F.col(f"high{i}")
        interpolated.append((low + (high - low) * share).alias(f"q{i}"))
    return found.select(*interpolated)


def approximate(
    frame: DataFrame, value: str, probabilities: Sequence[float], accuracy: int = 10_000
) -> DataFrame:
    """The same row from one mergeable sketch, when an error of 1/accuracy of
    the ranks is acceptable."""
    if not all(math.isfinite(p) and 0 <= p <= 1 for p in probabilities):
        raise ValueError("probabilities lie between 0 and 1")
    sketch = F.percentile_approx(F.col(value).cast("double"), list(probabilities), accuracy)
    return frame.agg(sketch.alias("q")).select(
        *[F.col("q")[i].alias(f"q{i}") for i in range(len(probabilities))]
    )
