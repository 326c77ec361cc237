"""Distinct counts that add up: a sketch per day, merged for any scope.

A count of distinct customers cannot be summed over days, so every scope would read
the facts again. A HyperLogLog sketch can be merged: the facts are read once, and
each day and dimension keeps one sketch of bounded size. Estimates are off by about
1.04 / sqrt(2^precision), 0.8 % at 14; an exact count remains the default elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketgrain.operators import calendar

PRECISION = 14  # 16,384 registers, at most 16 KB a sketch


def daily(facts: DataFrame, value: str, *dimensions: str, precision: int = PRECISION) -> DataFrame:
    """One sketch of ``value`` per day of ``placed_at`` and dimensions. Nulls are not
    counted; sketches are combined in the tasks, so a hot day is one row per task."""
    counted = facts.groupBy(calendar.as_day("placed_at").alias("day"), *dimensions)
    return counted.agg(F.hll_sketch_agg(value, precision).alias("sketch"))


def merged(summary: DataFrame, *scope: Column | str) -> DataFrame:
    """The estimate of each scope from the stored sketches alone."""
    found = summary.groupBy(*scope) if scope else summary
    return found.agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))
