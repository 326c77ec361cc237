"""Calendars without gaps and series filled up to them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketgrain.functions.labels import iso_weekday, weekday_name


def as_day(moment: Column | str) -> Column:
    return F.to_date(F.col(moment) if isinstance(moment, str) else moment)


def as_month(moment: Column | str) -> Column:
    """First day of the month."""
    return F.trunc(as_day(moment), "month")


def span(frame: DataFrame, moment: str) -> DataFrame:
    """One row with the first and last day; min and max merge map-side."""
    return frame.agg(
        F.to_date(F.min(moment)).alias("first_day"), F.to_date(F.max(moment)).alias("last_day")
    )


def days(bounds: DataFrame, *keep: str) -> DataFrame:
    """Every day from ``first_day`` to ``last_day``, both included.

    One row of bounds yields one calendar; a row per segment yields one
    calendar per segment without a cross join.
    """
    steps = F.sequence("first_day", "last_day", F.expr("interval 1 day"))
    return bounds.where(F.col("first_day").isNotNull()).select(
        *keep, F.explode(steps).alias("day")
    )


def months(bounds: DataFrame, *keep: str) -> DataFrame:
    """First day of every month from ``first_day`` to ``last_day``."""
    steps = F.sequence(
        F.trunc("first_day", "month"), F.trunc("last_day", "month"), F.expr("interval 1 month")
    )
    return bounds.where(F.col("first_day").isNotNull()).select(
        *keep, F.explode(steps).alias("month")
    )


def dimension(calendar: DataFrame, language: str = "pt") -> DataFrame:
    """Calendar attributes of each day, independent of the locale."""
    number = iso_weekday(F.col("day"))
    return calendar.select(
        *[c for c in calendar.columns if c != "day"],
        "day",
        F.year("day").alias("year"),
        F.month("day").alias("month"),
        F.dayofmonth("day").alias("day_of_month"),
        number.alias("iso_weekday"),
        weekday_name(number, language).alias("weekday"),
    )


def fill(
    calendar: DataFrame, facts: DataFrame, keys: Sequence[str], zero: Sequence[str]
) -> DataFrame:
    """Keep every calendar row; absent measures become zero.

    ``facts`` must already be filtered and aggregated to the calendar grain: a
    filter after this join would remove the very rows the calendar adds.
    ``recorded`` tells a real zero from an absent record.
    """
    marked = facts.withColumn("recorded", F.lit(True))
    joined = calendar.join(marked, list(keys), "left")
    filled = {name: F.coalesce(F.col(name), F.lit(0)) for name in zero}
    filled["recorded"] = F.coalesce(F.col("recorded"), F.lit(False))
    return joined.withColumns(filled)
