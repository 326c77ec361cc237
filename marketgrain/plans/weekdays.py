"""Average daily sales per weekday over a calendar without gaps.

``base`` is the daily summary of the orders (``sales.sales_base``) with the
dimensions a selection or a segment refers to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketgrain.functions.labels import iso_weekday, weekday_name
from marketgrain.functions.money import display, mean
from marketgrain.operators import calendar
from marketgrain.operators.summary import one_row


def daily_sales(base: DataFrame, selected: Column | str | None = None, *by: str) -> DataFrame:
    """Orders and their value per day (and segment). The selection is applied
    to the records, before any calendar is joined; over a base that is not
    stored it reaches the scan of the orders."""
    kept = base if selected is None else base.where(selected)
    return kept.groupBy(*by, "day").agg(
        F.sum("orders").alias("orders"), F.sum("revenue").alias("sales")
    )


def calendar_sales(
    base: DataFrame, selected: Column | str | None = None, language: str = "pt"
) -> DataFrame:
    """One row per calendar day of the whole order period with the selected
    sales; days without a selected record carry zero."""
    every_day = calendar.dimension(calendar.days(calendar.span(base, "day")), language)
    return calendar.fill(every_day, daily_sales(base, selected), ["day"], ["orders", "sales"])


def segment_calendar_sales(
    base: DataFrame, segment: str, segments: DataFrame | None = None,
    selected: Column | str | None = None,
) -> DataFrame:
    """The same per segment: every segment gets the full calendar, also the
    segments that sold nothing. ``segments`` is the dimension to cover; without
    it the segments seen in the base are covered."""
    bounds = one_row(calendar.span(base, "day"))
    known = (base if segments is None else segments).select(segment).distinct()
    per_segment = known.select(
        segment,
        bounds["first_day"].alias("first_day"),
        bounds["last_day"].alias("last_day"),
    )
    every_day = calendar.days(per_segment, segment)
    return calendar.fill(
        every_day,
        daily_sales(base, selected, segment),
        [segment, "day"],
        ["orders", "sales"],
    )


def weekday_means(filled: DataFrame, *by: str) -> DataFrame:
    """Exact weekday figures of a calendar-filled daily series.

    ``mean_sales`` divides by all calendar days, ``mean_recorded`` only by the
    days that have a record. Two notions of an empty day are reported: no
    record at all, and sales adding up to zero.
    """
    number = iso_weekday(F.col("day"))
    total = F.sum("sales")
    recorded = F.count_if("recorded")
    every_day = F.count(F.lit(1))
    return filled.groupBy(*by, number.alias("iso_weekday")).agg(
        every_day.alias("calendar_days"),
        (every_day - recorded).alias("days_without_record"),
        F.count_if(F.col("sales") == 0).alias("zero_sales_days"),
        total.alias("sales"),
        mean(total, every_day).alias("mean_sales"),
        mean(total, recorded).alias("mean_recorded"),
    )


def weekday_report(means: DataFrame, *by: str, language: str = "pt") -> DataFrame:
    """Name the weekdays, flag the weakest one and round for display. Ranking
    uses the exact mean; the earlier weekday wins a tie."""
    weakest = Window.partitionBy(*by).orderBy(F.col("mean_sales").asc(), F.col("iso_weekday").asc())
    flagged = means.withColumn("is_lowest", F.row_number().over(weakest) == 1)
    ordered = flagged.orderBy(*by, F.col("mean_sales").asc(), F.col("iso_weekday").asc())
    return ordered.select(
        *by,
        "iso_weekday",
        weekday_name(F.col("iso_weekday"), language).alias("weekday"),
        "calendar_days",
        "days_without_record",
        "zero_sales_days",
        display(F.col("mean_sales")).alias("mean_sales"),
        display(F.col("mean_recorded")).alias("mean_recorded"),
        "is_lowest",
    )


def weekday_mean(
    base: DataFrame, selected: Column | str | None = None, language: str = "pt"
) -> DataFrame:
    """The weekday report of the selected orders, weakest weekday first."""
    means = weekday_means(calendar_sales(base, selected, language))
    return weekday_report(means, language=language)


def reconcile_calendar(
    orders: DataFrame, base: DataFrame, selected: Column | str | None = None
) -> DataFrame:
    """Proof that the calendar neither lost nor duplicated anything: figures
    straight from the orders against those after the calendar."""
    kept = orders if selected is None else orders.where(selected)
    before = one_row(
        kept.agg(
            F.count(F.lit(1)).alias("orders"),
            F.coalesce(F.sum("total"), F.lit(0)).cast("decimal(28,2)").alias("sales"),
        )
    )
    bounds = one_row(calendar.span(orders, "placed_at"))
    expected = (F.date_diff(bounds["last_day"], bounds["first_day"]) + 1).cast("bigint")
    after = calendar_sales(base, selected).agg(
        F.count(F.lit(1)).alias("calendar_days"),
        F.count_distinct("day").alias("distinct_days"),
        F.sum("orders").alias("orders_after"),
        F.sum("sales").cast("decimal(28,2)").alias("sales_after"),
    )
    return after.select(
        "calendar_days",
        "distinct_days",
        expected.alias("expected_days"),
        before["orders"].alias("orders_before"),
        "orders_after",
        before["sales"].cast("double").alias("sales_before"),
        F.col("sales_after").cast("double").alias("sales_after"),
        (
            (F.col("calendar_days") == F.col("distinct_days"))
            & (F.col("calendar_days") == expected)
            & (F.col("orders_after") == before["orders"])
            & (F.col("sales_after") == before["sales"])
        ).alias("balanced"),
    )
