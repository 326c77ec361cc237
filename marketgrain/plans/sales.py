"""Sales over time and by dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketgrain.functions.labels import month_text
from marketgrain.functions.money import display, mean, percent
from marketgrain.operators import calendar
from marketgrain.operators.summary import one_row


def sales_base(orders: DataFrame, *dimensions: str) -> DataFrame:
    """Orders and value per day and dimension: the one pass over the orders
    that every sales summary can be derived from. Its size is bounded by days
    times dimension values, not by orders."""
    return orders.groupBy(calendar.as_day("placed_at").alias("day"), *dimensions).agg(
        F.count(F.lit(1)).alias("orders"), F.sum("total").alias("revenue")
    )


def monthly(base: DataFrame, *, zero_months: bool = True) -> DataFrame:
    """Orders, value and mean ticket per month. Months without orders appear
    with zeros unless ``zero_months`` is off."""
    dated = base.where(F.col("day").isNotNull())
    facts = dated.groupBy(calendar.as_month("day").alias("month")).agg(
        F.sum("orders").alias("orders"), F.sum("revenue").alias("revenue")
    )
    if zero_months:
        every = calendar.months(calendar.span(base, "day"))
        facts = calendar.fill(every, facts, ["month"], ["orders", "revenue"])
    return facts.orderBy("month").select(
        month_text(F.col("month")).alias("month"),
        "orders",
        F.col("revenue").cast("double").alias("revenue"),
        display(mean(F.col("revenue"), F.col("orders"))).alias("average_ticket"),
    )


def breakdown(base: DataFrame, dimension: str, order: str = "orders") -> DataFrame:
    """Totals and shares per value of a dimension. ``order`` is ``"orders"``
    (most orders first, then label) or ``"revenue"`` (largest value first)."""
    if order not in ("orders", "revenue"):
        raise ValueError(f"unknown order {order!r}")
    facts = base.groupBy(dimension).agg(
        F.sum("orders").alias("orders"), F.sum("revenue").alias("value")
    )
    whole = one_row(facts.agg(F.sum("orders").alias("orders"), F.sum("value").alias("value")))
    first = F.col("orders") if order == "orders" else F.col("value")
    return facts.orderBy(first.desc(), F.col(dimension).asc()).select(
        dimension,
        "orders",
        F.col("value").cast("double").alias("revenue"),
        display(mean(F.col("value"), F.col("orders"))).alias("average_ticket"),
        percent(F.col("orders"), whole["orders"]).alias("order_share_pct"),
        percent(F.col("value"), whole["value"]).alias("revenue_share_pct"),
    )


def crosstab(
    orders: DataFrame, dimension: str, lookup: DataFrame, key: str, attribute: str
) -> DataFrame:
    """Orders and value per dimension value and attribute of a looked-up row.

    Orders collapse to (dimension, key) before the lookup join, so a key held
    by a third of all orders meets the join as one row."""
    small = orders.groupBy(dimension, key).agg(
        F.count(F.lit(1)).alias("orders"), F.sum("total").alias("value")
    )
    return (
        small.join(lookup.select(key, attribute), key)
        .groupBy(dimension, attribute)
        .agg(
            F.sum("orders").alias("orders"),
            F.sum("value").cast("double").alias("revenue"),
        )
        .orderBy(dimension, attribute)
    )
