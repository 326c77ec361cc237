"""The same analysis under several definitions of a counted order.

A scope is a set of statuses. Facts are aggregated per status first and only
the small result is repeated per scope, so more scopes do not mean more passes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketgrain.functions.money import display, mean
from marketgrain.operators import calendar
from marketgrain.operators.joins import members
from marketgrain.plans.segments import by_ticket
from marketgrain.plans.weekdays import daily_sales, weekday_means, weekday_report

Scopes = Mapping[str, Sequence[str] | None]


def scopes_of(status: Column, scopes: Scopes) -> Column:
    """Names of the scopes a status belongs to; ``None`` takes every status."""
    hits = [
        F.lit(name) if allowed is None else F.when(status.isin(list(allowed)), F.lit(name))
        for name, allowed in scopes.items()
    ]
    return F.array_compact(F.array(*hits))


def per_scope(frame: DataFrame, scopes: Scopes) -> DataFrame:
    """Repeat each row for the scopes its status belongs to."""
    return frame.withColumn("scope", F.explode(scopes_of(F.col("status"), scopes)))


def elite_by_scope(
    orders: DataFrame, bought: DataFrame, scopes: Scopes, minimum: int, n: int = 10
) -> DataFrame:
    """The elite of every scope, with its exact ticket. ``bought`` holds the
    purchases per customer, status and category."""
    value = (
        per_scope(
            orders.groupBy("customer_id", "status").agg(
                F.sum("total").alias("total"), F.count("order_id").alias("orders")
            ),
            scopes,
        )
        .groupBy("scope", "customer_id")
        .agg(
            F.sum("orders").alias("frequency"),
            mean(F.sum("total"), F.sum("orders")).alias("ticket"),
        )
    )
    variety = (
        per_scope(bought, scopes)
        .groupBy("scope", "customer_id")
        .agg(F.count_distinct("category_id").alias("diversity"))
        .where(F.col("diversity") >= minimum)
    )
    # The filter on the position lets every task cut to n rows per scope
    # before anything is shuffled.
    position = F.row_number().over(Window.partitionBy("scope").orderBy(*by_ticket()))
    return (
        value.join(variety, ["scope", "customer_id"])
        .withColumn("rank", position)
        .where(F.col("rank") <= n)
    )


def elite_report(chosen: DataFrame) -> DataFrame:
    return chosen.select(
        "scope",
        "rank",
        "customer_id",
        "frequency",
        display(F.col("ticket")).alias("average_ticket"),
        "diversity",
    ).orderBy("scope", "rank")


def leader_by_scope(bought: DataFrame, chosen: DataFrame, scopes: Scopes) -> DataFrame:
    """Leading category of each scope's elite, ties kept. Purchases of other
    customers are dropped before any row is repeated per scope."""
    of_chosen = members(bought, chosen.select("customer_id"), "customer_id")
    elite = per_scope(of_chosen, scopes).join(
        chosen.select("scope", "customer_id"), ["scope", "customer_id"]
    )
    units = elite.groupBy("scope", "category_id").agg(F.sum("units").cast("bigint").alias("units"))
    best = units.groupBy("scope").agg(F.max("units").alias("units"))
    return units.join(best, ["scope", "units"], "left_semi").orderBy("scope", "category_id")


def weekday_by_scope(
    base: DataFrame, scopes: Scopes, selected: Column | str | None = None
) -> DataFrame:
    """Weekday means per scope over the calendar of all orders. ``base`` is the
    daily summary of the orders with their status."""
    daily = daily_sales(base, selected, "status")
    facts = per_scope(daily, scopes).groupBy("scope", "day").agg(
        F.sum("orders").alias("orders"), F.sum("sales").alias("sales")
    )
    names = F.array(*map(F.lit, scopes))
    every_day = calendar.days(
        calendar.span(base, "day").withColumn("scope", F.explode(names)), "scope"
    )
    filled = calendar.fill(every_day, facts, ["scope", "day"], ["orders", "sales"])
    return weekday_report(weekday_means(filled, "scope"), "scope")
