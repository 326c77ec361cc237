"""Customer value, category diversity and the elite they define.

Money is aggregated at order grain and items at item grain; the two meet only
as one row per customer, so an order total is never repeated per item.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketgrain.functions.labels import ordinal_label
from marketgrain.functions.money import display, mean, percent
from marketgrain.operators.joins import checked_join, members
from marketgrain.operators.ranking import leaders, numbered, positions, top
from marketgrain.operators.summary import one_row


def item_context(
    items: DataFrame,
    products: DataFrame,
    variants: DataFrame | None = None,
    *,
    unmatched: str = "error",
    validate: str | None = "m:1",
) -> DataFrame:
    """Items with their product columns, through variants where they exist."""
    if variants is not None:
        items = checked_join(
            items, variants, "variant_id", name="variants", validate=validate, unmatched=unmatched
        )
    return checked_join(
        items, products, "product_id", name="products", validate=validate, unmatched=unmatched
    )


def order_metrics(orders: DataFrame, *, valued_only: bool = False) -> DataFrame:
    """Revenue, frequency and exact mean ticket per customer. ``valued_only``
    counts distinct orders and divides by those that have a total."""
    frequency = F.count_distinct("order_id") if valued_only else F.count("order_id")
    divisor = F.count("total") if valued_only else F.count("order_id")
    return orders.groupBy("customer_id").agg(
        F.sum("total").alias("revenue"),
        frequency.alias("frequency"),
        mean(F.sum("total"), divisor).alias("ticket"),
    )


def purchases(
    context: DataFrame, orders: DataFrame, category: str = "category_id", *, by: Sequence[str] = ()
) -> DataFrame:
    """Lines and units per customer, category and the order columns ``by``.

    This is the only pass over the items. Diversity counts its rows, and the
    units of any group of customers add up from it. Both keys take part in the
    shuffle and rows are combined before it, so neither a customer nor a
    category with a third of all items makes a large group."""
    bought = context.join(orders.select("order_id", "customer_id", *by), "order_id")
    return bought.groupBy("customer_id", *by, F.col(category).alias("category_id")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum("quantity").cast("bigint").alias("units")
    )


def diversity(bought: DataFrame) -> DataFrame:
    """Distinct categories per customer, from ``purchases``."""
    return bought.groupBy("customer_id").agg(F.count("category_id").alias("diversity"))


def customer_metrics(
    orders: DataFrame,
    bought: DataFrame,
    customers: DataFrame | None = None,
    population: str = "registered",
    *,
    valued_only: bool = False,
) -> DataFrame:
    """One row per customer of the chosen population; ``bought`` is the result
    of ``purchases``.

    ``"registered"``: every row of ``customers``, zeros without orders;
    ``"ordering"``: customers with at least one order that has items;
    ``"with_orders"``: customers with orders, diversity zero without items.
    """
    value, variety = order_metrics(orders, valued_only=valued_only), diversity(bought)
    if population == "ordering":
        return value.join(variety, "customer_id")
    if population == "with_orders":
        joined = value.join(variety, "customer_id", "left")
    elif population == "registered" and customers is not None:
        joined = (
            customers.select("customer_id")
            .join(value, "customer_id", "left")
            .join(variety, "customer_id", "left")
        )
    else:
        raise ValueError(f"population {population!r} needs a customer table or is unknown")
    measures = ("revenue", "frequency", "ticket", "diversity")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in measures})


def by_ticket() -> list[Column]:
    return [F.col("ticket").desc_nulls_last(), F.col("customer_id").asc()]


def eligible(metrics: DataFrame, minimum: int) -> DataFrame:
    return metrics.where(F.col("diversity") >= minimum)


def elite(metrics: DataFrame, minimum: int, n: int = 10) -> DataFrame:
    """The ``n`` eligible customers with the highest mean ticket, numbered."""
    return numbered(top(eligible(metrics, minimum), by_ticket(), n), by_ticket())


def elite_report(chosen: DataFrame) -> DataFrame:
    return chosen.orderBy("rank").select(
        "rank",
        "customer_id",
        F.col("revenue").cast("double").alias("revenue"),
        "frequency",
        display(F.col("ticket")).alias("average_ticket"),
        "diversity",
    )


def anonymous_report(chosen: DataFrame, prefix: str) -> DataFrame:
    """The same without identifiers: customers are labelled by position."""
    return elite_report(chosen).select(
        "rank",
        ordinal_label(prefix, F.col("rank")).alias("label"),
        "revenue",
        "frequency",
        "average_ticket",
        "diversity",
    )


def of_elite(bought: DataFrame, chosen: DataFrame) -> DataFrame:
    """Purchases of the elite."""
    return members(bought, chosen.select("customer_id"), "customer_id")


def category_units(bought: DataFrame) -> DataFrame:
    return bought.groupBy("category_id").agg(F.sum("units").cast("bigint").alias("units"))


def named(frame: DataFrame, categories: DataFrame | None) -> DataFrame:
    """Attach category names where a category table exists."""
    return frame if categories is None else frame.join(categories, "category_id")


def leading_categories(
    units: DataFrame, categories: DataFrame | None = None, *, ties: bool = True
) -> DataFrame:
    """Category with the most units: all leaders, or the smallest id only."""
    best = leaders(units, "units")
    if not ties:
        best = top(best, [F.col("category_id").asc()], 1)
    return named(best, categories).orderBy("category_id")


def category_share(units: DataFrame, categories: DataFrame | None = None) -> DataFrame:
    """Ranked categories with their share of all units."""
    whole = units.agg(F.sum("units"))
    order = [F.col("units").desc(), F.col("category_id").asc()]
    ranked = positions(named(units, categories), order)
    return ranked.withColumn("share_pct", percent(F.col("units"), whole.scalar()))


def category_units_by_name(units: DataFrame, categories: DataFrame, n: int) -> DataFrame:
    """Units per category *name*: equal names are merged; the first ``n``."""
    merged = units.join(categories, "category_id", "left").groupBy("category").agg(
        F.sum("units").cast("bigint").alias("units")
    )
    return top(merged, [F.col("units").desc(), F.col("category").asc()], n)


def diversity_histogram(metrics: DataFrame) -> DataFrame:
    return (
        metrics.groupBy("diversity").agg(F.count(F.lit(1)).alias("customers")).orderBy("diversity")
    )


def eligibility(metrics: DataFrame, minimum: int) -> DataFrame:
    """How selective the diversity threshold is."""
    passed = F.count_if(F.col("diversity") >= minimum)
    everyone = F.count(F.lit(1))
    return metrics.agg(
        F.lit(minimum).alias("minimum_categories"),
        everyone.alias("customers"),
        F.count_if(F.col("frequency") > 0).alias("customers_with_orders"),
        passed.alias("eligible_customers"),
        percent(passed, everyone).alias("eligible_share_pct"),
    )


def elite_totals(orders: DataFrame, bought: DataFrame, chosen: DataFrame) -> DataFrame:
    """Orders, lines and units of the elite and the share of its leader."""
    items = of_elite(bought, chosen)
    leader = category_units(items).agg(F.max("units")).scalar()
    of_orders = one_row(
        members(orders, chosen.select("customer_id"), "customer_id").agg(
            F.count(F.lit(1)).alias("orders"), F.sum("total").cast("double").alias("revenue")
        )
    )
    return items.agg(
        F.sum("lines").alias("lines"), F.sum("units").cast("bigint").alias("units")
    ).select(
        of_orders["orders"].alias("orders"),
        of_orders["revenue"].alias("revenue"),
        "lines",
        "units",
        leader.alias("leader_units"),
        percent(leader, F.col("units")).alias("leader_share_pct"),
    )
