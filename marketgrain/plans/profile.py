"""Descriptive audit of one table: it counts, it never repairs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from marketgrain.functions.columns import literal_column
from marketgrain.functions.money import CENT, display, mean, percent
from marketgrain.operators import quantiles as q
from marketgrain.operators.joins import duplicate_keys


def stacked(frame: DataFrame, columns: Sequence[str], name: str, value: str) -> DataFrame:
    """Turn the columns of a one-row result into rows, after the aggregation."""
    pairs = [F.struct(F.lit(c).alias(name), F.col(c).alias(value)) for c in columns]
    return frame.select(F.inline(F.array(*pairs)))


def missing(column: str) -> Column:
    return F.count(F.lit(1)) - F.count(column)


def overview(orders: DataFrame, amount: str = "total", moment: str = "placed_at") -> DataFrame:
    """Rows, period and amounts in one pass, with the rows behind the mean."""
    used = F.count(amount)
    return orders.agg(
        F.count(F.lit(1)).alias("rows"),
        F.date_format(F.min(moment), "yyyy-MM-dd HH:mm:ss").alias("first_moment"),
        F.date_format(F.max(moment), "yyyy-MM-dd HH:mm:ss").alias("last_moment"),
        F.min(amount).cast("double").alias("smallest"),
        F.max(amount).cast("double").alias("largest"),
        display(mean(F.sum(amount), used)).alias("average"),
        used.alias("amounts_used"),
        missing(amount).alias("amounts_missing"),
        missing(moment).alias("moments_missing"),
    )


def null_profile(frame: DataFrame) -> DataFrame:
    """Nulls of every column, from a single wide aggregate."""
    names = list(enumerate(frame.columns, start=1))
    present = [F.count(literal_column(c)).alias(f"present_{i}") for i, c in names]
    counts = frame.agg(F.count(F.lit(1)).alias("rows"), *present)
    entries = []
    for i, c in names:
        nulls = F.col("rows") - F.col(f"present_{i}")
        entries.append(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(c).alias("column_name"),
                nulls.alias("nulls"),
                percent(nulls, F.col("rows")).alias("null_pct"),
            )
        )
    return counts.select(F.inline(F.array(*entries)))


def nulls_by(frame: DataFrame, dimension: str, column: str) -> DataFrame:
    """Rows and nulls of a column per value of a dimension."""
    return (
        frame.groupBy(dimension)
        .agg(F.count(F.lit(1)).alias("rows"), missing(column).alias("nulls"))
        .orderBy(dimension)
    )


def rule_checks(frame: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Violations per named rule; all rules share one scan. A rule that is
    null for a row, because an operand is, does not count as violated."""
    counts = frame.agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()])
    return stacked(counts, list(rules), "rule", "violations")


def order_rules(tolerance: str = CENT, strict: bool = False) -> dict[str, Column]:
    """Plausibility rules for orders. ``strict`` counts only differences above
    the tolerance; by default a difference of exactly the tolerance counts."""
    subtotal, discount, total = F.col("subtotal"), F.col("discount"), F.col("total")
    placed, created, updated = F.col("placed_at"), F.col("created_at"), F.col("updated_at")
    gap, limit = F.abs(subtotal - discount - total), F.lit(tolerance).cast("decimal(18,2)")
    return {
        "negative_subtotal": subtotal < 0,
        "negative_total": total < 0,
        "zero_total": total == 0,
        "discount_out_of_range": (discount < 0) | (discount > subtotal),
        "total_differs": gap > limit if strict else gap >= limit,
        "placed_after_created": placed > created,
        "created_after_updated": created > updated,
        "identical_timestamps": (placed == created) & (created == updated),
    }


def duplicates(frame: DataFrame, key: str) -> DataFrame:
    """Both meanings of duplication: values that repeat, and rows in excess."""
    return duplicate_keys(frame, key).agg(
        F.count(F.lit(1)).alias("duplicated_values"),
        F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).cast("bigint").alias("extra_rows"),
    )


def duplicate_report(frame: DataFrame, keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """``duplicates`` for several, also compound, keys of one table."""
    reports = [
        duplicates(frame.select(F.struct(*columns).alias("key")), "key").select(
            F.lit(name).alias("key"), "duplicated_values", "extra_rows"
        )
        for name, columns in keys.items()
    ]
    return reduce(DataFrame.unionByName, reports)


def id_gaps(frame: DataFrame, key: str) -> DataFrame:
    """Unused numbers between the smallest and the largest key."""
    return frame.agg(
        F.min(key).cast("bigint").alias("smallest"),
        F.max(key).cast("bigint").alias("largest"),
        F.count_distinct(F.col(key)).alias("distinct_keys"),
    ).select("*", (F.col("largest") - F.col("smallest") + 1 - F.col("distinct_keys")).alias("gaps"))


def id_gap_ranges(frame: DataFrame, key: str) -> DataFrame:
    """Runs of unused whole numbers between two keys: (first, last, missing).

    The distinct keys are stored in ranges. Neighbours are found inside each range, and
    at the borders from the ends of the ranges, one row per range; no window sees
    more than one range or the list of their ends. Nulls and repeats don't count.
    """
    keys = q.value_counts(frame.select(F.col(key).cast("bigint").alias("key")), "key")
    placed = keys.select("value", q.range_number().alias("part"))
    ends = placed.groupBy("part").agg(F.min("value").alias("low"), F.max("value").alias("high"))

    def steps(rows: DataFrame, over: WindowSpec, upper: str, lower: str) -> DataFrame:
        return rows.select(F.lag(upper).over(over).alias("below"), F.col(lower).alias("above"))

    inside = steps(placed, Window.partitionBy("part").orderBy("value"), "value", "value")
    across = steps(ends, Window.orderBy("part"), "high", "low")
    below, above = F.col("below"), F.col("above")
    return (
        inside.unionByName(across)
        .where(above - 1 > below)
        .select(
            (below + 1).alias("first"),
            (above - 1).alias("last"),
            (above - below - 1).alias("missing"),
        )
    )


def tukey(
    frame: DataFrame, amount: str, factor: float = 1.5, *, accuracy: int | None = None
) -> DataFrame:
    """Quartiles, fences and the number of values outside; nothing is dropped.

    Values are collapsed to (value, rows) once; the quartiles and the count
    outside the fences both read that result. ``accuracy`` switches to the
    approximate quartiles.
    """
    counts = q.value_counts(frame, amount)
    thirds = [0.25, 0.5, 0.75]
    row = q.quantiles(counts, thirds) if accuracy is None else q.approximate(
        frame, amount, thirds, accuracy
    )
    low, mid, high = F.col("q0"), F.col("q1"), F.col("q2")
    width = high - low
    lower, upper = low - F.lit(factor) * width, high + F.lit(factor) * width
    value = F.col("value").cast("double")
    outside = (value < lower) | (value > upper)

    def total(rows: Column) -> Column:
        return F.coalesce(F.sum(rows), F.lit(0)).cast("bigint")

    # The one row of quartiles stands beside every value.
    return counts.join(F.broadcast(row), how="cross").agg(
        F.min(low).alias("q1"),
        F.min(mid).alias("median"),
        F.min(high).alias("q3"),
        F.min(lower).alias("lower_fence"),
        F.min(upper).alias("upper_fence"),
        total(F.col("rows")).alias("evaluated"),
        total(F.when(outside, F.col("rows"))).alias("candidates"),
    )


def by_dimension(frame: DataFrame, dimension: str, amount: str = "total") -> DataFrame:
    """Rows, smallest, largest and mean amount per value, most rows first."""
    return (
        frame.groupBy(dimension)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.min(amount).cast("double").alias("smallest"),
            F.max(amount).cast("double").alias("largest"),
            display(mean(F.sum(amount), F.count(amount))).alias("average"),
        )
        .orderBy(F.col("rows").desc(), dimension)
    )
