"""Money, ratios and shares on exact decimals.

Amounts are summed as decimals, so a total never depends on how the rows were
partitioned. Rounding is for display and happens after ranking.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
CENT = "0.01"


def money(value: Column | str) -> Column:
    """The value as an exact two-digit amount."""
    return F.col(value).cast(MONEY) if isinstance(value, str) else value.cast(MONEY)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Exact quotient, zero where the denominator is zero or absent."""
    return F.when(
        denominator != 0, numerator / F.nullif(denominator, F.lit(0))
    ).otherwise(F.lit(0))


def mean(total: Column, count: Column) -> Column:
    """Average amount from an exact total, with twelve digits kept."""
    return ratio(total.cast("decimal(28,2)"), count.cast("decimal(20,0)"))


def percent(part: Column, whole: Column) -> Column:
    """Share of a whole in percent, rounded to two digits for display."""
    scaled = part.cast("decimal(24,2)") * F.lit(100)
    return display(ratio(scaled, whole.cast("decimal(24,2)")))


def display(value: Column, digits: int = 2) -> Column:
    """Round an exact value half up and hand it out as a double."""
    return F.round(value, digits).cast("double")
