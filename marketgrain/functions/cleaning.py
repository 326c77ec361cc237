"""Cleaning of text columns that carry numbers, and of varying column names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketgrain.functions.columns import literal_column


def locale_number(text: Column) -> Column:
    """Read amounts such as ``R$ 1.234,56``, ``1234,56`` and ``1234.56``.

    The currency mark, spaces and outer white space go; with both separators present the point
    groups thousands, a lone comma is the decimal mark. What is then not a
    finite number is null.
    """
    bare = F.regexp_replace(text, r"R\$| |\A\s+|\s+\z", "")
    has_comma, has_point = bare.contains(","), bare.contains(".")
    ungrouped = F.replace(bare, F.lit("."), F.lit(""))
    plain = (
        F.when(has_comma & has_point, F.replace(ungrouped, F.lit(","), F.lit(".")))
        .when(has_comma, F.replace(bare, F.lit(","), F.lit(".")))
        .otherwise(bare)
    )
    shaped = plain.rlike(r"\A[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z")
    number = F.when(shaped, plain.try_cast("double"))
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def cleaned_numbers(
    frame: DataFrame, column: str, *, default: float | None = None
) -> DataFrame:
    """Add ``<column>_number`` and ``<column>_rejected``. Unreadable text is
    flagged and stays null, or becomes ``default`` where one is given."""
    number = locale_number(F.col(column))
    value = number if default is None else F.coalesce(number, F.lit(float(default)))
    rejected = F.col(column).isNotNull() & number.isNull()
    return frame.withColumns({f"{column}_number": value, f"{column}_rejected": rejected})


def first_alias(
    frame: DataFrame, names: Sequence[str], default: Column | None = None
) -> Column:
    """First non-null value among the columns a field may be called. Exact
    names count before names that differ only in case; absent names are
    skipped."""
    exact = [n for n in names if n in frame.columns]
    folded = {c.lower(): c for c in frame.columns}
    loose = [folded[n.lower()] for n in names if n.lower() in folded]
    chosen = list(dict.fromkeys(exact + loose))
    options = [literal_column(c) for c in chosen] + ([] if default is None else [default])
    return F.coalesce(*options) if options else F.lit(None)


# Names under which a published field may appear.
ALIASES = {
    "month": ("month", "period", "date", "mes"),
    "value": (
        "value",
        "revenue",
        "recordedValue",
        "registeredValue",
        "totalValue",
        "amount",
        "total",
    ),
    "orders": ("orders", "orderCount", "count", "pedidos"),
    "ticket": ("ticket", "averageTicket", "avgTicket", "ticketMedio"),
    "frequency": ("orders", "frequency", "orderCount", "frequencia"),
    "categories": (
        "categories",
        "categoryCount",
        "categoryDiversity",
        "diversity",
        "diversidade",
    ),
    "category": ("category", "categoryName", "name", "label"),
    "quantity": ("quantity", "units", "value", "totalQuantity"),
    "weekday": ("weekday", "weekdayName", "day", "name", "label"),
    "average": (
        "average",
        "avg",
        "averageDailySales",
        "avgRecordedValue",
        "averageValue",
        "value",
    ),
    "prediction": ("prediction", "forecast", "predicted", "previsao"),
    "actual": ("actual", "realized", "observed", "real"),
    "similarity": ("similarity", "score", "cosineSimilarity"),
    "product": ("product", "productName", "name", "label"),
}


def normalized(
    frame: DataFrame, required: Sequence[str], optional: Sequence[str] = ()
) -> DataFrame:
    """Bring a published section to its field names. Rows without a required
    field are dropped; optional fields become null where no name matches."""
    fields = [*required, *optional]
    shaped = frame.select(*[first_alias(frame, ALIASES[f]).alias(f) for f in fields])
    return shaped.na.drop(subset=list(required))
