"""The published summary: sections, cards, metadata and one JSON document.

Every section is a small DataFrame. The sales sections are derived from one
daily summary of the orders and the customer sections from one summary of the
items. Forecast, recommendations and checks read the tables themselves.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketgrain.errors import AnalyticsError
from marketgrain.functions.money import display, mean, percent
from marketgrain.operators.summary import one_row

# The sections a published document must have.
REQUIRED_SECTIONS = ("metadata", "executive", "sales", "customers", "operations", "quality")


def require_sections(document: DataFrame) -> None:
    """Schema assertion: every section is present and is an object."""
    fields = {f.name: f.dataType for f in document.schema.fields}
    bad = [s for s in REQUIRED_SECTIONS if not isinstance(fields.get(s), T.StructType)]
    if bad:
        raise AnalyticsError("sections missing or invalid: " + ", ".join(bad))


def cards(
    base: DataFrame, customers: DataFrame, products: DataFrame, eligibility: DataFrame
) -> DataFrame:
    """Headline figures: (position, id, value, format)."""
    totals = base.agg(
        F.sum("orders").alias("orders"),
        F.sum("revenue").alias("revenue"),
    )
    rows = totals.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("position"),
                        F.lit(name).alias("id"),
                        value.cast("double").alias("value"),
                        F.lit(kind).alias("format"),
                    )
                    for i, (name, value, kind) in enumerate(
                        [
                            ("gross-sales", F.col("revenue"), "currency"),
                            ("orders", F.col("orders"), "integer"),
                            (
                                "average-ticket",
                                display(mean(F.col("revenue"), F.col("orders"))),
                                "currency",
                            ),
                            ("customers", customers.agg(F.count(F.lit(1))).scalar(), "integer"),
                            ("products", products.agg(F.count(F.lit(1))).scalar(), "integer"),
                            (
                                "elite-eligibility",
                                eligibility.select("eligible_share_pct").scalar(),
                                "percent",
                            ),
                        ],
                        start=1,
                    )
                ]
            )
        )
    )
    return rows


# The published insights, in order, with their tone.
INSIGHTS = (
    ("elite-selectivity", "attention"),
    ("elite-category", "positive"),
    ("weekday-pos", "neutral"),
    ("forecast", "attention"),
)


def insights(
    eligibility: DataFrame, categories: DataFrame, weekdays: DataFrame, forecast: DataFrame
) -> DataFrame:
    """The numbers behind the insights: (position, id, tone, subject, value, other).

    Share of eligible customers and the minimum of categories; the elite's first
    category and its units; the weakest weekday (the earliest of equal ones) and its
    mean; the forecast's mean error and shortfall. A section without rows leaves its
    insight with null values."""
    chosen = one_row(eligibility.agg(F.max("eligible_share_pct").alias("value"), F.max("minimum_categories").alias("other")))
    top = one_row(
        categories.where(F.col("rank") == 1).agg(F.max("category").cast("string").alias("subject"), F.max("units").alias("value"))
    )
    lowest = weekdays.where(F.col("is_lowest"))
    day = one_row(
        lowest.agg(
            F.min_by("weekday", "iso_weekday").alias("subject"),
            F.min_by("mean_sales", "iso_weekday").alias("value"),
        )
    )
    error = one_row(forecast.agg(F.max("mae").alias("value"), F.max("shortfall").alias("other")))
    nothing = F.lit(None)
    facts = (
        (nothing, chosen["value"], chosen["other"]),
        (top["subject"], top["value"], nothing),
        (day["subject"], day["value"], nothing),
        (nothing, error["value"], error["other"]),
    )
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(name).alias("id"),
            F.lit(tone).alias("tone"),
            subject.cast("string").alias("subject"),
            value.cast("double").alias("value"),
            other.cast("double").alias("other"),
        )
        for i, ((name, tone), (subject, value, other)) in enumerate(zip(INSIGHTS, facts, strict=True), start=1)
    ]
    return eligibility.sparkSession.range(1).select(F.inline(F.array(*rows)))


def metadata(base: DataFrame, inventory: DataFrame) -> DataFrame:
    """Period, statuses and record totals of the sources."""
    records = one_row(
        inventory.agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"))
    )
    return base.agg(
        F.date_format(F.min("day"), "yyyy-MM-dd").alias("period_start"),
        F.date_format(F.max("day"), "yyyy-MM-dd").alias("period_end"),
        F.array_join(F.array_sort(F.collect_set("status")), ",").alias("statuses"),
    ).select(
        "period_start",
        "period_end",
        "statuses",
        records["files"].alias("source_files"),
        records["rows"].alias("total_records"),
    )


def inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns per table; counting reads no column."""
    rows = [
        frame.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), "rows", F.lit(len(frame.columns)).alias("columns")
        )
        for name, frame in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def view_numbers(
    channels: DataFrame, statuses: DataFrame, weekdays: DataFrame, checks: DataFrame,
    compared_weekday: int = 7,
) -> DataFrame:
    """Numbers a reader derives from the sections: channel total, largest
    status share, pass rate and the gap of the weakest weekday to another."""
    passed = F.count_if(F.col("status").rlike("(?i)pass|ok|success|valid"))
    lowest = F.min(F.when(F.col("is_lowest"), F.col("mean_sales")))
    other = F.min(F.when(F.col("iso_weekday") == compared_weekday, F.col("mean_sales")))
    gap = one_row(
        weekdays.agg(
            F.round(F.abs(lowest - other), 2).alias("gap"),
            F.round(
                F.lit(100) * F.abs(lowest - other) / F.greatest(other, F.lit(1.0)), 2
            ).alias("pct"),
        )
    )
    return checks.agg(percent(passed, F.count(F.lit(1))).alias("pass_rate_pct")).select(
        channels.agg(F.sum(F.col("revenue").cast("decimal(28,2)")).cast("double"))
        .scalar()
        .alias("channel_total"),
        statuses.agg(F.max("order_share_pct")).scalar().alias("dominant_status_pct"),
        "pass_rate_pct",
        gap["gap"].alias("weekday_gap"),
        gap["pct"].alias("weekday_gap_pct"),
    )


def finite(frame: DataFrame) -> DataFrame:
    """Stop instead of publishing a value JSON cannot express."""

    def safe(name: str) -> Column:
        value = F.col(name)
        broken = F.isnan(value) | (F.abs(value) == float("inf"))
        message = F.lit(f"{name} is not a finite number")
        return F.when(broken, F.raise_error(message)).otherwise(value)

    real = (T.DoubleType, T.FloatType)
    doubles = [f.name for f in frame.schema.fields if isinstance(f.dataType, real)]
    return frame.withColumns({name: safe(name) for name in doubles}) if doubles else frame


def as_list(frame: DataFrame, order: Sequence[str]) -> Column:
    """A section as one ordered array. Sections are summaries, so the array is
    as small as the report it ends in."""
    item = F.struct(*[F.col(c) for c in frame.columns])
    keyed = F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(order)], item.alias("item"))
    gathered = finite(frame).agg(F.array_sort(F.collect_list(keyed)).alias("rows"))
    return gathered.select(F.transform("rows", lambda r: r["item"])).scalar()


def as_object(frame: DataFrame) -> Column:
    """A one-row section as a struct."""
    return one_row(finite(frame))


def document(spark: SparkSession, sections: Mapping[str, Mapping[str, Column]]) -> DataFrame:
    """One row with a struct per section."""
    nested = [
        F.struct(*[value.alias(name) for name, value in parts.items()]).alias(section)
        for section, parts in sections.items()
    ]
    return spark.range(1).select(*nested)


def as_json(doc: DataFrame) -> DataFrame:
    return doc.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("document"))
