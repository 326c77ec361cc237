"""Monthly demand: dense series, moving-average forecasts and their errors.

All operators work on any number of series at once. ``by`` names the series
key; without it the frame is one series. A series never has more rows than
there are months, so a window per series stays small.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketgrain.errors import AnalyticsError
from marketgrain.functions.labels import month_text
from marketgrain.operators import calendar
from marketgrain.operators.joins import checked_join, guard, members
from marketgrain.operators.summary import one_row

SERIES_A_TASK = 20_000


@dataclass(frozen=True)
class Horizon:
    """Last training month, the test months and the averaging window."""

    train_end: date
    test_start: date
    test_end: date
    window: int = 3

    def __post_init__(self) -> None:
        if self.window <= 0:
            raise AnalyticsError("the averaging window must be positive")
        if not self.train_end < self.test_start <= self.test_end:
            raise AnalyticsError("test months must follow the training months")

    @property
    def steps(self) -> int:
        """Number of test months."""
        years = self.test_end.year - self.test_start.year
        return 12 * years + self.test_end.month - self.test_start.month + 1

    @property
    def cutoff(self) -> date:
        """First day after the last test month."""
        year, month = divmod(12 * self.test_end.year + self.test_end.month, 12)
        return date(year, month + 1, 1)


def unified_items(
    items: DataFrame,
    products: DataFrame,
    orders: DataFrame,
    name: str,
    variants: DataFrame | None = None,
    validate: str | None = "m:1",
) -> DataFrame:
    """Item lines of all products carrying exactly this name, with their order.

    Items are reduced to the wanted products by a semi join before anything is
    looked up. An item whose order does not exist stops the query.
    """
    targets = products.where(F.col("product_name") == name)
    if targets.isEmpty():
        raise AnalyticsError(f"no product is called {name!r}")
    if variants is None:
        kept = members(items, targets, "product_id")
    else:
        wanted = members(variants, targets, "product_id")
        if wanted.isEmpty():
            raise AnalyticsError(f"no variant belongs to {name!r}")
        kept = checked_join(
            members(items, wanted, "variant_id"), wanted, "variant_id",
            name="variants", validate=validate,
        )
    described = checked_join(
        kept, targets.select("product_id", "product_name"), "product_id",
        name="products", validate=validate,
    )
    dated = checked_join(described, orders, "order_id", name="orders", validate=validate)
    return dated.withColumn("month", calendar.as_month("placed_at"))


def monthly_units(
    sold: DataFrame,
    first: Column,
    last: Column,
    by: Sequence[str] = (),
    series: DataFrame | None = None,
) -> DataFrame:
    """Units per month from ``first`` to ``last``; months without sales are 0.

    ``series`` lists the series to cover; without it the series that sold.
    Item lines are summed per (series, month) before anything else happens, so
    a best-selling product is no larger than any other.
    """
    keys = list(by)
    dated = sold.where(F.col("month").isNotNull())
    facts = dated.groupBy(*keys, "month").agg(F.sum("quantity").cast("bigint").alias("units"))
    if keys and series is not None:
        # Tasks by number of series: partitions sized by their bytes, as adaptive execution
        # makes them, would hold many series, each of which becomes a row per month.
        every = series.select(*keys).distinct()
        tasks = max(every.sparkSession.sparkContext.defaultParallelism, math.ceil(every.count() / SERIES_A_TASK))
        every, facts = series.select(*keys).repartition(tasks, *keys).distinct(), facts.repartition(tasks, *keys)
    # A series is at most one entry per month, so it fits a map in one row.
    # Filling it there keeps the rows partitioned by series for the windows
    # that follow; joining a calendar would shuffle every filled month again.
    entries = F.collect_list(F.struct("month", "units"))
    sparse = facts.groupBy(*keys).agg(F.map_from_entries(entries).alias("sold"))
    if keys and series is not None:
        sparse = every.join(sparse, keys, "left")
    calendar_months = F.sequence(
        F.trunc(first, "month"), F.trunc(last, "month"), F.expr("interval 1 month")
    )
    filled = F.transform(
        "calendar",
        lambda m: F.struct(
            m.alias("month"), F.coalesce(F.try_element_at("sold", m), F.lit(0)).alias("units")
        ),
    )
    return sparse.withColumn("calendar", calendar_months).select(*keys, F.inline(filled))


def split(series: DataFrame, horizon: Horizon, by: Sequence[str] = ()) -> DataFrame:
    """Mark every month ``train`` or ``test`` and drop the others. A series
    without all test months, or with too short a history, stops the query."""
    month = F.col("month")
    period = F.when(month <= F.lit(horizon.train_end), "train").when(
        month.between(F.lit(horizon.test_start), F.lit(horizon.test_end)), "test"
    )
    marked = series.withColumn("period", period).where(F.col("period").isNotNull())
    # The same order as the forecasts use, so one sort serves both windows.
    whole = (
        Window.partitionBy(*by)
        .orderBy("month")
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    counted = marked.withColumns(
        {
            "_train": F.count_if(F.col("period") == "train").over(whole),
            "_test": F.count_if(F.col("period") == "test").over(whole),
        }
    )
    complete = guard(counted, F.col("_test") != horizon.steps, "test months are missing")
    enough = guard(
        complete, F.col("_train") < horizon.window,
        f"history is shorter than the window of {horizon.window} months",
    )
    return enough.drop("_train", "_test")


def _scored(frame: DataFrame, keys: Sequence[str], prediction: Column) -> DataFrame:
    return frame.select(
        *keys, "month", prediction.alias("prediction"), F.col("units").alias("actual")
    ).withColumn("absolute_error", F.abs(F.col("prediction") - F.col("actual")))


def walk_forward(marked: DataFrame, horizon: Horizon, by: Sequence[str] = ()) -> DataFrame:
    """Mean of the months before the predicted one. The actual value of a test
    month enters the history only for the months after it."""
    before = (
        Window.partitionBy(*by).orderBy("month").rowsBetween(-horizon.window, Window.currentRow - 1)
    )
    history = F.sum("units").over(before) / F.lit(horizon.window)
    predicted = marked.withColumn("_mean", history).where(F.col("period") == "test")
    return _scored(predicted, by, F.col("_mean"))


def _last_window(marked: DataFrame, horizon: Horizon, by: Sequence[str]) -> DataFrame:
    """Train months at the end of the history as one small array per series."""
    last_months = marked.where(
        (F.col("period") == "train")
        & (F.col("month") > F.add_months(F.lit(horizon.train_end), -horizon.window))
    )
    ordered = F.array_sort(F.collect_list(F.struct("month", "units")))
    return last_months.groupBy(*by).agg(
        F.transform(ordered, lambda m: m["units"].cast("double")).alias("recent")
    )


def _test_months(marked: DataFrame) -> DataFrame:
    return marked.where(F.col("period") == "test")


def _array_mean(values: Column, n: int) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v) / F.lit(n)


def frozen(marked: DataFrame, horizon: Horizon, by: Sequence[str] = ()) -> DataFrame:
    """The last training mean repeated for every test month."""
    recent = _last_window(marked, horizon, by)
    tests = _test_months(marked)
    level = _array_mean(F.col("recent"), horizon.window)
    if by:
        return _scored(tests.join(recent, list(by)), by, level)
    return _scored(tests.withColumn("recent", recent.scalar()), by, level)


def recursive(marked: DataFrame, horizon: Horizon, by: Sequence[str] = ()) -> DataFrame:
    """Several steps ahead: each prediction replaces the oldest month of the
    window. One fold per series, no loop over months on the driver."""
    k = horizon.window

    def step(state: Column, _: Column) -> Column:
        guess = _array_mean(F.slice(state, -k, k), k)
        return F.concat(state, F.array(guess))

    recent = _last_window(marked, horizon, by)
    path = F.aggregate(F.sequence(F.lit(1), F.lit(horizon.steps)), F.col("recent"), step)
    steps = F.months_between(F.col("month"), F.lit(horizon.test_start)).cast("int")
    tests = _test_months(marked)
    if by:
        joined = tests.join(recent.select(*by, path.alias("path")), list(by))
    else:
        joined = tests.withColumn("path", recent.select(path).scalar())
    return _scored(joined, by, F.element_at("path", steps + F.lit(k + 1)))


def seasonal(
    marked: DataFrame, horizon: Horizon, by: Sequence[str] = (), season: int = 12
) -> DataFrame:
    """The value of the same month one season earlier; needs a dense series."""
    earlier = F.lag("units", season).over(Window.partitionBy(*by).orderBy("month"))
    return _scored(
        marked.withColumn("_earlier", earlier.cast("double")).where(F.col("period") == "test"),
        by,
        F.col("_earlier"),
    )


def summary(forecasts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean absolute error from unrounded errors, totals and shortfall."""
    return forecasts.groupBy(*by).agg(
        F.count(F.lit(1)).alias("months"),
        F.avg("absolute_error").alias("mae"),
        F.sum("prediction").alias("predicted_total"),
        F.sum("actual").cast("bigint").alias("actual_total"),
        (F.sum("actual") - F.sum("prediction")).alias("shortfall"),
    )


def rounded_mae(forecasts: DataFrame, digits: int = 6) -> DataFrame:
    """The published variant: errors are rounded before they are averaged."""
    return forecasts.agg(F.avg(F.round("absolute_error", digits)).alias("mae"))


def report(forecasts: DataFrame, by: Sequence[str] = (), digits: int = 6) -> DataFrame:
    return forecasts.orderBy(*by, "month").select(
        *by,
        month_text(F.col("month")).alias("month"),
        F.round("prediction", digits).alias("prediction"),
        "actual",
        F.round("absolute_error", digits).alias("absolute_error"),
    )


def dataset_profile(unified: DataFrame, marked: DataFrame, horizon: Horizon, unit: str) -> DataFrame:
    """Lines and units in train and test, distinct sold units, empty months."""
    placed = F.col("month")
    train = placed <= F.lit(horizon.train_end)
    test = placed.between(F.lit(horizon.test_start), F.lit(horizon.test_end))
    zero = one_row(
        marked.agg(
            F.count_if((F.col("units") == 0) & (F.col("period") == "train")).alias("train"),
            F.count_if((F.col("units") == 0) & (F.col("period") == "test")).alias("test"),
        )
    )

    def units(period: Column) -> Column:
        return F.coalesce(F.sum(F.when(period, F.col("quantity"))), F.lit(0)).cast("bigint")

    return unified.agg(
        F.count_if(train).alias("train_lines"),
        F.count_if(test).alias("test_lines"),
        units(train).alias("train_units"),
        units(test).alias("test_units"),
        F.count_distinct(unit).alias("distinct_keys"),
    ).select(
        "*",
        zero["train"].alias("train_zero_months"),
        zero["test"].alias("test_zero_months"),
    )
