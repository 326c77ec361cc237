from datetime import date

import pytest
from pyspark.sql import functions as F

from marketgrain.errors import AnalyticsError
from marketgrain.plans import forecast
from marketgrain.sources import sinks
from tests.conftest import rows

H = forecast.Horizon(date(2025, 12, 1), date(2026, 1, 1), date(2026, 3, 1))


def series(spark, values, start="2025-10-01", name=None):
    data = [(name, i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, "name string, i int, units bigint")
    return df.select("name", F.add_months(F.to_date(F.lit(start)), F.col("i")).alias("month"), "units")


def shop(spark):
    products = spark.createDataFrame(
        [(1, "compass"), (2, "compass"), (3, "compass 7")], "product_id int, product_name string"
    )
    variants = spark.createDataFrame([(10, 1), (20, 2), (30, 3)], "variant_id int, product_id int")
    orders = spark.createDataFrame(
        [(1, "2025-01-05 10:00:00"), (2, "2025-03-07 10:00:00"), (3, "2025-03-08 10:00:00")],
        "order_id int, at string",
    ).select("order_id", F.col("at").cast("timestamp_ntz").alias("placed_at"))
    items = spark.createDataFrame(
        [(1, 10, 2), (2, 20, 3), (3, 30, 100)], "order_id int, variant_id int, quantity bigint"
    )
    return items, products, orders, variants


def test_exact_name_joins_all_its_products(spark):
    items, products, orders, variants = shop(spark)
    found = forecast.unified_items(items, products, orders, "compass", variants).collect()
    assert {r["product_id"] for r in found} == {1, 2} and sum(r["quantity"] for r in found) == 5


def test_unknown_names_and_dangling_orders_are_errors(spark):
    items, products, orders, variants = shop(spark)
    with pytest.raises(AnalyticsError, match="no product"):
        forecast.unified_items(items, products, orders, "comp", variants)
    with pytest.raises(AnalyticsError, match="no variant"):
        forecast.unified_items(items, products, orders, "compass", variants.where("product_id = 3"))
    with pytest.raises(Exception, match="no orders row for order_id = 2"):
        forecast.unified_items(items, products, orders.where("order_id <> 2"), "compass", variants).collect()


def test_months_without_sales_are_zero(spark):
    sold = spark.createDataFrame([("2025-01-01", 2), ("2025-01-01", 3), ("2025-03-01", 7)], "m string, quantity bigint")
    sold = sold.select(F.col("m").cast("date").alias("month"), "quantity")
    dense = forecast.monthly_units(sold, F.to_date(F.lit("2025-01-15")), F.to_date(F.lit("2025-03-02")))
    assert [r["units"] for r in dense.orderBy("month").collect()] == [5, 0, 7]
    none = forecast.monthly_units(sold.where("quantity > 99"), F.to_date(F.lit("2025-01-15")), F.to_date(F.lit("2025-02-02")))
    assert [r["units"] for r in none.collect()] == [0, 0]


def test_series_that_never_sold_are_covered(spark):
    sold = spark.sql("select 'a' as name, date'2025-01-01' as month, 4L as quantity union all select 'a', null, 5L")
    names = spark.createDataFrame([("a",), ("b",)], "name string")
    dense = forecast.monthly_units(sold, F.to_date(F.lit("2025-01-01")), F.to_date(F.lit("2025-02-01")), ["name"], names)
    assert sorted((r["name"], r["units"]) for r in dense.collect()) == [("a", 0), ("a", 4), ("b", 0), ("b", 0)]


def test_split_bounds(spark):
    marked = forecast.split(series(spark, [1, 2, 3, 4, 5, 6, 7]).drop("name"), H)
    months = {p: [str(r["month"]) for r in marked.where(F.col("period") == p).orderBy("month").collect()] for p in ("train", "test")}
    assert months["train"][-1] == "2025-12-01" and months["test"] == ["2026-01-01", "2026-02-01", "2026-03-01"]


def test_missing_test_month_or_short_history(spark):
    with pytest.raises(Exception, match="test months are missing"):
        forecast.split(series(spark, [1, 2, 3, 4, 5]), H).collect()
    with pytest.raises(Exception, match="history is shorter"):
        forecast.split(series(spark, [1, 2, 3, 4, 5], "2025-11-01"), H).collect()


def test_horizon_is_checked():
    with pytest.raises(AnalyticsError):
        forecast.Horizon(date(2025, 12, 1), date(2026, 1, 1), date(2026, 3, 1), 0)
    with pytest.raises(AnalyticsError):
        forecast.Horizon(date(2026, 1, 1), date(2026, 1, 1), date(2026, 3, 1))
    assert (H.steps, H.cutoff) == (3, date(2026, 4, 1))
    assert forecast.Horizon(date(2025, 6, 1), date(2025, 11, 1), date(2025, 12, 1)).cutoff == date(2026, 1, 1)


def test_walk_forward_learns_only_from_the_past(spark):
    marked = forecast.split(series(spark, [10, 20, 30, 60, 90, 120]), H)
    found = forecast.walk_forward(marked, H).orderBy("month").collect()
    assert [r["prediction"] for r in found] == [20.0, 110 / 3, 60.0]
    changed = forecast.split(series(spark, [10, 20, 30, 60, 90, 999]), H)
    again = forecast.walk_forward(changed, H).orderBy("month").collect()
    assert [r["prediction"] for r in again] == [r["prediction"] for r in found]


def test_mae_uses_unrounded_errors(spark):
    marked = forecast.split(series(spark, [34, 60, 22, 79, 68, 60]), H)
    summed = forecast.summary(forecast.walk_forward(marked, H)).first()
    assert summed["mae"] == pytest.approx(19 + 4 / 9, abs=1e-12)
    assert summed["predicted_total"] == pytest.approx(148 + 2 / 3) and summed["actual_total"] == 207
    assert summed["shortfall"] == pytest.approx(58 + 1 / 3)
    rounded = forecast.rounded_mae(forecast.walk_forward(marked, H)).first()["mae"]
    assert rounded == pytest.approx((40.333333 + 14.333333 + 3.666667) / 3, abs=1e-12)


def test_frozen_and_recursive(spark):
    marked = forecast.split(series(spark, [34, 60, 22, 79, 68, 60]), H)
    level = forecast.frozen(marked, H)
    assert {round(r["prediction"], 3) for r in level.collect()} == {38.667}
    assert forecast.summary(level).first()["mae"] == pytest.approx(30.33, abs=0.005)
    path = forecast.recursive(marked, H)
    assert [round(r["prediction"], 2) for r in path.orderBy("month").collect()] == [38.67, 40.22, 33.63]
    assert forecast.summary(path).first()["mae"] == pytest.approx(31.49, abs=0.005)


def test_seasonal_takes_last_year(spark):
    marked = forecast.split(series(spark, list(range(1, 16)), "2025-01-01"), H)
    assert [r["prediction"] for r in forecast.seasonal(marked, H).orderBy("month").collect()] == [1.0, 2.0, 3.0]


def test_many_series_equal_one_by_one(spark):
    a, b = [34, 60, 22, 79, 68, 60], [1, 2, 3, 4, 5, 6]
    both = series(spark, a, name="a").union(series(spark, b, name="b"))
    marked = forecast.split(both, H, ["name"])
    for method in (forecast.walk_forward, forecast.frozen, forecast.recursive):
        together = method(marked, H, ["name"])
        for name, values in (("a", a), ("b", b)):
            alone = method(forecast.split(series(spark, values), H), H)
            assert rows(together.where(F.col("name") == name).drop("name").orderBy("month")) == rows(alone.orderBy("month"))
    assert forecast.summary(forecast.walk_forward(marked, H, ["name"]), ["name"]).count() == 2


def test_exported_series_names_the_period(spark):
    exported = sinks.monthly_with_period(series(spark, [1, 2, 3, 4, 5, 6]), H).orderBy("month").collect()
    assert [r["period"] for r in exported] == ["train"] * 3 + ["test"] * 3
    assert exported[0]["month"] == "2025-10"


def test_dataset_profile(spark):
    unified = spark.createDataFrame(
        [("2025-10-01", 1, 5), ("2025-12-01", 2, 6), ("2026-01-01", 1, 7)], "m string, product_id int, quantity bigint"
    ).select(F.col("m").cast("date").alias("month"), "product_id", "quantity")
    marked = forecast.split(series(spark, [5, 0, 6, 7, 0, 0]), H)
    assert rows(forecast.dataset_profile(unified, marked, H, "product_id")) == [(2, 1, 11, 7, 2, 1, 2)]
