import pytest
from pyspark.sql import functions as F

from marketgrain.functions.labels import iso_weekday, weekday_name
from marketgrain.plans import sales, weekdays
from tests.conftest import rows

POS = "channel = 'pos'"


def orders(spark, data):
    df = spark.createDataFrame(data, "placed_at string, channel string, status string, total string")
    return df.select(
        F.col("placed_at").cast("timestamp_ntz"), "channel", "status", F.col("total").cast("decimal(18,2)")
    )


DATA = [
    ("2026-01-01 09:00:00", "pos", "paid", "10.00"),   # Thursday, first day
    ("2026-01-01 23:59:59", "pos", "draft", "20.00"),
    ("2026-01-02 10:00:00", "web", "paid", "99.00"),   # only the other channel
    ("2026-01-05 10:00:00", "pos", "paid", "5.00"),    # sums to zero
    ("2026-01-05 11:00:00", "pos", "paid", "-5.00"),
    ("2026-01-15 10:00:00", "pos", "paid", "7.00"),    # Thursday, last day
]


@pytest.fixture
def base(spark):
    return sales.sales_base(orders(spark, DATA), "channel", "status")


def test_iso_weekdays(spark):
    df = spark.sql("select date'2026-01-01' as d union all select date'2026-01-04'")
    found = rows(df.select(iso_weekday(F.col("d")), weekday_name(iso_weekday(F.col("d")), "en")).orderBy("d"))
    assert found == [(4, "Thursday"), (7, "Sunday")]


def test_every_day_appears_with_both_edges(base):
    filled = weekdays.calendar_sales(base, POS).orderBy("day").collect()
    assert len(filled) == 15
    assert (str(filled[0]["day"]), float(filled[0]["sales"])) == ("2026-01-01", 30.0)
    assert (str(filled[-1]["day"]), float(filled[-1]["sales"])) == ("2026-01-15", 7.0)
    second = filled[1]
    assert (second["orders"], float(second["sales"]), second["recorded"]) == (0, 0.0, False)


def test_two_notions_of_an_empty_day(base):
    found = {r["iso_weekday"]: r for r in weekdays.weekday_mean(base, POS).collect()}
    monday = found[1]
    assert (monday["calendar_days"], monday["days_without_record"], monday["zero_sales_days"]) == (2, 1, 2)
    thursday = found[4]
    assert (thursday["mean_sales"], thursday["mean_recorded"]) == (12.33, 18.5)
    assert sorted(found) == [1, 2, 3, 4, 5, 6, 7]


def test_lowest_weekday_prefers_the_earlier_one(base):
    report = weekdays.weekday_mean(base, POS).collect()
    assert report[0]["iso_weekday"] == 1 and [r["is_lowest"] for r in report] == [True] + [False] * 6


def test_totals_survive_the_calendar(spark, base):
    r = weekdays.reconcile_calendar(orders(spark, DATA), base, POS).first()
    assert (r["calendar_days"], r["orders_after"], r["sales_after"], r["balanced"]) == (15, 5, 37.0, True)


def test_no_orders_and_null_dates(spark):
    empty = sales.sales_base(orders(spark, []), "channel")
    assert weekdays.weekday_mean(empty).count() == 0
    odd = sales.sales_base(orders(spark, [(None, "pos", "x", "1.00"), ("2026-01-01 00:00:00", "pos", "x", None)]), "channel")
    r = weekdays.weekday_mean(odd).collect()
    assert len(r) == 1 and r[0]["calendar_days"] == 1 and r[0]["mean_sales"] == 0.0
    assert [m["month"] for m in sales.monthly(odd).collect()] == ["2026-01"]


def test_segments_get_the_full_calendar(spark, base):
    names = spark.createDataFrame([("pos",), ("web",), ("fair",)], "channel string")
    filled = weekdays.segment_calendar_sales(base, "channel", names)
    found = {r["channel"]: (r["n"], float(r["s"])) for r in filled.groupBy("channel").agg(F.count("*").alias("n"), F.sum("sales").alias("s")).collect()}
    assert found == {"pos": (15, 37.0), "web": (15, 99.0), "fair": (15, 0.0)}


def test_months_without_orders(spark):
    base = sales.sales_base(orders(spark, [DATA[0], ("2026-03-31 23:00:00", "web", "x", "3.00")]), "channel")
    assert rows(sales.monthly(base)) == [("2026-01", 1, 10.0, 10.0), ("2026-02", 0, 0.0, 0.0), ("2026-03", 1, 3.0, 3.0)]
    assert [r[0] for r in rows(sales.monthly(base, zero_months=False))] == ["2026-01", "2026-03"]


def test_breakdown_orders_and_shares(base):
    found = rows(sales.breakdown(base, "channel"))
    assert found == [("pos", 5, 37.0, 7.4, 83.33, 27.21), ("web", 1, 99.0, 99.0, 16.67, 72.79)]
    assert [r[0] for r in rows(sales.breakdown(base, "channel", "revenue"))] == ["web", "pos"]
    with pytest.raises(ValueError):
        sales.breakdown(base, "channel", "name")


def test_breakdown_of_zero_value(spark):
    base = sales.sales_base(orders(spark, [("2026-01-01 00:00:00", "a", "x", "0.00")]), "channel")
    assert rows(sales.breakdown(base, "channel")) == [("a", 1, 0.0, 0.0, 100.0, 0.0)]
