import datetime

import pytest
from pyspark.sql import functions as F

from marketgrain.operators import summary
from marketgrain.plans import affinity, contract, sketches
from marketgrain.sources import sinks


def test_wide_blocks_hold_every_value_once(spark):
    cells = {(r, c): r * 100.0 + c for r in range(4) for c in (0, 1, 6, 7, 13, 100_003) if (r + c) % 3}
    long = spark.createDataFrame([(*k, v) for k, v in cells.items()], "r int, c bigint, v double")
    found = affinity.wide_blocks(long, "r", "c", "v", 7).collect()
    assert len({(x["block"], x["r"]) for x in found}) == len(found)
    back = {(x["r"], x["block"] * 7 + i): x[f"c{i}"] for x in found for i in range(7) if x[f"c{i}"]}
    assert back == {k: v for k, v in cells.items() if v}


def test_wide_blocks_of_nulls_and_nothing(spark):
    schema = "r int, c bigint, v double"
    odd = spark.createDataFrame([(1, None, 2.0), (None, 1, 2.0), (3, -1, 5.0)], schema)
    (only,) = affinity.wide_blocks(odd, "r", "c", "v", 4).collect()
    assert (only["block"], only["r"], only["c3"], only["c0"]) == (-1, 3, 5.0, 0.0)
    assert affinity.wide_blocks(spark.createDataFrame([], schema), "r", "c", "v", 4).collect() == []


def test_merged_sketches_count_a_customer_of_many_days_once(spark):
    orders = spark.range(60_000).select(
        (F.col("id") % 5000).alias("customer_id"),
        F.timestamp_add("DAY", (F.col("id") % 30).cast("int"), F.lit(datetime.datetime(2025, 1, 1))).alias("placed_at"),
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("channel"),
    )
    daily = sketches.daily(orders, "customer_id", "channel")
    assert daily.count() <= 60
    (every,) = sketches.merged(daily).collect()
    assert abs(every["estimate"] - 5000) < 150
    exact = {r[0]: r[1] for r in orders.groupBy("channel").agg(F.count_distinct("customer_id")).collect()}
    for row in sketches.merged(daily, "channel").collect():
        assert abs(row["estimate"] - exact[row["channel"]]) <= 0.03 * exact[row["channel"]]


def test_null_customers_are_not_counted(spark):
    orders = spark.createDataFrame([(None, datetime.datetime(2025, 1, 1))], "customer_id bigint, placed_at timestamp_ntz")
    assert sketches.merged(sketches.daily(orders, "customer_id")).first()["estimate"] == 0


def _insights(spark, elite, days, errors):
    share = spark.createDataFrame([(12.5, 3)], "eligible_share_pct double, minimum_categories int")
    return contract.insights(
        share,
        spark.createDataFrame(elite, "rank int, category string, units bigint"),
        spark.createDataFrame(days, "iso_weekday int, weekday string, mean_sales double, is_lowest boolean"),
        spark.createDataFrame(errors, "mae double, shortfall double"),
    ).collect()


def test_insights_name_the_first_of_equal_weekdays(spark):
    days = [(5, "e", 2.0, True), (2, "b", 2.0, True), (1, "a", 9.0, False)]
    found = _insights(spark, [(2, "y", 1), (1, "x", 7)], days, [(1.5, -4.0)])
    assert [(r["id"], r["subject"], r["value"], r["other"]) for r in found] == [
        ("elite-selectivity", None, 12.5, 3.0), ("elite-category", "x", 7.0, None), ("weekday-pos", "b", 2.0, None), ("forecast", None, 1.5, -4.0),
    ]


def test_insights_of_empty_sections_are_null(spark):
    found = _insights(spark, [], [], [])
    assert [r["value"] for r in found] == [12.5, None, None, None]


@pytest.mark.parametrize("mark", [False, True])
def test_the_mark_stands_before_the_header_alone(spark, tmp_path, mark):
    row = spark.createDataFrame([sinks.TIDY_COLUMNS], ", ".join(f"{c} string" for c in sinks.TIDY_COLUMNS))
    sinks.write_view(row, str(tmp_path / "v"), mark=mark)
    (part,) = (tmp_path / "v").glob("part-*")
    header = ";".join(sinks.TIDY_COLUMNS)
    assert part.read_bytes().decode() == ("﻿" if mark else "") + f"{header}\r\n{header}\r\n"


def test_only_small_sources_are_spread(spark):
    assert summary.spread(spark.range(100, numPartitions=1)).rdd.getNumPartitions() > 1
    many = summary.SMALL_SPLITS + 1
    assert summary.spread(spark.range(100, numPartitions=many)).rdd.getNumPartitions() == many
