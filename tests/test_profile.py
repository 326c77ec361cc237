import math
import random

import pytest
from pyspark.sql import functions as F

from marketgrain.operators import quantiles
from marketgrain.plans import profile
from tests.conftest import rows



def make(spark, data):
    text = spark.createDataFrame(
        [tuple(None if v is None else str(v) for v in r) for r in data],
        "order_id string, status string, total string, subtotal string, discount string, "
        "placed_at string, created_at string, updated_at string",
    )
    money = ["total", "subtotal", "discount"]
    moments = ["placed_at", "created_at", "updated_at"]
    return text.select(
        F.col("order_id").cast("int"),
        "status",
        *[F.col(c).cast("decimal(18,2)") for c in money],
        *[F.col(c).cast("timestamp_ntz") for c in moments],
    )


T = "2026-01-01 10:00:00"
LATE = "2026-01-02 10:00:00"
ROWS = [
    (1, "paid", "10.00", "12.00", "2.00", T, T, T),
    (2, "paid", "0.00", "1.00", "1.00", T, LATE, LATE),
    (2, "draft", "-5.00", "-5.00", "0.00", LATE, T, T),
    (5, "draft", "9.99", "12.00", "2.00", T, LATE, T),
    (7, None, None, "3.00", "4.00", T, T, LATE),
]


def test_overview(spark):
    r = profile.overview(make(spark, ROWS)).first()
    assert (r["rows"], r["smallest"], r["largest"], r["amounts_used"], r["amounts_missing"]) == (5, -5.0, 10.0, 4, 1)
    assert r["average"] == 3.75


def test_overview_of_nothing(spark):
    r = profile.overview(make(spark, [])).first()
    assert (r["rows"], r["smallest"], r["average"], r["first_moment"]) == (0, None, 0.0, None)


def test_overview_of_nulls_only(spark):
    r = profile.overview(make(spark, [(1, "x", None, None, None, None, None, None)])).first()
    assert (r["rows"], r["amounts_used"], r["moments_missing"]) == (1, 0, 1)


def test_null_profile(spark):
    found = {r["column_name"]: (r["nulls"], r["null_pct"]) for r in profile.null_profile(make(spark, ROWS)).collect()}
    assert found["status"] == (1, 20.0) and found["order_id"] == (0, 0.0)


def test_nulls_by_dimension(spark):
    assert rows(profile.nulls_by(make(spark, ROWS), "status", "total")) == [(None, 1, 1), ("draft", 2, 0), ("paid", 2, 0)]


def test_rules(spark):
    found = dict(rows(profile.rule_checks(make(spark, ROWS), profile.order_rules())))
    assert found == {
        "negative_subtotal": 1,
        "negative_total": 1,
        "zero_total": 1,
        "discount_out_of_range": 2,
        "total_differs": 1,
        "placed_after_created": 1,
        "created_after_updated": 1,
        "identical_timestamps": 1,
    }


def test_a_difference_of_one_cent_counts_unless_strict(spark):
    df = make(spark, [(1, "x", "9.99", "12.00", "2.00", T, T, T), (2, "x", "9.98", "12.00", "2.00", T, T, T)])
    loose, strict = (profile.order_rules(strict=s)["total_differs"] for s in (False, True))
    assert dict(rows(profile.rule_checks(df, {"a": loose, "b": strict}))) == {"a": 2, "b": 1}


def test_duplicates_have_two_meanings(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (3,), (3,)], "k int")
    assert rows(profile.duplicates(df, "k")) == [(2, 3)]
    assert rows(profile.duplicates(df.where("k = 2"), "k")) == [(0, 0)]
    assert rows(profile.duplicates(df.where("k > 9"), "k")) == [(0, 0)]


def test_id_gaps(spark):
    assert rows(profile.id_gaps(make(spark, ROWS), "order_id")) == [(1, 7, 4, 3)]


def exact(values, p):
    ordered = sorted(values)
    position = p * (len(ordered) - 1)
    low, high = math.floor(position), math.ceil(position)
    return ordered[low] + (ordered[high] - ordered[low]) * (position - low)


@pytest.mark.parametrize("seed", range(4))
def test_quantiles_match_a_sorted_list(spark, seed):
    draw = random.Random(seed)
    shapes = [
        lambda: round(draw.uniform(-1000, 1000), 2),
        lambda: float(draw.randint(0, 3)),
        lambda: draw.lognormvariate(3, 4),
        lambda: 7.0 if draw.random() < 0.4 else -draw.random() * 1e9,
    ]
    values = [shapes[seed]() for _ in range(777)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(7)
    wanted = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    found = quantiles.quantiles(quantiles.value_counts(df, "v"), wanted).first()
    for p, value in zip(wanted, found):
        assert value == pytest.approx(exact(values, p), rel=1e-12, abs=1e-9)


def test_approximate_quantiles_on_request(spark):
    df = spark.range(1, 1002).selectExpr("cast(id as double) as v")
    assert rows(quantiles.approximate(df, "v", [0.5])) == [(501.0,)]
    with pytest.raises(ValueError):
        quantiles.approximate(df, "v", [1.5])


def test_tukey_flags_and_keeps(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 100]], "v double")
    r = profile.tukey(df, "v").first()
    assert (r["q1"], r["median"], r["q3"], r["evaluated"], r["candidates"]) == (2.0, 3.0, 4.0, 5, 1)
    assert (r["lower_fence"], r["upper_fence"]) == (-1.0, 7.0)
    approx = profile.tukey(df, "v", accuracy=100).first()
    assert approx["candidates"] == 1


def test_tukey_without_spread_one_row_and_no_row(spark):
    same = spark.createDataFrame([(5.0,)] * 4 + [(6.0,)], "v double")
    r = profile.tukey(same, "v").first()
    assert (r["q1"], r["q3"], r["candidates"]) == (5.0, 5.0, 1)
    one = profile.tukey(same.where("v = 6"), "v").first()
    assert (one["median"], one["candidates"]) == (6.0, 0)
    none = profile.tukey(same.where("v > 9"), "v").first()
    assert (none["median"], none["evaluated"], none["candidates"]) == (None, 0, 0)


def test_by_dimension_most_rows_first(spark):
    found = rows(profile.by_dimension(make(spark, ROWS[:4] + [(9, "paid", "1.00", "1", "0", T, T, T)]), "status"))
    assert [r[0] for r in found] == ["paid", "draft"] and found[0][1:] == (3, 0.0, 10.0, 3.67)
