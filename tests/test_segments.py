import pytest
from pyspark.sql import functions as F

from marketgrain.plans import scopes, segments
from marketgrain.operators import joins
from tests.conftest import rows


@pytest.fixture
def shop(spark):
    """Four customers; customer 4 has no order, order 50 has no items."""
    orders = spark.createDataFrame(
        [(10, 1, "paid", "100.00"), (11, 1, "paid", "50.00"), (20, 2, "paid", "75.00"),
         (30, 3, "draft", "90.00"), (50, 3, "paid", "10.00")],
        "order_id int, customer_id int, status string, total string",
    ).withColumn("total", F.col("total").cast("decimal(18,2)"))
    items = spark.createDataFrame(
        [(10, 1, 2), (10, 2, 1), (10, 3, 1), (11, 1, 4), (20, 1, 5), (20, 2, 5), (30, 4, 9)],
        "order_id int, variant_id int, quantity bigint",
    )
    variants = spark.createDataFrame([(1, 100), (2, 200), (3, 300), (4, 100)], "variant_id int, product_id int")
    products = spark.createDataFrame(
        [(100, "a", 1), (200, "b", 2), (300, "c", 1)], "product_id int, product_name string, category_id int"
    )
    customers = spark.createDataFrame([(i,) for i in (1, 2, 3, 4)], "customer_id int")
    categories = spark.createDataFrame([(1, "one"), (2, "two")], "category_id int, category string")
    context = segments.item_context(items, products, variants)
    return dict(orders=orders, items=items, variants=variants, products=products, customers=customers,
                categories=categories, context=context, bought=segments.purchases(context, orders))


def test_order_totals_are_not_repeated_per_item(shop):
    found = {r["customer_id"]: (float(r["revenue"]), r["frequency"], float(r["ticket"]))
             for r in segments.order_metrics(shop["orders"]).collect()}
    assert found == {1: (150.0, 2, 75.0), 2: (75.0, 1, 75.0), 3: (100.0, 2, 50.0)}


def test_diversity_counts_categories_not_products(shop):
    assert dict(rows(segments.diversity(shop["bought"]))) == {1: 2, 2: 2, 3: 1}


@pytest.mark.parametrize(
    ("population", "expected"),
    [("registered", {1: 2, 2: 2, 3: 1, 4: 0}), ("ordering", {1: 2, 2: 2, 3: 1}), ("with_orders", {1: 2, 2: 2, 3: 1})],
)
def test_populations(shop, population, expected):
    metrics = segments.customer_metrics(shop["orders"], shop["bought"], shop["customers"], population)
    assert {r["customer_id"]: r["diversity"] for r in metrics.collect()} == expected


def test_customer_without_items_is_left_out_of_the_ordering_population(shop):
    only_empty = shop["orders"].where("order_id = 50")
    bought = segments.purchases(shop["context"], only_empty)
    assert segments.customer_metrics(only_empty, bought, population="ordering").count() == 0
    assert segments.customer_metrics(only_empty, bought, population="with_orders").first()["diversity"] == 0


def test_equal_tickets_rank_by_customer(shop):
    metrics = segments.customer_metrics(shop["orders"], shop["bought"], population="ordering")
    assert [r[:2] for r in rows(segments.elite_report(segments.elite(metrics, 1)))] == [(1, 1), (2, 2), (3, 3)]


def test_threshold_is_inclusive(shop):
    metrics = segments.customer_metrics(shop["orders"], shop["bought"], population="ordering")
    assert {r["customer_id"] for r in segments.eligible(metrics, 2).collect()} == {1, 2}
    assert segments.elite(metrics, 3).count() == 0


def test_ranking_uses_the_exact_ticket(spark):
    orders = spark.createDataFrame(
        [(1, 1, "10.00"), (2, 1, "10.00"), (3, 1, "10.01"), (4, 2, "10.00"), (5, 2, "10.00"), (6, 2, "10.00"),
         (7, 2, "10.01")],
        "order_id int, customer_id int, total string",
    ).withColumn("total", F.col("total").cast("decimal(18,2)"))
    bought = spark.createDataFrame([(1, 1, 1, 1), (2, 1, 1, 1)], "customer_id int, category_id int, lines int, units int")
    report = rows(segments.elite_report(segments.elite(segments.customer_metrics(orders, bought, population="ordering"), 1)))
    assert [(r[1], r[4]) for r in report] == [(1, 10.0), (2, 10.0)]


def test_tied_leaders_are_all_shown(shop):
    metrics = segments.customer_metrics(shop["orders"], shop["bought"], population="ordering")
    chosen = segments.elite(metrics, 2)
    units = segments.category_units(segments.of_elite(shop["bought"], chosen))
    assert dict(rows(units)) == {1: 12, 2: 6}
    assert rows(segments.leading_categories(units, shop["categories"])) == [(1, 12, "one")]
    tied = units.withColumn("units", F.lit(6))
    assert [r[0] for r in rows(segments.leading_categories(tied))] == [1, 2]
    assert [r[0] for r in rows(segments.leading_categories(tied, ties=False))] == [1]


def test_shares_histogram_eligibility_and_totals(shop):
    metrics = segments.customer_metrics(shop["orders"], shop["bought"], shop["customers"])
    assert rows(segments.diversity_histogram(metrics)) == [(0, 1), (1, 1), (2, 2)]
    assert rows(segments.eligibility(metrics, 2)) == [(2, 4, 3, 2, 50.0)]
    chosen = segments.elite(metrics, 2)
    share = segments.category_share(segments.category_units(segments.of_elite(shop["bought"], chosen)), shop["categories"])
    assert [(r["category"], r["rank"], r["share_pct"]) for r in share.collect()] == [("one", 1, 66.67), ("two", 2, 33.33)]
    assert rows(segments.elite_totals(shop["orders"], shop["bought"], chosen)) == [(3, 225.0, 6, 18, 12, 66.67)]


def test_equal_category_names_can_be_merged(shop):
    same = shop["categories"].withColumn("category", F.lit("same"))
    units = segments.category_units(shop["bought"])
    assert rows(segments.category_units_by_name(units, same, 6)) == [("same", 27)]


def test_mean_over_valued_orders(spark):
    orders = spark.createDataFrame([(1, 1, 10.0), (2, 1, None)], "order_id int, customer_id int, total double")
    orders = orders.withColumn("total", F.col("total").cast("decimal(18,2)"))
    both = segments.order_metrics(orders).first()
    valued = segments.order_metrics(orders, valued_only=True).first()
    assert (float(both["ticket"]), float(valued["ticket"])) == (5.0, 10.0)
    assert both["frequency"] == valued["frequency"] == 2


def test_anonymous_report_has_no_identifier(shop):
    metrics = segments.customer_metrics(shop["orders"], shop["bought"], population="ordering")
    report = segments.anonymous_report(segments.elite(metrics, 1), "Profile")
    assert "customer_id" not in report.columns
    assert [r["label"] for r in report.collect()] == ["Profile 01", "Profile 02", "Profile 03"]


def test_repeated_lookup_keys_stop_the_query(shop):
    twice = shop["products"].union(shop["products"])
    with pytest.raises(Exception, match="not unique"):
        segments.item_context(shop["items"], twice, shop["variants"]).collect()


def test_dangling_keys_by_policy(shop):
    few = shop["variants"].where("variant_id <> 4")
    for policy, lines in (("drop", 6), ("keep", 7)):
        assert joins.checked_join(shop["items"], few, "variant_id", name="variants", unmatched=policy).count() == lines
    with pytest.raises(Exception, match="no variants row for variant_id = 4"):
        joins.checked_join(shop["items"], few, "variant_id", name="variants").collect()
    with pytest.raises(Exception, match="left side"):
        joins.checked_join(shop["items"], few, "variant_id", name="v", validate="1:1", unmatched="drop").collect()
    with pytest.raises(ValueError):
        joins.checked_join(shop["items"], few, "variant_id", name="v", unmatched="?")


def test_scopes_share_one_pass(shop):
    names = {"all": None, "paid": ["paid"]}
    bought = segments.purchases(shop["context"], shop["orders"], by=["status"])
    chosen = scopes.elite_by_scope(shop["orders"], bought, names, 1, 2)
    report = [(r["scope"], r["rank"], r["customer_id"]) for r in scopes.elite_report(chosen).collect()]
    assert report == [("all", 1, 1), ("all", 2, 2), ("paid", 1, 1), ("paid", 2, 2)]
    leaders = scopes.leader_by_scope(bought, chosen, names)
    assert {(r["scope"], r["category_id"], r["units"]) for r in leaders.collect()} == {("all", 1, 12), ("paid", 1, 12)}
