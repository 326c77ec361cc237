"""Plans and skew: what has to hold when the data no longer fits a machine."""

import re

import pytest
from pyspark.sql import functions as F

from marketgrain.operators import quantiles, ranking
from marketgrain.parity.queries import REGISTRY
from marketgrain.plans import affinity, forecast, profile, quality, sales, scopes, segments
from marketgrain.session import scratch_dir, tune
from tests.conftest import rows


@pytest.fixture
def large_joins(spark):
    """No side may be broadcast and anything above a few rows counts as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "32",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def hot(spark):
    """One order, one product and one customer each hold a third of all items."""
    n = 60_000
    ids = spark.range(0, n, 1, 16)
    third = F.col("id") % 3 == 0
    items = ids.select(
        F.when(third, 0).otherwise(F.col("id") % 5000).cast("int").alias("order_id"),
        F.when(third, F.lit(1)).otherwise(F.col("id") % 701).cast("int").alias("product_id"),
        (F.col("id") % 7 + 1).alias("quantity"),
    )
    orders = spark.range(5000).select(
        F.col("id").cast("int").alias("order_id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 400).cast("int").alias("customer_id"),
        F.when(F.col("id") % 2 == 0, "paid").otherwise("draft").alias("status"),
        F.lit("pos").alias("channel"),
        (F.col("id") % 1000 + 1).cast("decimal(18,2)").alias("total"),
        F.expr("timestamp_ntz'2026-01-01 00:00:00' + make_dt_interval(cast(id % 90 as int))").alias("placed_at"),
    )
    products = spark.range(701).select(
        F.col("id").cast("int").alias("product_id"), F.concat(F.lit("p"), F.col("id") % 50).alias("product_name"),
        (F.col("id") % 25).cast("int").alias("category_id"),
    )
    return items, orders, products


def test_hot_keys_are_split_by_the_join(spark, hot, large_joins):
    items, orders, products = hot
    joined = segments.item_context(items, products, unmatched="keep", validate=None)
    counted = joined.join(orders, "order_id").groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    assert sum(r["n"] for r in counted.collect()) == 60_000
    assert "skew=true" in final_plan(counted)


def test_results_do_not_change_when_joins_shuffle(spark, hot):
    items, orders, products = hot

    def results():
        context = segments.item_context(items, products)
        bought = segments.purchases(context, orders)
        metrics = segments.customer_metrics(orders, bought, population="ordering")
        links = affinity.interactions(items, orders)
        return (
            sorted(rows(segments.elite_report(segments.elite(metrics, 3)))),
            sorted(rows(segments.category_units(bought))),
            sorted(rows(affinity.similar_products(links, products, 1))),
            affinity.pair_cosine(links, block=64).agg(F.count("*"), F.sum("common"), F.max("common")).first(),
        )

    small = results()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        assert results() == small
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_results_do_not_depend_on_partitioning(spark, hot):
    items, orders, products = hot
    expected = None
    for n in (1, 5, 23):
        base = sales.sales_base(orders.repartition(n), "status")
        bought = segments.purchases(segments.item_context(items.repartition(n), products), orders)
        found = (rows(sales.breakdown(base, "status")), sorted(rows(segments.order_metrics(orders.repartition(n)))),
                 sorted(rows(segments.diversity(bought))), rows(profile.tukey(orders.repartition(n), "total")))
        expected = expected or found
        assert found == expected


def test_a_large_basket_is_cut_into_small_groups(spark):
    """The join groups of a customer with 3000 products stay near the block size."""
    basket = spark.range(3000).selectExpr("0 as customer_id", "cast(id as int) as product_id")
    pairs = affinity.pair_cosine(basket, block=500)
    assert pairs.count() == 3000 * 2999 // 2
    group = basket.select(F.pmod(F.xxhash64("product_id"), F.lit(6)).alias("g")).groupBy("g").count()
    assert group.agg(F.max("count")).first()[0] < 600


def test_foreign_keys_collapse_before_the_shuffle(spark, hot):
    items, orders, _ = hot
    report = quality.orphan_report([quality.Edge("e", items, "order_id", orders.where("order_id > 0"), "order_id")])
    assert rows(report) == [("e", 1, 20_008)]
    plan = optimized(report)
    assert plan.index("LeftOuter") < plan.rindex("Aggregate [")


def test_top_per_scope_is_cut_before_the_shuffle(spark, hot):
    items, orders, products = hot
    context = segments.item_context(items, products, validate=None)
    bought = segments.purchases(context, orders, by=["status"])
    chosen = scopes.elite_by_scope(orders, bought, {"all": None, "paid": ["paid"]}, 1, 5)
    assert "WindowGroupLimit" in final_plan(chosen) and chosen.count() == 10


def test_top_n_keeps_n_rows_per_task(spark, hot):
    _, orders, _ = hot
    best = segments.top(segments.order_metrics(orders), segments.by_ticket(), 10)
    assert "TakeOrderedAndProject" in final_plan(best)


def test_filters_and_columns_reach_the_scan(spark):
    plan = final_plan(REGISTRY["weekday_mean"](spark, "/root/testdata/sf0.001"))
    assert "PushedFilters: [IsNotNull(o_orderpriority), EqualTo(o_orderpriority,1-URGENT)]" in plan
    assert re.search(r"ReadSchema: struct<o_orderdate:timestamp_ntz>", plan)
    assert "o_custkey" not in plan


def test_no_cross_joins(spark):
    # tukey lays one row beside every value, which is a broadcast of one row
    for name in ("weekday_by_segment", "similar_items", "forecast_recursive", "scope_leader", "pair_cosine"):
        plan = final_plan(REGISTRY[name](spark, "/root/testdata/sf0.001"))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_every_broadcast_hint_is_bounded(spark):
    """Hints appear only on top-n keys and on the bins that hold a quantile."""
    import pathlib

    root = pathlib.Path(__file__).parent.parent / "marketgrain"
    files = [p for folder in ("operators", "plans", "sources", "functions") for p in (root / folder).glob("*.py")]
    hits = [(p.name, line) for p in files for line in p.read_text().splitlines() if "F.broadcast(" in line]
    # one row, or the few ranges that hold a wanted position
    one_row = ("F.broadcast(row)", "F.broadcast(best)")
    assert hits and all("offsets.where(wanted)" in line or any(x in line for x in one_row) for _, line in hits)


def test_quantiles_of_a_narrow_range(spark):
    """A million values in [0, 1e-6] are spread evenly; no range holds more than its share."""
    frame = spark.range(1_000_000).select((F.col("id") * 1e-12).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        counts = quantiles.value_counts(frame, "v")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r["count"] for r in counts.groupBy(F.col("_metadata.file_name")).count().collect()]
    assert len(sizes) > 4 and max(sizes) < 2 * sum(sizes) / len(sizes)
    (row,) = quantiles.quantiles(counts, [0.25, 0.5, 0.99]).collect()
    assert [row[i] for i in range(3)] == pytest.approx([249999.75e-12, 499999.5e-12, 989999.01e-12])


def test_part_numbers_beyond_their_padding(spark, tmp_path):
    """Files are ordered by number: 99,999 before 100,000."""
    names = [f"part-{n:05d}-x.parquet" for n in (99_999, 100_000)]
    assert sorted(names) != names
    number = F.regexp_extract(F.col("name"), r"\Apart-([0-9]+)", 1).cast("bigint")
    frame = spark.createDataFrame([(n,) for n in names], "name string")
    assert [r["name"] for r in frame.orderBy(number).collect()] == names


def test_dense_series_are_not_shuffled_again(spark, hot):
    items, orders, products = hot
    dated = items.join(products, "product_id").join(orders, "order_id").withColumn("month", F.trunc("placed_at", "month"))
    day = lambda text: F.to_date(F.lit(text))
    dense = forecast.monthly_units(dated, day("2025-01-01"), day("2026-03-01"), ["product_id"])
    w = forecast.Window.partitionBy("product_id").orderBy("month")
    plan = final_plan(dense.withColumn("s", F.sum("units").over(w)))
    above = plan[: plan.index("Generate")]
    assert "Exchange" not in above


def test_scratch_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first != second
    if named:
        assert first.startswith(f"{named.rstrip('/')}/x-")


class _Unset:
    """A session in which no checkpoint folder was configured."""

    def __init__(self, master="local[2]"):
        self.conf, self.sparkContext = self, self
        self.master, self.folder = master, None

    def get(self, key, default=None):
        return default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = f"file:{folder}/inner"


def test_scratch_folder_without_a_named_one(spark):
    session = _Unset()
    first, second = scratch_dir(session, "x"), scratch_dir(session, "y")
    assert first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0] == session.folder
    assert tune(spark) is spark


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[2,1,1024]"])
def test_scratch_folder_must_be_named_on_a_cluster(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(_Unset(master), "x")


def test_positions_over_many_ranges(spark):
    """A full ranking equals the sorted list, also with equal values."""
    frame = spark.range(0, 5000, 1, 9).select("id", (F.col("id") % 7).alias("units"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = ranking.positions(frame, [F.col("units").desc(), F.col("id").asc()])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    found = sorted((r["rank"], r["units"], r["id"]) for r in ranked.collect())
    ordered = sorted(((i % 7, i) for i in range(5000)), key=lambda p: (-p[0], p[1]))
    assert found == [(n, u, i) for n, (u, i) in enumerate(ordered, 1)]
    assert len(ranked.inputFiles()) > 1


def test_pairs_are_counted_where_their_item_is(spark, large_joins):
    """No pair is shuffled as a row: after the item's baskets arrive, only counting follows,
    also in the wide form, and the tasks grow with the pairs."""
    links = spark.range(4000).selectExpr("cast(id % 40 as int) as customer_id", "id % 97 as product_id").distinct()
    pairs = affinity.pair_cosine(links)
    wide = affinity.wide_blocks(affinity.mirrored(affinity.pair_cosine(links, both=True), links, both=True), "product_a", "product_b", "similarity")
    for frame in (pairs, wide):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        head = plan[: plan.index("posexplode")]
        assert "HashAggregate" in head and "Exchange" not in head
    fewer = affinity.pairs.counting_tasks(links, "customer_id")
    affinity.pairs.PARTNERS_A_TASK, before = 1 << 12, affinity.pairs.PARTNERS_A_TASK
    try:
        assert affinity.pairs.counting_tasks(links, "customer_id", both=True) > 2 * fewer
    finally:
        affinity.pairs.PARTNERS_A_TASK = before
    every = affinity.mirrored(affinity.pair_cosine(links), links)
    both = affinity.mirrored(affinity.pair_cosine(links, both=True), links, both=True)
    assert sorted(rows(every)) == sorted(rows(both))


def test_tasks_follow_the_number_of_series(spark, monkeypatch):
    """Not the bytes of the sums, of which each becomes a row per month."""
    monkeypatch.setattr(forecast, "SERIES_A_TASK", 10)
    series = spark.range(400).selectExpr("cast(id as int) as product_id")
    sold = series.selectExpr("product_id", "date'2026-01-01' as month", "1L as quantity")
    first, last = F.lit("2025-01-01").cast("date"), F.lit("2026-03-01").cast("date")
    months = forecast.monthly_units(sold, first, last, ["product_id"], series)
    assert months.rdd.getNumPartitions() == 40
    assert months.agg(F.count("*"), F.sum("units")).first()[:] == (400 * 15, 400)
