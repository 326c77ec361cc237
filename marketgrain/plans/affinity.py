"""Which products are bought by the same customers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketgrain.errors import AnalyticsError
from marketgrain.operators import pairs
from marketgrain.operators.joins import checked_join, lookup
from marketgrain.operators.ranking import numbered, position_of_best, top
from marketgrain.operators.summary import cleared, materialized


def interactions(
    context: DataFrame, orders: DataFrame, *, unmatched: str = "error", validate: str | None = "m:1"
) -> DataFrame:
    """Each (customer, product) once, however often it was bought."""
    owners = orders.select("order_id", "customer_id")
    joined = checked_join(
        context.select("order_id", "product_id"), owners, "order_id",
        name="orders", validate=validate, unmatched=unmatched,
    )
    return joined.select("customer_id", "product_id").distinct()


def cosine(common: Column, support_a: Column, support_b: Column) -> Column:
    """Cosine of two binary vectors; zero when one of them is empty."""
    product = support_a.cast("double") * support_b.cast("double")
    return F.when(product > 0, common / F.sqrt(product)).otherwise(F.lit(0.0))


def pair_cosine(
    links: DataFrame, *, min_common: int = 1, min_cosine: float = 0.0, block: int = 1024, both: bool = False
) -> DataFrame:
    """Similarity of every two products with a common buyer, each pair once
    (``product_a < product_b``) or, with ``both``, both ways. A pair that is absent has similarity 0, or less
    than ``min_cosine`` where that is given. Without it the result grows with the
    square of the baskets; ask for it only where all pairs are needed."""
    counted = pairs.common_owners(
        links,
        "customer_id",
        "product_id",
        min_common=min_common,
        min_cosine=min_cosine,
        block=block,
        both=both,
    )
    similar = counted.select(
        F.col("item_a").alias("product_a"),
        F.col("item_b").alias("product_b"),
        "common",
        cosine(F.col("common"), F.col("support_a"), F.col("support_b")).alias("similarity"),
    )
    return similar.where(F.col("similarity") >= min_cosine) if min_cosine > 0 else similar


def most_similar(
    links: DataFrame, n: int, *, min_cosine: float = 0.0, block: int = 1024
) -> DataFrame:
    """The ``n`` most similar products of every product, the smaller id first
    among equals, without counting all pairs.

    Two products share at most the smaller support, so products whose supports are
    d powers of two apart reach a cosine of at most 2^(-(d-1)/2). Pairs are counted
    from near supports to far ones, once for each of the two, in the task that has all
    pairs of that product: only its ``n`` best leave it. A product is settled when its
    n-th best is above what is still to come, and gathers only while it is open. What a
    catalogue of like supports shares has to be counted; rare
    products never meet all that was bought with a best seller.
    """
    baskets = pairs.Baskets.of(links, "customer_id", "product_id", block)
    with cleared(links.sparkSession):
        widest = baskets.supports.agg(F.max("level") - F.min("level")).first()[0]
    best, open_items, low, width = None, None, 0, 1
    # no product is settled before levels up to two apart are counted: if few pairs are
    # farther apart, rounds of their own would cost more than they could save
    if widest and min_cosine <= 2.0 ** (-(widest - 1) / 2) and (widest < 3 or baskets.share_apart(3) < 1 / 10):
        width = widest + 1
    while widest is not None and low <= widest:
        apart = range(low, min(low + width, widest + 1)) if width <= widest else None
        bound = 2.0 ** (-(low - 1) / 2)
        if min_cosine > bound * (1 + 1e-9):
            break
        similarity = cosine(F.col("common"), F.col("support_a"), F.col("support_b"))
        order = Window.partitionBy("product_id").orderBy(F.col("similarity").desc(), "other_id")
        made = []
        # a round's shuffles are gone from the disks before the next
        for part in baskets.rounds():
            whole = apart is None and open_items is None and part.lists is not None and 0 < n <= 16
            met = part.candidates(n, similarity) if whole else part.met(apart, open_items)
            found = met.select(
                F.col("item_a").alias("product_id"),
                F.col("item_b").alias("other_id"),
                "common",
                similarity.alias("similarity"),
            )
            found = found.where(F.col("similarity") >= min_cosine) if min_cosine > 0 else found
            # the first cut is made where the pairs were counted
            found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n).drop("rank")
            found = found if best is None else best.where(part.in_round("product_id")).unionByName(found)
            ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
            made.append(materialized(ranked.drop("rank"), "most-similar"))
        best = reduce(DataFrame.unionByName, made)
        low, width = low + width, width * 2
        # strictly above what is to come, as an equal one with a smaller id would win
        after = 2.0 ** (-(low - 1) / 2) * (1 + 1e-9)
        settled = best.groupBy("product_id").agg(F.count(F.lit(1)).alias("k"), F.min("similarity").alias("least"))
        settled = settled.where((F.col("k") >= n) & (F.col("least") > after)).select(F.col("product_id").alias("item"))
        open_items = materialized(baskets.supports.join(settled, "item", "left_anti").select("item"), "open-products")
        if not open_items.take(1):
            break
    if best is None:
        kind = links.schema["product_id"].dataType.simpleString()
        schema = f"product_id {kind}, other_id {kind}, common bigint, similarity double"
        best = links.sparkSession.createDataFrame([], schema)
    order = Window.partitionBy("product_id").orderBy(F.col("similarity").desc(), "other_id")
    ranked = best.withColumn("rank", F.row_number().over(order))
    return ranked.select("product_id", "rank", "other_id", "common", "similarity")


def mirrored(similar: DataFrame, links: DataFrame, *, both: bool = False) -> DataFrame:
    """Both directions and the diagonal. A product without buyers has no
    diagonal entry, as its vector is zero. ``both``: ``similar`` has both directions
    already, each counted where all pairs of its first product are, so no pair moves;
    the diagonal is dealt out in the same way."""
    diagonal = pairs.support(links, "product_id").select(
        F.col("product_id").alias("product_a"),
        F.col("product_id").alias("product_b"),
        F.col("support").alias("common"),
        F.lit(1.0).alias("similarity"),
    )
    if both:
        tasks = pairs.counting_tasks(links, "customer_id", both=True)
        return similar.unionByName(diagonal.repartition(tasks, "product_a"))
    turned = similar.select(
        F.col("product_b").alias("product_a"),
        F.col("product_a").alias("product_b"),
        "common",
        "similarity",
    )
    return similar.unionByName(turned).unionByName(diagonal)


def wide(frame: DataFrame, rows: str, columns: str, value: Column, limit: int = 10_000) -> DataFrame:
    """Matrix form of a long table, refused beyond ``limit`` columns. The long
    form is the contract; this one is for small catalogues."""
    names = [r[0] for r in frame.select(columns).distinct().limit(limit + 1).collect()]
    if len(names) > limit:
        raise AnalyticsError(f"more than {limit} values of {columns}: keep the long form")
    return frame.groupBy(rows).pivot(columns, sorted(names)).agg(value).na.fill(0).orderBy(rows)


def wide_blocks(frame: DataFrame, row: str, column: str, value: str, width: int = 50) -> DataFrame:
    """Matrix form of a long table with whole-number columns, for a catalogue of any
    size: (block, ``row``, c0 … c<width-1>).

    Block b holds the columns from b * ``width`` on, so c3 of block 2 is column
    2 * ``width`` + 3. Names are declared, none are collected, and a group is one row
    within one block, at most ``width`` values. Absent cells are 0; a row without any
    value in a block is left out of it, as all its cells there are 0. A null row or
    column has no place and is left out."""
    placed = frame.where(F.col(row).isNotNull() & F.col(column).isNotNull()).select(
        F.floor(F.col(column) / width).alias("block"), row, F.pmod(column, F.lit(width)).alias("place"), value
    )
    cells = [F.coalesce(F.max(F.when(F.col("place") == i, F.col(value))), F.lit(0.0)).alias(f"c{i}") for i in range(width)]
    return placed.groupBy("block", row).agg(*cells)


def target_id(products: DataFrame, name: str) -> int:
    """Id of the one product with this exact name."""
    found = products.where(F.col("product_name") == name).select("product_id").limit(2).collect()
    if len(found) != 1:
        count = "several" if found else "none"
        raise AnalyticsError(f"expected one product called {name!r}, found {count}")
    return found[0][0]


def similarity_to(links: DataFrame, products: DataFrame, target: int) -> DataFrame:
    """Similarity of every other product to the target.

    Only the target's buyers matter, so their baskets are marked and one pass
    counts support and common buyers per product; no pairs are formed."""
    buyers = links.where(F.col("product_id") == target).select(
        "customer_id", F.lit(True).alias("is_buyer")
    )
    counted = (
        links.join(buyers, "customer_id", "left")
        .groupBy("product_id")
        .agg(
            F.count(F.lit(1)).alias("product_customers"),
            F.count("is_buyer").alias("common_customers"),
        )
    )
    size = buyers.agg(
        F.when(F.count(F.lit(1)) == 0, F.raise_error(F.lit("the target product has no buyers")))
        .otherwise(F.count(F.lit(1)))
        .alias("n")
    )
    others = products.where(F.col("product_id") != target)
    filled = lookup(others, counted, "product_id", {"product_customers": 0, "common_customers": 0})
    with_target = filled.withColumn("target_customers", size.scalar())
    return with_target.withColumn(
        "similarity",
        cosine(F.col("common_customers"), F.col("target_customers"), F.col("product_customers")),
    )


def by_similarity() -> list[Column]:
    return [F.col("similarity").desc(), F.col("product_id").asc()]


def similar_products(links: DataFrame, products: DataFrame, target: int, n: int = 5) -> DataFrame:
    """The ``n`` most similar products; the smaller id wins a tie."""
    best = top(similarity_to(links, products, target), by_similarity(), n)
    return numbered(best, by_similarity())


def class_position(
    links: DataFrame, products: DataFrame, target: int, is_member: Column
) -> DataFrame:
    """Where the first product of a class stands in the similarity order."""
    return position_of_best(
        similarity_to(links, products, target), is_member, "similarity", "product_id"
    )
