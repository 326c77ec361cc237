"""The test tables in the roles the analyses expect."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketgrain.functions.money import money
from marketgrain.plans.forecast import Horizon
from marketgrain.session import tune
from marketgrain.sources.tables import role

POS = "1-URGENT"
MIN_CATEGORIES = 20
TARGET_PRODUCT = 1
TARGET_NAME = "red widget"
TARGET_CLASS = "%ring"
AS_OF = date(2001, 6, 30)
SIMILAR_FROM = 0.1
SCOPES = {"all": None, "open_or_partial": ["O", "P"], "open": ["O"]}
HORIZON = Horizon(date(2001, 4, 1), date(2001, 5, 1), date(2001, 7, 1))


class Tables:
    """Lazy access to one folder of test tables."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = tune(spark), folder

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def orders(self) -> DataFrame:
        return role(
            self.raw("orders"),
            order_id="o_orderkey",
            customer_id="o_custkey",
            status="o_orderstatus",
            channel="o_orderpriority",
            total="o_totalprice",
            placed_at="o_orderdate",
        )

    def full_orders(self) -> DataFrame:
        """Orders with the sums and ship dates of their lines as subtotal,
        discount and later timestamps."""
        price = money("l_extendedprice")
        lines = (
            self.raw("lineitem")
            .groupBy(F.col("l_orderkey").alias("order_id"))
            .agg(
                money(F.sum(price)).alias("subtotal"),
                money(F.sum(price * F.col("l_discount").cast("decimal(4,2)"))).alias("discount"),
                F.min("l_shipdate").alias("created_at"),
                F.max("l_shipdate").alias("updated_at"),
            )
        )
        return self.orders().join(lines, "order_id", "left")

    def items(self) -> DataFrame:
        return role(
            self.raw("lineitem"),
            order_id="l_orderkey",
            product_id="l_partkey",
            quantity="l_quantity",
        )

    def products(self) -> DataFrame:
        return role(
            self.raw("part"),
            product_id="p_partkey",
            product_name="p_name",
            category_id="p_brand",
            family="p_type",
        )

    def customers(self) -> DataFrame:
        return role(self.raw("customer"), customer_id="c_custkey", nation_id="c_nationkey")

    def nations(self) -> DataFrame:
        return role(self.raw("nation"), nation_id="n_nationkey", nation="n_name")

    def labelled_documents(self) -> DataFrame:
        """Documents with their labels, which only some of them have."""
        documents = self.raw("documents").select("doc_id", "lang", "source", "n_chars")
        return documents.join(self.raw("labels"), "doc_id", "left")
