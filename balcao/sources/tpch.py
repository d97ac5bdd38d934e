"""The order-item tables of the test data under the names of the cleaned layer.

A line is priced as sold (extended price over quantity), so no product join is
needed to value it. A product repeated in an order is one item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from balcao.functions.numbers import cents, rounded

def brand_number() -> Column:
    """'Brand#17' -> 17"""
    return F.substring_index(F.col("p_brand"), "#", -1).cast("int")


class Raw:
    """Lazy access to the raw tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def orders(self, with_shipping: bool = False) -> DataFrame:
        """Shipping needs the item table, so it is read only when asked for."""
        orders = self.table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("order_date"),
            F.col("o_totalprice").alias("freight"),
        )
        if not with_shipping:
            return orders
        shipped = (
            self.table("lineitem")
            .groupBy(F.col("l_orderkey").alias("order_id"))
            .agg(F.max("l_shipdate").alias("shipped_date"))
        )
        return orders.join(shipped, "order_id", "left")

    def order_details(self) -> DataFrame:
        """Summed as whole cents; decimals are made once per item, after the grouping.

        Lines are brought together by order, which also serves the joins with the orders.
        """
        units = F.sum("l_quantity")
        return (
            self.table("lineitem")
            .repartition("l_orderkey")
            .groupBy(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"))
            .agg(
                rounded(F.sum(cents(F.col("l_extendedprice"))) / 100 / units, 2).alias("unit_price"),
                units.alias("quantity"),
                F.max("l_discount").alias("discount"),
            )
        )

    def customers(self) -> DataFrame:
        nation = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
        )
        return (
            self.table("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select(
                F.col("c_custkey").alias("customer_id"),
                F.col("c_name").alias("company_name"),
                F.col("c_mktsegment").alias("contact_name"),
                F.col("n_name").alias("country"),
                F.col("r_name").alias("region"),
            )
        )

    def plain_customers(self) -> DataFrame:
        """Without country and region, which only the register needs."""
        return self.table("customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("company_name"),
            F.col("c_mktsegment").alias("contact_name"),
        )

    def products(self) -> DataFrame:
        supplier = (
            self.table("lineitem")
            .groupBy(F.col("l_partkey").alias("product_id"))
            .agg(F.min("l_suppkey").alias("supplier_id"))
        )
        return self.plain_products().join(supplier, "product_id", "left")

    def plain_products(self) -> DataFrame:
        """Without the supplier, which only the catalogue needs. A brand is a category."""
        return self.table("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            brand_number().alias("category_id"),
            F.col("p_type").alias("quantity_per_unit"),
            F.col("p_retailprice").alias("unit_price"),
            F.col("p_size").alias("units_in_stock"),
        )

    def categories(self) -> DataFrame:
        return (
            self.table("part")
            .select(brand_number().alias("category_id"), F.col("p_brand").alias("category_name"))
            .distinct()
        )

    def suppliers(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_suppkey").alias("supplier_id"), F.col("s_name").alias("company_name")
        )
