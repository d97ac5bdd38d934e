"""Cleaned layer: one projection per table, columns the source lacks become NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from balcao.functions.text import blank_to_null
from balcao.sources.schemas import REVENUE, SILVER


def _typed(column: Column, kind: str) -> Column:
    return blank_to_null(column) if kind == "text" else column.cast(kind)


def clean(raw: DataFrame, table: str) -> DataFrame:
    """Cast every column of the layer; text columns also turn '' into NULL."""
    present = set(raw.columns)
    return raw.select(
        *[
            _typed(F.col(name) if name in present else F.lit(None), kind).alias(name)
            for name, kind in SILVER[table].items()
        ]
    )


def customers(raw: DataFrame) -> DataFrame:
    return clean(raw, "customers")


def orders(raw: DataFrame) -> DataFrame:
    return clean(raw, "orders")


def products(raw: DataFrame) -> DataFrame:
    return clean(raw, "products")


def order_details(raw: DataFrame) -> DataFrame:
    """Adds the net revenue of the item in exact decimal arithmetic."""
    net = F.round(F.col("unit_price") * F.col("quantity") * (1 - F.col("discount")), 2)
    return clean(raw, "order_details").withColumn("receita_item", net.cast(REVENUE))


def categories(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("category_id").cast("int").alias("category_id"),
        F.col("category_name").cast("string").alias("categoria_nome"),
    )


def suppliers(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("supplier_id").cast("bigint").alias("supplier_id"),
        F.col("company_name").cast("string").alias("fornecedor_nome"),
    )
