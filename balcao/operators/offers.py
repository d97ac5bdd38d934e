"""Highest discount of the month as an offer, and what is shown beside a suggestion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from balcao.functions.months import month_label
from balcao.functions.numbers import ptbr_percent

# Fixed values.
NO_OFFER = "Sem oferta"
NO_DISCOUNT = "Sem desconto"


def offer_text(discount: Column) -> Column:
    """No row of the month and a discount of zero are different states."""
    return F.when(discount.isNull(), NO_OFFER).when(discount == 0, NO_DISCOUNT).otherwise(ptbr_percent(discount))


def month_list(table: DataFrame) -> DataFrame:
    """Months of a table in order with their label; the last one is preselected."""
    months = table.select("ano_mes").distinct()
    last = table.agg(F.max("ano_mes")).scalar()
    return months.select(
        "ano_mes",
        month_label(F.col("ano_mes")).alias("rotulo"),
        (F.col("ano_mes") == last).cast("int").alias("selecionado"),
    ).orderBy("ano_mes")


def monthly_offers(discounts: DataFrame) -> DataFrame:
    """Offer of every product in every month it was sold in; elsewhere it has none."""
    offer = F.col("maior_desconto")
    return discounts.select("ano_mes", "produto_id", offer.alias("oferta"), offer_text(offer).alias("oferta_texto"))


def in_context(
    rows: DataFrame,
    context: DataFrame,
    catalogue: DataFrame,
    consumption: DataFrame,
    discounts: DataFrame,
) -> DataFrame:
    """Adds category, price, the customer's consumption and the month's offer.

    `rows` has cart_id and produto_id, `context` the customer and month of each
    cart. Nothing here changes a score or an order. Rows go by product once: there they meet what their customers bought
    of it, and the product's offers, which are one row with a list by month; the result lies by product.
    """
    products = catalogue.select("produto_id", "categoria_nome", "preco_unitario")
    added = ["categoria_nome", "preco_unitario", "oferta", "consumo_cliente", "oferta_texto"]
    carried = [c for c in rows.columns if c not in ("cart_id", "produto_id")]
    own = [c for c in context.columns if c not in ("ano_mes", "cliente_id", "cart_id")]
    named = (
        _beside_units(rows.join(context, "cart_id"), consumption.join(context, "cliente_id", "left_semi"))
        .withColumn("consumo_cliente", F.coalesce("quantidade_total", F.lit(0)))
        .join(products, "produto_id", "left")
        .join(offers_of_products(discounts), "produto_id", "left")
    )
    of_month = F.try_element_at("ofertas", F.col("ano_mes"))
    return (
        named.select("*", F.inline_outer(of_month))
        .withColumn("oferta_texto", offer_text(F.col("oferta")))
        .select("ano_mes", "produto_id", "cliente_id", "cart_id", *carried, *own, *added)
    )


def _beside_units(lines: DataFrame, units: DataFrame) -> DataFrame:
    """Each line with `quantidade_total` of its customer and product, as often as there are rows of these, or NULL.

    A join on both would deal the lines by both, and again by product for what follows. Dealt by product together with the
    units, the rows of a customer are found by a sort in place.
    """
    bought = units.filter(F.col("cliente_id").isNotNull() & F.col("produto_id").isNotNull())
    listed = bought.select("cliente_id", "produto_id", F.struct("quantidade_total").alias("_unidades"))
    dealt = lines.unionByName(listed, allowMissingColumns=True).repartition("produto_id")
    same = Window.partitionBy("produto_id", "cliente_id")
    beside = dealt.withColumn("_compras", F.collect_list("_unidades").over(same)).filter(F.col("_unidades").isNull())
    return beside.select(*lines.columns, F.inline_outer("_compras"))


def offers_of_products(discounts: DataFrame) -> DataFrame:
    """(produto_id, ofertas): the offers of each month a product was sold in, as many entries as rows of that month.

    A product has at most a list per month of the calendar.
    """
    listed = F.collect_list(F.struct(F.col("maior_desconto").alias("oferta")))
    by_month = discounts.filter(F.col("ano_mes").isNotNull()).groupBy("produto_id", "ano_mes").agg(listed.alias("do_mes"))
    return by_month.groupBy("produto_id").agg(
        F.map_from_entries(F.collect_list(F.struct("ano_mes", "do_mes"))).alias("ofertas")
    )
