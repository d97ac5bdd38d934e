"""Products to offer a customer, by how regularly they were bought in nine months.

Selection month s looks at purchases in s-9..s-1. Purchases are folded to one row
per customer and product with the list of months, which the calendar bounds, and
only unfolded into selection months after the product's categories and offers
have been attached.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from balcao.functions import months as M
from balcao.functions.text import locale_order, with_place
from balcao.operators.snapshots import Range

WINDOW = 9
# Place of a product's name in Portuguese order, beside the rows where they are ranked.
PLACE = "lugar_nome"


def product_calendar(products: DataFrame, discounts: DataFrame, placed: bool = False) -> DataFrame:
    """One row per product: name, category and the offer of each month; `placed` adds `PLACE`."""
    calendar = discounts.groupBy("produto_id").agg(
        F.max("categoria_id").alias("categoria_id"),
        F.map_from_entries(F.collect_list(F.struct(M.index_of_key(F.col("ano_mes")), "maior_desconto"))).alias("ofertas"),
    )
    names = products.select(F.col("product_id").alias("produto_id"), F.col("product_name").alias("produto_nome"))
    if placed:
        names = with_place(names, "produto_nome", "produto_id", PLACE)
    return names.join(calendar, "produto_id", "left")


def recurrence(
    purchases: DataFrame, calendar: DataFrame, span: Range, clients: DataFrame | None = None
) -> DataFrame:
    """Months with a purchase, points and offer per customer, selection month and product.

    `purchases` has cliente_id, produto_id and ano_mes; repetitions do not count. `clients` has the customers that
    count, all without it. Rows meet them last and are unfolded behind that shuffle, so that what is counted by
    customer and month afterwards finds its rows in place; only offers of selection months travel with them.
    """
    bought = purchases.groupBy("cliente_id", "produto_id").agg(
        F.collect_set(M.index_of_key(F.col("ano_mes"))).alias("meses")
    )
    reach = F.array_distinct(
        F.flatten(F.transform("meses", lambda m: F.sequence(m + 1, m + WINDOW)))
    )
    place = [c for c in [PLACE] if c in calendar.columns]
    folded = (
        bought.join(calendar, "produto_id")
        .withColumns({"_de": span.first, "_ate": span.last})
        .withColumn("selecoes", F.filter(reach, lambda i: i.between(F.col("_de"), F.col("_ate"))))
        .withColumn("ofertas", F.transform("selecoes", lambda i: F.try_element_at("ofertas", i)))
        .drop("_de", "_ate")
        .repartition("cliente_id")
    )
    if clients is not None:
        folded = folded.join(clients.select("cliente_id").hint("shuffle_hash"), "cliente_id", "left_semi")
    selections = folded.select("*", F.posexplode("selecoes").alias("_n", "idx"))
    count = F.size(F.filter("meses", lambda m: m.between(F.col("idx") - WINDOW, F.col("idx") - 1)))
    return selections.select(
        "cliente_id",
        M.key_of_index(F.col("idx")).alias("ano_mes"),
        "produto_id",
        "produto_nome",
        "categoria_id",
        count.cast("bigint").alias("meses_com_compra"),
        F.floor(count * 100 / WINDOW).cast("int").alias("frequencia"),
        F.get("ofertas", F.col("_n")).alias("oferta"),
        *place,
    )


def with_score(rows: DataFrame) -> DataFrame:
    """Own points plus those of the customer's other products of the same category."""
    category = Window.partitionBy("cliente_id", "ano_mes", "categoria_id")
    points = F.col("frequencia").cast("bigint")
    return rows.withColumn(
        "score",
        F.when(F.col("categoria_id").isNull(), points).otherwise(F.sum(points).over(category)),
    )


def ranked(scored: DataFrame) -> DataFrame:
    """Highest score first, then the larger offer, no offer last, then by name."""
    order = Window.partitionBy("cliente_id", "ano_mes").orderBy(
        F.desc("score"), F.col("oferta").desc_nulls_last(),
        *([PLACE] if PLACE in scored.columns else [locale_order(F.col("produto_nome")), "produto_id"]),
    )
    return scored.withColumn("posicao", F.row_number().over(order)).drop(PLACE)
