"""Products bought together: directed pairs per order and statistics per pair.

A pair table has one row per ordered pair by definition, so its size is fixed by
the result. What is kept small is the work of one group: ordinary orders are
folded into an array of at most BLOCK products and unfolded in place, larger
ones are cut into tiles of about BLOCK x BLOCK pairs that shuffle on their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from balcao.functions.months import month_key
from balcao.functions.numbers import ratio
from balcao.functions.text import locale_order, with_place

BLOCK = 256
# Place of a companion's name in Portuguese order, beside the statistics where they are ranked.
PLACE = "lugar_y"


def basket_items(details: DataFrame, products: DataFrame) -> DataFrame:
    """Items of known products, with the product name."""
    names = products.select("product_id", F.col("product_name").alias("nome"))
    return details.select("order_id", "product_id", F.col("quantity").alias("quantidade")).join(
        names, "product_id"
    )


def _oversized(items: DataFrame, block: int) -> DataFrame:
    """Orders with more than `block` products.

    The rebalance is a stage of its own: when it turns out empty, AQE drops the
    joins with it and the whole branch for large orders.
    """
    sizes = items.groupBy("order_id").agg(F.count(F.lit(1)).alias("total"))
    return sizes.filter(F.col("total") > block).hint("rebalance")


def _folded(items: DataFrame, oversized: DataFrame, header: DataFrame, member: Column) -> DataFrame:
    """One row per ordinary order; the order's columns join here, before any pair exists."""
    return (
        items.join(oversized, "order_id", "left_anti")
        .groupBy("order_id")
        .agg(F.collect_list(member).alias("itens"))
        .join(header, "order_id")
        .withColumn("total", F.size("itens").cast("bigint"))
    )


def _tiles(items: DataFrame, oversized: DataFrame, header: DataFrame, block: int, member: Column) -> DataFrame:
    """All (x, y) of the large orders: both sides are hashed into parts, a tile is a pair of parts."""
    parts = oversized.withColumn("partes", F.ceil(F.col("total") / block).cast("int"))
    part = F.pmod(F.xxhash64("product_id"), F.col("partes")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("partes") - 1))
    hot = items.join(parts.join(header, "order_id"), "order_id").select(
        *header.columns, "total", "partes", part.alias("p"), member.alias("m")
    )
    left = hot.select(*header.columns, "total", F.col("m").alias("x"), F.col("p").alias("px"), every.alias("py"))
    right = hot.select("order_id", F.col("m").alias("y"), every.alias("px"), F.col("p").alias("py"))
    return left.join(right, ["order_id", "px", "py"]).select(*header.columns, "total", "x", "y")


def directed_pairs(items: DataFrame, header: DataFrame, columns: list[str], block: int = BLOCK) -> DataFrame:
    """Every ordered pair (x, y) of different products of an order, beside the order's columns.

    `x` and `y` are structs of `columns`, the first one being the product. An
    order with a single product yields one row whose `y` is NULL.
    """
    member = F.struct(*columns)
    oversized = _oversized(items, block)
    folded = _folded(items, oversized, header, member)
    alone = F.array(F.lit(None).cast(folded.schema["itens"].dataType.elementType))
    others = F.when(F.col("total") == 1, alone).otherwise(F.col("itens"))
    ordinary = folded.select(*header.columns, "total", "itens", F.explode("itens").alias("x")).select(
        *header.columns, "total", "x", F.explode(others).alias("y")
    )
    different = F.col(f"y.{columns[0]}").isNull() | (F.col(f"x.{columns[0]}") != F.col(f"y.{columns[0]}"))
    return ordinary.unionByName(_tiles(items, oversized, header, block, member)).filter(different)


def undirected_pairs(items: DataFrame, header: DataFrame, block: int = BLOCK, by: tuple[str, ...] = ()) -> DataFrame:
    """(total, x, y) with x < y: half of the directed pairs, enough for counting; with the order's columns `by`."""
    oversized = _oversized(items, block)
    product = F.col("product_id")
    ordinary = (
        _folded(items, oversized, header, product)
        .select(*by, "total", F.sort_array("itens").alias("itens"))
        .select(*by, "total", "itens", F.posexplode("itens").alias("i", "x"))
        .select(*by, "total", "x", F.explode(F.slice("itens", F.col("i") + 2, F.col("total").cast("int"))).alias("y"))
    )
    tiled = _tiles(items, oversized, header, block, product).filter(F.col("x") < F.col("y"))
    return ordinary.unionByName(tiled.select(*by, "total", "x", "y"))


def items_with_company(orders: DataFrame, details: DataFrame, products: DataFrame) -> DataFrame:
    """One row per order and product: month, and how many other products beside a companion the order has."""
    items = basket_items(details, products).select("order_id", F.col("product_id").alias("produto_x"))
    sizes = items.groupBy("order_id").agg(F.count(F.lit(1)).alias("total"))
    header = orders.select("order_id", month_key(F.col("order_date")).alias("ano_mes"))
    others = F.greatest(F.col("total") - 2, F.lit(0))
    return items.join(sizes, "order_id").join(header, "order_id").select("ano_mes", "produto_x", others.alias("outros"))


def orders_per_product(items: DataFrame, header: DataFrame, block: int = BLOCK, by: tuple[str, ...] = ()) -> DataFrame:
    """Orders each product is in, unfolded from the same arrays the pairs come from."""
    oversized = _oversized(items, block)
    ordinary = _folded(items, oversized, header, F.col("product_id")).select(*by, F.explode("itens").alias("produto_x"))
    large = items.join(oversized.join(header, "order_id"), "order_id").select(*by, F.col("product_id").alias("produto_x"))
    return ordinary.unionAll(large).groupBy(*by, "produto_x").agg(F.count(F.lit(1)).alias("pedidos_com_x"))


def couple_counts(items: DataFrame, header: DataFrame, block: int = BLOCK, by: tuple[str, ...] = ()) -> DataFrame:
    """Orders with both products of each couple x < y, and those among them with others too."""
    return (
        undirected_pairs(items, header, block, by)
        .groupBy(*by, "x", "y")
        .agg(
            F.count(F.lit(1)).alias("pedidos_com_x_e_y"),
            F.sum((F.col("total") > 2).cast("int")).alias("pedidos_com_outros"),
        )
    )


def produtos_associados(
    orders: DataFrame, details: DataFrame, products: DataFrame, block: int = BLOCK
) -> DataFrame:
    """One row per order, product bought and companion; single-product orders keep a NULL companion."""
    header = orders.select(
        "order_id", "customer_id", "order_date", month_key(F.col("order_date")).alias("ano_mes")
    )
    pairs = directed_pairs(
        basket_items(details, products), header, ["product_id", "nome", "quantidade"], block
    )
    others = F.when(F.col("total") == 1, F.lit(0)).otherwise(F.col("total") - 2).cast("bigint")
    return pairs.select(
        "ano_mes",
        F.col("order_date").alias("data_compra"),
        F.col("order_id").alias("id_compra"),
        F.col("customer_id").alias("id_cliente"),
        F.col("x.product_id").alias("produto_comprado_id"),
        F.col("x.nome").alias("produto_comprado_nome"),
        F.col("x.quantidade").alias("quantidade_comprada"),
        F.col("y.product_id").alias("produto_acompanhante_id"),
        F.col("y.nome").alias("produto_acompanhante_nome"),
        F.col("y.quantidade").alias("quantidade_acompanhante"),
        F.col("total").alias("total_produtos_distintos"),
        others.alias("quantidade_outros_produtos_distintos"),
    )


def association_stats(
    orders: DataFrame, details: DataFrame, products: DataFrame, block: int = BLOCK, placed: bool = False
) -> DataFrame:
    """For every X -> Y: orders with X, with both, with both and others, and the two shares.

    Pairs are counted once per couple with a map-side combine and mirrored afterwards.
    The join on X comes last: the ranking per X then finds its rows in place.
    `placed` adds `PLACE`, by which a ranking need not compare names.
    """
    items, header = basket_items(details, products), orders.select("order_id")
    return shares(couple_counts(items, header, block), orders_per_product(items, header, block), products, placed)


def shares(couples: DataFrame, orders_with: DataFrame, products: DataFrame, placed: bool = False) -> DataFrame:
    """The statistics of each X -> Y from the counts of couples and products."""
    both_ways = F.array(
        F.struct(F.col("x").alias("produto_x"), F.col("y").alias("produto_y")),
        F.struct(F.col("y").alias("produto_x"), F.col("x").alias("produto_y")),
    )
    mirrored = couples.select(F.inline(both_ways), "pedidos_com_x_e_y", "pedidos_com_outros")
    names = products.select(
        F.col("product_id").alias("produto_y"), F.col("product_name").alias("nome_y")
    )
    if placed:
        names = with_place(names, "nome_y", "produto_y", PLACE)
    together, n = F.col("pedidos_com_x_e_y"), F.col("pedidos_com_x")
    return (
        mirrored.join(names, "produto_y")
        .join(orders_with, "produto_x")
        .select(
            "produto_x", "produto_y", "nome_y", "pedidos_com_x", "pedidos_com_x_e_y",
            "pedidos_com_outros",
            (ratio(together, n) * 100).alias("pct_associacao"),
            (ratio(F.col("pedidos_com_outros"), together) * 100).alias("pct_outros"),
            *([PLACE] if placed else []),
        )
    )


def name_order(rows: DataFrame) -> list[Column]:
    """Companions by name, and by number where names are equal."""
    return [F.asc(PLACE)] if PLACE in rows.columns else [locale_order(F.col("nome_y")), F.asc("produto_y")]


def ranked_partners(stats: DataFrame) -> DataFrame:
    """Position of every partner of a product; it does not depend on any cart."""
    order = Window.partitionBy("produto_x").orderBy(
        F.desc("pct_associacao"), F.asc("pct_outros"), F.desc("pedidos_com_x_e_y"), *name_order(stats)
    )
    return stats.withColumn("posicao", F.row_number().over(order))


# What the share of orders with only the two products tells.
NEVER_ALONE = "nunca_sozinhos"
STRONG = "forte"
PARTIAL = "parcial"
WEAK = "fraca"


def association_evidence(stats: DataFrame) -> DataFrame:
    """How often the pair was the whole order, and the band that share falls into."""
    only = F.col("pedidos_com_x_e_y") - F.col("pedidos_com_outros")
    share = ratio(only, F.col("pedidos_com_x_e_y")) * 100
    band = (
        F.when(only == 0, NEVER_ALONE).when(share >= 70, STRONG).when(share >= 40, PARTIAL).otherwise(WEAK)
    )
    return stats.select(
        "produto_x", "produto_y", "pedidos_com_x_e_y", "pedidos_com_outros",
        only.alias("pedidos_somente"), share.alias("pct_somente"), band.alias("evidencia"),
    )
