"""Suggestions for carts, all carts in one job.

`carts` holds (cart_id, product_id), one row per product.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from balcao.functions.numbers import ratio, rounded
from balcao.functions.text import locale_order
from balcao.operators.baskets import PLACE, name_order, ranked_partners
from balcao.session import ensure_checkpoint_dir, stored

TOP = 5
# A cart of c products hides at most c - 1 partners of one of them, so the first
# TOP + c - 1 partners are enough: PREFIX of them serve carts of PREFIX - TOP + 1.
PREFIX = 32
# Carts up to this size travel as an array beside each of their products.
LISTED = 1024
# Catalogue products of a gap that are held as one list.
GAP = 4096
# Float noise of a product over the origins must not decide an order.
SCORE_DIGITS = 9

PARTNER = [
    "posicao", "produto_y", "nome_y", "pedidos_com_x", "pedidos_com_x_e_y", "pedidos_com_outros",
    "pct_associacao", "pct_outros",
]


def _partner(stats: DataFrame) -> list[str]:
    return PARTNER + [c for c in [PLACE] if c in stats.columns]


def _sized(carts: DataFrame, small: int) -> DataFrame:
    """The products of each cart, once, with the cart's size. Lines without a cart are one cart, never taken for a large one."""
    size = F.count(F.lit(1)).over(Window.partitionBy("cart_id"))
    own = F.when(F.col("cart_id").isNull(), F.least(size, F.lit(small))).otherwise(size)
    return carts.select("cart_id", "product_id").distinct().withColumn("tamanho", own)


def _listed_carts(carts: DataFrame, partners: DataFrame) -> DataFrame:
    """The cart travels as an array: exclusion and cut happen inside the row, which holds a list for each column."""
    columns = _partner(partners)
    folded = carts.groupBy("cart_id").agg(F.collect_list("product_id").alias("itens"))
    best = partners.groupBy("produto_x").agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("parceiros"))
    enough = F.slice("parceiros", F.lit(1), F.size("itens") + TOP - 1)
    allowed = F.filter(enough, lambda p: ~F.array_contains("itens", p["produto_y"]))
    return (
        folded.select("cart_id", "itens", F.explode("itens").alias("produto_x"))
        .join(best, "produto_x")
        .select("cart_id", "produto_x", F.slice(allowed, 1, TOP).alias("p"))
        .select("cart_id", "produto_x", *[F.col("p")[c].alias(c) for c in columns[1:]])
    )


def _asked(partners: DataFrame, carts: DataFrame) -> DataFrame:
    """The partners that some cart reads, and `ate`, how many of its product that is: its largest cart tells."""
    reach = carts.groupBy(F.col("product_id").alias("produto_x")).agg((F.max("tamanho") + TOP - 1).alias("ate"))
    return partners.drop("ate").join(reach, "produto_x").filter(F.col("posicao") <= F.col("ate"))


def _huge_carts(carts: DataFrame, partners: DataFrame) -> DataFrame:
    """Partners are fetched by position, so a popular product brings only those it needs.

    A cart asks for no position its product does not have: whatever its size, it
    reads the partners at most once.
    """
    columns = _partner(partners)
    available = partners.groupBy("produto_x").agg(F.max("posicao").alias("parceiros"))
    asked = (
        carts.withColumnRenamed("product_id", "produto_x")
        .join(available, "produto_x")
        .withColumn("ate", F.least(F.col("tamanho") + TOP - 1, F.col("parceiros")).cast("int"))
        .select("cart_id", "produto_x", F.explode(F.sequence(F.lit(1), F.col("ate"))).alias("posicao"))
    )
    inside = carts.select("cart_id", F.col("product_id").alias("produto_y"))
    order = Window.partitionBy("cart_id", "produto_x").orderBy("posicao")
    return (
        asked.join(partners, ["produto_x", "posicao"])
        .join(inside, ["cart_id", "produto_y"], "left_anti")
        .withColumn("ordem", F.row_number().over(order))
        .filter(F.col("ordem") <= TOP)
        .groupBy("cart_id", "produto_x")
        .agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("p"))
        .select("cart_id", "produto_x", *[F.col("p")[c].alias(c) for c in columns[1:]])
    )


def chosen_partners(carts: DataFrame, stats: DataFrame, prefix: int = PREFIX, listed: int = LISTED) -> DataFrame:
    """The five best partners of each product of each cart, none of them in the cart: a row per product, a list per column.

    The partners that some cart can read are few beside the statistics. They are stored, and what counted and ranked the
    pairs leaves the disks before the carts meet them. Up to `listed` products a cart is one row, and those too large for
    a prefix read lists of their own; larger ones ask for single positions.
    """
    small = prefix - TOP + 1
    huge = max(listed, small)
    carts = _sized(carts, small)
    partners = stored(_asked(ranked_partners(stats), carts))
    size, short = F.col("tamanho"), F.col("posicao") <= prefix
    chosen = _listed_carts(carts.filter(size <= small), partners.filter(short))
    # Larger carts with partners show in how far some cart reads.
    furthest = partners.agg(F.max("ate")).first()[0] or 0
    if furthest >= small + TOP:
        large = carts.filter((size > small) & (size <= huge))
        chosen = chosen.unionByName(_listed_carts(large, _asked(partners, large)))
    if furthest >= huge + TOP:
        chosen = chosen.unionByName(_huge_carts(carts.filter(size > huge), partners))
    return chosen


def _unfolded(chosen: DataFrame) -> DataFrame:
    """One row per partner. The lists travel to their cart before that, and what follows finds a cart's rows in place."""
    by_cart = chosen.repartition("cart_id").select("*", F.posexplode("produto_y").alias("_i", "_y"))
    lists = [c for c in PARTNER[1:] + [PLACE] if c in chosen.columns]
    cells = {c: F.col("_y") if c == "produto_y" else F.get(F.col(c), F.col("_i")) for c in lists}
    others = [c for c in chosen.columns if c not in cells]
    return by_cart.select(*others, *[cell.alias(c) for c, cell in cells.items()], (F.col("_i") + 1).alias("ordem"))


def top_partners(carts: DataFrame, stats: DataFrame, prefix: int = PREFIX, listed: int = LISTED) -> DataFrame:
    """The five best partners of each product of each cart, none of them in the cart, one row each, which lie by cart."""
    return _unfolded(chosen_partners(carts, stats, prefix, listed))


def combined_suggestions(top: DataFrame) -> DataFrame:
    """One row per cart and suggested product, merging the products that suggest it."""
    miss = 1 - F.col("pct_associacao") / 100
    combined = F.greatest(F.lit(0.0), F.least(F.lit(100.0), (1 - F.product(miss)) * 100))
    weight = F.sum("pedidos_com_x_e_y")
    others = F.coalesce(ratio(F.sum(F.col("pct_outros") * F.col("pedidos_com_x_e_y")), weight), F.lit(0.0))
    # The name belongs to the product; as a key it keeps the aggregate on hashing.
    merged = top.groupBy("cart_id", "produto_y", "nome_y").agg(
        combined.alias("associacao_combinada"),
        others.alias("media_outros_produtos"),
        weight.alias("total_pedidos_conjuntos"),
        F.count(F.lit(1)).alias("origens"),
        *[F.min(c).alias(c) for c in [PLACE] if c in top.columns],
    )
    index = F.col("associacao_combinada") * (1 - 0.25 * (F.col("media_outros_produtos") / 100))
    return merged.withColumn("indice_oportunidade", index)


def ranked_suggestions(suggestions: DataFrame) -> DataFrame:
    """Order within the cart; a cart has at most five rows per product it holds."""
    order = Window.partitionBy("cart_id").orderBy(
        rounded(F.col("indice_oportunidade"), SCORE_DIGITS).desc(),
        F.desc("total_pedidos_conjuntos"),
        *name_order(suggestions),
    )
    return suggestions.withColumn("posicao", F.row_number().over(order)).drop(PLACE)


def suggestion_origins(top: DataFrame, products: DataFrame, folded: bool = False) -> DataFrame:
    """The products behind a suggestion, one row each, best association first.

    `top` has a row per partner, or is `folded` as `chosen_partners` gives it; names then join a row per product.
    """
    names = products.select(
        F.col("product_id").alias("produto_x"), F.col("product_name").alias("nome_x")
    )
    named = top.join(names, "produto_x")
    best_first = Window.partitionBy("cart_id", "produto_y").orderBy(F.desc("pct_associacao"), "produto_x")
    return (_unfolded(named) if folded else named).select(
        "cart_id", "produto_y", F.row_number().over(best_first).alias("ordem_origem"), "produto_x", "nome_x",
        "pedidos_com_x", "pedidos_com_x_e_y", "pct_associacao", "pedidos_com_outros", "pct_outros",
    )


# ── consumption, offers and what is shown beside a suggestion ──


def client_consumption(history: DataFrame) -> DataFrame:
    """Units per customer and product over all months."""
    return history.groupBy("cliente_id", "produto_id").agg(
        F.sum("quantidade_consumida").alias("quantidade_total")
    )


def _numbered(catalogue: DataFrame) -> DataFrame:
    """(produto_id, produto_nome, lugar): places 0, 1, ... in Portuguese order, without a task that holds all products."""
    ensure_checkpoint_dir(catalogue.sparkSession, local_fallback=True)
    # Stored, so that both readers below see the same partitions.
    ordered = (
        catalogue.select("produto_id", "produto_nome")
        .orderBy(locale_order(F.col("produto_nome")), "produto_id")
        .withColumn("_n", F.monotonically_increasing_id())
        .withColumn("_parte", F.shiftright("_n", 33))
        .checkpoint(eager=True)
    )

    before = Window.orderBy("_parte").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ordered.groupBy("_parte").agg(F.count(F.lit(1)).alias("_linhas"))
    starts = sizes.select("_parte", F.coalesce(F.sum("_linhas").over(before), F.lit(0)).alias("_inicio"))
    place = F.col("_inicio") + F.col("_n") - F.shiftleft("_parte", 33)
    return ordered.join(F.broadcast(starts), "_parte").select("produto_id", "produto_nome", place.alias("lugar"))


def ranked_catalogue(catalogue: DataFrame, consumption: DataFrame, clients: DataFrame) -> DataFrame:
    """The whole catalogue for each requested customer: bought products first, most units first, then by name.

    `clients` has cliente_id, and each of them gets one row per catalogue product, by definition. `consumption` has one
    row per customer and product. Only products with units are numbered by customer; the others lie in the gaps between
    those in the one order of the catalogue, and a gap's places follow from its ends.
    """
    # Its files are small for what they hold; as a broadcast the catalogue would pass through the driver.
    shelf = _numbered(catalogue).hint("merge")
    wanted = clients.select("cliente_id").filter("cliente_id IS NOT NULL").distinct()
    units = consumption.withColumn("quantidade_total", F.coalesce("quantidade_total", F.lit(0)))
    bought = (
        units.filter("quantidade_total != 0")
        .join(wanted, "cliente_id", "left_semi")
        .join(shelf, "produto_id")
        .select("cliente_id", "produto_id", "produto_nome", "quantidade_total", "lugar")
    )
    size = shelf.agg(F.count(F.lit(1)).alias("tamanho"))
    own = Window.partitionBy("cliente_id")
    first = Window.partitionBy("cliente_id").orderBy(F.desc("quantidade_total"), "lugar")
    # Less than no units comes behind those with none.
    number = F.row_number().over(first) + F.when(
        F.col("quantidade_total") < 0, F.col("tamanho") - F.count(F.lit(1)).over(own)
    ).otherwise(0)
    columns = ["cliente_id", "produto_id", "produto_nome", "quantidade_total"]
    numbered = bought.crossJoin(size).select(*columns, number.cast("int").alias("posicao"))

    # A customer's own gap begins the catalogue; each product with units begins another.
    edges = bought.select("cliente_id", "lugar", "quantidade_total").unionByName(
        wanted.select("cliente_id", F.lit(-1).cast("long").alias("lugar"), F.lit(None).alias("quantidade_total"))
    )
    along = Window.partitionBy("cliente_id").orderBy("lugar")
    gaps = edges.crossJoin(size).select(
        "cliente_id",
        (F.col("lugar") + 1).alias("de"),
        (F.lead("lugar").over(along)).alias("_proximo"),
        "tamanho",
        # Places in the gap: those with more units come first, and products with units before it leave a place free.
        (F.count_if(F.col("quantidade_total") > 0).over(own) - F.row_number().over(along) + 2).alias("desloca"),
    )
    gaps = gaps.withColumn("ate", F.coalesce("_proximo", "tamanho") - 1).filter("de <= ate")
    pieces = gaps.withColumn("de", F.explode(F.sequence("de", "ate", F.lit(GAP).cast("long")))).select(
        "cliente_id",
        "desloca",
        F.explode(F.sequence("de", F.least(F.col("ate"), F.col("de") + GAP - 1))).alias("lugar"),
    )
    kind = numbered.schema["quantidade_total"].dataType
    rest = pieces.join(shelf, "lugar").select(
        "cliente_id",
        "produto_id",
        "produto_nome",
        F.lit(0).cast(kind).alias("quantidade_total"),
        (F.col("lugar") + F.col("desloca")).cast("int").alias("posicao"),
    )
    return numbered.unionByName(rest)


def alphabetical_catalogue(catalogue: DataFrame) -> DataFrame:
    """Catalogue in Portuguese order, as shown when no customer is chosen."""
    return catalogue.orderBy(locale_order(F.col("produto_nome")), "produto_id")
