"""The layers of one data folder, wired together lazily."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from balcao.functions.months import month_key
from balcao.operators import actions, baskets, carts, gold, offers, silver, snapshots, status
from balcao.sources.tpch import Raw


class Model:
    """Every table is a plan; nothing runs until a result is asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.raw = Raw(spark, folder)

    # cleaned layer

    @cached_property
    def customers(self) -> DataFrame:
        return silver.customers(self.raw.customers())

    @cached_property
    def named_customers(self) -> DataFrame:
        return silver.customers(self.raw.plain_customers())

    @cached_property
    def orders(self) -> DataFrame:
        return silver.orders(self.raw.orders())

    @cached_property
    def shipped_orders(self) -> DataFrame:
        return silver.orders(self.raw.orders(with_shipping=True))

    @cached_property
    def products(self) -> DataFrame:
        return silver.products(self.raw.plain_products())

    @cached_property
    def supplied_products(self) -> DataFrame:
        return silver.products(self.raw.products())

    @cached_property
    def details(self) -> DataFrame:
        return silver.order_details(self.raw.order_details())

    # analytical layer

    @cached_property
    def clientes(self) -> DataFrame:
        return gold.clientes(self.customers)

    @cached_property
    def produtos(self) -> DataFrame:
        return gold.produtos(
            self.supplied_products,
            silver.categories(self.raw.categories()),
            silver.suppliers(self.raw.suppliers()),
        )

    @cached_property
    def vitrine(self) -> DataFrame:
        """Catalogue without suppliers, which here come from the item table."""
        categories = silver.categories(self.raw.categories())
        return self.products.join(categories, "category_id", "left").select(
            F.col("product_id").alias("produto_id"),
            F.col("product_name").alias("produto_nome"),
            "categoria_nome",
            F.col("unit_price").alias("preco_unitario"),
        )

    @cached_property
    def descontos(self) -> DataFrame:
        return gold.descontos(self.orders, self.details, self.products)

    @cached_property
    def ticket_medio(self) -> DataFrame:
        return gold.ticket_medio(self.orders, self.details)

    @cached_property
    def historico_produtos(self) -> DataFrame:
        return gold.historico_cliente_produtos(self.orders, self.details, self.named_customers, self.products)

    @cached_property
    def historico_volume(self) -> DataFrame:
        return gold.historico_cliente_volume(self.orders, self.details, self.named_customers)

    @cached_property
    def associados(self) -> DataFrame:
        return baskets.produtos_associados(self.orders, self.details, self.products)

    # snapshots

    @cached_property
    def span(self) -> snapshots.Range:
        return snapshots.full_range(self.orders)

    @cached_property
    def metricas(self) -> DataFrame:
        return snapshots.historico_cliente_metricas(self.orders, self.details, self.named_customers, self.span)

    @cached_property
    def com_status(self) -> DataFrame:
        return status.with_status(status.clients_of_month(self.metricas, gold.clientes(self.named_customers)))

    @cached_property
    def tendencias(self) -> DataFrame:
        return status.trends(self.metricas)

    # baskets

    @cached_property
    def associacoes(self) -> DataFrame:
        return baskets.association_stats(self.orders, self.details, self.products)

    @cached_property
    def carrinhos(self) -> DataFrame:
        """Every order is a cart."""
        return self.details.select(F.col("order_id").alias("cart_id"), "product_id")

    @cached_property
    def melhores(self) -> DataFrame:
        return self.melhores_em_ordem.drop(baskets.PLACE)

    @cached_property
    def associacoes_em_ordem(self) -> DataFrame:
        """With the place of the companion's name, by which partners and suggestions are ranked."""
        return baskets.association_stats(self.orders, self.details, self.products, placed=True)

    @cached_property
    def melhores_em_ordem(self) -> DataFrame:
        return carts.top_partners(self.carrinhos, self.associacoes_em_ordem)

    @cached_property
    def escolhidos(self) -> DataFrame:
        """The best partners as lists, a row per product of a cart."""
        return carts.chosen_partners(self.carrinhos, self.associacoes_em_ordem).drop(baskets.PLACE)

    @cached_property
    def sugestoes(self) -> DataFrame:
        return carts.ranked_suggestions(carts.combined_suggestions(self.melhores_em_ordem))

    @cached_property
    def contexto(self) -> DataFrame:
        """The customer and month of each cart."""
        return self.orders.select(
            F.col("order_id").alias("cart_id"),
            F.col("customer_id").alias("cliente_id"),
            month_key(F.col("order_date")).alias("ano_mes"),
        )

    @cached_property
    def consumo(self) -> DataFrame:
        """Straight from the items; customers without a register entry have none."""
        items = gold.dated_items(self.orders, self.details).select(
            F.col("customer_id").alias("cliente_id"),
            F.col("product_id").alias("produto_id"),
            F.col("quantity").alias("quantidade_consumida"),
        )
        return self.registered(carts.client_consumption(items))

    def registered(self, rows: DataFrame) -> DataFrame:
        """Rows of customers in the register, like the tables that carry their name."""
        return rows.join(gold.company_names(self.named_customers), "cliente_id", "left_semi")

    def in_context(self, rows: DataFrame) -> DataFrame:
        return offers.in_context(rows, self.contexto, self.vitrine, self.consumo, self.descontos)

    # actions

    def _acoes(self, placed: bool) -> DataFrame:
        purchases = gold.dated_items(self.orders, self.details).select(
            F.col("customer_id").alias("cliente_id"), F.col("product_id").alias("produto_id"), "ano_mes"
        )
        calendar = actions.product_calendar(self.products, self.descontos, placed)
        return actions.recurrence(purchases, calendar, self.span, gold.company_names(self.named_customers))

    @cached_property
    def acoes(self) -> DataFrame:
        return self._acoes(placed=False)

    @cached_property
    def acoes_pontuadas(self) -> DataFrame:
        return actions.with_score(self.acoes)

    @cached_property
    def acoes_em_ordem(self) -> DataFrame:
        """Ranked by the place of the product's name."""
        return actions.ranked(actions.with_score(self._acoes(placed=True)))
