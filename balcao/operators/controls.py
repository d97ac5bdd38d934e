"""Control figures of each table: one row each, one aggregate each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from balcao.functions.numbers import ratio, rounded
from balcao.sources.schemas import TOTAL

def rows() -> Column:
    return F.count(F.lit(1))


def orders(df: DataFrame) -> DataFrame:
    return df.agg(rows().alias("pedidos"), F.count_if(F.col("shipped_date").isNull()).alias("sem_envio"))


def order_details(df: DataFrame) -> DataFrame:
    return df.agg(rows().alias("itens"), F.sum("receita_item").cast(TOTAL).alias("receita"))


def descontos(df: DataFrame) -> DataFrame:
    by_product = df.groupBy("produto_id").agg(rows().alias("n"), F.max("maior_desconto").alias("maior"))
    return by_product.agg(
        F.sum("n").alias("linhas"),
        rows().alias("produtos"),
        F.count_if(F.col("maior") > 0).alias("produtos_com_desconto"),
        F.max("maior").alias("maior_desconto"),
    )


def historico_cliente_produtos(df: DataFrame) -> DataFrame:
    """Folded to customer and product first: one shuffle serves the three distinct counts."""
    pairs = df.groupBy("cliente_id", "produto_id").agg(
        rows().alias("n"), F.sum("quantidade_consumida").alias("unidades"), F.sum("receita_total").alias("receita")
    )
    return pairs.agg(
        F.sum("n").alias("linhas"),
        rows().alias("pares"),
        F.count_distinct("cliente_id").alias("clientes"),
        F.count_distinct("produto_id").alias("produtos"),
        F.sum("unidades").alias("unidades"),
        F.sum("receita").cast(TOTAL).alias("receita"),
    )


def historico_cliente_volume(df: DataFrame) -> DataFrame:
    clients = df.groupBy("cliente_id").agg(
        rows().alias("n"),
        *[F.sum(c).alias(c) for c in
          ("receita_sem_desconto", "receita_total", "quantidade_itens", "quantidade_pedidos")],
    )
    discount = 1 - ratio(F.sum("receita_total"), F.sum("receita_sem_desconto"))
    return clients.agg(
        F.sum("n").alias("linhas"),
        rows().alias("clientes"),
        F.sum("receita_sem_desconto").cast(TOTAL).alias("receita_sem_desconto"),
        F.sum("receita_total").cast(TOTAL).alias("receita_total"),
        F.sum("quantidade_itens").alias("itens"),
        F.sum("quantidade_pedidos").alias("pedidos"),
        F.coalesce(discount, F.lit(0.0)).alias("desconto_medio"),
    )


def produtos_associados(df: DataFrame) -> DataFrame:
    """Orders are counted by folding the pairs of each order first."""
    alone = F.col("produto_acompanhante_id").isNull()
    per_order = df.groupBy("id_compra").agg(
        F.max("total_produtos_distintos").alias("produtos"),
        F.count_if(~alone).alias("pares"),
        F.count_if(alone).alias("sem"),
        F.min("data_compra").alias("primeira"),
        F.max("data_compra").alias("ultima"),
    )
    return per_order.agg(
        rows().alias("pedidos"),
        F.count_if(F.col("produtos") == 1).alias("pedidos_um_produto"),
        F.sum("pares").alias("pares"),
        F.sum("sem").alias("linhas_sem_acompanhante"),
        F.min("primeira").alias("primeira_compra"),
        F.max("ultima").alias("ultima_compra"),
        F.max("produtos").alias("maior_cesta"),
    )


def ticket_global(df: DataFrame) -> DataFrame:
    return df.agg(
        F.sum("receita_total").cast(TOTAL).alias("receita"),
        F.sum("qtd_pedidos").alias("pedidos"),
        rounded(ratio(F.sum("receita_total"), F.sum("qtd_pedidos")), 2).alias("ticket_medio_global"),
    )


def historico_cliente_metricas(df: DataFrame) -> DataFrame:
    """Customers with and without purchases in the oldest band, per snapshot month."""
    bought = F.col("frequencia_compra_9m") > 0
    return df.groupBy("ano_mes").agg(
        rows().alias("clientes"),
        F.count_if(bought).alias("com_compra_9m"),
        F.count_if(~bought).alias("sem_compra_9m"),
    )
