"""Named queries over a data folder.

Results are handed out with money as double and days as text, the forms every
engine prints alike; the tables themselves keep decimals and dates.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, DecimalType

from balcao.functions.months import key_of_index, month_key, month_label, month_name
from balcao.functions.numbers import rounded
from balcao.operators import (
    actions, baskets, carts, controls, gold, offers, quality, search, snapshots, status,
)
from balcao.plans import stored
from balcao.plans.model import Model
from balcao.session import small_tasks, tune
from balcao.sources.readers import query

SCORE_COLUMNS = ["associacao_combinada", "media_outros_produtos", "indice_oportunidade"]
SHOWN_DIGITS = 6


def portable(df: DataFrame) -> DataFrame:
    forms = {DecimalType: "double", DateType: "string"}
    return df.select(
        *[
            F.col(f.name).cast(forms[type(f.dataType)]).alias(f.name) if type(f.dataType) in forms else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _scores(df: DataFrame) -> DataFrame:
    """The merged scores are products and sums in any order: show them without float noise."""
    return df.withColumns({c: rounded(F.col(c), SHOWN_DIGITS) for c in SCORE_COLUMNS if c in df.columns})


def _parameter_sql(m: Model) -> DataFrame:
    """Orders of each product in some months, counted on order and product, before any pair exists."""
    sql = """
        SELECT produto_x, COUNT(*) AS pedidos, COUNT_IF(outros > :outros) AS pedidos_com_outros
        FROM {itens}
        WHERE ano_mes BETWEEN :mes_inicial AND :mes_final
        GROUP BY produto_x
    """
    args = {"outros": 2, "mes_inicial": "1994-03", "mes_final": "1996-10"}
    return query(m.spark, sql, args, itens=baskets.items_with_company(m.orders, m.details, m.products))


def _snapshot_quality(m: Model) -> DataFrame:
    months = snapshots.snapshot_months(m.orders).select("ano_mes")
    base = snapshots.base_orders(m.orders, m.span)
    return quality.historico_cliente_metricas(
        m.metricas,
        months,
        key_of_index(m.span.last),
        snapshots.eligible_rows(m.orders, m.named_customers, m.span),
        base.select(month_key(F.col("order_date")).alias("ano_mes")),
    )


def _status_rows(m: Model) -> DataFrame:
    states = [f"estado_{x.key}" for x in status.METRICS]
    return m.com_status.select("ano_mes", "cliente_id", *states, "status", F.array_join("motivos", ",").alias("motivos"))


def _change_rows(m: Model) -> DataFrame:
    return m.tendencias.select("ano_mes", "cliente_id", "metrica", "comparacao_3x6", "comparacao_3x9")


def _month_names(m: Model) -> DataFrame:
    return offers.month_list(snapshots.snapshot_months(m.orders)).select(
        "ano_mes", "rotulo", "selecionado", month_name(F.col("ano_mes"), capital=True).alias("nome")
    )


def _cart_lines(m: Model) -> DataFrame:
    """The context meets the lines where they lie by order; the names come last, where the lines lie by product."""
    names = gold.product_names(m.products).select("produto_id", "produto_nome")
    lines = m.in_context(m.carrinhos.withColumnRenamed("product_id", "produto_id"))
    shown = list(lines.columns)
    shown.insert(shown.index("cart_id") + 1, "produto_nome")
    return lines.join(names, "produto_id").select(shown)


def _suggestions_in_context(m: Model) -> DataFrame:
    rows = m.sugestoes.select(
        "cart_id", "posicao", F.col("produto_y").alias("produto_id"), F.col("nome_y").alias("produto_nome"),
        "indice_oportunidade",
    )
    return _scores(m.in_context(rows))


def _alphabetical(m: Model) -> DataFrame:
    return carts.alphabetical_catalogue(m.vitrine)


BUILDERS: dict[str, Callable[[Model], DataFrame]] = {
    # cleaned layer
    "silver_customers": lambda m: m.customers,
    "silver_orders": lambda m: m.shipped_orders,
    "silver_products": lambda m: m.supplied_products,
    "silver_order_details": lambda m: m.details,
    # analytical layer
    "gold_clientes": lambda m: m.clientes,
    "gold_produtos": lambda m: m.produtos,
    "gold_descontos": lambda m: m.descontos,
    "gold_ticket_medio": lambda m: m.ticket_medio,
    "gold_historico_cliente_produtos": lambda m: m.historico_produtos,
    "gold_historico_cliente_volume": lambda m: m.historico_volume,
    "gold_produtos_associados": lambda m: m.associados,
    "gold_historico_cliente_metricas": lambda m: m.metricas,
    "periodos": lambda m: snapshots.snapshot_months(m.orders),
    "cobertura": lambda m: snapshots.coverage_report(m.orders),
    # quality
    "dq_customers": lambda m: quality.customers(m.customers),
    "dq_orders": lambda m: quality.orders(m.orders),
    "dq_products": lambda m: quality.products(m.products),
    "dq_order_details": lambda m: quality.order_details(m.details, m.orders),
    "dq_clientes": lambda m: quality.clientes(m.clientes, m.customers),
    "dq_produtos": lambda m: quality.produtos(m.produtos, m.products),
    "dq_descontos": lambda m: quality.descontos(m.descontos, m.details),
    "dq_historico_produtos": lambda m: quality.historico_cliente_produtos(m.historico_produtos, m.details),
    "dq_historico_volume": lambda m: quality.historico_cliente_volume(m.historico_volume, m.orders, m.details),
    "dq_historico_metricas": _snapshot_quality,
    "dq_produtos_associados": lambda m: quality.produtos_associados(m.associados, m.orders),
    "dq_ticket_medio": lambda m: quality.ticket_medio(m.ticket_medio, m.orders),
    # control figures
    "ctl_orders": lambda m: controls.orders(m.shipped_orders),
    "ctl_order_details": lambda m: controls.order_details(m.details),
    "ctl_descontos": lambda m: controls.descontos(m.descontos),
    "ctl_historico_produtos": lambda m: controls.historico_cliente_produtos(m.historico_produtos),
    "ctl_historico_volume": lambda m: controls.historico_cliente_volume(m.historico_volume),
    "ctl_produtos_associados": lambda m: controls.produtos_associados(m.associados),
    "ctl_ticket_global": lambda m: controls.ticket_global(m.ticket_medio),
    "ctl_metricas": lambda m: controls.historico_cliente_metricas(m.metricas),
    # baskets
    "assoc_stats": lambda m: m.associacoes,
    "assoc_evidence": lambda m: baskets.association_evidence(m.associacoes),
    "assoc_top5": lambda m: m.melhores,
    # The paths of large orders and carts, which the test data would not take by itself.
    "assoc_stats_tiles": lambda m: baskets.association_stats(m.orders, m.details, m.products, block=3),
    "assoc_top5_large_carts": lambda m: carts.top_partners(m.carrinhos, m.associacoes_em_ordem, prefix=6).drop(
        baskets.PLACE
    ),
    "cart_suggestions": lambda m: _scores(carts.combined_suggestions(m.melhores)),
    "cart_suggestions_ranked": lambda m: _scores(m.sugestoes),
    "cart_suggestion_origins": lambda m: carts.suggestion_origins(m.escolhidos, m.products, folded=True),
    "sql_parametrizado": _parameter_sql,
    # consumption and offers
    "consumo_cliente": lambda m: m.consumo,
    "produtos_rank_cliente": lambda m: carts.ranked_catalogue(
        m.vitrine, m.consumo, search.search_clients(m.clientes, "nàtion_1")
    ),
    "catalogo_alfabetico": _alphabetical,
    "ofertas_mes": lambda m: offers.monthly_offers(m.descontos),
    "meses_oferta": lambda m: offers.month_list(m.descontos),
    "sugestoes_contexto": _suggestions_in_context,
    "carrinho_contexto": _cart_lines,
    # search
    "busca_produtos": lambda m: search.search_products(m.produtos, " RÌNG "),
    "busca_clientes": lambda m: search.search_clients(m.clientes, "nàtion_1"),
    # customers
    "meses_metricas": _month_names,
    "clientes_do_mes": lambda m: status.clients_of_month(m.metricas, gold.clientes(m.named_customers)),
    "variacao": _change_rows,
    "tendencias": lambda m: m.tendencias,
    "status_clientes": _status_rows,
    "status_enriquecido": lambda m: m.com_status.withColumn("motivos", F.array_join("motivos", ",")),
    "filtro_clientes": lambda m: status.filter_clients(
        m.com_status, client="BUÍLD", company="customer#", status="ruim"
    ).withColumn("motivos", F.array_join("motivos", ",")),
    "volume_9m": lambda m: snapshots.volume_series(m.orders, m.details, m.named_customers, m.span).withColumn(
        "rotulo", month_label(F.col("ano_mes"))
    ),
    "papel_metrica": lambda m: status.metric_roles(m.com_status),
    "frase_status": lambda m: status.status_sentences(m.com_status),
    "variacao_texto": lambda m: status.change_texts(m.tendencias),
    "interpretacao": lambda m: status.interpretations(m.tendencias),
    "meses_ativos": lambda m: status.active_months(m.metricas),
    # actions
    "acoes_base": lambda m: m.acoes,
    "acoes_score": lambda m: m.acoes_pontuadas,
    "acoes_ranked": lambda m: m.acoes_em_ordem,
    # stored tables, written and read again
    "metricas_avanco": stored.advanced_snapshots,
    "assoc_stats_mensal": stored.merged_pairs,
    "regras_mensais": stored.rules_by_month,
    "cobertura_rodapes": stored.coverage_from_footers,
    "meses_oferta_gravados": stored.offer_months_from_commits,
    "ctl_na_gravacao": stored.figures_of_write,
    "troca_atomica": stored.replaced_volume,
    "volume_meses_escolhidos": stored.volume_of_chosen_months,
    "meses_gravados": stored.stored_months,
    "ticket_em_baldes": stored.ticket_from_buckets,
    "busca_indice": stored.many_searches,
    "bronze_quarentena": stored.quarantined_items,
}


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return portable(BUILDERS[name](Model(small_tasks(tune(spark)), folder)))
