"""The same results in plain SQL over the raw tables, written from the definitions.

Every query lists the named subqueries it needs; `sql` puts them in front of it.
"""

from __future__ import annotations

import re

# Fixed values, written from the definitions and not taken from the operators: tolerance, metrics as
# (key, compared by relative change), and the texts.
TOLERANCE = 0.200000001
METRICS = {
    "frequencia_compra": False,
    "receita_media": True,
    "desconto_medio": False,
    "quantidade_produtos_distintos_media": True,
    "quantidade_itens_media": True,
}
DECIDING = ["frequencia_compra", "receita_media", "quantidade_itens_media"]
NO_BASE = "sem valor no período mais antigo (passou a existir agora)"
BANDS = {"3m": (0, 2), "6m": (3, 5), "9m": (6, 8)}
MEASURES = {
    "receita": "receita_total", "receita_sem_desconto": "receita_sem_desconto",
    "quantidade_pedidos": "quantidade_pedidos",
    "quantidade_produtos_distintos": "quantidade_produtos_distintos",
    "quantidade_itens": "quantidade_itens",
}


def _nulls(**kinds: str) -> str:
    return ", ".join(f"CAST(NULL AS {kind}) AS {name}" for name, kind in kinds.items())


def _key(idx: str) -> str:
    return f"(lpad(CAST(({idx}) // 12 AS VARCHAR), 4, '0') || '-' || lpad(CAST(({idx}) % 12 + 1 AS VARCHAR), 2, '0'))"


def _idx(day: str) -> str:
    return f"CAST(year({day}) * 12 + month({day}) - 1 AS INTEGER)"


def _ptbr(value: str) -> str:
    return f"translate(format('{{:,.1f}}', round({value}, 1)), ',.', '.,')"


def _offer(column: str) -> str:
    return (
        f"CASE WHEN {column} IS NULL THEN 'Sem oferta' WHEN {column} = 0 THEN 'Sem desconto' "
        f"ELSE {_ptbr(f'CAST({column} AS DOUBLE) * 100')} || '%' END"
    )


def _day(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"


def _discount(net: str, gross: str) -> str:
    return (
        f"CASE WHEN {gross} = 0 THEN 0.0::DOUBLE "
        f"ELSE round(1 - CAST({net} AS DOUBLE) / CAST({gross} AS DOUBLE), 4) + 0.0 END"
    )


def _band_sums() -> str:
    out = []
    for band, (lo, hi) in BANDS.items():
        cond = f"FILTER (WHERE p.s - b.idx BETWEEN {lo} AND {hi})"
        out.append(f"count(b.idx) {cond} AS ativos_{band}")
        for short, column in MEASURES.items():
            out.append(f"coalesce(sum(b.{column}) {cond}, 0) AS {short}_{band}")
    return ", ".join(out)


def _band_metrics() -> str:
    out = []
    for b in BANDS:
        out.append(f"round(ativos_{b} / 3.0::DOUBLE, 4) AS frequencia_compra_{b}")
        for short in MEASURES:
            out.append(f"round(CAST({short}_{b} AS DOUBLE) / 3.0::DOUBLE, 2) AS {short}_media_{b}")
        out.append(f"{_discount(f'receita_{b}', f'receita_sem_desconto_{b}')} AS desconto_medio_{b}")
    return ", ".join(out)


def _change(now: str, base: str, relative: bool) -> str:
    if not relative:
        return f"({now} - {base})"
    return (
        f"(CASE WHEN {base} = 0 THEN CASE WHEN {now} = 0 THEN 0.0::DOUBLE ELSE 'Infinity'::DOUBLE END "
        f"ELSE ({now} - {base}) / abs({base}) END)"
    )


def _trend_rows() -> str:
    parts = []
    for metric, relative in METRICS.items():
        v3, v6, v9 = (f"{metric}_{b}" for b in BANDS)
        parts.append(
            f"SELECT ano_mes, cliente_id, '{metric}' AS metrica, "
            f"'{'relativa' if relative else 'diferenca'}' AS modo, {v3} AS valor_3m, {v6} AS valor_6m, "
            f"{v9} AS valor_9m, {_change(v3, v6, relative)} AS comparacao_3x6, "
            f"{_change(v3, v9, relative)} AS comparacao_3x9 FROM metricas"
        )
    return " UNION ALL ".join(parts)


def _state(metric: str) -> str:
    return f"max(CASE WHEN metrica = '{metric}' THEN estado END) AS estado_{metric}"


def _text(value: str) -> str:
    return (
        f"CASE WHEN {value} = 'Infinity'::DOUBLE THEN '{NO_BASE}' ELSE "
        f"(CASE WHEN {value} > 0 THEN '+' WHEN {value} < 0 THEN '-' ELSE '' END) || "
        f"{_ptbr(f'abs({value}) * 100')} || (CASE WHEN modo = 'relativa' THEN '%' ELSE ' p.p.' END) END"
    )


STATES = ", ".join(f"estado_{m}" for m in METRICS)
FELL = [f"CAST(estado_{m} = 'diminuiu' AS INTEGER)" for m in DECIDING]
ORDER_PARTNER = "pct_associacao DESC, pct_outros ASC, pedidos_com_x_e_y DESC, nome_y, produto_y"
PARTNER = (
    "produto_x, produto_y, nome_y, pedidos_com_x, pedidos_com_x_e_y, pedidos_com_outros, "
    "pct_associacao, pct_outros"
)

CTES = {
    # cleaned layer
    "orders_": f"""
        SELECT o_orderkey AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
               CAST(o_orderdate AS DATE) AS order_date, strftime(o_orderdate, '%Y-%m') AS ano_mes,
               {_idx('o_orderdate')} AS idx, CAST(o_totalprice AS DECIMAL(10,2)) AS freight
        FROM orders""",
    "shipped": """
        SELECT l_orderkey AS order_id, max(CAST(l_shipdate AS DATE)) AS shipped_date
        FROM lineitem GROUP BY l_orderkey""",
    "lines": """
        SELECT l_orderkey AS order_id, l_partkey AS product_id,
               CAST(round(CAST(sum(CAST(l_extendedprice AS DECIMAL(14,2))) AS DOUBLE) / sum(l_quantity), 2)
                    AS DECIMAL(10,2)) AS unit_price,
               CAST(sum(l_quantity) AS INTEGER) AS quantity,
               max(CAST(l_discount AS DECIMAL(4,2))) AS discount
        FROM lineitem GROUP BY l_orderkey, l_partkey""",
    "details": """
        SELECT *, CAST(round(unit_price * quantity * (1 - discount), 2) AS DECIMAL(12,2)) AS receita_item,
               CAST(unit_price * quantity AS DECIMAL(14,2)) AS bruto
        FROM lines""",
    "customers_": """
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS company_name,
               c_mktsegment AS contact_name, n_name AS country, r_name AS region
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
                      LEFT JOIN region ON n_regionkey = r_regionkey""",
    "products_": """
        SELECT p_partkey AS product_id, p_name AS product_name,
               CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS INTEGER) AS category_id,
               p_brand AS category_name, p_type AS quantity_per_unit,
               CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price, p_size AS units_in_stock,
               (SELECT min(l_suppkey) FROM lineitem WHERE l_partkey = p_partkey) AS supplier_id
        FROM part""",
    # analytical layer
    "clientes": f"""
        SELECT customer_id AS cliente_id, company_name AS nome_empresa, contact_name AS nome_contato,
               region AS regiao, country AS pais,
               {_nulls(cargo_contato='VARCHAR', endereco='VARCHAR', cidade='VARCHAR', cep='VARCHAR',
                       telefone='VARCHAR', fax='VARCHAR')}
        FROM customers_""",
    "produtos": f"""
        SELECT product_id AS produto_id, product_name AS produto_nome, category_id AS categoria_id,
               category_name AS categoria_nome, supplier_id AS fornecedor_id, s_name AS fornecedor_nome,
               quantity_per_unit AS quantidade_por_unidade, CAST(unit_price AS DOUBLE) AS preco_unitario,
               units_in_stock AS unidades_em_estoque,
               {_nulls(unidades_em_pedido='INTEGER', nivel_reposicao='INTEGER', descontinuado='INTEGER')}
        FROM products_ LEFT JOIN supplier ON s_suppkey = supplier_id""",
    "itens": """
        SELECT d.*, o.customer_id AS cliente_id, o.ano_mes, o.idx, o.order_date, p.product_name AS nome,
               p.category_id, p.unit_price AS preco_catalogo
        FROM details d JOIN orders_ o USING (order_id) JOIN products_ p USING (product_id)""",
    "descontos": """
        SELECT ano_mes, product_id AS produto_id, nome AS produto_nome, category_id AS categoria_id,
               preco_catalogo AS preco_unitario, max(discount) AS maior_desconto
        FROM itens GROUP BY ALL""",
    "pedido": """
        SELECT o.ano_mes, order_id, sum(receita_item) AS ticket, sum(bruto) AS bruto, count(*) AS itens,
               sum(quantity) AS unidades, any_value(o.freight) AS frete
        FROM details JOIN orders_ o USING (order_id) GROUP BY o.ano_mes, order_id""",
    "ticket": """
        SELECT ano_mes, count(*) AS qtd_pedidos, CAST(sum(ticket) AS DECIMAL(14,2)) AS receita_total,
               round(CAST(sum(ticket) AS DOUBLE) / count(*), 2) AS ticket_medio,
               round(CAST(sum(unidades) AS DOUBLE) / count(*), 2) AS unidades_por_pedido,
               round(CAST(sum(itens) AS DOUBLE) / count(*), 3) AS itens_por_pedido,
               round(CAST(sum(bruto) AS DOUBLE) / CAST(sum(unidades) AS DOUBLE), 2) AS preco_medio,
               round(1 - CAST(sum(ticket) AS DOUBLE) / CAST(sum(bruto) AS DOUBLE), 4) AS desconto_efetivo,
               round(CAST(sum(frete) AS DOUBLE) / count(*), 2) AS frete_por_pedido
        FROM pedido GROUP BY ano_mes""",
    "hist_produtos": """
        SELECT i.ano_mes, i.idx, i.cliente_id, c.company_name AS nome_empresa, i.product_id AS produto_id,
               i.nome AS produto_nome, i.category_id AS categoria_id,
               CAST(sum(i.quantity) AS BIGINT) AS quantidade_consumida,
               CAST(sum(i.receita_item) AS DECIMAL(14,2)) AS receita_total
        FROM itens i JOIN customers_ c ON c.customer_id = i.cliente_id GROUP BY ALL""",
    "volume": """
        SELECT o.ano_mes, o.idx, o.customer_id AS cliente_id, c.company_name AS nome_empresa,
               CAST(sum(bruto) AS DECIMAL(14,2)) AS receita_sem_desconto,
               CAST(sum(receita_item) AS DECIMAL(14,2)) AS receita_total,
               count(DISTINCT order_id) AS quantidade_pedidos,
               count(DISTINCT product_id) AS quantidade_produtos_distintos,
               CAST(sum(quantity) AS BIGINT) AS quantidade_itens
        FROM details JOIN orders_ o USING (order_id) JOIN customers_ c USING (customer_id)
        GROUP BY ALL""",
    "volume_pct": f"""
        SELECT *, {_discount('receita_total', 'receita_sem_desconto')} AS desconto_medio FROM volume""",
    # snapshots
    "cov": f"""
        SELECT min(order_date) AS menor, max(order_date) AS maior,
               {_idx('min(order_date)')} + CASE WHEN day(min(order_date)) = 1 THEN 0 ELSE 1 END AS completo,
               {_idx('max(order_date)')}
                   - CASE WHEN max(order_date) = last_day(max(order_date)) THEN 0 ELSE 1 END AS ultimo
        FROM orders_""",
    "snaps": "SELECT unnest(generate_series(completo + 8, ultimo)) AS s FROM cov",
    "pop": """
        SELECT customer_id AS cliente_id, company_name AS nome_empresa, min(idx) AS entrada
        FROM orders_ JOIN customers_ USING (customer_id) GROUP BY ALL""",
    "elegiveis": "SELECT s, cliente_id, nome_empresa FROM snaps JOIN pop ON entrada <= s",
    "somas": f"""
        SELECT p.s, p.cliente_id, p.nome_empresa, {_band_sums()}
        FROM elegiveis p LEFT JOIN volume b ON b.cliente_id = p.cliente_id AND b.idx BETWEEN p.s - 8 AND p.s
        GROUP BY p.s, p.cliente_id, p.nome_empresa""",
    "metricas": f"SELECT {_key('s')} AS ano_mes, cliente_id, nome_empresa, {_band_metrics()} FROM somas",
    "variacoes": _trend_rows(),
    "tendencias": f"""
        SELECT *, (comparacao_3x6 + comparacao_3x9) / 2 AS indice,
               CASE WHEN (comparacao_3x6 + comparacao_3x9) / 2 > {TOLERANCE!r}::DOUBLE THEN 'aumentou'
                    WHEN (comparacao_3x6 + comparacao_3x9) / 2 < -{TOLERANCE!r}::DOUBLE THEN 'diminuiu'
                    ELSE 'normal' END AS estado
        FROM variacoes""",
    "estados": f"""
        SELECT ano_mes, cliente_id, {', '.join(_state(m) for m in METRICS)}
        FROM tendencias GROUP BY ano_mes, cliente_id""",
    "status_": f"""
        SELECT *, CASE WHEN {' + '.join(FELL)} >= 2 THEN 'ruim'
                       WHEN estado_frequencia_compra = 'diminuiu' OR estado_receita_media = 'diminuiu' THEN 'atencao'
                       WHEN estado_frequencia_compra = 'aumentou' AND estado_receita_media = 'aumentou' THEN 'bom'
                       ELSE 'normal' END AS status
        FROM estados""",
    "status_motivos": """
        SELECT *, CASE status
                    WHEN 'bom' THEN 'frequencia_compra,receita_media'
                    WHEN 'normal' THEN ''
                    ELSE concat_ws(',',
                        CASE WHEN estado_frequencia_compra = 'diminuiu' THEN 'frequencia_compra' END,
                        CASE WHEN estado_receita_media = 'diminuiu' THEN 'receita_media' END,
                        CASE WHEN estado_quantidade_itens_media = 'diminuiu' THEN 'quantidade_itens_media' END)
                  END AS motivos
        FROM status_""",
    "do_mes": """
        SELECT m.*, coalesce(nullif(trim(c.nome_contato), ''), m.cliente_id) AS nome_cliente, c.telefone
        FROM metricas m LEFT JOIN clientes c USING (cliente_id)""",
    "enriquecido": f"""
        SELECT d.*, {STATES}, status, motivos
        FROM do_mes d JOIN status_motivos s USING (ano_mes, cliente_id)""",
    # baskets
    "cesta": """
        SELECT order_id, cliente_id, ano_mes, order_date, product_id, nome, quantity,
               count(*) OVER (PARTITION BY order_id) AS total
        FROM itens""",
    "associados": """
        SELECT x.ano_mes, x.order_date AS data_compra, x.order_id AS id_compra, x.cliente_id AS id_cliente,
               x.product_id AS produto_comprado_id, x.nome AS produto_comprado_nome,
               x.quantity AS quantidade_comprada, y.product_id AS produto_acompanhante_id,
               y.nome AS produto_acompanhante_nome, y.quantity AS quantidade_acompanhante,
               x.total AS total_produtos_distintos,
               CASE WHEN x.total = 1 THEN 0 ELSE x.total - 2 END AS quantidade_outros_produtos_distintos
        FROM cesta x LEFT JOIN cesta y ON x.order_id = y.order_id AND x.product_id <> y.product_id""",
    "pedidos_x": """
        SELECT produto_comprado_id AS produto_x, count(DISTINCT id_compra) AS pedidos_com_x
        FROM associados GROUP BY 1""",
    "conjuntos": """
        SELECT produto_comprado_id AS produto_x, produto_acompanhante_id AS produto_y,
               produto_acompanhante_nome AS nome_y, count(DISTINCT id_compra) AS pedidos_com_x_e_y,
               count(DISTINCT CASE WHEN quantidade_outros_produtos_distintos > 0 THEN id_compra END)
                   AS pedidos_com_outros
        FROM associados WHERE produto_acompanhante_id IS NOT NULL GROUP BY 1, 2, 3""",
    "assoc": """
        SELECT *, CAST(pedidos_com_x_e_y AS DOUBLE) / pedidos_com_x * 100 AS pct_associacao,
               CAST(pedidos_com_outros AS DOUBLE) / pedidos_com_x_e_y * 100 AS pct_outros
        FROM conjuntos JOIN pedidos_x USING (produto_x)""",
    "carts": "SELECT order_id AS cart_id, product_id FROM details",
    "top5": f"""
        SELECT * FROM (
            SELECT c.cart_id, a.*,
                   CAST(row_number() OVER (PARTITION BY c.cart_id, a.produto_x ORDER BY {ORDER_PARTNER}) AS INTEGER) AS ordem
            FROM carts c JOIN assoc a ON a.produto_x = c.product_id
            WHERE NOT EXISTS (SELECT 1 FROM carts k WHERE k.cart_id = c.cart_id AND k.product_id = a.produto_y))
        WHERE ordem <= 5""",
    "sugestoes_cruas": """
        SELECT cart_id, produto_y, max(nome_y) AS nome_y,
               greatest(0.0, least(100.0, (1 - product(1 - pct_associacao / 100)) * 100)) AS associacao_combinada,
               sum(pct_outros * pedidos_com_x_e_y) / sum(pedidos_com_x_e_y) AS media_outros_produtos,
               CAST(sum(pedidos_com_x_e_y) AS BIGINT) AS total_pedidos_conjuntos, count(*) AS origens
        FROM top5 GROUP BY cart_id, produto_y""",
    "sugestoes": """
        SELECT *, associacao_combinada * (1 - 0.25 * (media_outros_produtos / 100)) AS indice_oportunidade
        FROM sugestoes_cruas""",
    "sugestoes_ordem": """
        SELECT *, CAST(row_number() OVER (PARTITION BY cart_id ORDER BY round(indice_oportunidade, 9) DESC,
                                          total_pedidos_conjuntos DESC, nome_y, produto_y) AS INTEGER) AS posicao
        FROM sugestoes""",
    "consumo": """
        SELECT cliente_id, produto_id, CAST(sum(quantidade_consumida) AS BIGINT) AS quantidade_total
        FROM hist_produtos GROUP BY 1, 2""",
    "contexto": "SELECT order_id AS cart_id, customer_id AS cliente_id, ano_mes FROM orders_",
    # actions
    "compras": """
        SELECT h.cliente_id, s.s, h.produto_id, max(h.produto_nome) AS produto_nome,
               count(DISTINCT h.ano_mes) AS meses_com_compra
        FROM hist_produtos h JOIN snaps s ON h.idx BETWEEN s.s - 9 AND s.s - 1
        GROUP BY 1, 2, 3""",
    "categorias": "SELECT produto_id, max(categoria_id) AS categoria_id FROM descontos GROUP BY 1",
    "acoes": f"""
        SELECT c.cliente_id, {_key('c.s')} AS ano_mes, c.produto_id, c.produto_nome, c.meses_com_compra,
               CAST(floor(c.meses_com_compra * 100.0 / 9) AS INTEGER) AS frequencia, k.categoria_id,
               d.maior_desconto AS oferta
        FROM compras c LEFT JOIN categorias k USING (produto_id)
             LEFT JOIN descontos d ON d.produto_id = c.produto_id AND d.ano_mes = {_key('c.s')}""",
    "acoes_score": """
        SELECT a.*, frequencia + CASE WHEN categoria_id IS NULL THEN 0 ELSE coalesce(o.total, 0) - frequencia END
                        AS score
        FROM acoes a LEFT JOIN (SELECT cliente_id, ano_mes, categoria_id, CAST(sum(frequencia) AS BIGINT) AS total
                                FROM acoes GROUP BY 1, 2, 3) o USING (cliente_id, ano_mes, categoria_id)""",
}

SCORES = ", ".join(
    f"round({c}, 6) + 0.0 AS {c}" for c in ("associacao_combinada", "media_outros_produtos", "indice_oportunidade")
)
SUGGESTION = f"cart_id, produto_y, nome_y, {SCORES}, total_pedidos_conjuntos, origens"
ACTION = (
    "cliente_id, ano_mes, produto_id, produto_nome, meses_com_compra, frequencia, categoria_id, "
    "CAST(oferta AS DOUBLE) AS oferta"
)
CONTEXT = f"""
    p.categoria_nome, p.preco_unitario, x.cliente_id, x.ano_mes, coalesce(q.quantidade_total, 0) AS consumo_cliente,
    CAST(d.maior_desconto AS DOUBLE) AS oferta, {_offer('d.maior_desconto')} AS oferta_texto"""
CONTEXT_JOINS = """
    JOIN contexto x USING (cart_id)
    LEFT JOIN produtos p ON p.produto_id = r.produto_id
    LEFT JOIN consumo q ON q.cliente_id = x.cliente_id AND q.produto_id = r.produto_id
    LEFT JOIN descontos d ON d.ano_mes = x.ano_mes AND d.produto_id = r.produto_id"""


# ── quality rules ─────────────────────────────────────────────


def _rules(table: str, rows: dict[str, str], others: dict[str, str]) -> str:
    """One SELECT per rule; `others` are complete scalar expressions."""
    parts = [
        f"SELECT '{name}' AS regra, CAST(count(*) FILTER (WHERE {cond}) AS BIGINT) AS violacoes FROM {table}"
        for name, cond in rows.items()
    ]
    parts += [
        f"SELECT '{name}' AS regra, CAST(coalesce(({value}), 0) AS BIGINT) AS violacoes" for name, value in others.items()
    ]
    return " UNION ALL ".join(parts)


def _dup(table: str, *key: str) -> str:
    columns = ", ".join(key)
    return f"(SELECT count(*) FROM {table}) - (SELECT count(*) FROM (SELECT DISTINCT {columns} FROM {table}))"


def _n(table: str, expr: str = "count(*)") -> str:
    return f"(SELECT {expr} FROM {table})"


def _cent(left: str, right: str) -> str:
    return f"CASE WHEN abs({left} - {right}) > 0.01 THEN 1 ELSE 0 END"


def _is_null(*columns: str) -> dict[str, str]:
    return {f"{c} nulo": f"{c} IS NULL" for c in columns}


def _snapshot_rules() -> str:
    rows = _is_null("cliente_id", "nome_empresa")
    ranges = ("frequencia_compra", "desconto_medio")
    amounts = (
        "receita_media", "receita_sem_desconto_media", "quantidade_pedidos_media",
        "quantidade_produtos_distintos_media", "quantidade_itens_media",
    )
    for b in BANDS:
        rows |= {f"{c}_{b} fora de [0, 1]": f"{c}_{b} < 0 OR {c}_{b} > 1" for c in ranges}
        rows |= {f"{c}_{b} negativa": f"{c}_{b} < 0" for c in amounts}
        rows |= {f"{c}_{b} invalida (NaN)": f"isnan({c}_{b})" for c in ranges + amounts}
        moved = " OR ".join(f"{c}_{b} <> 0" for c in amounts)
        rows[f"sem compra na faixa {b} com metrica"] = f"frequencia_compra_{b} = 0 AND ({moved})"
    return _rules(
        "metricas",
        rows,
        {
            "chave (ano_mes, cliente_id) duplicada": _dup("metricas", "ano_mes", "cliente_id"),
            "linhas fora dos meses processados": (
                f"SELECT count(*) FROM metricas WHERE ano_mes NOT IN (SELECT {_key('s')} FROM snaps)"
            ),
            "base com mes posterior": (
                "SELECT count(*) FROM volume WHERE idx <= (SELECT ultimo FROM cov) AND "
                f"ano_mes > (SELECT {_key('ultimo')} FROM cov)"
            ),
            "clientes != populacao elegivel": f"abs({_n('elegiveis')} - {_n('metricas')})",
        },
    )


DQ = {
    "dq_customers": _rules(
        "customers_", _is_null("customer_id", "company_name"),
        {"customer_id duplicado": _dup("customers_", "customer_id")},
    ),
    "dq_orders": _rules(
        "orders_",
        {"order_id nulo": "order_id IS NULL", "order_date nula": "order_date IS NULL", "freight negativo": "freight < 0"},
        {"order_id duplicado": _dup("orders_", "order_id")},
    ),
    "dq_products": _rules(
        "products_",
        {**_is_null("product_id", "product_name"), "unit_price negativo": "unit_price < 0",
         "discontinued fora de [0, 1]": "CAST(NULL AS INTEGER) < 0 OR CAST(NULL AS INTEGER) > 1"},
        {"product_id duplicado": _dup("products_", "product_id")},
    ),
    "dq_order_details": _rules(
        "details",
        {"quantity <= 0": "quantity <= 0", "unit_price < 0": "unit_price < 0",
         "discount fora de [0, 1]": "discount < 0 OR discount > 1"},
        {"chave (order_id, product_id) duplicada": _dup("details", "order_id", "product_id"),
         "item sem pedido": "SELECT count(*) FROM details d WHERE NOT EXISTS "
                            "(SELECT 1 FROM orders_ o WHERE o.order_id = d.order_id)"},
    ),
    "dq_clientes": _rules(
        "clientes", _is_null("cliente_id", "nome_empresa"),
        {"cliente_id duplicado": _dup("clientes", "cliente_id"),
         "linhas perdidas": f"{_n('customers_')} - {_n('clientes')}"},
    ),
    "dq_produtos": _rules(
        "produtos",
        {**_is_null("produto_id", "produto_nome"), "preco_unitario negativo": "preco_unitario < 0",
         "categoria sem nome": "categoria_id IS NOT NULL AND categoria_nome IS NULL",
         "fornecedor sem nome": "fornecedor_id IS NOT NULL AND fornecedor_nome IS NULL"},
        {"produto_id duplicado": _dup("produtos", "produto_id"),
         "produtos perdidos": f"{_n('products_')} - {_n('produtos')}"},
    ),
    "dq_descontos": _rules(
        "descontos",
        {**_is_null("produto_id", "produto_nome", "categoria_id"), "preco_unitario negativo": "preco_unitario < 0",
         "maior_desconto fora de [0, 1]": "maior_desconto < 0 OR maior_desconto > 1"},
        {"chave (ano_mes, produto_id) duplicada": _dup("descontos", "ano_mes", "produto_id"),
         "produtos vendidos perdidos":
             f"{_n('details', 'count(DISTINCT product_id)')} - {_n('descontos', 'count(DISTINCT produto_id)')}"},
    ),
    "dq_historico_produtos": _rules(
        "hist_produtos",
        {**_is_null("cliente_id", "produto_id", "nome_empresa", "produto_nome", "categoria_id"),
         "quantidade_consumida nao positiva": "quantidade_consumida <= 0",
         "receita_total negativa": "receita_total < 0"},
        {"chave (ano_mes, cliente_id, produto_id) duplicada":
             _dup("hist_produtos", "ano_mes", "cliente_id", "produto_id"),
         "soma quantidade != silver":
             f"abs({_n('hist_produtos', 'sum(quantidade_consumida)')} - {_n('details', 'sum(quantity)')})",
         "soma receita != silver":
             _cent(_n("hist_produtos", "sum(receita_total)"), _n("details", "sum(receita_item)"))},
    ),
    "dq_historico_volume": _rules(
        "volume_pct",
        {**_is_null("ano_mes", "cliente_id", "nome_empresa"),
         **{f"{c} nao positiva": f"{c} <= 0"
            for c in ("quantidade_pedidos", "quantidade_produtos_distintos", "quantidade_itens")},
         **{f"{c} negativa": f"{c} < 0" for c in ("receita_sem_desconto", "receita_total")},
         "bruto menor que liquido": "receita_sem_desconto < receita_total",
         "desconto_medio fora de [0, 1]": "desconto_medio < 0 OR desconto_medio > 1"},
        {"chave (ano_mes, cliente_id) duplicada": _dup("volume_pct", "ano_mes", "cliente_id"),
         "soma itens != silver": f"abs({_n('volume_pct', 'sum(quantidade_itens)')} - {_n('details', 'sum(quantity)')})",
         "soma bruto != silver": _cent(_n("volume_pct", "sum(receita_sem_desconto)"), _n("details", "sum(bruto)")),
         "soma receita != silver": _cent(_n("volume_pct", "sum(receita_total)"), _n("details", "sum(receita_item)")),
         "soma pedidos != silver":
             f"abs({_n('volume_pct', 'sum(quantidade_pedidos)')} - {_n('orders_', 'count(DISTINCT order_id)')})"},
    ),
    "dq_historico_metricas": _snapshot_rules(),
    "dq_produtos_associados": _rules(
        "associados",
        {"comprado igual ao acompanhante": "produto_comprado_id = produto_acompanhante_id",
         "pedido de 1 produto com acompanhante": "total_produtos_distintos = 1 AND produto_acompanhante_id IS NOT NULL",
         "par com total < 2": "produto_acompanhante_id IS NOT NULL AND total_produtos_distintos < 2",
         "outros produtos negativos": "quantidade_outros_produtos_distintos < 0",
         "produto_comprado_nome nulo": "produto_comprado_nome IS NULL",
         "quantidade_comprada nao positiva": "quantidade_comprada <= 0"},
        {"par duplicado": _dup("associados", "id_compra", "produto_comprado_id", "produto_acompanhante_id"),
         "pedidos faltando":
             f"{_n('orders_', 'count(DISTINCT order_id)')} - {_n('associados', 'count(DISTINCT id_compra)')}"},
    ),
    "dq_ticket_medio": _rules(
        "ticket",
        {"ano_mes nulo": "ano_mes IS NULL", "ticket_medio <= 0": "ticket_medio <= 0",
         "desconto_efetivo fora de [0, 1]": "desconto_efetivo < 0 OR desconto_efetivo > 1",
         "frete_por_pedido negativo": "frete_por_pedido < 0"},
        {"pedidos perdidos": f"{_n('orders_')} - {_n('ticket', 'sum(qtd_pedidos)')}"},
    ),
}


QUERIES = {
    **DQ,
    # cleaned layer
    "silver_customers": f"""
        SELECT customer_id, company_name, contact_name, country, region,
               {_nulls(contact_title='VARCHAR', address='VARCHAR', city='VARCHAR', postal_code='VARCHAR',
                       phone='VARCHAR', fax='VARCHAR')}
        FROM customers_""",
    "silver_orders": f"""
        SELECT o.order_id, o.customer_id, {_day('o.order_date')} AS order_date,
               {_day('s.shipped_date')} AS shipped_date, CAST(o.freight AS DOUBLE) AS freight,
               {_nulls(employee_id='INTEGER', required_date='VARCHAR', ship_via='INTEGER', ship_name='VARCHAR',
                       ship_address='VARCHAR', ship_city='VARCHAR', ship_region='VARCHAR',
                       ship_postal_code='VARCHAR', ship_country='VARCHAR')}
        FROM orders_ o LEFT JOIN shipped s USING (order_id)""",
    "silver_products": f"""
        SELECT product_id, product_name, supplier_id, category_id, quantity_per_unit,
               CAST(unit_price AS DOUBLE) AS unit_price, units_in_stock,
               {_nulls(units_on_order='INTEGER', reorder_level='INTEGER', discontinued='INTEGER')}
        FROM products_""",
    "silver_order_details": """
        SELECT order_id, product_id, CAST(unit_price AS DOUBLE) AS unit_price, quantity,
               CAST(discount AS DOUBLE) AS discount, CAST(receita_item AS DOUBLE) AS receita_item
        FROM details""",
    # analytical layer
    "gold_clientes": "SELECT * FROM clientes",
    "gold_produtos": "SELECT * FROM produtos",
    "gold_descontos": """
        SELECT * REPLACE (CAST(preco_unitario AS DOUBLE) AS preco_unitario,
                          CAST(maior_desconto AS DOUBLE) AS maior_desconto) FROM descontos""",
    "gold_ticket_medio": "SELECT * REPLACE (CAST(receita_total AS DOUBLE) AS receita_total) FROM ticket",
    "gold_historico_cliente_produtos": """
        SELECT * EXCLUDE (idx) REPLACE (CAST(receita_total AS DOUBLE) AS receita_total) FROM hist_produtos""",
    "gold_historico_cliente_volume": """
        SELECT * EXCLUDE (idx) REPLACE (CAST(receita_total AS DOUBLE) AS receita_total,
                                        CAST(receita_sem_desconto AS DOUBLE) AS receita_sem_desconto)
        FROM volume_pct""",
    "gold_produtos_associados": f"SELECT * REPLACE ({_day('data_compra')} AS data_compra) FROM associados",
    "gold_historico_cliente_metricas": "SELECT * FROM metricas",
    "periodos": f"""
        SELECT {_key('s')} AS ano_mes, {_key('s')} || '-01' AS inicio_mes_processado,
               {_day(f"last_day(CAST({_key('s')} || '-01' AS DATE))")} AS fim_mes_processado,
               {_key('s + 1')} || '-01' AS primeira_data_processamento,
               {', '.join(f"{_key(f's - {hi}')} AS inicio_{b}, {_key(f's - {lo}')} AS fim_{b}"
                          for b, (lo, hi) in BANDS.items())}
        FROM snaps""",
    "cobertura": f"""
        SELECT {_day('menor')} AS menor_data, {_day('maior')} AS maior_data,
               {_key('completo')} AS primeiro_mes_completo, {_key('completo + 8')} AS primeiro_retrato,
               {_key('ultimo')} AS ultimo_retrato, {_key('completo + 9')} || '-01' AS primeira_data_permitida,
               greatest(0, ultimo - completo - 7) AS retratos
        FROM cov""",
    # control figures
    "ctl_orders": """
        SELECT count(*) AS pedidos, count(*) FILTER (WHERE shipped_date IS NULL) AS sem_envio
        FROM orders_ LEFT JOIN shipped USING (order_id)""",
    "ctl_order_details": "SELECT count(*) AS itens, CAST(sum(receita_item) AS DOUBLE) AS receita FROM details",
    "ctl_descontos": """
        SELECT count(*) AS linhas, count(DISTINCT produto_id) AS produtos,
               count(DISTINCT CASE WHEN maior_desconto > 0 THEN produto_id END) AS produtos_com_desconto,
               CAST(max(maior_desconto) AS DOUBLE) AS maior_desconto
        FROM descontos""",
    "ctl_historico_produtos": """
        SELECT count(*) AS linhas, count(DISTINCT (cliente_id, produto_id)) AS pares,
               count(DISTINCT cliente_id) AS clientes, count(DISTINCT produto_id) AS produtos,
               CAST(sum(quantidade_consumida) AS BIGINT) AS unidades, CAST(sum(receita_total) AS DOUBLE) AS receita
        FROM hist_produtos""",
    "ctl_historico_volume": """
        SELECT count(*) AS linhas, count(DISTINCT cliente_id) AS clientes,
               CAST(sum(receita_sem_desconto) AS DOUBLE) AS receita_sem_desconto,
               CAST(sum(receita_total) AS DOUBLE) AS receita_total,
               CAST(sum(quantidade_itens) AS BIGINT) AS itens, CAST(sum(quantidade_pedidos) AS BIGINT) AS pedidos,
               1 - CAST(sum(receita_total) AS DOUBLE) / CAST(sum(receita_sem_desconto) AS DOUBLE) AS desconto_medio
        FROM volume""",
    "ctl_produtos_associados": f"""
        SELECT count(DISTINCT id_compra) AS pedidos,
               count(DISTINCT CASE WHEN total_produtos_distintos = 1 THEN id_compra END) AS pedidos_um_produto,
               count(produto_acompanhante_id) AS pares,
               count(*) FILTER (WHERE produto_acompanhante_id IS NULL) AS linhas_sem_acompanhante,
               {_day('min(data_compra)')} AS primeira_compra, {_day('max(data_compra)')} AS ultima_compra,
               max(total_produtos_distintos) AS maior_cesta
        FROM associados""",
    "ctl_ticket_global": """
        SELECT CAST(sum(receita_total) AS DOUBLE) AS receita, CAST(sum(qtd_pedidos) AS BIGINT) AS pedidos,
               round(CAST(sum(receita_total) AS DOUBLE) / CAST(sum(qtd_pedidos) AS DOUBLE), 2) AS ticket_medio_global
        FROM ticket""",
    "ctl_metricas": """
        SELECT ano_mes, count(*) AS clientes, count(*) FILTER (WHERE frequencia_compra_9m > 0) AS com_compra_9m,
               count(*) FILTER (WHERE NOT frequencia_compra_9m > 0) AS sem_compra_9m
        FROM metricas GROUP BY ano_mes""",
    # baskets
    "assoc_stats": f"SELECT {PARTNER} FROM assoc",
    "assoc_evidence": """
        SELECT produto_x, produto_y, pedidos_com_x_e_y, pedidos_com_outros, somente AS pedidos_somente, pct AS pct_somente,
               CASE WHEN somente = 0 THEN 'nunca_sozinhos' WHEN pct >= 70 THEN 'forte' WHEN pct >= 40 THEN 'parcial'
                    ELSE 'fraca' END AS evidencia
        FROM (SELECT *, pedidos_com_x_e_y - pedidos_com_outros AS somente,
                     CAST(pedidos_com_x_e_y - pedidos_com_outros AS DOUBLE) / pedidos_com_x_e_y * 100 AS pct
              FROM assoc)""",
    "assoc_top5": f"SELECT cart_id, {PARTNER}, ordem FROM top5",
    "assoc_stats_tiles": f"SELECT {PARTNER} FROM assoc",
    "assoc_top5_large_carts": f"SELECT cart_id, {PARTNER}, ordem FROM top5",
    "cart_suggestions": f"SELECT {SUGGESTION} FROM sugestoes",
    "cart_suggestions_ranked": f"SELECT {SUGGESTION}, posicao FROM sugestoes_ordem",
    "cart_suggestion_origins": """
        SELECT cart_id, produto_y, produto_x, p.produto_nome AS nome_x, pedidos_com_x, pedidos_com_x_e_y, pct_associacao,
               pedidos_com_outros, pct_outros,
               CAST(row_number() OVER (PARTITION BY cart_id, produto_y ORDER BY pct_associacao DESC, produto_x)
                    AS INTEGER) AS ordem_origem
        FROM top5 JOIN produtos p ON p.produto_id = produto_x""",
    "sql_parametrizado": """
        SELECT produto_comprado_id AS produto_x, count(DISTINCT id_compra) AS pedidos,
               count(DISTINCT CASE WHEN quantidade_outros_produtos_distintos > 2 THEN id_compra END)
                   AS pedidos_com_outros
        FROM associados WHERE ano_mes BETWEEN '1994-03' AND '1996-10' GROUP BY 1""",
    # consumption and offers
    "consumo_cliente": "SELECT * FROM consumo",
    "produtos_rank_cliente": """
        SELECT k.cliente_id, p.produto_id, p.produto_nome, coalesce(c.quantidade_total, 0) AS quantidade_total,
               CAST(row_number() OVER (PARTITION BY k.cliente_id ORDER BY coalesce(c.quantidade_total, 0) DESC,
                                       p.produto_nome, p.produto_id) AS INTEGER) AS posicao
        FROM (SELECT cliente_id FROM clientes
              WHERE contains(strip_accents(lower(cliente_id || ' ' || nome_empresa || ' ' || coalesce(nome_contato, '')
                             || ' ' || coalesce(cidade, '') || ' ' || coalesce(pais, ''))), 'nation_1')
              ORDER BY nome_empresa, cliente_id LIMIT 20) k JOIN produtos p ON TRUE
             LEFT JOIN consumo c ON c.cliente_id = k.cliente_id AND c.produto_id = p.produto_id""",
    "catalogo_alfabetico": "SELECT produto_id, produto_nome, categoria_nome, preco_unitario FROM produtos",
    "ofertas_mes": f"""
        SELECT ano_mes, produto_id, CAST(maior_desconto AS DOUBLE) AS oferta, {_offer('maior_desconto')} AS oferta_texto
        FROM descontos""",
    "meses_oferta": """
        SELECT DISTINCT ano_mes, substr(ano_mes, 6, 2) || '/' || substr(ano_mes, 3, 2) AS rotulo,
               CAST(ano_mes = (SELECT max(ano_mes) FROM descontos) AS INTEGER) AS selecionado
        FROM descontos""",
    "sugestoes_contexto": f"""
        SELECT r.cart_id, r.posicao, r.produto_id, r.nome_y AS produto_nome,
               round(r.indice_oportunidade, 6) + 0.0 AS indice_oportunidade, {CONTEXT}
        FROM (SELECT *, produto_y AS produto_id FROM sugestoes_ordem) r {CONTEXT_JOINS}""",
    "carrinho_contexto": f"""
        SELECT r.cart_id, r.produto_id, p.produto_nome, {CONTEXT}
        FROM (SELECT cart_id, product_id AS produto_id FROM carts) r {CONTEXT_JOINS}""",
    # search
    "busca_produtos": """
        SELECT * FROM produtos
        WHERE strip_accents(lower(coalesce(produto_nome, '') || ' ' || coalesce(categoria_nome, '') || ' '
                                  || coalesce(fornecedor_nome, ''))) LIKE '%ring%'""",
    "busca_clientes": """
        SELECT cliente_id, nome_empresa, nome_contato, cidade, pais,
               concat_ws(' · ', nullif(nome_contato, ''), nullif(cidade, ''), nullif(pais, '')) AS meta
        FROM clientes
        WHERE contains(strip_accents(lower(cliente_id || ' ' || nome_empresa || ' ' || coalesce(nome_contato, '') || ' '
                       || coalesce(cidade, '') || ' ' || coalesce(pais, ''))), 'nation_1')
        ORDER BY nome_empresa, cliente_id LIMIT 20""",
    # customers
    "meses_metricas": """
        SELECT DISTINCT ano_mes, substr(ano_mes, 6, 2) || '/' || substr(ano_mes, 3, 2) AS rotulo,
               CAST(ano_mes = (SELECT max(ano_mes) FROM metricas) AS INTEGER) AS selecionado,
               (['Janeiro', 'Fevereiro', 'Março', 'Abril', 'Maio', 'Junho', 'Julho', 'Agosto', 'Setembro',
                 'Outubro', 'Novembro', 'Dezembro'])[CAST(substr(ano_mes, 6, 2) AS INTEGER)]
                   || ' de ' || substr(ano_mes, 1, 4) AS nome
        FROM metricas""",
    "clientes_do_mes": "SELECT * FROM do_mes",
    "variacao": "SELECT ano_mes, cliente_id, metrica, comparacao_3x6, comparacao_3x9 FROM variacoes",
    "tendencias": "SELECT * FROM tendencias",
    "status_clientes": f"SELECT ano_mes, cliente_id, {STATES}, status, motivos FROM status_motivos",
    "status_enriquecido": "SELECT * FROM enriquecido",
    "filtro_clientes": """
        SELECT * FROM enriquecido
        WHERE (contains(lower(nome_cliente), 'build') OR contains(lower(cliente_id), 'build'))
          AND contains(lower(nome_empresa), 'customer#') AND status = 'ruim'""",
    "volume_9m": f"""
        SELECT e.cliente_id, {_key('e.m')} AS ano_mes, coalesce(v.quantidade_pedidos, 0) AS quantidade_pedidos,
               coalesce(CAST(v.receita_total AS DOUBLE), 0) AS receita_total,
               substr({_key('e.m')}, 6, 2) || '/' || substr({_key('e.m')}, 3, 2) AS rotulo
        FROM (SELECT DISTINCT cliente_id, s - k AS m
              FROM elegiveis JOIN (SELECT unnest(generate_series(0, 8)) AS k) t ON TRUE) e
             LEFT JOIN volume v ON v.cliente_id = e.cliente_id AND v.idx = e.m""",
    "papel_metrica": f"""
        SELECT t.ano_mes, t.cliente_id, s.status, t.metrica,
               CASE WHEN t.metrica IN ('frequencia_compra', 'receita_media') THEN
                        CASE WHEN list_contains(string_split(s.motivos, ','), t.metrica)
                             THEN 'Principal · participou do Status' ELSE 'Principal · não alterou o Status' END
                    WHEN t.metrica = 'quantidade_itens_media' THEN
                        CASE WHEN s.status = 'ruim' AND t.estado = 'diminuiu'
                             THEN 'Agravante · reforçou o Status Ruim' ELSE 'Contexto operacional' END
                    ELSE 'Contexto · não define o Status' END AS papel
        FROM tendencias t JOIN status_motivos s USING (ano_mes, cliente_id)""",
    "frase_status": f"""
        SELECT ano_mes, cliente_id, status,
               CASE status WHEN 'bom' THEN 'Frequência de compra e receita média aumentaram.' WHEN 'normal' THEN 'Frequência e receita permanecem dentro do comportamento normal.'
                    ELSE (CASE motivos
                        WHEN 'frequencia_compra' THEN 'A frequência de compra'
                        WHEN 'receita_media' THEN 'A receita média'
                        WHEN 'frequencia_compra,receita_media' THEN 'A frequência de compra e a receita média'
                        WHEN 'frequencia_compra,quantidade_itens_media'
                            THEN 'A frequência de compra e a quantidade comprada'
                        WHEN 'receita_media,quantidade_itens_media' THEN 'A receita média e a quantidade comprada'
                        ELSE 'A frequência de compra, a receita média e a quantidade comprada' END)
                      || CASE status WHEN 'atencao' THEN ' diminuiu; acompanhe a evolução deste cliente.' ELSE ' diminuíram, atendendo ao critério de risco.' END
               END AS frase
        FROM status_motivos""",
    "variacao_texto": f"""
        SELECT ano_mes, cliente_id, metrica, {_text('comparacao_3x6')} AS texto_3x6,
               {_text('comparacao_3x9')} AS texto_3x9, {_text('indice')} AS texto_media
        FROM tendencias""",
    "interpretacao": f"""
        SELECT ano_mes, cliente_id, metrica, estado,
               CASE estado WHEN 'normal' THEN 'A variação média (3m contra 6m e 9m) permaneceu dentro da tolerância de 20%.'
                    WHEN 'aumentou' THEN 'A variação média (3m contra 6m e 9m) superou +20% em '
                    ELSE 'A variação média (3m contra 6m e 9m) ficou abaixo de −20% em ' END
               || CASE WHEN estado = 'normal' THEN '' WHEN modo = 'diferenca' THEN 'pontos percentuais.'
                       ELSE 'percentual.' END AS interpretacao
        FROM tendencias""",
    "meses_ativos": f"""
        SELECT {_key('s')} AS ano_mes, cliente_id,
               {', '.join(f'CAST(ativos_{b} AS INTEGER) AS meses_ativos_{b}' for b in BANDS)}
        FROM somas""",
    # actions
    "acoes_base": f"SELECT {ACTION} FROM acoes",
    "acoes_score": f"SELECT {ACTION}, score FROM acoes_score",
    "acoes_ranked": f"""
        SELECT {ACTION}, score,
               CAST(row_number() OVER (PARTITION BY cliente_id, ano_mes ORDER BY score DESC,
                    a.oferta DESC NULLS LAST, produto_nome, produto_id) AS INTEGER) AS posicao
        FROM acoes_score a""",
    # stored tables
    "metricas_avanco": f"SELECT m.* FROM metricas m, cov WHERE m.ano_mes BETWEEN {_key('cov.ultimo - 2')} AND {_key('cov.ultimo')}",
    "assoc_stats_mensal": f"SELECT {PARTNER} FROM assoc",
    "ctl_na_gravacao": "SELECT count(*) AS itens, CAST(sum(receita_item) AS DOUBLE) AS receita FROM details JOIN orders_ USING (order_id)",
    "troca_atomica": """
        SELECT ano_mes, cliente_id, nome_empresa, CAST(receita_sem_desconto AS DOUBLE) AS receita_sem_desconto,
               CAST(receita_total AS DOUBLE) AS receita_total, desconto_medio, quantidade_pedidos,
               quantidade_produtos_distintos, quantidade_itens, count(*) OVER (PARTITION BY ano_mes) AS linhas_apos_falha
        FROM volume_pct""",
    "volume_meses_escolhidos": """
        SELECT ano_mes, cliente_id, nome_empresa, CAST(receita_sem_desconto AS DOUBLE) AS receita_sem_desconto,
               CAST(receita_total AS DOUBLE) AS receita_total, desconto_medio, quantidade_pedidos,
               quantidade_produtos_distintos, quantidade_itens
        FROM volume_pct WHERE ano_mes IN (SELECT arg_max(ano_mes, (ticket_medio, ano_mes)) FROM ticket GROUP BY left(ano_mes, 4))""",
    "meses_gravados": """
        SELECT ano_mes, CAST(row_number() OVER (ORDER BY ano_mes DESC) AS INTEGER) AS posicao
        FROM (SELECT DISTINCT ano_mes FROM volume)""",
    "ticket_em_baldes": "SELECT * REPLACE (CAST(receita_total AS DOUBLE) AS receita_total) FROM ticket",
    "busca_indice": """
        SELECT t.termo, p.produto_id, p.produto_nome, p.categoria_nome
        FROM produtos p JOIN (VALUES (' RÌNG ', 'ring'), ('stéel', 'steel'), ('Brand#1', 'brand#1'), ('xy', 'xy'), ('k', 'k'),
                                     ('almond  blue', 'almond  blue')) t(termo, procurado)
          ON contains(lower(p.produto_nome || ' ' || p.categoria_nome), t.procurado)""",
    "bronze_quarentena": """
        SELECT motivo, count(*) AS linhas, CASE WHEN motivo = '' THEN sum(quantity) END::BIGINT AS unidades
        FROM (SELECT quantity, CASE WHEN order_id % 97 = 0 THEN 'campos' WHEN order_id % 89 = 0 THEN 'quantity' ELSE '' END AS motivo
              FROM lines)
        GROUP BY motivo""",
}

# The same results from stored tables.
QUERIES["regras_mensais"] = " UNION ALL ".join(f"SELECT '{name[3:]}' AS tabela, * FROM ({text})" for name, text in DQ.items())
QUERIES["cobertura_rodapes"] = QUERIES["cobertura"]
QUERIES["meses_oferta_gravados"] = QUERIES["meses_oferta"]


def sql(name: str) -> str:
    """The query with the subqueries it uses, in definition order."""
    needed: set[str] = set()
    pending = [QUERIES[name]]
    while pending:
        words = set(re.findall(r"\w+", pending.pop()))
        new = [c for c in CTES if c in words and c not in needed]
        needed.update(new)
        pending += [CTES[c] for c in new]
    if not needed:
        return QUERIES[name]
    parts = ",\n".join(f"{c} AS ({CTES[c]})" for c in CTES if c in needed)
    return f"WITH {parts}\n{QUERIES[name]}"
