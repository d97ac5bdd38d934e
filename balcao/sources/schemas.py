"""Columns of every layer, stated once.

Identifiers are 64 bit: order numbers outgrow 32 bit long before 100 TB.
"""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

# Columns of the raw ';'-separated files, in file order.
BRONZE = {
    "customers": [
        "customer_id", "company_name", "contact_name", "contact_title", "address", "city",
        "region", "postal_code", "country", "phone", "fax",
    ],
    "orders": [
        "order_id", "customer_id", "employee_id", "order_date", "required_date", "shipped_date",
        "ship_via", "freight", "ship_name", "ship_address", "ship_city", "ship_region",
        "ship_postal_code", "ship_country",
    ],
    "products": [
        "product_id", "product_name", "supplier_id", "category_id", "quantity_per_unit",
        "unit_price", "units_in_stock", "units_on_order", "reorder_level", "discontinued",
    ],
    "order_details": ["order_id", "product_id", "unit_price", "quantity", "discount"],
    "categories": ["category_id", "category_name", "description", "picture"],
    "suppliers": [
        "supplier_id", "company_name", "contact_name", "contact_title", "address", "city",
        "region", "postal_code", "country", "phone", "fax", "homepage",
    ],
}

# Typed columns of the cleaned layer.
SILVER = {
    "customers": {c: "text" for c in BRONZE["customers"]},
    "orders": {
        "order_id": "bigint", "customer_id": "text", "employee_id": "int", "order_date": "date",
        "required_date": "date", "shipped_date": "date", "ship_via": "int",
        "freight": "decimal(10,2)", "ship_name": "text", "ship_address": "text",
        "ship_city": "text", "ship_region": "text", "ship_postal_code": "text",
        "ship_country": "text",
    },
    "products": {
        "product_id": "bigint", "product_name": "string", "supplier_id": "bigint",
        "category_id": "int", "quantity_per_unit": "string", "unit_price": "decimal(10,2)",
        "units_in_stock": "int", "units_on_order": "int", "reorder_level": "int",
        "discontinued": "int",
    },
    "order_details": {
        "order_id": "bigint", "product_id": "bigint", "unit_price": "decimal(10,2)",
        "quantity": "int", "discount": "decimal(4,2)",
    },
}

MONEY = "decimal(14,2)"
# Sums over a whole table or month.
TOTAL = "decimal(38,2)"
REVENUE = "decimal(12,2)"

KEYS = {
    "customers": ["customer_id"],
    "orders": ["order_id"],
    "products": ["product_id"],
    "order_details": ["order_id", "product_id"],
    "clientes": ["cliente_id"],
    "produtos": ["produto_id"],
    "descontos": ["ano_mes", "produto_id"],
    "produtos_associados": ["id_compra", "produto_comprado_id", "produto_acompanhante_id"],
    "ticket_medio": ["ano_mes"],
    "historico_cliente_produtos": ["ano_mes", "cliente_id", "produto_id"],
    "historico_cliente_volume": ["ano_mes", "cliente_id"],
    "historico_cliente_metricas": ["ano_mes", "cliente_id"],
}

_SNAPSHOT = [
    "frequencia_compra", "receita_media", "receita_sem_desconto_media", "desconto_medio", "quantidade_pedidos_media",
    "quantidade_produtos_distintos_media", "quantidade_itens_media",
]

# Declared once: monthly tables are read with it, so that no file is opened to learn its columns.
GOLD = {
    "clientes": "cliente_id string, nome_empresa string, nome_contato string, cargo_contato string, endereco string, "
    "cidade string, regiao string, cep string, pais string, telefone string, fax string",
    "produtos": "produto_id bigint, produto_nome string, categoria_id int, categoria_nome string, "
    "fornecedor_id bigint, fornecedor_nome string, quantidade_por_unidade string, preco_unitario decimal(10,2), "
    "unidades_em_estoque int, unidades_em_pedido int, nivel_reposicao int, descontinuado int",
    "descontos": "ano_mes string, produto_id bigint, produto_nome string, categoria_id int, "
    "preco_unitario decimal(10,2), maior_desconto decimal(4,2)",
    "ticket_medio": f"ano_mes string, qtd_pedidos bigint, receita_total {TOTAL}, ticket_medio {REVENUE}, "
    "unidades_por_pedido double, itens_por_pedido double, preco_medio double, desconto_efetivo double, "
    "frete_por_pedido double",
    "historico_cliente_produtos": "ano_mes string, cliente_id string, nome_empresa string, produto_id bigint, "
    f"produto_nome string, categoria_id int, quantidade_consumida bigint, receita_total {MONEY}",
    "historico_cliente_volume": f"ano_mes string, cliente_id string, nome_empresa string, receita_sem_desconto {MONEY}, "
    f"receita_total {MONEY}, desconto_medio double, quantidade_pedidos bigint, "
    "quantidade_produtos_distintos bigint, quantidade_itens bigint",
    "produtos_associados": "ano_mes string, data_compra date, id_compra bigint, id_cliente string, "
    "produto_comprado_id bigint, produto_comprado_nome string, quantidade_comprada int, "
    "produto_acompanhante_id bigint, produto_acompanhante_nome string, quantidade_acompanhante int, "
    "total_produtos_distintos bigint, quantidade_outros_produtos_distintos bigint",
    "historico_cliente_metricas": "ano_mes string, cliente_id string, nome_empresa string, "
    + ", ".join(f"{metric}_{band} double" for band in ("3m", "6m", "9m") for metric in _SNAPSHOT),
}


def raw_schema(table: str) -> StructType:
    """All-text schema: codes keep their leading zeros, nothing is guessed."""
    return StructType([StructField(c, StringType()) for c in BRONZE[table]])
