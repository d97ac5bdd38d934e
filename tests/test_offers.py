"""What is shown beside a line: category, price, consumption and the month's offer."""

from __future__ import annotations

import re

from balcao.operators import offers


def _shown(spark):
    rows = spark.createDataFrame([(1, 10), (1, 11), (2, 10), (3, 10), (4, None), (5, 12), (9, 10)], "cart_id long, produto_id long")
    context = spark.createDataFrame(
        [(1, "A", "1997-04"), (2, "A", "1997-05"), (3, "B", None), (4, "B", "1997-04"), (5, "A", "1997-04")],
        "cart_id long, cliente_id string, ano_mes string",
    )
    catalogue = spark.createDataFrame(
        [(10, "ten", 1.0), (11, "eleven", 2.0), (11, "eleven", 2.5)], "produto_id long, categoria_nome string, preco_unitario double"
    )
    units = spark.createDataFrame([("A", 10, 7), ("A", 12, None)], "cliente_id string, produto_id long, quantidade_total long")
    # A month with two rows, one without a discount, rows without month or product.
    discounts = spark.createDataFrame(
        [("1997-04", 10, 0.1), ("1997-04", 10, 0.2), ("1997-05", 10, None), (None, 10, 0.3), ("1997-04", None, 0.4), ("1997-04", 11, 0.0)],
        "ano_mes string, produto_id long, maior_desconto double",
    )
    return offers.in_context(rows, context, catalogue, units, discounts)


def test_offers_of_the_month_beside_each_line(spark):
    shown = _shown(spark).select("cart_id", "produto_id", "categoria_nome", "preco_unitario", "oferta", "consumo_cliente", "oferta_texto")
    assert sorted((tuple(r) for r in shown.collect()), key=repr) == sorted(
        [
            (1, 10, "ten", 1.0, 0.1, 7, "10,0%"),
            (1, 10, "ten", 1.0, 0.2, 7, "20,0%"),
            (1, 11, "eleven", 2.0, 0.0, 0, "Sem desconto"),
            (1, 11, "eleven", 2.5, 0.0, 0, "Sem desconto"),
            (2, 10, "ten", 1.0, None, 7, "Sem oferta"),
            (3, 10, "ten", 1.0, None, 0, "Sem oferta"),
            (4, None, None, None, None, 0, "Sem oferta"),
            (5, 12, None, None, None, 0, "Sem oferta"),
        ],
        key=repr,
    )


def test_lines_are_not_shuffled_by_month_and_product(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = _shown(spark)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    joins = re.findall(r"Join \[([^\]]*)\]", plan)
    assert len(joins) == 4 and not any("ano_mes" in j for j in joins)


def test_lines_are_dealt_by_product_only(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = _shown(spark)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    dealt = [re.sub(r"#\w+", "", keys) for keys in re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)]
    assert not any("cliente_id" in keys and "produto_id" in keys for keys in dealt)


def test_consumption_beside_lines(spark):
    """As a join gives it: rows that occur twice, and nothing for lines without a customer or a product."""
    lines = spark.createDataFrame([(1, 10, "A"), (2, 10, "A"), (3, 11, "A"), (4, None, "A"), (5, 10, None), (6, 12, "A")], "cart_id long, produto_id long, cliente_id string")
    units = spark.createDataFrame(
        [("A", 10, 7), ("A", 10, 8), ("A", None, 9), (None, 10, 9), ("A", 12, None), ("B", 11, 1)], "cliente_id string, produto_id long, quantidade_total long"
    )
    found = offers._beside_units(lines, units).select("cart_id", "produto_id", "cliente_id", "quantidade_total")
    joined = lines.join(units, ["cliente_id", "produto_id"], "left").select(found.columns)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, joined.collect())) and found.count() == 8
