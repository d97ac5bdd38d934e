"""Recurrence, category bonus, offers and search."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from balcao.operators import actions, offers, search
from balcao.operators.snapshots import Range

APRIL = date(1998, 2, 1)
SELECTED = 1998 * 12 + 1


@pytest.fixture
def parts(spark):
    purchases = spark.createDataFrame(
        [("A", 1, "1998-01"), ("A", 1, "1998-01"), ("A", 2, "1997-05"), ("A", 3, "1998-02"), ("A", 4, "1997-04"),
         ("A", 5, "1997-12"), ("A", 5, "1997-11"), ("A", 6, "1997-06")]
        + [("B", 1, f"1997-{m:02d}") for m in range(5, 13)] + [("B", 1, "1998-01")],
        "cliente_id string, produto_id long, ano_mes string",
    )
    products = spark.createDataFrame([(i, f"p{i}") for i in range(1, 7)], "product_id long, product_name string")
    discounts = spark.createDataFrame(
        [("1998-02", 1, 4, Decimal("0.05")), ("1998-01", 2, 4, Decimal("0.20")), ("1998-02", 5, 7, Decimal("0.00"))],
        "ano_mes string, produto_id long, categoria_id int, maior_desconto decimal(4,2)",
    )
    span = Range(F.lit(SELECTED), F.lit(SELECTED))
    return actions.recurrence(purchases, actions.product_calendar(products, discounts), span)


def test_recurrence(parts):
    rows = {(r.cliente_id, r.produto_id): r for r in parts.collect()}
    assert set(rows) == {("A", 1), ("A", 2), ("A", 5), ("A", 6), ("B", 1)}  # neither the month itself nor ten months back
    assert [rows["A", p].frequencia for p in (1, 2, 5)] == [11, 11, 22]
    assert rows["B", 1].frequencia == 100 and rows["B", 1].meses_com_compra == 9
    assert {r.ano_mes for r in rows.values()} == {"1998-02"}
    assert rows["A", 1].oferta == Decimal("0.05") and rows["A", 5].oferta == 0
    assert rows["A", 2].oferta is None and rows["A", 2].categoria_id == 4  # category from another month


def test_category_bonus_and_order(parts):
    rows = actions.ranked(actions.with_score(parts)).filter("cliente_id = 'A'").orderBy("posicao").collect()
    assert [(r.produto_id, r.score) for r in rows] == [(1, 22), (5, 22), (2, 22), (6, 11)]


def test_offer_texts(spark):
    df = spark.createDataFrame([(Decimal("0.05"),), (Decimal("0.00"),), (None,)], "d decimal(4,2)")
    assert [r[0] for r in df.select(offers.offer_text(F.col("d"))).collect()] == ["5,0%", "Sem desconto", "Sem oferta"]


def test_offers_belong_to_their_month(spark):
    discounts = spark.createDataFrame(
        [("1997-01", 1, Decimal("0.10")), ("1997-03", 2, Decimal("0.00"))],
        "ano_mes string, produto_id long, maior_desconto decimal(4,2)",
    )
    out = {(r.ano_mes, r.produto_id): r.oferta_texto for r in offers.monthly_offers(discounts).collect()}
    assert out == {("1997-01", 1): "10,0%", ("1997-03", 2): "Sem desconto"}
    months = {r.ano_mes: (r.rotulo, r.selecionado) for r in offers.month_list(discounts).collect()}
    assert months == {"1997-01": ("01/97", 0), "1997-03": ("03/97", 1)}


def test_product_search(spark):
    rows = [(1, "Queijo São João", "Laticínios", None), (2, "Pão", None, "Padaria Ñandú"), (3, "CAFÉ", "x", "y")]
    df = spark.createDataFrame(rows, "produto_id long, produto_nome string, categoria_nome string, fornecedor_nome string")

    def found(term):
        return sorted(r.produto_id for r in search.search_products(df, term).collect())

    assert found(" sao ") == [1] and found("LATICINIOS") == [1] and found("nandu") == [2]
    assert found("café") == [3] and found("") == [1, 2, 3] and found(None) == [1, 2, 3] and found("%") == []


def test_client_search(spark):
    rows = [(f"C{i:02d}", f"Empresa {i:02d}", "Zé" if i % 2 else "", "Mossoró", None) for i in range(30)]
    df = spark.createDataFrame(rows, "cliente_id string, nome_empresa string, nome_contato string, cidade string, pais string")
    out = search.search_clients(df, "mossoro").collect()
    assert [r.nome_empresa for r in out] == [f"Empresa {i:02d}" for i in range(20)]
    assert out[0].meta == "Mossoró" and out[1].meta == "Zé · Mossoró"
    assert search.search_clients(df, "  ").count() == 0 and search.search_clients(df, "ze").count() == 15


def test_rows_meet_their_customer_folded(spark):
    """Customers are shuffled before their months are unfolded, and both rankings find them in place."""
    purchases = spark.createDataFrame([("A", 1, "1998-01"), ("B", 2, "1998-01")], "cliente_id string, produto_id long, ano_mes string")
    products = spark.createDataFrame([(1, "á"), (2, "b")], "product_id long, product_name string")
    discounts = spark.createDataFrame([("1998-02", 1, 4, Decimal("0.05"))], "ano_mes string, produto_id long, categoria_id int, maior_desconto decimal(4,2)")
    clients = spark.createDataFrame([("A",)], "cliente_id string")
    span = Range(F.lit(SELECTED), F.lit(SELECTED))
    rows = actions.recurrence(purchases, actions.product_calendar(products, discounts, placed=True), span, clients)
    ranked = actions.ranked(actions.with_score(rows))
    plan = ranked._jdf.queryExecution().executedPlan().toString().split("Generate")[0]
    assert "Window" in plan and "Exchange" not in plan
    assert [(r.cliente_id, r.produto_id, r.oferta) for r in ranked.collect()] == [("A", 1, Decimal("0.05"))]
