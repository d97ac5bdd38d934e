"""Raw files, typing and the analytical tables on hand-made rows."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from balcao.operators import gold, silver
from balcao.sources import readers


def test_raw_file_keeps_codes_and_blanks(spark, tmp_path):
    path = tmp_path / "customers.csv"
    path.write_text(
        "customer_id;company_name;contact_name;contact_title;address;city;region;postal_code;country;phone;fax\n"
        'A1;Casa, Filhos;Ana;Dona;Rua São João 1;Mossoró;;05021;Brasil;1; \n'
        'A2;"";Bia;;x;y;RN;S-1;Brasil;2;3\n',
        encoding="utf-8",
    )
    rows = silver.customers(readers.read_raw(spark, "customers", str(path))).orderBy("customer_id").collect()
    assert rows[0].postal_code == "05021" and rows[0].region is None
    assert rows[0].company_name == "Casa, Filhos" and rows[0].city == "Mossoró"
    assert rows[0].fax == " "  # only an empty text is missing
    assert rows[1].company_name is None


def test_raw_orders_are_typed(spark, tmp_path):
    path = tmp_path / "orders.csv"
    path.write_text(
        "order_id;customer_id;employee_id;order_date;required_date;shipped_date;ship_via;freight;ship_name;"
        "ship_address;ship_city;ship_region;ship_postal_code;ship_country\n"
        "10248;VINET;5;1996-07-04;1996-08-01;;3;32.38;Vins;Rua 1;Reims;;51100;France\n"
    )
    row = silver.orders(readers.read_raw(spark, "orders", str(path))).first()
    assert (row.order_id, row.order_date, row.shipped_date) == (10248, date(1996, 7, 4), None)
    assert row.freight == Decimal("32.38") and row.ship_region is None


def test_products_keep_blank_text(spark):
    raw = spark.createDataFrame([("7", "", "2", "3.456")], "product_id string, product_name string, category_id string, unit_price string")
    row = silver.products(raw).first()
    assert row.product_name == "" and row.unit_price == Decimal("3.46") and row.category_id == 2


def test_net_revenue_is_exact(spark):
    raw = spark.createDataFrame([(1, 1, "9.99", 3, "0.15")], "order_id int, product_id int, unit_price string, quantity int, discount string")
    row = silver.order_details(raw).first()
    assert row.receita_item == Decimal("25.47")  # 25.4745


def test_optional_table(spark, tmp_path):
    assert readers.read_optional(spark, str(tmp_path / "none")) is None
    spark.range(3).write.parquet(str(tmp_path / "some"))
    assert readers.read_optional(spark, str(tmp_path / "some")).count() == 3


def test_parameterised_sql(spark):
    df = spark.createDataFrame([("1997-01", 1), ("1997-02", 2)], "ano_mes string, n int")
    out = readers.query(spark, "SELECT n FROM {t} WHERE ano_mes = :m", {"m": "1997-02"}, t=df)
    assert [r.n for r in out.collect()] == [2]


def test_product_without_category_stays(spark, make_sales):
    *_, products = make_sales({1: ("A", "1997-01-01")}, [(1, 5, 10, 1, 0)], {5: None})
    categories = spark.createDataFrame([(1, "Bebidas")], "category_id int, categoria_nome string")
    suppliers = spark.createDataFrame([], "supplier_id long, fornecedor_nome string")
    row = gold.produtos(products, categories, suppliers).first()
    assert row.produto_id == 5 and row.categoria_nome is None


def test_discount_is_weighted_by_value(make_sales):
    orders, details, customers, _ = make_sales(
        {1: ("A", "1997-01-05"), 2: ("A", "1997-01-20")},
        [(1, 1, 10, 10, 0.10), (2, 2, 30, 30, 0.20)],
    )
    row = gold.historico_cliente_volume(orders, details, customers).first()
    assert row.receita_sem_desconto == Decimal("1000.00") and row.receita_total == Decimal("810.00")
    assert row.desconto_medio == 0.19
    assert (row.quantidade_pedidos, row.quantidade_produtos_distintos, row.quantidade_itens) == (2, 2, 40)


def test_nothing_sold_has_no_discount(make_sales):
    orders, details, customers, _ = make_sales({1: ("A", "1997-01-05")}, [(1, 1, 0, 10, 0.10)])
    assert gold.historico_cliente_volume(orders, details, customers).first().desconto_medio == 0.0


def test_ticket_does_not_repeat_freight(make_sales):
    orders, details, *_ = make_sales(
        {1: ("A", "1997-01-05"), 2: ("B", "1997-01-09")},
        [(1, 1, 10, 1, 0), (1, 2, 20, 2, 0.5), (2, 1, 10, 3, 0)],
    )
    row = gold.ticket_medio(orders, details).first()
    assert row.qtd_pedidos == 2 and row.frete_por_pedido == 1.0
    assert row.receita_total == Decimal("60.00") and row.ticket_medio == Decimal("30.00")
    assert row.itens_por_pedido == 1.5 and row.unidades_por_pedido == 3.0
    assert row.preco_medio == 13.33 and row.desconto_efetivo == 0.25


def test_highest_discount_of_the_month(make_sales):
    sales = make_sales(
        {1: ("A", "1997-01-05"), 2: ("B", "1997-01-09"), 3: ("B", "1997-02-01")},
        [(1, 1, 10, 1, 0.05), (2, 1, 10, 1, 0.10), (3, 1, 10, 1, 0)],
    )
    out = gold.descontos(sales[0], sales[1], sales[3]).orderBy("ano_mes").collect()
    assert [(r.ano_mes, r.maior_desconto) for r in out] == [("1997-01", Decimal("0.10")), ("1997-02", Decimal("0.00"))]


def test_rounding_goes_away_from_zero(spark):
    from balcao.functions.numbers import ptbr_number, rounded

    df = spark.createDataFrame([(2.5,), (-2.5,), (0.125,), (1234567.86,)], "x double")
    assert [r[0] for r in df.select(rounded(F.col("x"), 0)).collect()] == [3.0, -3.0, 0.0, 1234568.0]
    assert df.select(rounded(F.col("x"), 2)).collect()[2][0] == 0.13
    assert df.select(ptbr_number(F.col("x"), 1)).collect()[3][0] == "1.234.567,9"


@pytest.mark.parametrize("key, label, name", [("1997-04", "04/97", "Abril de 1997"), ("2001-12", "12/01", "Dezembro de 2001")])
def test_month_texts(spark, key, label, name):
    from balcao.functions import months as M

    row = spark.createDataFrame([(key,)], "m string").select(
        M.month_label(F.col("m")), M.month_name(F.col("m"), capital=True), M.key_of_index(M.index_of_key(F.col("m")))
    ).first()
    assert tuple(row) == (label, name, key)
