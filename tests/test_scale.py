"""Cases beyond the test data: large totals, unknown customers, other scripts, plans and declared types."""

from __future__ import annotations

import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from balcao.operators import actions, carts, controls, gold, search, snapshots
from balcao.plans.model import Model
from balcao.sources.schemas import GOLD

FOLDER = "/root/testdata/sf0.001"
given = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


def test_totals_above_a_million_millions(spark):
    rows = spark.createDataFrame([(Decimal("999999999999.99"),)] * 3, "receita_total decimal(14,2)")
    rows = rows.withColumns({"receita_item": F.col("receita_total"), "qtd_pedidos": F.lit(1)})
    assert controls.order_details(rows).first().receita == Decimal("2999999999999.97")
    assert controls.ticket_global(rows).first().receita == Decimal("2999999999999.97")


def test_month_total_above_a_million_millions(spark, make_sales):
    orders, details, *_ = make_sales({i: ("A", "1997-01-05") for i in range(3)}, [(i, 1, 1, 1, 0) for i in range(3)])
    details = details.withColumn("receita_item", F.lit("900000000000.00").cast("decimal(14,2)"))
    details = details.withColumn("unit_price", F.col("receita_item"))
    row = gold.ticket_medio(orders, details.withColumn("receita_item", F.col("receita_item"))).select("receita_total", "qtd_pedidos").first()
    assert (row.receita_total, row.qtd_pedidos) == (Decimal("2700000000000.00"), 3)


def test_orders_of_unknown_customers(spark, make_sales, monkeypatch):
    months = [f"1996-{m:02d}" for m in range(7, 13)] + [f"1997-{m:02d}" for m in range(1, 8)]
    sales = {i: ("A" if i % 2 else "X", f"{m}-{d}") for i, (m, d) in enumerate((m, d) for m in months for d in ("01", "02", "28"))}
    orders, details, customers, products = make_sales(sales, [(i, 1 + i % 3, 5, 2, 0) for i in sales])
    known = customers.filter("customer_id != 'X'")
    model = Model(spark, FOLDER)
    vars(model).update(orders=orders, details=details, named_customers=known, products=products)
    assert {r.cliente_id for r in model.consumo.collect()} == {"A"}
    assert {r.cliente_id for r in model.acoes.collect()} == {"A"}
    assert {r.cliente_id for r in snapshots.volume_series(orders, details, known).collect()} == {"A"}
    assert {r.cliente_id for r in snapshots.historico_cliente_metricas(orders, details, known).collect()} == {"A"}
    shelf = products.select(F.col("product_id").alias("produto_id"), F.col("product_name").alias("produto_nome"))
    asked = spark.createDataFrame([("X",), ("A",)], "cliente_id string")
    units = {(r.cliente_id, r.produto_id): r.quantidade_total for r in carts.ranked_catalogue(shelf, model.consumo, asked).collect()}
    assert len(units) == 6 and all((n == 0) == (c == "X") for (c, _), n in units.items())


def test_series_holds_the_nine_months_of_every_snapshot(spark, make_sales):
    days = ["1996-07-01", "1996-09-10", "1997-02-03", "1997-02-04", "1997-05-30", "1997-06-30"]
    orders, details, customers, _ = make_sales({i: ("A", d) for i, d in enumerate(days)}, [(i, 1, 10, 1, 0) for i in range(6)])
    rows = {r.ano_mes: (r.quantidade_pedidos, float(r.receita_total)) for r in snapshots.volume_series(orders, details, customers).collect()}
    assert sorted(rows) == [f"1996-{m:02d}" for m in range(7, 13)] + [f"1997-{m:02d}" for m in range(1, 7)]
    assert rows["1997-02"] == (2, 20.0) and rows["1997-03"] == (0, 0.0)


def test_search_in_other_scripts(spark):
    rows = spark.createDataFrame([(1, "한국 café", None, None), (2, "क़लम", None, None)], "produto_id long, produto_nome string, categoria_nome string, fornecedor_nome string")
    found = {t: [r.produto_id for r in search.search_products(rows, t).collect()] for t in ("한국", "CAFE", "café", "क़लम")}
    assert found == {"한국": [1], "CAFE": [1], "café": [1], "क़लम": [2]}


def test_distinct_counts_copy_no_line(make_sales):
    orders, details, *_ = make_sales({1: ("A", "1997-01-05"), 2: ("A", "1997-01-06")}, [(1, 1, 5, 10, 0), (2, 1, 5, 30, 0), (2, 2, 5, 1, 0)])
    volume = gold.monthly_volume(orders, details)
    assert "Expand" not in volume._jdf.queryExecution().toString()
    row = volume.first()
    assert (row.quantidade_pedidos, row.quantidade_produtos_distintos, row.quantidade_itens) == (2, 2, 41)


@given
def test_a_monthly_run_reads_its_months_only(spark):
    model = Model(spark, FOLDER)
    period = snapshots.period_of("1997-05-01")
    one = snapshots.historico_cliente_metricas(model.orders, model.details, model.named_customers, snapshots.single_month(period))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate," in plan and plan.count("LessThan(o_orderdate,1997-05-01") == 2
    every = model.metricas.filter("ano_mes = '1997-04'")
    assert one.count() == every.count() > 0 and one.exceptAll(every).isEmpty()


@given
@pytest.mark.parametrize("table,name", [
    ("clientes", "clientes"), ("produtos", "produtos"), ("descontos", "descontos"), ("ticket_medio", "ticket_medio"),
    ("historico_cliente_produtos", "historico_produtos"), ("historico_cliente_volume", "historico_volume"),
    ("produtos_associados", "associados"), ("historico_cliente_metricas", "metricas"),
])
def test_declared_types(spark, table, name):
    declared = spark.createDataFrame([], GOLD[table])
    assert getattr(Model(spark, FOLDER), name).dtypes == declared.dtypes


def test_one_product_in_a_third_of_all_orders(make_sales):
    sales = {i: ("A", f"1997-{1 + i % 6:02d}-01") for i in range(60)}
    items = [(i, 1, 5, 1, 0) for i in range(0, 60, 3)] + [(i, 2 + i % 7, 5, 1, 0) for i in range(60)]
    orders, details, _, products = make_sales(sales, items)
    from balcao.operators import baskets

    stats = baskets.association_stats(orders, details, products)
    top = carts.top_partners(details.select(F.col("order_id").alias("cart_id"), "product_id"), stats)
    assert top.filter("ordem > 5").isEmpty() and top.filter("produto_x = 1").count() > 0


def test_a_later_month_in_the_base_is_found(spark):
    from balcao.operators import quality
    from balcao.operators.quality import SNAPSHOT_AMOUNTS, SNAPSHOT_RANGES

    metrics = {f"{n}_{b}": F.lit(0.0) for n in SNAPSHOT_RANGES + SNAPSHOT_AMOUNTS for b in ("3m", "6m", "9m")}
    rows = spark.createDataFrame([("1997-04", "A", "a"), ("1997-04", "A", "a")], "ano_mes string, cliente_id string, nome_empresa string")
    months = spark.createDataFrame([("1997-03",)], "ano_mes string")
    base = spark.createDataFrame([("1997-04",), ("1997-05",)], "ano_mes string")
    eligible = spark.createDataFrame([(5,)], "valor long")
    report = quality.historico_cliente_metricas(rows.withColumns(metrics), months, F.lit("1997-04"), eligible, base)
    found = {r.regra: r.violacoes for r in report.collect() if r.violacoes}
    assert found == {
        "base com mes posterior": 1, "linhas fora dos meses processados": 2,
        "chave (ano_mes, cliente_id) duplicada": 1, "clientes != populacao elegivel": 3,
    }


@given
@pytest.mark.parametrize("name,scans", [("dq_historico_volume", 2), ("dq_historico_produtos", 2), ("dq_historico_metricas", 1)])
def test_a_report_computes_its_table_once(spark, name, scans):
    from balcao.plans import catalog

    plan = catalog.run(name, spark, FOLDER)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("l_extendedprice") and sum("lineitem.parquet" in line for line in plan.split("\n") if "FileScan" in line) <= scans


@given
@pytest.mark.parametrize("name", ["gold_historico_cliente_metricas", "dq_historico_metricas"])
def test_snapshots_are_not_grouped_one_by_one(spark, name):
    from balcao.plans import catalog

    plan = catalog.run(name, spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    grouped = [line for line in plan.split("\n") if "Aggregate [" in line]
    assert grouped and not any("mes_idx" in line.split("]")[0] for line in grouped)
    # The report folds a customer's years; its months are bits.
    assert name != "dq_historico_metricas" or "bit_or" in plan


@given
def test_months_of_a_customer_meet_the_register_unsorted(spark):
    from balcao.operators import status

    model = Model(spark, FOLDER)
    plan = status.clients_of_month(model.metricas, gold.clientes(model.named_customers))._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=shuffle_hash" in plan


def test_a_month_of_the_key_may_be_any_text(spark):
    from balcao.operators import quality

    months = ["1997-04", "1997-04", "1997-05", "2002-04", None, None, "x", "x", "1997-4"]
    rows = spark.createDataFrame([(m, "A") for m in months] + [("1997-04", "B"), ("1997-04", None)], "ano_mes string, cliente_id string")
    found = [quality.one_pass(rows, ["ano_mes", "cliente_id"], {}, {}, month=m).first() for m in (None, "ano_mes")]
    assert found[0] == found[1] and (found[0]["rows"], found[0]["extra"]) == (11, 3)


def test_tasks_stay_small_unless_the_cluster_says_otherwise(spark):
    from balcao.session import ADVISORY, INITIAL, small_tasks

    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", "10")
    small_tasks(session)
    assert (session.conf.get(ADVISORY), session.conf.get(INITIAL)) == ("16m", "40")
    session.conf.set("spark.sql.shuffle.partitions", "100")
    small_tasks(session)
    assert session.conf.get(INITIAL) == "400"
    session.conf.set(INITIAL, "7")
    session.conf.set(ADVISORY, "32m")
    small_tasks(session)
    assert (session.conf.get(ADVISORY), session.conf.get(INITIAL)) == ("32m", "7")
