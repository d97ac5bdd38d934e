"""Pairs, statistics and suggestions, also for orders and carts far above the usual size."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from pyspark.sql import functions as F

from balcao.operators import baskets, carts


def test_directed_pairs(make_sales):
    orders, details, _, products = make_sales(
        {1: ("A", "1997-01-05"), 2: ("A", "1997-01-06"), 3: ("B", "1997-02-01")},
        [(1, 1, 1, 2, 0), (1, 2, 1, 3, 0), (1, 3, 1, 4, 0), (2, 1, 1, 1, 0), (2, 2, 1, 1, 0), (3, 9, 1, 7, 0)],
    )
    rows = baskets.produtos_associados(orders, details, products).collect()
    by_order = Counter(r.id_compra for r in rows)
    assert by_order == {1: 6, 2: 2, 3: 1}
    assert {r.quantidade_outros_produtos_distintos for r in rows if r.id_compra == 1} == {1}
    assert {r.quantidade_outros_produtos_distintos for r in rows if r.id_compra == 2} == {0}
    alone = next(r for r in rows if r.id_compra == 3)
    assert alone.produto_acompanhante_id is None and alone.produto_acompanhante_nome is None
    assert alone.quantidade_comprada == 7 and alone.total_produtos_distintos == 1
    pair = next(r for r in rows if (r.id_compra, r.produto_comprado_id, r.produto_acompanhante_id) == (1, 2, 3))
    assert (pair.quantidade_comprada, pair.quantidade_acompanhante) == (3, 4)


def _random_sales(make_sales, hot: int, seed: int = 7):
    """Forty small orders and one order with `hot` products, a large share of all items."""
    rng = random.Random(seed)
    orders, items = {}, []
    for o in range(1, 41):
        orders[o] = ("A", "1997-01-05")
        items += [(o, p, 1, 1, 0) for p in rng.sample(range(1, 61), rng.randint(1, 6))]
    orders[99] = ("B", "1997-01-06")
    items += [(99, p, 1, 1, 0) for p in range(1, hot + 1)]
    return orders, items, make_sales(orders, items)


@pytest.mark.parametrize("block", [3, 16, 256])
def test_large_orders_are_tiled_without_loss(make_sales, block):
    _, items, (orders, details, _, products) = _random_sales(make_sales, hot=60)
    content = defaultdict(set)
    for o, p, *_ in items:
        content[o].add(p)
    expected = {(o, x, y) for o, ps in content.items() for x in ps for y in ps if x != y}
    expected |= {(o, next(iter(ps)), None) for o, ps in content.items() if len(ps) == 1}
    rows = baskets.produtos_associados(orders, details, products, block).collect()
    assert len(rows) == len(expected)
    assert {(r.id_compra, r.produto_comprado_id, r.produto_acompanhante_id) for r in rows} == expected


@pytest.mark.parametrize("block", [3, 256])
def test_statistics_match_brute_force(make_sales, block):
    _, items, (orders, details, _, products) = _random_sales(make_sales, hot=60)
    content = defaultdict(set)
    for o, p, *_ in items:
        content[o].add(p)
    n, m, other = Counter(), Counter(), Counter()
    for ps in content.values():
        for x in ps:
            n[x] += 1
            for y in ps - {x}:
                m[x, y] += 1
                other[x, y] += len(ps) > 2
    rows = baskets.association_stats(orders, details, products, block).collect()
    assert len(rows) == len(m)
    for r in rows:
        key = (r.produto_x, r.produto_y)
        assert (r.pedidos_com_x, r.pedidos_com_x_e_y, r.pedidos_com_outros) == (n[key[0]], m[key], other[key])
        assert r.pct_associacao == pytest.approx(100 * m[key] / n[key[0]])


def _best(stats, cart):
    """The five best partners of each product of a cart, straight from the definition."""
    out = {}
    for x in cart:
        mine = [r for r in stats if r.produto_x == x and r.produto_y not in cart]
        mine.sort(key=lambda r: (-r.pct_associacao, r.pct_outros, -r.pedidos_com_x_e_y, r.nome_y, r.produto_y))
        for i, r in enumerate(mine[:5], 1):
            out[x, r.produto_y] = i
    return out


@pytest.mark.parametrize("prefix", [6, 8, 32])
def test_small_and_large_carts_agree(spark, make_sales, prefix):
    """A small prefix sends most carts through the path for large ones."""
    _, _, (orders, details, _, products) = _random_sales(make_sales, hot=30)
    stats = baskets.association_stats(orders, details, products)
    wanted = {1: {1, 2}, 2: {5}, 3: set(range(1, 11)), 4: set(range(1, 41)), 5: {7, 30, 59}}
    rows = spark.createDataFrame([(c, p) for c, ps in wanted.items() for p in ps], "cart_id long, product_id long")
    top = carts.top_partners(rows, baskets.ranked_partners(stats), prefix).collect()
    facts = stats.collect()
    found = defaultdict(dict)
    for r in top:
        found[r.cart_id][r.produto_x, r.produto_y] = r.ordem
    assert {c: dict(found[c]) for c in wanted} == {c: _best(facts, ps) for c, ps in wanted.items()}


def test_merged_score(spark):
    columns = "cart_id long, produto_x long, produto_y long, nome_y string, pedidos_com_x long, " \
              "pedidos_com_x_e_y long, pedidos_com_outros long, pct_associacao double, pct_outros double"
    top = spark.createDataFrame(
        [(1, 1, 9, "y", 2, 1, 1, 50.0, 100.0), (1, 2, 9, "y", 2, 1, 1, 50.0, 100.0),
         (2, 1, 8, "z", 4, 4, 0, 100.0, 0.0), (2, 3, 8, "z", 4, 2, 1, 50.0, 50.0)],
        columns,
    )
    rows = {r.cart_id: r for r in carts.combined_suggestions(top).collect()}
    assert rows[1].associacao_combinada == pytest.approx(75) and rows[1].media_outros_produtos == pytest.approx(100)
    assert rows[1].indice_oportunidade == pytest.approx(56.25)
    assert rows[2].associacao_combinada == pytest.approx(100)  # a certain origin makes the rest irrelevant
    assert rows[2].media_outros_produtos == pytest.approx(50 * 2 / 6)


def test_every_origin_is_a_row(spark):
    top = spark.createDataFrame(
        [(1, x, 9, "y", 10, x, 0, 10.0 * x, 0.0) for x in (1, 2, 3)],
        "cart_id long, produto_x long, produto_y long, nome_y string, pedidos_com_x long, "
        "pedidos_com_x_e_y long, pedidos_com_outros long, pct_associacao double, pct_outros double",
    )
    products = spark.createDataFrame([(i, f"p{i}") for i in (1, 2, 3)], "product_id long, product_name string")
    rows = carts.suggestion_origins(top, products).orderBy("ordem_origem").collect()
    assert [(r.ordem_origem, r.produto_x, r.nome_x) for r in rows] == [(1, 3, "p3"), (2, 2, "p2"), (3, 1, "p1")]


def test_evidence_bands(spark):
    stats = spark.createDataFrame(
        [(1, 2, 10, 10), (1, 3, 10, 3), (1, 4, 10, 6), (1, 5, 10, 7)],
        "produto_x long, produto_y long, pedidos_com_x_e_y long, pedidos_com_outros long",
    )
    out = {r.produto_y: r.evidencia for r in baskets.association_evidence(stats).collect()}
    assert out == {2: "nunca_sozinhos", 3: "forte", 4: "parcial", 5: "fraca"}


def test_catalogue_of_a_client(spark):
    catalogue = spark.createDataFrame(
        [(1, "Zed"), (2, "Ção"), (3, "azul"), (4, "cao")], "produto_id long, produto_nome string"
    )
    bought = spark.createDataFrame([("A", 1, 5), ("B", 3, 9)], "cliente_id string, produto_id long, quantidade_total long")
    wanted = spark.createDataFrame([("A",)], "cliente_id string")
    rows = carts.ranked_catalogue(catalogue, bought, wanted).orderBy("posicao").collect()
    assert [(r.produto_nome, r.quantidade_total) for r in rows] == [("Zed", 5), ("azul", 0), ("cao", 0), ("Ção", 0)]
    assert [r.produto_nome for r in carts.alphabetical_catalogue(catalogue).collect()] == ["azul", "cao", "Ção", "Zed"]
    many = spark.range(300).selectExpr("cast(id AS string) AS cliente_id")
    assert carts.ranked_catalogue(catalogue, bought, many).count() == 1200
    assert carts.ranked_catalogue(catalogue, bought, many.limit(0)).count() == 0


def test_catalogue_of_many_clients(spark, monkeypatch):
    """As the sort of every customer's catalogue gives it, without all customers in one value."""
    monkeypatch.setattr(carts, "GAP", 3, raising=False)
    names = {i: f"{'aáAzç'[i % 5]}{i // 10}" for i in range(40)}
    units = {(str(c), p): (c * p * 7) % 5 - 1 for c in range(30) for p in range(40) if (c + p * p) % 3 == 0 and c}
    units |= {("29", p): 2 for p in range(40)}
    catalogue = spark.createDataFrame(list(names.items()), "produto_id long, produto_nome string").repartition(4)
    bought = [(c, p, n) for (c, p), n in units.items()] + [("1", 99, 8), ("other", 1, 8)]
    bought = spark.createDataFrame(bought, "cliente_id string, produto_id long, quantidade_total long")
    wanted = spark.createDataFrame([(str(c),) for c in range(30)] + [("3",), (None,)], "cliente_id string")
    out = carts.ranked_catalogue(catalogue, bought, wanted)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set" not in plan and "scalar-subquery" not in plan
    alphabet = [r.produto_id for r in carts.alphabetical_catalogue(catalogue).collect()]
    expected = set()
    for c in map(str, range(30)):
        order = sorted(alphabet, key=lambda p: (-units.get((c, p), 0), alphabet.index(p)))
        expected |= {(c, p, names[p], units.get((c, p), 0), i + 1) for i, p in enumerate(order)}
    rows = [tuple(r) for r in out.collect()]
    assert len(rows) == 1200 and set(rows) == expected


def test_carts_of_any_size_agree(spark, make_sales):
    """As one row or position by position, and ranked by names or by their places."""
    sales = {i: ("A", "1997-01-05") for i in range(12)}
    items = [(i, p, 5, 1, 0) for i in range(12) for p in range(1, 3 + i % 7)]
    orders, details, _, products = make_sales(sales, items)
    rows = details.select(F.col("order_id").alias("cart_id"), "product_id")
    plain = baskets.association_stats(orders, details, products)
    placed = baskets.association_stats(orders, details, products, placed=True)
    columns = ["cart_id", "produto_x", "produto_y", "ordem"]
    results = [
        sorted(carts.top_partners(rows, stats, prefix, listed).select(columns).collect())
        for stats, prefix, listed in ((plain, 32, 1024), (placed, 6, 1024), (placed, 6, 4))
    ]
    assert results[0] and results[0] == results[1] == results[2]


def _dealt(spark, make) -> list[str]:
    """The keys by which the rows of a result are dealt, nothing being broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = make()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    return [re.sub(r"#\w+", "", keys) for keys in re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)]


def test_suggestions_go_to_their_cart_once_and_as_lists(spark, make_sales):
    """The statistics are stored by then; scores, ranks and origins find the rows of a cart in place."""
    _, _, (orders, details, _, products) = _random_sales(make_sales, hot=20)
    rows = details.select(F.col("order_id").alias("cart_id"), "product_id")
    stats = baskets.association_stats(orders, details, products, placed=True)
    ranked = _dealt(spark, lambda: carts.ranked_suggestions(carts.combined_suggestions(carts.top_partners(rows, stats))))
    origins = _dealt(spark, lambda: carts.suggestion_origins(carts.chosen_partners(rows, stats), products, folded=True))
    for dealt in (ranked, origins):
        assert not any("produto_y" in keys or keys in ("x, y", "y, x") for keys in dealt)
        assert dealt.count("cart_id") == 2  # the lines, to be one row, and the lists


def test_origins_of_lists_are_those_of_rows(spark, make_sales):
    _, _, (orders, details, _, products) = _random_sales(make_sales, hot=40)
    rows = details.select(F.col("order_id").alias("cart_id"), "product_id")
    stats = baskets.association_stats(orders, details, products)
    # A product with two names stands there twice.
    named = products.unionByName(products.filter("product_id = 3").withColumn("product_name", F.lit("outro")))
    lists = carts.suggestion_origins(carts.chosen_partners(rows, stats), named, folded=True)
    single = carts.suggestion_origins(carts.top_partners(rows, stats), named)
    columns = [c for c in single.columns if c != "nome_x"]  # the order of equal origins is open
    assert lists.columns == single.columns and lists.filter("nome_x = 'outro'").count() > 0
    assert sorted(map(tuple, lists.select(columns).collect())) == sorted(map(tuple, single.select(columns).collect()))


def test_lines_without_cart_or_product(spark, make_sales):
    """Lines without a cart are one cart, whatever its size; lines without a product suggest nothing."""
    _, _, (orders, details, _, products) = _random_sales(make_sales, hot=60)
    stats = baskets.association_stats(orders, details, products)
    lines = [(None, p) for p in (1, 2, 2, None)] + [(5, 1), (5, None), (6, None)] + [(7, p) for p in range(1, 31)]
    rows = spark.createDataFrame(lines, "cart_id long, product_id long")
    found = defaultdict(dict)
    for r in carts.top_partners(rows, stats).collect():
        found[r.cart_id][r.produto_x, r.produto_y] = r.ordem
    facts = stats.collect()
    assert dict(found) == {None: _best(facts, {1, 2}), 5: _best(facts, {1}), 7: _best(facts, set(range(1, 31)))}
