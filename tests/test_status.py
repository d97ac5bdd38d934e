"""Trend, status and their texts."""

from __future__ import annotations

import itertools

import pytest
from pyspark.sql import functions as F

from balcao.operators import status as S

TRENDS = [
    (False, 0.667, 1.0, 1.0, -0.333, -0.333, -0.333, "diminuiu"),
    (False, 1.0, 0.667, 0.556, 0.333, 0.444, 0.3885, "aumentou"),
    (False, 0.8, 1.0, 1.0, -0.2, -0.2, -0.2, "normal"),
    (False, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, "normal"),
    (True, 80.0, 100.0, 120.0, -0.2, -1 / 3, -0.8 / 3, "diminuiu"),
    (True, 121.0, 100.0, 100.0, 0.21, 0.21, 0.21, "aumentou"),
    (True, 120.0, 100.0, 100.0, 0.2, 0.2, 0.2, "normal"),
    (True, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, "normal"),
    (True, 5.0, 0.0, 10.0, float("inf"), -0.5, float("inf"), "aumentou"),
]


@pytest.mark.parametrize("relative, v3, v6, v9, c36, c39, index, state", TRENDS)
def test_trend(spark, relative, v3, v6, v9, c36, c39, index, state):
    df = spark.createDataFrame([(v3, v6, v9)], "a double, b double, c double")
    t = S.trend(F.col("a"), F.col("b"), F.col("c"), relative)
    row = df.select(t.c36, t.c39, t.index, t.state).first()
    assert tuple(row)[:3] == pytest.approx((c36, c39, index)) and row[3] == state


def _expected(f, r, q):
    falls = [f, r, q].count("diminuiu")
    if falls >= 2:
        return "ruim"
    if "diminuiu" in (f, r):
        return "atencao"
    return "bom" if f == r == "aumentou" else "normal"


def test_status_of_every_combination(spark):
    states = list(itertools.product(["aumentou", "normal", "diminuiu"], repeat=3))
    df = spark.createDataFrame(states, "f string, r string, q string")
    cols = [F.col(c) for c in "frq"]
    status = S.status_of(*cols)
    out = df.withColumn("s", status).withColumn("m", S.reasons_of(F.col("s"), *cols)).collect()
    names = ["frequencia_compra", "receita_media", "quantidade_itens_media"]
    for row in out:
        trio = (row.f, row.r, row.q)
        assert row.s == _expected(*trio)
        fell = [n for n, s in zip(names, trio) if s == "diminuiu"]
        assert row.m == {"bom": names[:2], "normal": []}.get(row.s, fell)


def test_sentences(spark):
    df = spark.createDataFrame(
        [("bom", ["frequencia_compra", "receita_media"]), ("normal", []), ("atencao", ["receita_media"]),
         ("ruim", ["frequencia_compra", "receita_media", "quantidade_itens_media"])],
        "s string, m array<string>",
    )
    out = [r[0] for r in df.select(S.sentence_of(F.col("s"), F.col("m"))).collect()]
    assert out == [
        "Frequência de compra e receita média aumentaram.",
        "Frequência e receita permanecem dentro do comportamento normal.",
        "A receita média diminuiu; acompanhe a evolução deste cliente.",
        "A frequência de compra, a receita média e a quantidade comprada diminuíram, atendendo ao critério de risco.",
    ]


def test_change_texts(spark):
    df = spark.createDataFrame([(0.125, False), (-0.5, True), (0.0, True), (float("inf"), True), (12.5, True)], "v double, r boolean")
    out = [r[0] for r in df.select(S.change_text(F.col("v"), F.col("r"))).collect()]
    assert out == ["+12,5 p.p.", "-50,0%", "0,0%", S.NO_BASE, "+1.250,0%"]


def _snapshot(spark, **bands):
    """One snapshot row; each metric as its three bands, flat where not given."""
    values = {}
    for m in S.METRICS:
        for band, v in zip(("3m", "6m", "9m"), bands.get(m.key, (0.5, 0.5, 0.5))):
            values[f"{m.key}_{band}"] = v
    schema = "ano_mes string, cliente_id string, nome_empresa string, " + ", ".join(f"{k} double" for k in values)
    return spark.createDataFrame([("1997-04", "ÁLFKI", "São João Ltda", *values.values())], schema)


def test_context_metrics_never_decide(spark):
    df = S.with_status(_snapshot(spark, desconto_medio=(0.0, 0.9, 0.9), quantidade_produtos_distintos_media=(1.0, 9.0, 9.0)))
    row = df.first()
    assert row.status == "normal" and row.estado_desconto_medio == "diminuiu"


def test_roles_filter_and_months(spark):
    falling = _snapshot(spark, frequencia_compra=(0.3333, 1.0, 1.0), quantidade_itens_media=(1.0, 5.0, 5.0))
    clients = spark.createDataFrame([("ÁLFKI", "  ", "1")], "cliente_id string, nome_contato string, telefone string")
    rows = S.with_status(S.clients_of_month(falling, clients, "1997-04"))
    row = rows.first()
    assert row.status == "ruim" and row.nome_cliente == "ÁLFKI" and row.telefone == "1"
    roles = {r.metrica: r.papel for r in S.metric_roles(rows).collect()}
    assert roles["frequencia_compra"] == S.ROLE_MAIN_IN and roles["receita_media"] == S.ROLE_MAIN_OUT
    assert roles["quantidade_itens_media"] == S.ROLE_WORSE and roles["desconto_medio"] == S.ROLE_CONTEXT
    months = S.active_months(falling).first()
    assert (months.meses_ativos_3m, months.meses_ativos_6m) == (1, 3)
    for args, n in [(("alfki",), 1), (("", "SAO joão"), 1), (("", "", "bom"), 0), (("x",), 0), (("", "", "todos"), 1)]:
        assert S.filter_clients(rows, *args).count() == n


def test_unknown_client_keeps_its_row(spark):
    clients = spark.createDataFrame([], "cliente_id string, nome_contato string, telefone string")
    assert S.clients_of_month(_snapshot(spark), clients).first().nome_cliente == "ÁLFKI"
