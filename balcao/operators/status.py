"""Trend of each metric, status of each customer and the texts that explain them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from balcao.functions.numbers import ptbr_number
from balcao.functions.text import normalized, normalized_term

TOLERANCE = 0.20 + 1e-9

# States and texts shown to the user.
UP, FLAT, DOWN = "aumentou", "normal", "diminuiu"
BAD, ATTENTION, GOOD, NORMAL = "ruim", "atencao", "bom", "normal"
NO_BASE = "sem valor no período mais antigo (passou a existir agora)"
SENTENCES = {
    GOOD: "Frequência de compra e receita média aumentaram.",
    NORMAL: "Frequência e receita permanecem dentro do comportamento normal.",
}
ENDINGS = {
    ATTENTION: " diminuiu; acompanhe a evolução deste cliente.",
    BAD: " diminuíram, atendendo ao critério de risco.",
}
ROLE_MAIN_IN = "Principal · participou do Status"
ROLE_MAIN_OUT = "Principal · não alterou o Status"
ROLE_WORSE = "Agravante · reforçou o Status Ruim"
ROLE_OPERATIONAL = "Contexto operacional"
ROLE_CONTEXT = "Contexto · não define o Status"
MEANING = {
    UP: "A variação média (3m contra 6m e 9m) superou +20% em ",
    DOWN: "A variação média (3m contra 6m e 9m) ficou abaixo de −20% em ",
    FLAT: "A variação média (3m contra 6m e 9m) permaneceu dentro da tolerância de 20%.",
}


@dataclass(frozen=True)
class Metric:
    key: str
    title: str
    relative: bool
    reason: str | None = None  # wording in the status sentence


# The metrics. Proportions are compared by difference, amounts by relative change.
METRICS = [
    Metric("frequencia_compra", "Frequência de compra", False, "a frequência de compra"),
    Metric("receita_media", "Média de receita", True, "a receita média"),
    Metric("desconto_medio", "Média de desconto", False),
    Metric("quantidade_produtos_distintos_media", "Média de itens variados", True),
    Metric("quantidade_itens_media", "Média de quantidade", True, "a quantidade comprada"),
]
FREQUENCY, REVENUE, QUANTITY = METRICS[0], METRICS[1], METRICS[4]
DECIDING = [FREQUENCY, REVENUE, QUANTITY]


def change(now: Column, base: Column, relative: bool) -> Column:
    """Difference, or change relative to the base; anything new against zero is infinite."""
    if not relative:
        return now - base
    from_zero = F.when(now == 0, F.lit(0.0)).otherwise(F.lit(float("inf")))
    return F.when(base == 0, from_zero).otherwise((now - base) / F.abs(F.nullif(base, F.lit(0.0))))


@dataclass(frozen=True)
class Trend:
    c36: Column
    c39: Column
    index: Column
    state: Column


def trend(v3: Column, v6: Column, v9: Column, relative: bool) -> Trend:
    """The newest quarter against both older ones; exactly 20 % is still normal."""
    c36, c39 = change(v3, v6, relative), change(v3, v9, relative)
    index = (c36 + c39) / 2
    state = F.when(index > TOLERANCE, UP).when(index < -TOLERANCE, DOWN).otherwise(FLAT)
    return Trend(c36, c39, index, state)


def metric_trend(metric: Metric) -> Trend:
    v3, v6, v9 = (F.col(f"{metric.key}_{band}") for band in ("3m", "6m", "9m"))
    return trend(v3, v6, v9, metric.relative)


def status_of(frequency: Column, revenue: Column, quantity: Column) -> Column:
    """Two falls out of three are bad; discount and variety never decide."""
    falls = sum(((s == DOWN).cast("int") for s in (frequency, revenue, quantity)), F.lit(0))
    return (
        F.when(falls >= 2, BAD)
        .when((frequency == DOWN) | (revenue == DOWN), ATTENTION)
        .when((frequency == UP) & (revenue == UP), GOOD)
        .otherwise(NORMAL)
    )


def reasons_of(status: Column, frequency: Column, revenue: Column, quantity: Column) -> Column:
    """Keys of the metrics that decided the status, in fixed order."""
    states = zip(DECIDING, (frequency, revenue, quantity))
    fell = F.array_compact(F.array(*[F.when(s == DOWN, F.lit(m.key)) for m, s in states]))
    rose = F.array(F.lit(FREQUENCY.key), F.lit(REVENUE.key))
    none = F.array().cast("array<string>")
    return F.when(status.isin(BAD, ATTENTION), fell).when(status == GOOD, rose).otherwise(none)


def with_status(snapshots: DataFrame) -> DataFrame:
    """State of the five metrics, status and deciding metrics of every snapshot row.

    The states come out of a one-row generator: a later filter on the status then
    tests the states and does not drag five copies of their arithmetic down the plan.
    """
    states = F.struct(*[metric_trend(m).state.alias(f"estado_{m.key}") for m in METRICS])
    deciding = [F.col(f"estado_{m.key}") for m in DECIDING]
    return (
        snapshots.select("*", F.inline(F.array(states)))
        .withColumn("status", status_of(*deciding))
        .withColumn("motivos", reasons_of(F.col("status"), *deciding))
    )


def trends(snapshots: DataFrame) -> DataFrame:
    """Long form: one row per snapshot row and metric."""
    cells = []
    for metric in METRICS:
        t = metric_trend(metric)
        cells.append(
            F.struct(
                F.lit(metric.key).alias("metrica"),
                F.lit("relativa" if metric.relative else "diferenca").alias("modo"),
                *[F.col(f"{metric.key}_{band}").alias(f"valor_{band}") for band in ("3m", "6m", "9m")],
                t.c36.alias("comparacao_3x6"),
                t.c39.alias("comparacao_3x9"),
                t.index.alias("indice"),
                t.state.alias("estado"),
            )
        )
    return snapshots.select("ano_mes", "cliente_id", F.inline(F.array(*cells)))


def sentence_of(status: Column, reasons: Column) -> Column:
    """One sentence naming exactly the metrics that decided the status."""
    names = F.filter(
        F.array(*[F.when(F.array_contains(reasons, m.key), F.lit(m.reason)) for m in DECIDING]),
        lambda n: n.isNotNull(),
    )
    last = F.element_at(names, -1)
    listed = F.when(F.size(names) <= 1, F.array_join(names, "")).otherwise(
        F.concat(F.array_join(F.slice(names, 1, F.size(names) - 1), ", "), F.lit(" e "), last)
    )
    capital = F.concat(F.upper(F.substring(listed, 1, 1)), F.substr(listed, F.lit(2)))
    return (
        F.when(status == GOOD, SENTENCES[GOOD])
        .when(status == NORMAL, SENTENCES[NORMAL])
        .when(status == ATTENTION, F.concat(capital, F.lit(ENDINGS[ATTENTION])))
        .otherwise(F.concat(capital, F.lit(ENDINGS[BAD])))
    )


def status_sentences(enriched: DataFrame) -> DataFrame:
    return enriched.select(
        "ano_mes", "cliente_id", "status", sentence_of(F.col("status"), F.col("motivos")).alias("frase")
    )


def role_of(metric: Metric) -> Column:
    took_part = F.array_contains("motivos", metric.key)
    if metric in (FREQUENCY, REVENUE):
        return F.when(took_part, ROLE_MAIN_IN).otherwise(ROLE_MAIN_OUT)
    if metric is QUANTITY:
        return F.when(took_part & (F.col("status") == BAD), ROLE_WORSE).otherwise(ROLE_OPERATIONAL)
    return F.lit(ROLE_CONTEXT)


def metric_roles(enriched: DataFrame) -> DataFrame:
    """Part every metric played in the status."""
    cells = [F.struct(F.lit(m.key).alias("metrica"), role_of(m).alias("papel")) for m in METRICS]
    return enriched.select("ano_mes", "cliente_id", "status", F.inline(F.array(*cells)))


def change_text(value: Column, relative: Column) -> Column:
    """Signed text in points or percent; a value born from zero has no percentage."""
    sign = F.when(value > 0, "+").when(value < 0, "-").otherwise("")
    unit = F.when(relative, "%").otherwise(" p.p.")
    finite = F.when(value != float("inf"), F.abs(value) * 100)
    return F.when(value == float("inf"), NO_BASE).otherwise(F.concat(sign, ptbr_number(finite, 1), unit))


def change_texts(long_trends: DataFrame) -> DataFrame:
    relative = F.col("modo") == "relativa"
    return long_trends.select(
        "ano_mes", "cliente_id", "metrica",
        change_text(F.col("comparacao_3x6"), relative).alias("texto_3x6"),
        change_text(F.col("comparacao_3x9"), relative).alias("texto_3x9"),
        change_text(F.col("indice"), relative).alias("texto_media"),
    )


def interpretations(long_trends: DataFrame) -> DataFrame:
    unit = F.when(F.col("modo") == "diferenca", "pontos percentuais.").otherwise("percentual.")
    text = (
        F.when(F.col("estado") == UP, F.concat(F.lit(MEANING[UP]), unit))
        .when(F.col("estado") == DOWN, F.concat(F.lit(MEANING[DOWN]), unit))
        .otherwise(MEANING[FLAT])
    )
    return long_trends.select("ano_mes", "cliente_id", "metrica", "estado", text.alias("interpretacao"))


def active_months(snapshots: DataFrame) -> DataFrame:
    """Months with a purchase in each three-month band."""
    return snapshots.select(
        "ano_mes",
        "cliente_id",
        *[
            F.round(F.col(f"frequencia_compra_{b}") * 3).cast("int").alias(f"meses_ativos_{b}")
            for b in ("3m", "6m", "9m")
        ],
    )


def clients_of_month(snapshots: DataFrame, clientes: DataFrame, month: str | None = None) -> DataFrame:
    """Snapshot rows with the contact name, or the code when there is none, and the phone.

    One month comes sorted for display; all months stay unsorted. The register, one row per customer, is hashed: the
    many snapshots of a customer are not sorted to meet it.
    """
    if month:
        named = clients_of_month(snapshots.filter(F.col("ano_mes") == month), clientes)
        return named.orderBy("nome_cliente", "nome_empresa", "cliente_id")
    contact = F.nullif(F.trim(F.col("nome_contato")), F.lit(""))
    known = clientes.select("cliente_id", contact.alias("contato"), "telefone")
    return (
        snapshots.join(known.hint("shuffle_hash"), "cliente_id", "left")
        .withColumn("nome_cliente", F.coalesce("contato", F.col("cliente_id").cast("string")))
        .drop("contato")
    )


def filter_clients(
    rows: DataFrame, client: str = "", company: str = "", status: str = "todos"
) -> DataFrame:
    """Customer by name or code, company and status, all of them; empty means no filter."""
    wanted, firm = normalized_term(client), normalized_term(company)
    if wanted:
        name, code = normalized(F.col("nome_cliente")), normalized(F.col("cliente_id").cast("string"))
        rows = rows.filter(F.contains(name, F.lit(wanted)) | F.contains(code, F.lit(wanted)))
    if firm:
        rows = rows.filter(F.contains(normalized(F.col("nome_empresa")), F.lit(firm)))
    return rows if status == "todos" else rows.filter(F.col("status") == status)
