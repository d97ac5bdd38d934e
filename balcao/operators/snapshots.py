"""Monthly snapshots of every customer over three consecutive quarters.

A snapshot of month m looks at months m-2..m (3m), m-5..m-3 (6m) and m-8..m-6
(9m). All months are computed together: a customer's months are one row, which is
unfolded into snapshots that find their nine months by position.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from balcao.functions import months as M
from balcao.functions.numbers import rounded, weighted_discount
from balcao.operators.gold import company_names, monthly_volume
from balcao.sources.schemas import MONEY

# Months back from the snapshot, newest and oldest of each band.
BANDS = {"3m": (0, 2), "6m": (3, 5), "9m": (6, 8)}
MONTHS_PER_BAND = 3
HISTORY = 9
MONEY_MEASURES = ["receita_total", "receita_sem_desconto"]
COUNT_MEASURES = ["quantidade_pedidos", "quantidade_produtos_distintos", "quantidade_itens"]


# ── periods ───────────────────────────────────────────────────


@dataclass(frozen=True)
class Period:
    """The closed month before a processing day and its three bands of months."""

    processing_day: date
    index: int
    last_day: date
    bands: dict[str, list[str]]

    @property
    def month(self) -> str:
        return M.key_at(self.index)

    @property
    def first_day(self) -> date:
        return M.first_day_at(self.index)

    @property
    def history_start(self) -> date:
        return M.first_day_at(self.index - HISTORY + 1)


def period_of(processing_day: date | str) -> Period:
    day = M.parse_day(processing_day) if isinstance(processing_day, str) else processing_day
    last = M.last_closed_day(day)
    index = M.index_of_day(last)
    bands = {name: [M.key_at(index - back) for back in range(oldest, newest - 1, -1)] for name, (newest, oldest) in BANDS.items()}
    return Period(day, index, last, bands)


def coverage(orders: DataFrame) -> DataFrame:
    """One row: date span, first complete month, first and last month with a full snapshot."""
    span = orders.agg(F.min("order_date").alias("menor_data"), F.max("order_date").alias("maior_data"))
    first, last = F.col("menor_data"), F.col("maior_data")
    complete = M.month_index(first) + F.when(F.dayofmonth(first) == 1, 0).otherwise(1)
    covered = M.month_index(last) - F.when(last == F.last_day(last), 0).otherwise(1)
    return span.select(
        "menor_data",
        "maior_data",
        complete.alias("idx_completo"),
        (complete + HISTORY - 1).alias("idx_primeiro"),
        covered.alias("idx_ultimo"),
    )


def coverage_report(orders: DataFrame) -> DataFrame:
    permitted = F.to_date(F.concat(M.key_of_index(F.col("idx_completo") + HISTORY), F.lit("-01")))
    return coverage(orders).select(
        "menor_data",
        "maior_data",
        M.key_of_index(F.col("idx_completo")).alias("primeiro_mes_completo"),
        M.key_of_index(F.col("idx_primeiro")).alias("primeiro_retrato"),
        M.key_of_index(F.col("idx_ultimo")).alias("ultimo_retrato"),
        permitted.alias("primeira_data_permitida"),
        F.greatest(F.lit(0), F.col("idx_ultimo") - F.col("idx_primeiro") + 1).alias("retratos"),
    )


def require_coverage(orders: DataFrame, period: Period) -> str:
    """Raise unless the orders cover the nine months; returns the first complete month."""
    row = coverage_report(orders).first()
    problems = []
    needed = M.key_at(period.index - HISTORY + 1)
    if needed < row.primeiro_mes_completo:
        problems.append(
            f"historico de 9m incompleto: falta {needed}; meses completos desde {row.primeiro_mes_completo}, "
            f"processamento possivel desde {row.primeira_data_permitida.isoformat()}"
        )
    if row.maior_data < period.last_day:
        problems.append(f"{period.month} ainda aberto: ultimo pedido em {row.maior_data.isoformat()}")
    if problems:
        raise ValueError("; ".join(problems))
    return row.primeiro_mes_completo


def snapshot_months(orders: DataFrame) -> DataFrame:
    """Every month that can be processed, with the limits of its bands."""
    valid = coverage(orders).filter(F.col("idx_ultimo") >= F.col("idx_primeiro"))
    months = valid.select(F.explode(F.sequence("idx_primeiro", "idx_ultimo")).alias("mes_idx"))
    first_day = F.to_date(F.concat(M.key_of_index(F.col("mes_idx")), F.lit("-01")))
    limits = [
        M.key_of_index(F.col("mes_idx") - back).alias(f"{side}_{name}")
        for name, pair in BANDS.items()
        for side, back in zip(("fim", "inicio"), pair)
    ]
    return months.select(
        M.key_of_index(F.col("mes_idx")).alias("ano_mes"),
        first_day.alias("inicio_mes_processado"),
        F.last_day(first_day).alias("fim_mes_processado"),
        F.add_months(first_day, 1).alias("primeira_data_processamento"),
        *limits,
    )


# ── customers by calendar month ───────────────────────────────


@dataclass(frozen=True)
class Range:
    """First and last snapshot month as index columns."""

    first: Column
    last: Column


def full_range(orders: DataFrame) -> Range:
    """All months the data covers; two scalar subqueries, nothing is joined."""
    span = coverage(orders)
    return Range(span.select("idx_primeiro").scalar(), span.select("idx_ultimo").scalar())


def single_month(period: Period) -> Range:
    return Range(F.lit(period.index), F.lit(period.index))


def base_orders(orders: DataFrame, span: Range) -> DataFrame:
    """The orders that snapshots of `span` are built from.

    Bounds are on the day itself, so that a run of one month skips the files of other months.
    """
    return orders.filter(F.col("order_date") < M.first_day(span.last + 1))


def _recent(known: DataFrame, span: Range) -> DataFrame:
    return known.filter(F.col("order_date") >= M.first_day(span.first - (HISTORY - 1)))


def months_of_customers(orders: DataFrame, details: DataFrame, span: Range) -> DataFrame:
    """(cliente_id, de, meses): the first snapshot of each customer and the measures of every month from eight before it.

    Customers enter with their first order, with or without items, and stay. A customer sends at most one row per month
    through the shuffle and is one row behind it: nothing is grouped by snapshot. `meses` has a place for each month up to
    the last one, NULL where nothing was bought, so that the months of a snapshot are found by position. Money is whole cents.
    """
    known = base_orders(orders, span)
    bought = monthly_volume(_recent(known, span), details).select(
        "cliente_id",
        F.struct(
            M.index_of_key(F.col("ano_mes")).alias("idx"),
            F.lit(1).cast("bigint").alias("mes_ativo"),
            *[(F.col(c) * 100).cast("bigint").alias(c) for c in MONEY_MEASURES],
            *COUNT_MEASURES,
        ).alias("mes"),
    )
    entry = known.groupBy(F.col("customer_id").alias("cliente_id")).agg(
        M.month_index(F.min("order_date")).alias("entrada")
    )
    folded = (
        bought.unionByName(entry, allowMissingColumns=True)
        .groupBy("cliente_id")
        .agg(F.min("entrada").alias("entrada"), F.collect_list("mes").alias("meses"))
        .withColumn("de", F.greatest("entrada", span.first))
        .filter(F.col("de") <= span.last)
    )
    by_month = F.map_from_entries(F.transform("meses", lambda m: F.struct(m["idx"], m)))
    places = F.sequence(F.col("de") - (HISTORY - 1), span.last)
    return folded.select("cliente_id", "de", by_month.alias("meses"), places.alias("lugares")).select(
        "cliente_id", "de", F.transform("lugares", lambda i: F.try_element_at("meses", i)).alias("meses")
    )


def _sums(name: str) -> list[Column]:
    """Totals of a band; `lugar` is the place of the newest month."""
    newest, oldest = BANDS[name]
    months = [F.get("meses", F.col("lugar") - back) for back in range(newest, oldest + 1)]
    return [
        reduce(Column.__add__, [F.coalesce(m[c], F.lit(0)) for m in months]).alias(f"{c}_{name}")
        for c in ["mes_ativo", *MONEY_MEASURES, *COUNT_MEASURES]
    ]


def _metrics(name: str) -> list[Column]:
    """The seven metrics of a band; means always divide by its three months."""

    def mean(total: Column, digits: int = 2) -> Column:
        return rounded(total.cast("double") / MONTHS_PER_BAND, digits)

    net, gross = F.col(f"receita_total_{name}") / 100, F.col(f"receita_sem_desconto_{name}") / 100
    return [
        mean(F.col(f"mes_ativo_{name}"), 4).alias(f"frequencia_compra_{name}"),
        mean(net).alias(f"receita_media_{name}"),
        mean(gross).alias(f"receita_sem_desconto_media_{name}"),
        weighted_discount(net, gross).alias(f"desconto_medio_{name}"),
        mean(F.col(f"quantidade_pedidos_{name}")).alias(f"quantidade_pedidos_media_{name}"),
        mean(F.col(f"quantidade_produtos_distintos_{name}")).alias(f"quantidade_produtos_distintos_media_{name}"),
        mean(F.col(f"quantidade_itens_{name}")).alias(f"quantidade_itens_media_{name}"),
    ]


def historico_cliente_metricas(
    orders: DataFrame, details: DataFrame, customers: DataFrame, span: Range | None = None
) -> DataFrame:
    """Snapshot rows of every eligible customer for every month of `span`.

    The name joins the customer's one row, before it is unfolded.
    """
    span = span or full_range(orders)
    months = months_of_customers(orders, details, span).join(company_names(customers), "cliente_id")
    unfolded = months.select(
        "cliente_id", "nome_empresa", "de", "meses", F.explode(F.sequence("de", span.last)).alias("mes_idx")
    ).withColumn("lugar", F.col("mes_idx") - F.col("de") + (HISTORY - 1))
    return _shown(
        unfolded.select(
            M.key_of_index(F.col("mes_idx")).alias("ano_mes"), "cliente_id", "nome_empresa",
            *[c for name in BANDS for c in _sums(name)],
        )
    )


def _shown(sums: DataFrame) -> DataFrame:
    return sums.select("ano_mes", "cliente_id", "nome_empresa", *[c for name in BANDS for c in _metrics(name)])


def from_sums(sums: DataFrame, customers: DataFrame) -> DataFrame:
    """Snapshot rows of registered customers from the totals of their bands."""
    return _shown(sums.join(company_names(customers), "cliente_id"))


def process_month(
    orders: DataFrame, details: DataFrame, customers: DataFrame, processing_day: date | str
) -> DataFrame:
    """The snapshot of one closed month; the day within the month does not matter."""
    period = period_of(processing_day)
    require_coverage(orders, period)
    return historico_cliente_metricas(orders, details, customers, single_month(period))


def volume_series(orders: DataFrame, details: DataFrame, customers: DataFrame, span: Range | None = None) -> DataFrame:
    """Orders and revenue of every month of each customer, months without orders included.

    The series begins eight months before the customer's first snapshot, so the nine months of any snapshot are a
    slice of it. The months of a customer, which the calendar bounds, travel as one list.
    """
    span = span or full_range(orders)
    known = base_orders(orders, span)
    bought = monthly_volume(_recent(known, span), details).select(
        "cliente_id",
        F.struct(M.index_of_key(F.col("ano_mes")).alias("idx"), "quantidade_pedidos", "receita_total").alias("mes"),
    )
    entry = known.groupBy(F.col("customer_id").alias("cliente_id")).agg(
        M.month_index(F.min("order_date")).alias("entrada")
    )
    series = (
        bought.unionByName(entry, allowMissingColumns=True)
        .groupBy("cliente_id")
        .agg(F.min("entrada").alias("entrada"), F.collect_list("mes").alias("meses"))
        .join(company_names(customers), "cliente_id", "left_semi")
        .withColumn("de", F.greatest("entrada", span.first) - (HISTORY - 1))
        .filter(F.col("de") + HISTORY - 1 <= span.last)
    )
    by_month = F.map_from_entries(F.transform("meses", lambda m: F.struct(m["idx"], m)))
    dense = series.select("cliente_id", by_month.alias("meses"), F.explode(F.sequence("de", span.last)).alias("idx"))
    month = F.try_element_at("meses", "idx")
    return dense.select(
        "cliente_id",
        M.key_of_index(F.col("idx")).alias("ano_mes"),
        F.coalesce(month["quantidade_pedidos"], F.lit(0)).alias("quantidade_pedidos"),
        F.coalesce(month["receita_total"], F.lit(0)).cast(MONEY).alias("receita_total"),
    )


def eligible_rows(orders: DataFrame, customers: DataFrame, span: Range) -> DataFrame:
    """How many snapshot rows the orders call for, without building them."""
    entry = (
        orders.groupBy(F.col("customer_id").alias("cliente_id"))
        .agg(M.month_index(F.min("order_date")).alias("entrada"))
        .join(company_names(customers), "cliente_id", "left_semi")
    )
    months = span.last - F.greatest("entrada", span.first) + 1
    return entry.agg(F.coalesce(F.sum(F.greatest(months, F.lit(0))), F.lit(0)).alias("valor"))
