"""Accent- and case-insensitive search over the catalogue and the customers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from balcao.functions.text import normalized, normalized_term, search_text

MAX_CLIENTS = 20


def _with_meta(rows: DataFrame) -> DataFrame:
    parts = [F.nullif(F.col(c), F.lit("")) for c in ("nome_contato", "cidade", "pais")]
    return rows.withColumn("meta", F.concat_ws(" · ", *parts))


def search_products(catalogue: DataFrame, term: str | None) -> DataFrame:
    """Name, category or supplier contains the term; no term keeps everything."""
    wanted = normalized_term(term)
    if not wanted:
        return catalogue
    text = search_text(*[F.col(c) for c in ("produto_nome", "categoria_nome", "fornecedor_nome")])
    return catalogue.filter(F.contains(text, F.lit(wanted)))


def search_clients(clientes: DataFrame, term: str | None) -> DataFrame:
    """First twenty matches by company name; no term finds nobody."""
    wanted = normalized_term(term)
    columns = ["cliente_id", "nome_empresa", "nome_contato", "cidade", "pais"]
    rows = _with_meta(clientes.select(*columns))
    if not wanted:
        return rows.filter(F.lit(False))
    text = search_text(*[F.col(c) for c in columns])
    return (
        rows.filter(F.contains(text, F.lit(wanted)))
        .orderBy("nome_empresa", "cliente_id")
        .limit(MAX_CLIENTS)
    )


# ── many terms at once ────────────────────────────────────────

GRAM = 3


def _grams(text: Column, sizes: list[int]) -> Column:
    """The different substrings of these lengths."""
    each = [
        F.when(F.char_length(text) < n, F.array().cast("array<string>")).otherwise(
            F.transform(F.sequence(F.lit(1), F.char_length(text) - n + 1), _cut(text, n))
        )
        for n in sizes
    ]
    return F.array_distinct(F.concat(*each))


def _cut(text: Column, n: int):
    return lambda at: F.substring(text, at, F.lit(n))


@dataclass
class SubstringIndex:
    """Rows and the list of (gram, id) of their normalised text, all grams of one to three letters.

    A term of three letters or more is looked up under the one of its three-letter grams that the fewest rows hold, and
    only the rows found there are compared with the term; a shorter term is a gram itself. Terms that are empty once
    normalised find nothing. The index is two tables, which can be stored: `rows` has id, texto and the rows' columns,
    `grams` has gram, id and in how many rows the gram occurs.
    """

    rows: DataFrame
    grams: DataFrame

    @staticmethod
    def build(rows: DataFrame, ident: str, *columns: str) -> SubstringIndex:
        kept = rows.withColumns({"id": F.col(ident), "texto": search_text(*[F.col(c) for c in columns])})
        pairs = kept.select(F.explode(_grams(F.col("texto"), [1, 2, GRAM])).alias("gram"), "id")
        times = pairs.groupBy("gram").agg(F.count(F.lit(1)).alias("linhas"))
        # A gram that a third of all rows hold is split by the join, which is on another form of it.
        turned = F.reverse("gram").alias("marg")
        joined = pairs.select("*", turned).join(times.select(turned, "linhas"), "marg").drop("marg")
        return SubstringIndex(kept, joined)

    def find(self, terms: DataFrame) -> DataFrame:
        """(termo, and the columns of the rows): every row that contains the term, for all terms of the column `termo`."""
        asked = terms.select("termo").distinct().withColumn("procurado", normalized(F.col("termo"))).filter("procurado != ''")
        own = F.when(F.char_length("procurado") < GRAM, F.array("procurado")).otherwise(_grams(F.col("procurado"), [GRAM]))
        wanted = asked.select("termo", "procurado", F.explode(own).alias("gram"))
        sizes = self.grams.select("gram", "linhas").join(F.broadcast(wanted.select("gram").distinct()), "gram", "left_semi").distinct()
        # A gram that no row holds decides as well: its term finds nothing.
        order = Window.partitionBy("termo").orderBy(F.coalesce("linhas", F.lit(0)), "gram")
        rarest = wanted.join(sizes, "gram", "left").withColumn("n", F.row_number().over(order)).filter("n = 1")
        candidates = self.grams.select("gram", "id").join(rarest.select("termo", "procurado", "gram"), "gram").select("termo", "procurado", "id")
        columns = [c for c in self.rows.columns if c not in ("id", "texto")]
        return candidates.join(self.rows, "id").filter(F.contains("texto", F.col("procurado"))).select("termo", *columns)
