"""Operator 6 against the same fit in numpy."""

from __future__ import annotations

import random

import numpy as np
import pytest

import corpus_pipeline
from balcao.llm import mixing, queries

WORDS = {"en": ["the", "and", "of", "to"], "fr": ["le", "et", "de", "un"], "de": ["der", "und", "von", "ein"]}
TARGETS = {"en": 0.4, "fr": 0.3, "de": 0.3}


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(9)
    rows = []
    for i in range(400):
        lang = rng.choices(list(WORDS), [6, 3, 1])[0]
        mixed = [w for v in WORDS.values() for w in v]
        words = [rng.choice(mixed if rng.random() < 0.2 else WORDS[lang]) for _ in range(rng.randrange(1, 60))]
        rows.append((i, "\n ".join(words) + " ", lang if i % 7 else None))
    rows += [(400, None, "en"), (401, "", None), (402, " \t ", "fr"), (403, "unknown words only", "xx"), (None, "the and", "en")]
    rows += [(404, "le le le", "fr")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    labels = spark.createDataFrame([(i,) for i in range(0, 404, 2)] + [(None,), (9999,)], "doc_id long")
    return rows, docs, labels


def test_rates(tables):
    rows, docs, labels = tables
    found = mixing.rates(docs, labels, TARGETS).toPandas()
    assert len(found) == len(rows)
    p = found[[f"p_{d}" for d in sorted(TARGETS)]].to_numpy()
    assert np.allclose(p.sum(axis=1), 1)
    mass = p * found["tokens"].to_numpy()[:, None]
    now, weights = mass.sum(axis=0), np.array([TARGETS[d] for d in sorted(TARGETS)])
    total = (now / weights).max()
    # The same steps by brute force.
    rate, tokens = np.ones(len(p)), found["tokens"].to_numpy()
    second = (p * tokens[:, None]).T @ p
    for _ in range(40):
        error = mass.T @ rate - weights * total
        if np.abs(error).max() <= 1e-4 * total:
            break
        rate = np.maximum(0, rate - p @ np.linalg.lstsq(second, error, rcond=1e-9)[0])
    assert np.allclose(found["rate"], rate, atol=1e-6)
    assert np.abs(mass.T @ found["rate"].to_numpy() - weights * total).max() <= 2e-4 * total
    assert (found["rate"] >= 0).all() and (found["copies"] >= np.floor(found["rate"])).all()
    best = dict((r[0], r[2]) for r in rows if r[1] and r[2] in TARGETS and len(r[1].split()) > 10)
    named = found[found["doc_id"].isin(list(best))]
    assert np.mean([best[i] == d for i, d in zip(named["doc_id"], named["domain"])]) > 0.97


def test_rates_meet_zero(tables, monkeypatch):
    monkeypatch.setattr(mixing, "STEPS", 8)
    _, docs, labels = tables
    found = mixing.rates(docs, labels, {"en": 0.0001, "fr": 0.9998, "de": 0.0001}, total=500.0).toPandas()
    assert found["rate"].min() == 0
    assert (found["rate"] >= 0).all()


def test_rows_come_as_often_as_decided(tables):
    _, docs, labels = tables
    rates = mixing.rates(docs, labels, TARGETS).toPandas()
    kept = mixing.mixed(docs, labels, TARGETS)
    assert kept.dtypes == docs.dtypes
    assert kept.count() == rates["copies"].sum()
    assert (rates["copies"] >= 1).mean() > 0.95


def test_empty_and_unlabelled(docs, empty, spark):
    none = spark.createDataFrame([], "doc_id long")
    assert mixing.rates(empty, none, TARGETS).count() == mixing.mixed(empty, none, TARGETS).count() == 0
    found = mixing.rates(docs, none, TARGETS).toPandas()
    assert np.allclose(found["p_en"], 1 / 3)
    assert mixing.mixed(docs, none, TARGETS).dtypes == docs.dtypes


@pytest.fixture(scope="module")
def tabled(spark):
    """Tables of words that are rare each, split by one sign that all languages share; 3,000 words in all."""
    rng = random.Random(4)
    rows = []
    for i in range(1200):
        lang = rng.choices(list(WORDS), [6, 3, 1])[0]
        sign = "|" if lang == "fr" or rng.random() < 0.5 else ";"
        rows.append((i, f" {sign} ".join(f"{lang}{rng.randrange(1000)}" for _ in range(30)), lang))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    return rows, docs, spark.createDataFrame([(i,) for i in range(1000)], "doc_id long")


def test_every_labelled_word_is_known(tabled):
    rows, docs, labels = tabled
    model = mixing.classifier(docs, labels, sorted(TARGETS), "lang")[0]
    assert {r["word"] for r in model.collect()} == {w for i, text, _ in rows if i < 1000 for w in text.split()}
    found = mixing.rates(docs, labels, TARGETS).toPandas().set_index("doc_id")
    assert all(found["domain"][i] == lang for i, _, lang in rows)
    # What is mixed, by the documents' own languages.
    mass = (found["copies"] * found["tokens"]).groupby(found.index.map({i: lang for i, _, lang in rows})).sum()
    assert all(abs(mass[d] / mass.sum() - TARGETS[d]) < 0.02 for d in TARGETS)


def test_large_word_table_gives_the_same(tabled, tables, monkeypatch):
    for _, docs, labels in (tabled, tables):
        columns = [f"p_{d}" for d in sorted(TARGETS)]
        small = mixing.rates(docs, labels, TARGETS).toPandas().sort_values(["doc_id", *columns])
        with monkeypatch.context() as m:
            m.setattr(mixing, "BROADCAST_BYTES", -1)
            large = mixing.rates(docs, labels, TARGETS).toPandas().sort_values(["doc_id", *columns])
        assert (small["tokens"].to_numpy() == large["tokens"].to_numpy()).all()
        assert np.allclose(small[[*columns, "rate"]], large[[*columns, "rate"]])


def test_every_document_is_kept(spark, tmp_path):
    """Short texts of overlapping languages: the registered query and the pipeline drop none of them."""
    rng = random.Random(2)
    own = {"en": WORDS["en"], "fr": WORDS["fr"], "de": WORDS["de"], "es": ["el", "y", "de", "un"]}
    rows = []
    for i in range(20_000):
        lang = rng.choices(list(own), [6, 2, 1, 1])[0]
        rows.append((i, " ".join(rng.choice(own[lang]) for _ in range(rng.randrange(1, 8))), lang))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.range(0, 20_000, 4).withColumnRenamed("id", "doc_id").write.parquet(f"{tmp_path}/labels.parquet")
    found = queries.op6_mixing(spark, str(tmp_path)).toPandas()
    assert found["rate"].min() >= 1 and found["copies"].min() == 1
    mass = found[[f"p_{d}" for d in sorted(queries.TARGETS)]].to_numpy() * found["tokens"].to_numpy()[:, None]
    reached = mass.T @ found["rate"].to_numpy()
    assert np.allclose(reached / reached.sum(), [queries.TARGETS[d] for d in sorted(queries.TARGETS)], atol=2e-4)
    kept = corpus_pipeline.mixture(spark, docs, str(tmp_path))
    assert kept.count() == found["copies"].sum()
    assert kept.select("doc_id").distinct().count() == len(rows)


@pytest.mark.parametrize("targets", [(0.58, 0.42), (0.54, 0.46), (0.3, 0.7), (0.61, 0.39)])
def test_targets_near_the_edge_of_the_posteriors(spark, targets):
    """Only documents with posteriors (0.6, 0.4) and (0.4, 0.6): the total grows as far as the targets ask."""
    rows = [(1, False, 1, 1, 100, [0.6, 0.4]), (2, False, 2, 1, 100, [0.4, 0.6])]
    table = spark.createDataFrame(rows, "_id long, _none boolean, _h long, rows long, tokens long, p array<double>")
    steps, met = mixing.fit_rates(table, list(targets), None, 1e-4, 1.0)
    rates = {r["_id"]: r["rate"] for r in table.withColumn("rate", mixing._rate(steps, 1.0)).collect()}
    assert min(rates.values()) >= 1
    share = (rates[1] * 0.6 + rates[2] * 0.4) / (rates[1] + rates[2])
    possible = 0.4 <= targets[0] <= 0.6
    assert met == possible
    if possible:
        assert abs(share - targets[0]) <= 2e-4
        assert abs(min(rates.values()) - 1) < 1e-6  # and no further


def test_a_document_that_would_need_less_is_flagged_or_met(spark, monkeypatch):
    """A document whose linear rate would be below zero keeps the least one; `met` tells how it ended."""
    monkeypatch.setattr(mixing, "STEPS", 4)
    monkeypatch.setattr(mixing, "GROWTHS", (1,))
    rows = [(1, False, 1, 1, 1000, [0.9, 0.05, 0.05]), (2, False, 2, 1, 100, [0.05, 0.9, 0.05]), (3, False, 3, 1, 100, [0.05, 0.05, 0.9])]
    table = spark.createDataFrame(rows, "_id long, _none boolean, _h long, rows long, tokens long, p array<double>")
    weights = np.array([0.04, 0.48, 0.48])
    steps, met = mixing.fit_rates(table, list(weights), None, 1e-4, 1.0)
    found = table.withColumn("rate", mixing._rate(steps, 1.0)).toPandas()
    reached = (np.array(found["p"].tolist()) * found["tokens"].to_numpy()[:, None]).T @ found["rate"].to_numpy()
    assert found["rate"].min() >= 1
    assert not met and not np.allclose(reached / reached.sum(), weights, atol=1e-3)  # no document lacks the first domain
