"""Document rates that bring soft domain totals to target weights."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from balcao.llm.frames import WORD_BREAK, checkpointed

#: Labelled documents that the classifier is fitted on at most, chosen by the hash of their id; it knows all their words.
MOST_LABELLED = 20_000
#: Bytes of the word table up to which every task gets it whole; a larger one meets the words in a shuffle.
BROADCAST_BYTES = 96 << 20
#: Words whose evidence counts; a longer text is as sure as one of this length.
EVIDENCE = 40
STEPS = 40
#: Growths of the total that are tried where no rates linear in the posteriors meet the targets without one below the least.
GROWTHS = (1, 4, 16)
_BLANKS = "\t\n\x0b\x0c\r "
_KEY = ["_id", "_none", "_h"]


def _keys(docs: DataFrame) -> list[Column]:
    """Id and text hash name a row; rows that repeat both are the same document."""
    return [
        F.coalesce("doc_id", F.lit(0)).cast("long").alias("_id"),
        F.col("doc_id").isNull().alias("_none"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("_h"),
    ]


def _words(rows: DataFrame) -> DataFrame:
    """A row per word of `text`, and one with an empty word for the text itself."""
    text = F.btrim(F.coalesce("text", F.lit("")), F.lit(_BLANKS))
    listed = F.when(text == "", F.array(F.lit(""))).otherwise(F.split(F.concat(F.lit(" "), text), WORD_BREAK))
    return rows.withColumn("word", F.explode(listed)).drop("text")


def classifier(docs: DataFrame, labels: DataFrame, domains: list[str], domain: str) -> tuple[DataFrame, list[float], int]:
    """Log-likelihood of each word in each domain, (word, w0, w1, ...), the log-priors, and the bytes of the words' table.

    Multinomial naive Bayes on the documents that `labels` has, with every word of them. Labels without an id and documents whose domain is
    null or has no target are left out.
    """
    chosen = labels.select(F.col("doc_id").alias("_label")).filter("_label IS NOT NULL").distinct()
    chosen = chosen.orderBy(F.xxhash64("_label"), "_label").limit(MOST_LABELLED)
    training = docs.select("doc_id", "text", F.col(domain).alias("domain")).filter(F.col("domain").isin(domains))
    training = training.join(F.broadcast(chosen), F.col("doc_id") == F.col("_label"), "left_semi").select("domain", "text")
    counts = [F.count_if(F.col("domain") == d).alias(f"c{i}") for i, d in enumerate(domains)]
    # The empty word counts the documents.
    known = checkpointed(_words(training).groupBy("word").agg(*counts))
    names = [f"c{i}" for i in range(len(domains))]
    documents = known.filter("word = ''").agg(*(F.sum(c) for c in names)).first()
    totals = known.filter("word != ''").agg(F.count(F.lit(1)), F.sum(F.octet_length("word")), *(F.sum(c) for c in names)).first()
    size = (totals[1] or 0) + totals[0] * (48 + 8 * len(domains))
    all_docs = sum(x or 0 for x in documents)
    prior = [math.log(((x or 0) + 1) / (all_docs + len(domains))) for x in documents]
    weights = [
        F.log((F.col(c) + 1) / F.lit((total or 0) + totals[0] + 1.0)).alias(f"w{i}")
        for i, (c, total) in enumerate(zip(names, totals[2:]))
    ]
    return known.filter("word != ''").select("word", *weights), prior, size


def posteriors(docs: DataFrame, model: DataFrame, prior: list[float], size: int) -> DataFrame:
    """(_id, _none, _h, rows, tokens, p): words and domain posteriors of each document, and how often its row occurs.

    Words meet a model of up to BROADCAST_BYTES in a broadcast join and are summed by document before any shuffle. For a
    larger one equal words of a document are counted first, and a frequent word's documents can be split in the join.
    """
    k = range(len(prior))
    words = _words(docs.select(*_keys(docs), "text"))
    if size <= BROADCAST_BYTES:
        times = F.lit(1)
        met = words.join(F.broadcast(model), "word", "left")
    else:
        times = F.col("times")
        met = words.groupBy(*_KEY, "word").agg(F.count(F.lit(1)).alias("times")).join(model.hint("merge"), "word", "left")
    summed = met.groupBy(*_KEY).agg(
        F.sum(F.when(F.col("word") == "", times).otherwise(0)).alias("rows"),
        F.sum(times).alias("n"),
        F.sum(F.when(F.col("w0").isNotNull(), times).otherwise(0)).alias("known"),
        *(F.sum(F.col(f"w{i}") * times).alias(f"s{i}") for i in k),
    )
    tokens = ((F.col("n") - F.col("rows")) / F.col("rows")).cast("long")
    share = F.least(F.lit(float(EVIDENCE)), F.col("known") / F.col("rows")) / F.greatest("known", F.lit(1))
    scores = [F.coalesce(F.col(f"s{i}") * share, F.lit(0.0)) + F.lit(prior[i]) for i in k]
    logs = F.array(*scores)
    spread = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    return summed.select(*_KEY, "rows", tokens.alias("tokens"), spread.alias("e")).select(
        *_KEY, "rows", "tokens", F.transform("e", lambda x: x / F.aggregate("e", F.lit(0.0), lambda a, b: a + b)).alias("p")
    )


def _rate(steps: list[np.ndarray], least: float) -> Column:
    """The rates after the steps: one to begin with, each step along the posteriors, never below `least`."""
    rate = F.lit(max(1.0, least))
    for step in steps:
        moved = sum((F.col("p")[i] * float(x) for i, x in enumerate(step)), F.lit(0.0))
        rate = F.greatest(F.lit(float(least)), rate - moved)
    return rate


def _steps(table: DataFrame, second: np.ndarray, now: np.ndarray, target: np.ndarray, tolerance: float, least: float) -> tuple[list[np.ndarray], bool]:
    """Steps of projected gradient towards the targets, and whether they are met. `now` are the totals at rates of one."""
    k = range(len(target))
    mass = F.col("rows") * F.col("tokens")
    near = tolerance * max(float(target.sum()), 1.0)
    steps: list[np.ndarray] = []
    reached = now * max(1.0, least)
    for _ in range(STEPS):
        if np.abs(reached - target).max(initial=0.0) <= near:
            break
        steps.append(np.linalg.lstsq(second, reached - target, rcond=1e-9)[0])
        before = reached
        sums = table.agg(*(F.sum(mass * F.col("p")[i] * _rate(steps, least)) for i in k)).first()
        reached = np.array([x or 0.0 for x in sums])
        if np.abs(reached - before).max() <= 1e-9 * max(float(target.sum()), 1.0):  # no step leads further
            break
    return steps, bool(np.abs(reached - target).max(initial=0.0) <= near)


def fit_rates(table: DataFrame, weights: list[float], total: float | None, tolerance: float, least: float = 0.0) -> tuple[list[np.ndarray], bool]:
    """Steps of projected gradient on the squares of expected domain totals less targets, and whether the targets are met.

    The gradient is taken in the metric of tokens and scaled by the domains' second moments, so that a rate depends
    on the posteriors only and one step is exact unless a rate meets the least one. Each step is one aggregation of a few
    sums over all documents. Without `total`, it is the least at which no domain loses tokens; with `least`, the least at
    which rates that are a mean of one rate a domain, weighted by the posteriors, meet the targets and are `least` or more
    for every document there is. Where there are no such rates, the total grows by GROWTHS until the projected steps meet
    the targets; `met` is false if none does. Targets outside the span of all posteriors cannot be met at any total, and are met as near as may be.
    """
    k = range(len(weights))
    mass = F.col("rows") * F.col("tokens")
    p = F.col("p")
    first = [F.sum(mass * p[i]).alias(f"b{i}") for i in k]
    moments = table.agg(*first, *(F.sum(mass * p[i] * p[j]).alias(f"m{i}_{j}") for i in k for j in k)).first()
    now = np.array([moments[f"b{i}"] or 0.0 for i in k])
    second = np.array([[moments[f"m{i}_{j}"] or 0.0 for j in k] for i in k])
    share = np.array(weights) / sum(weights)
    if total is not None:
        return _steps(table, second, now, share * total, tolerance, least)
    total = max((x / w for x, w in zip(now, share) if w > 0), default=0.0) * max(1.0, least)
    if not least or not total:
        return _steps(table, second, now, share * total, tolerance, least)
    # Rates of total * (p . pull) meet the targets, if they can be met at all.
    pull = np.linalg.lstsq(second, share, rcond=1e-9)[0]
    if not np.allclose(second @ pull, share, atol=tolerance):
        return _steps(table, second, now, share * total, tolerance, least)
    lowest = table.agg(F.min(sum((p[i] * float(x) for i, x in enumerate(pull)), F.lit(0.0)))).first()[0]
    if lowest > 0:
        return _steps(table, second, now, share * max(total, least / lowest), tolerance, least)
    for growth in GROWTHS:
        steps, met = _steps(table, second, now, share * total * growth, tolerance, least)
        if met:
            break
    return steps, met


def rated(
    docs: DataFrame,
    labels: DataFrame,
    targets: dict[str, float],
    domain: str = "lang",
    total: float | None = None,
    tolerance: float = 1e-4,
    seed: int = 11,
    least: float = 0.0,
) -> DataFrame:
    """One row per distinct document: _id, _none, _h, rows, tokens, p, rate, copies, met.

    No rate is below `least`; with 1 every document is kept, also one that gains nothing from the targets.
    `copies` rounds the rate up or down by a hash of id, text and seed, so that its expectation is the rate.
    """
    domains = sorted(targets)
    model, prior, size = classifier(docs, labels, domains, domain)
    table = checkpointed(posteriors(docs, model, prior, size))
    steps, met = fit_rates(table, [targets[d] for d in domains], total, tolerance, least)
    chance = F.pmod(F.xxhash64("_id", "_none", "_h", F.lit(seed)), F.lit(1 << 20)) / float(1 << 20)
    return table.withColumn("rate", _rate(steps, least)).withColumns(
        {"copies": F.floor(F.col("rate") + chance).cast("long"), "met": F.lit(met)}
    )


def rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float], **options) -> DataFrame:
    """One row per row of `docs`: doc_id, domain, tokens, rate, copies, met, and a posterior p_<domain> for each target.

    `met` says whether the expected domain totals of all rates meet the targets; where no rates can, it is false.

    Tokens are words between ASCII white space. Null and empty texts have none and the prior as posteriors; they get
    a rate like others. Rows that repeat an id and its text get one decision. A document whose own `domain` column is
    null or unknown is judged by its text like all others; that column serves the labelled rows only. Without labels
    all posteriors are equal. Other columns are not read.
    """
    domains = sorted(targets)
    out = rated(docs, labels, targets, **options)
    best = F.array(*(F.lit(d) for d in domains))[F.array_position("p", F.array_max("p")).cast("int") - 1]
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("rows")))).select(
        F.when(~F.col("_none"), F.col("_id")).alias("doc_id"),
        best.alias("domain"),
        "tokens",
        "rate",
        "copies",
        "met",
        *(F.col("p")[i].alias(f"p_{d}") for i, d in enumerate(domains)),
    )


def mixed(docs: DataFrame, labels: DataFrame, targets: dict[str, float], **options) -> DataFrame:
    """The rows of `docs` with all their columns, each as often as its `copies` says; none where that is zero."""
    decided = rated(docs, labels, targets, **options).select(*_KEY, "copies")
    rows = docs.select(*_keys(docs), F.struct("*").alias("_row")).join(decided, _KEY).filter("copies > 0")
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("_row.*")
