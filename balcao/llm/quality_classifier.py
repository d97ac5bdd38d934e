"""Quality scores: a Gaussian kernel on document statistics, by random Fourier features and ridge regression."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from balcao.llm.frames import SPACES, checkpointed, pieces, words

#: Most labelled rows that a model is fitted on, chosen by the hash of their id.
MOST_LABELLED = 20_000
FEATURES = 192
PARTS = 8
HELD_OUT_FOLDS, CALIBRATION_FOLD = 5, 1


def _class(members: bytes | range) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(members)] = True
    return table


_CLASSES = {
    "capitals": _class(range(65, 91)),
    "digits": _class(range(48, 58)),
    "beyond_ascii": _class(range(128, 256)),
    "stops": _class(b".,;:"),
    "calls": _class(b"!?"),
    "bars": _class(b"|"),
    "signs": _class(b"#*$%&<>@_=+~^\\/{}[]`"),
    "quotes": _class(b"\"'()-"),
    "spaces": SPACES,
    "breaks": _class(b"\n"),
}
STATISTICS = (
    "log_words", "word_length", "word_spread", "long_words", "distinct_words", "echoes", "distinct_pairs", "lines",
    "repeated_lines", "entropy", *_CLASSES,
)


def statistics(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row of STATISTICS per text; a text without words has zeros where a mean over words is asked for."""
    begin, end, first = words(data, bounds)
    n_words, n_bytes = np.diff(first), np.diff(bounds)
    some, size = np.maximum(n_words, 1), np.maximum(n_bytes, 1)

    def total(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(values)))[edges])

    length = end - begin
    mean = total(length, first) / some
    spread = np.sqrt(np.maximum(total(length * length, first) / some - mean * mean, 0))
    raw = data.tobytes()
    rows = []
    for at, to in zip(bounds[:-1], bounds[1:]):
        text = raw[at:to]
        own = text.split()
        n = max(len(own), 1)
        lines = [line for line in text.split(b"\n") if line.strip()]
        share = np.bincount(data[at:to], minlength=256) / max(to - at, 1)
        share = share[share > 0]
        pairs = list(zip(own, own[1:]))
        rows.append(
            (
                len(set(own)) / n,
                sum(a == b for a, b in pairs) / n,
                len(set(pairs)) / max(len(pairs), 1),
                len(lines) / n,
                1 - len(set(lines)) / max(len(lines), 1),
                -float(share @ np.log(share)) if len(share) else 0.0,
            )
        )
    by_text = np.array(rows, dtype=np.float64).reshape(-1, 6)
    return np.column_stack(
        [np.log1p(n_words), mean, spread, total(length > 20, first) / some, by_text]
        + [total(table[data], bounds) / size for table in _CLASSES.values()]
    )


@dataclass(frozen=True)
class Model:
    """Standardisation, Fourier features, ridge weights and the steps of the calibration."""

    centre: np.ndarray
    scale: np.ndarray
    waves: np.ndarray
    shift: np.ndarray
    weights: np.ndarray
    steps: tuple[np.ndarray, np.ndarray]

    def features(self, x: np.ndarray) -> np.ndarray:
        # Values far outside what was seen are drawn in, so that no text leaves the kernel's reach.
        scaled = np.clip((x - self.centre) / self.scale, -5, 5)
        z = np.sqrt(2 / len(self.shift)) * np.cos(scaled @ self.waves + self.shift)
        return np.column_stack([z, np.ones(len(x))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = self.raw(x)
        calibrated = np.interp(raw, *self.steps) if len(self.steps[0]) else np.full(len(raw), 0.5)
        # A hundredth by the uncalibrated score keeps the order inside a step.
        return np.clip(0.99 * calibrated + 0.01 * np.clip(raw, 0, 1), 0, 1)


def isotonic(scores: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least-squares non-decreasing fit: the mean score and the mean label of each pooled block."""
    order = np.argsort(scores, kind="stable")
    blocks: list[list[float]] = []  # count, sum of labels, sum of scores
    for s, y in zip(scores[order], labels[order]):
        blocks.append([1, y, s])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    parts = np.array(blocks, dtype=np.float64).reshape(-1, 3)
    return parts[:, 2] / parts[:, 0], parts[:, 1] / parts[:, 0]


def _statistics_of(rows: DataFrame, carried: str) -> DataFrame:
    """`carried` columns (names and types) and the array `x` in place of _text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, bounds in pieces(batches, "_text"):
            x = pa.array(list(statistics(data, bounds)), pa.list_(pa.float64()))
            names = batch.schema.names[:-1]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], x], names=[*names, "x"])

    return rows.mapInArrow(run, f"{carried}, x array<double>")


def _fold(column: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % HELD_OUT_FOLDS, F.lit(0))


def fit(docs: DataFrame, labels: DataFrame, ridge: float = 1e-3, seed: int = 7) -> Model:
    """Fits on labelled rows outside the held-out fold, MOST_LABELLED of them at most.

    One fold calibrates, the others fit. Each partition sums its own normal equations; the driver adds PARTS of them.
    Labels that are null are left out. Without any label the score is constant.
    """
    chosen = (
        labels.select(F.col("doc_id").alias("_id"), F.col("quality").cast("double").alias("y"), _fold().alias("fold"))
        .filter("fold != 0 AND y IS NOT NULL AND _id IS NOT NULL")
        .orderBy(F.xxhash64("_id"), "_id", "y")
        .limit(MOST_LABELLED)
    )
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
    joined = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("_id", "fold", "y", "_text")
    # Where several rows have the id of a label, one of them is taken, so that the bound holds here too.
    seen = _statistics_of(joined, "_id long, fold long, y double").groupBy("_id", "fold", "y").agg(F.min("x").alias("x"))
    sample = checkpointed(seen.repartition(PARTS))

    d = len(STATISTICS)
    moments = sample.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s")).collect()
    centre, scale = np.zeros(d), np.ones(d)
    for row in moments:
        centre[row["i"]], scale[row["i"]] = row["m"], max(row["s"], 1e-6)
    rng = np.random.default_rng(seed)
    waves = rng.normal(size=(d, FEATURES)) / np.sqrt(d)
    shift = rng.uniform(0, 2 * np.pi, FEATURES)
    start = Model(centre, scale, waves, shift, np.zeros(FEATURES + 1), (np.zeros(0), np.zeros(0)))

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = np.zeros((FEATURES + 1, FEATURES + 1)), np.zeros(FEATURES + 1)
        for batch in batches:
            if batch.num_rows:
                z = start.features(np.array(batch.column("x").to_pylist()))
                a += z.T @ z
                b += z.T @ batch.column("y").to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array([np.append(a.ravel(), b)], pa.list_(pa.float64()))], names=["sums"])

    fitting = sample.filter(F.col("fold") != CALIBRATION_FOLD)
    sums = sum((np.array(r["sums"]) for r in fitting.mapInArrow(equations, "sums array<double>").collect()), np.zeros((FEATURES + 1) * (FEATURES + 2)))
    a, b = sums[: (FEATURES + 1) ** 2].reshape(FEATURES + 1, -1), sums[(FEATURES + 1) ** 2 :]
    rows = max(a[-1, -1], 1)
    model = Model(centre, scale, waves, shift, np.linalg.solve(a / rows + ridge * np.eye(FEATURES + 1), b / rows), start.steps)

    held = sample.filter(F.col("fold") == CALIBRATION_FOLD)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                raw = model.raw(np.array(batch.column("x").to_pylist()))
                yield pa.RecordBatch.from_arrays([pa.array(raw), batch.column("y")], names=["raw", "y"])

    pairs = held.mapInArrow(scored, "raw double, y double").collect()
    steps = isotonic(np.array([p["raw"] for p in pairs]), np.array([p["y"] for p in pairs]))
    return Model(centre, scale, waves, shift, model.weights, steps)


def scores(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, score, predicted.

    The score reads the text alone. Null and empty texts have the statistics of a text without words and are scored
    like any other; repeated rows get equal scores. A null id counts as held out. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, bounds in pieces(batches, "_text"):
            score = pa.array(model.score(statistics(data, bounds)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), score], names=["doc_id", "held_out", "score"])

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (_fold() == 0).alias("held_out"), F.coalesce("text", F.lit("")).alias("_text")
    )
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double").withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )
