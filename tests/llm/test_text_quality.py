"""Operators 3 and 7."""

from __future__ import annotations

import random
from zlib import crc32

import numpy as np
import pytest

from balcao.llm import quality_classifier, quality_rules


def longest_elsewhere(words):
    n = len(words)
    best = [0] * n
    for i in range(n):
        for j in range(n):
            k = 0
            while i != j and i + k < n and j + k < n and words[i + k] == words[j + k]:
                k += 1
            best[i] = max(best[i], k)
    return best


def test_suffix_order_against_brute_force():
    rng = random.Random(2)
    for _ in range(150):
        words = [rng.randrange(rng.choice([1, 2, 5])) for _ in range(rng.randrange(40))]
        found = quality_rules.repeats(np.array([*words, 99], dtype=np.int64))
        assert found[:-1].tolist() == longest_elsewhere(words)


def test_byte_repeats_against_brute_force():
    rng = random.Random(9)
    for _ in range(60):
        texts = ["".join(rng.choice("ab\x00é"[: rng.choice([1, 2, 4])]) for _ in range(rng.randrange(30))).encode() for _ in range(rng.randrange(1, 5))]
        bounds = np.cumsum([0, *map(len, texts)])
        numbers = quality_rules._byte_numbers(np.frombuffer(b"".join(texts), np.uint8), bounds)
        found = quality_rules.repeats(numbers, quality_rules._WIDTH).tolist()
        assert found == [x for t in texts for x in [*longest_elsewhere(t), 0]]


def test_covered_bytes(docs, rows):
    found = {(r["doc_id"], r["n_bytes"], r["n_words"]): r["n_covered_bytes"] for r in quality_rules.assess(docs).collect()}
    for doc, text, *_ in rows:
        raw = (text or "").encode()
        n = 10
        while len(raw) > 4096 * 2 ** ((n - 10) / 2):
            n += 1
        seen: dict[bytes, list[int]] = {}
        for i in range(len(raw) - n + 1):
            seen.setdefault(raw[i : i + n], []).append(i)
        twice = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(n)}
        assert found[doc, len(raw), len(raw.split())] == len(twice)


def test_table_like_text_is_rejected(spark):
    rng = random.Random(10)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7))
    clean = " ".join(word() for _ in range(400))
    table = " ".join(f"{word()} | total of | {word()}" for _ in range(100))
    frame = spark.createDataFrame([(1, clean), (2, table)], "doc_id long, text string")
    assert {r["doc_id"]: (r["base_failed"], r["kept"]) for r in quality_rules.assess(frame).collect()} == {1: (False, True), 2: (False, False)}


def test_counts(docs, rows):
    found = {(r["doc_id"], r["n_words"], r["word_chars"]): r for r in quality_rules.assess(docs).collect()}
    assert quality_rules.assess(docs).count() == len(rows)
    for doc, text, *_ in rows:
        raw = (text or "").encode()
        words = raw.split()
        row = found[doc, len(words), sum(len(w.decode()) for w in words)]
        assert row["n_symbols"] == sum(raw.count(bytes([c])) for c in b"#*$%&|<>")
        lines = [x for x in raw.split(b"\n") if x.split()]
        assert row["n_dup_lines"] == sum(x in lines[:i] for i, x in enumerate(lines))
        if len(words) < 1000:
            five = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
            twice = {i + k for i, w in enumerate(five) if five.count(w) > 1 for k in range(5)}
            assert row["n_repeat_words"] == len(twice)
            assert row["longest_repeat"] == max(longest_elsewhere(words), default=0)
        assert row["base_failed"] == (len(words) < 10 or 100 * row["n_repeat_words"] > 20 * len(words))
        assert not (row["kept"] and row["base_failed"])


def test_a_long_repeat_is_rejected_and_clean_text_kept(spark):
    rng = random.Random(3)
    clean = " ".join(f"w{rng.randrange(10**6)}" for _ in range(600))
    passage = " ".join(clean.split()[:60])
    frame = spark.createDataFrame([(1, clean), (2, f"{clean} {passage}")], "doc_id long, text string")
    assert [r["doc_id"] for r in quality_rules.filtered(frame).collect()] == [1]


def test_one_short_sequence_said_twice_is_kept(spark):
    own = [f"w{i}" for i in range(250)]
    once = own[:152] + own[:13]
    twice = own[:211] + own[:13] + own[:13] + own[211:224]
    frame = spark.createDataFrame([(1, " ".join(once)), (2, " ".join(twice))], "doc_id long, text string")
    found = {r["doc_id"]: (r["n_words"], r["n_covered_words"], r["base_failed"], r["kept"]) for r in quality_rules.assess(frame).collect()}
    assert found == {1: (165, 26, False, True), 2: (250, 39, False, False)}


def test_filter_hands_on_all_columns(docs):
    kept = quality_rules.filtered(docs)
    assert kept.dtypes == docs.dtypes
    assert kept.count() == quality_rules.assess(docs).filter("kept").count()


def test_no_rows(empty):
    assert quality_rules.assess(empty).count() == 0
    assert quality_rules.filtered(empty).count() == 0


def test_isotonic_is_the_least_squares_fit():
    x, y = quality_classifier.isotonic(np.array([0.1, 0.2, 0.3, 0.4, 0.5]), np.array([0.0, 1.0, 0.0, 1.0, 1.0]))
    assert (np.diff(y) > 0).all()
    assert np.allclose(np.interp([0.1, 0.25, 0.45], x, y), [0.0, 0.5, 1.0])


@pytest.fixture(scope="module")
def judged(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(600):
        good = rng.random() < 0.7
        words = [f"word{rng.randrange(3000)}" for _ in range(rng.randrange(20, 200))]
        rows.append((i, " ".join(words if good else [w + rng.choice(["###", "$$$", "%%%"]) for w in words])))
        labels.append((i, int(good)))
    docs = spark.createDataFrame([*rows, (600, None), (601, ""), (None, "x y z"), (602, "y " * 50_000)], "doc_id long, text string")
    marks = spark.createDataFrame([*labels, (None, 1), (601, None)], "doc_id long, quality int")
    return docs, marks, dict(labels)


def test_held_out_accuracy(judged):
    docs, marks, labels = judged
    rows = quality_classifier.scores(docs, quality_classifier.fit(docs, marks)).collect()
    assert len(rows) == 604 and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows if r["doc_id"] is not None)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in held]) > 0.97


def test_held_out_labels_change_nothing(judged, spark):
    docs, marks, labels = judged
    other = spark.createDataFrame(
        [(i, 1 - q if crc32(str(i).encode()) % 5 == 0 else q) for i, q in labels.items()], "doc_id long, quality int"
    )
    a = quality_classifier.fit(docs, marks.filter("doc_id < 600"))
    b = quality_classifier.fit(docs, other)
    assert np.allclose(a.weights, b.weights)


def plain_statistics(text):
    """The statistics of one text, written out one by one."""
    raw = text.encode()
    own = raw.split()
    n, size = max(len(own), 1), max(len(raw), 1)
    lengths = [len(w) for w in own]
    mean = sum(lengths) / n
    pairs = list(zip(own, own[1:]))
    lines = [x for x in raw.split(b"\n") if x.split()]
    shares = [raw.count(bytes([b])) / size for b in set(raw)]
    kinds = [
        lambda b: 65 <= b <= 90, lambda b: 48 <= b <= 57, lambda b: b > 127, lambda b: b in b".,;:", lambda b: b in b"!?",
        lambda b: b == 124, lambda b: b in b"#*$%&<>@_=+~^\\/{}[]`", lambda b: b in b"\"'()-", lambda b: b in b" \t\n\v\f\r", lambda b: b == 10,
    ]
    return [
        np.log(1 + len(own)), mean, max(sum(x * x for x in lengths) / n - mean * mean, 0) ** 0.5, sum(x > 20 for x in lengths) / n,
        len(set(own)) / n, sum(a == b for a, b in pairs) / n, len(set(pairs)) / max(len(pairs), 1), len(lines) / n,
        1 - len(set(lines)) / max(len(lines), 1), -sum(p * np.log(p) for p in shares), *(sum(map(k, raw)) / size for k in kinds),
    ]


def test_fit_and_scores_against_plain_numpy(judged):
    """Every row: statistics, Fourier features, ridge solution, pooled calibration and scores, without Spark."""
    docs, marks, labels = judged
    texts = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    x = np.array([plain_statistics(t) for _, t in texts])
    fold = np.array([0 if i is None else crc32(str(i).encode()) % 5 for i, _ in texts])
    y = np.array([labels.get(i, np.nan) for i, _ in texts], dtype=float)
    learnt = (fold != 0) & ~np.isnan(y)
    centre, scale = x[learnt].mean(axis=0), np.maximum(x[learnt].std(axis=0), 1e-6)
    rng = np.random.default_rng(7)
    waves = rng.normal(size=(x.shape[1], quality_classifier.FEATURES)) / np.sqrt(x.shape[1])
    shift = rng.uniform(0, 2 * np.pi, quality_classifier.FEATURES)
    z = np.sqrt(2 / len(shift)) * np.cos(np.clip((x - centre) / scale, -5, 5) @ waves + shift)
    z = np.column_stack([z, np.ones(len(z))])
    fitting, held = learnt & (fold != 1), learnt & (fold == 1)
    # Ridge as least squares on stacked rows, a different way to the same weights.
    n = fitting.sum()
    stacked = np.vstack([z[fitting], np.sqrt(1e-3 * n) * np.eye(z.shape[1])])
    weights = np.linalg.lstsq(stacked, np.append(y[fitting], np.zeros(z.shape[1])), rcond=None)[0]
    model = quality_classifier.fit(docs, marks)
    assert np.allclose(model.centre, centre) and np.allclose(model.scale, scale) and np.allclose(model.weights, weights, atol=1e-6)
    raw = z @ weights
    order = np.argsort(raw[held])
    s, t = raw[held][order], y[held][order]
    # Non-decreasing least squares by its min-max formula.
    level = np.array([max(min(t[a : b + 1].mean() for b in range(i, len(t))) for a in range(i + 1)) for i in range(len(t))])
    at = [s[np.isclose(level, v)].mean() for v in np.unique(level.round(9))]
    expected = 0.99 * np.interp(raw, at, np.unique(level.round(9))) + 0.01 * np.clip(raw, 0, 1)
    rows = quality_classifier.scores(docs, model).collect()
    found = sorted((str(r["doc_id"]), round(r["score"], 4)) for r in rows)
    for (a, p), (b, q) in zip(found, sorted((str(i), e) for (i, _), e in zip(texts, expected))):
        assert a == b and abs(p - q) < 1e-3


def test_without_labels(docs, empty, spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = quality_classifier.fit(docs, none)
    assert {r["score"] for r in quality_classifier.scores(docs, model).collect()} == {0.495}
    assert quality_classifier.scores(empty, model).count() == 0
