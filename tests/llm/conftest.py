from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng: random.Random, words: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))


@pytest.fixture(scope="session")
def rows() -> list[tuple]:
    """Copies, near copies, shared passages, repeated rows, null and empty texts, null ids, blanks of every kind."""
    rng = random.Random(5)
    passage = prose(rng, 70)
    whole = prose(rng, 120)
    long = prose(rng, 6000, 5000)
    texts: list[tuple[int | None, str | None]] = []
    for i in range(40):
        texts.append((i, prose(rng, rng.randrange(5, 200))))
    for i in range(40, 48):
        texts.append((i, whole))
    for i in range(48, 60):
        texts.append((i, f"{prose(rng, 30)} {passage} {prose(rng, 30)}"))
    texts.append((60, f"{passage} {passage}"))
    texts.append((61, whole.replace("w1", "v1", 1)))
    texts.append((62, long))
    texts.append((63, long[:9000] + " x " + long[9000:]))
    texts += [(64, None), (65, ""), (66, " \t\n\x0b\x0c\r "), (67, "x"), (68, "Äpfel und Öl\u00a0hier " * 30)]
    texts += [(69, "same row " + passage), (69, "same row " + passage), (None, "no id " + whole), (None, None)]
    texts += [(70, "A b\tc\nd"), (71, "line one\nline two\nline one\n\nline one"), (72, "\x00 a\x00b " * 50)]
    return [(i, t, rng.choice(["en", "fr", "de", "es", None]), "s", len(t or "")) for i, t in texts]


@pytest.fixture(scope="session")
def docs(spark, rows):
    """With columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    names = ["h", "key", "t1", "_row", "_text", "id", "kept", "shard", "spans", "copies", "word", "p"]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return frame.withColumns({n: F.lit(n) for n in names})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
