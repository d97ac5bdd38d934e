"""Operator 11 against plain counting, and its perfect hashes."""

from __future__ import annotations

import os
import random
import re
from collections import Counter, defaultdict

import compare
import pytest
from balcao.llm import divergence, queries

SCHEMA = "doc_id long, text string, lang string, source string"


def brute(rows, least, top):
    said, held = defaultdict(Counter), defaultdict(Counter)
    groups = set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        said[lang, source].update(terms)
        held[lang].update(set(terms))
    out = []
    for lang in {x for x, _ in groups}:
        kept = [t for t, n in held[lang].items() if n >= least]
        sources = sorted(s for x, s in groups if x == lang)

        def shares(counts):
            total = sum(counts[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // total for t in kept}

        p = {s: shares(said[lang, s]) for s in sources}
        q = shares(sum((said[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in sources if o != s]
            terms = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if said[lang, s][t] and p[s][t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i) for i, (item, value) in enumerate(found[:limit], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    """A source with a third of all rows, sources and languages alone, terms that fold, nulls, empty and repeated rows."""
    rng = random.Random(8)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(300)] + ["Über", "ÜBER", "naïve", "日本", "É", "x'y", "a\x00b", "𝄞"]
    out = []
    for i in range(240):
        lang = rng.choice(["en", "fr"])
        source = "hot" if rng.random() < 0.4 else f"s{rng.randrange(4)}"
        text = rng.choice([" ", "\n", "-1"]).join(rng.choice(words[: 60 if source == "hot" else 308]).title() for _ in range(rng.randrange(30)))
        out.append((i, text, lang, source))
    out += [(500, "only one here", "xx", "alone"), (501, "zz yy", "de", "a"), (502, None, "de", "b"), (503, "", "de", None)]
    out += [(504, "12 345 @@", "en", "empty"), (505, None, None, None), (None, "the end", None, "s1"), (506, "end the", None, "s2"), (507, "the THE", "", "s2")]
    out += [(508, "twice twice", "fr", "s1")] * 3 + [(509, "long" * 5000 + " " + "word " * 3000, "en", "s0")]
    return out


@pytest.fixture(scope="module")
def frame(spark, rows):
    from pyspark.sql import functions as F

    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return table.withColumns({n: F.lit(n) for n in ("term", "shard", "n", "part", "item", "value", "rank", "salt")})


def found(df):
    return sorted(tuple(r) for r in df.collect())


def test_audit_equals_brute_force(frame, rows):
    result = divergence.audit(frame, least=3, top=20)
    assert result.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert found(result) == brute(rows, 3, 20)


def test_many_shards_passes_and_handovers_give_the_same(frame, rows, monkeypatch):
    monkeypatch.setattr(divergence, "SHARD", 64)
    monkeypatch.setattr(divergence, "BROADCAST_BYTES", 3000)
    monkeypatch.setattr(divergence, "HELD", 2000)
    monkeypatch.setattr(divergence, "SLOT_BYTES", 1500)
    assert found(divergence.audit(frame, least=2, top=7)) == brute(rows, 2, 7)


def test_nothing_kept_and_empty(frame, rows):
    assert found(divergence.audit(frame, least=10**6, top=5)) == brute(rows, 10**6, 5)
    assert divergence.audit(frame.filter("false")).count() == 0


def test_perfect_hash_is_minimal_and_verified():
    rng = random.Random(1)
    terms = [rng.randbytes(rng.randrange(1, 9)) for _ in range(3000)]
    terms = sorted(set(terms))
    hashed = divergence.Perfect.unpacked(*divergence.Perfect.build(terms).packed())
    at = hashed.find(terms, *divergence._digests(terms))
    assert sorted(at.tolist()) == list(range(len(terms)))
    assert [hashed.terms()[i] for i in at] == terms
    others = [t + bytes(9) for t in terms]  # longer than any term
    assert (hashed.find(others, *divergence._digests(others)) == -1).all()


def test_counts_of_any_size_are_exact():
    import numpy as np

    big = np.array([0, 5, 10**13, 4 * 10**17], dtype=np.int64)
    total = int(big.sum()) + 4
    assert divergence._scaled(big, total).tolist() == [1 + 10**9 * (int(c) + 1) // total for c in big]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test data")
def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.001"
    name = "op11_source_divergence"
    assert compare.differences(queries.QUERIES[name](spark, folder), compare.connect(folder), queries.ORACLES[name]) == []
