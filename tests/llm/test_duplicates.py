"""Operators 5 and 8."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from balcao.llm import exact_dedup, simhash
from balcao.llm.components import components

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str | None, shingle: int = 4) -> int:
    words = (text or "").encode().translate(LOWER).split()
    parts = [words[i : i + shingle] for i in range(len(words) - shingle + 1)] or ([words] if words else [])
    hashes = [xxhash.xxh64_intdigest(b" ".join(p), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(values: list[int], distance: int) -> list[int]:
    label = list(range(len(values)))
    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= distance and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return label


@pytest.mark.parametrize("distance", [0, 4, 20])
def test_groups_against_brute_force(docs, rows, distance):
    prints = [fingerprint(r[1]) for r in rows]
    label = groups(prints, distance)
    ids = defaultdict(list)
    for row, own in zip(rows, label):
        ids[own] += [row[0]] if row[0] is not None else []
    expected = sorted(((r[0], f"{p:016x}", min(ids[own], default=None)) for r, p, own in zip(rows, prints, label)), key=repr)
    found = simhash.near_groups(docs, 4, distance).drop("h").collect()
    assert sorted((tuple(r) for r in found), key=repr) == expected


def test_one_row_of_each_group_stays(docs, rows):
    kept = simhash.deduplicated(docs)
    assert kept.dtypes == docs.dtypes
    label = groups([fingerprint(r[1]) for r in rows], 4)
    best = {}
    for row, own in zip(rows, label):
        best[own] = min(best.get(own, 1 << 60), 1 << 60 if row[0] is None else row[0])
    assert sorted((r["doc_id"] if r["doc_id"] is not None else 1 << 60) for r in kept.collect()) == sorted(best.values())


def clustered(rng: random.Random, n: int) -> list[int]:
    seeds = [rng.getrandbits(64) for _ in range(max(1, n // 12))]
    out = set()
    while len(out) < n:
        value = rng.choice(seeds)
        for _ in range(rng.randrange(6)):
            value ^= 1 << rng.randrange(64)
        out.add(value)
    return sorted(out)


def test_gray_index_finds_every_link():
    rng = random.Random(1)
    for n in (1, 2, 9, 70, 900):
        value = np.array(clustered(rng, n), dtype=np.uint64)
        bucket = np.array([rng.randrange(3) for _ in range(n)])
        found = {frozenset(p) for a, b in simhash.GrayIndex(bucket, value).links(4) for p in zip(a.tolist(), b.tolist())}
        near = np.bitwise_count(value[:, None] ^ value[None, :]) <= 4
        expected = {frozenset((i, j)) for i, j in np.argwhere(near & (bucket[:, None] == bucket[None, :])).tolist() if i < j}
        assert found == expected


@pytest.mark.parametrize("limit", [24, 2048])
def test_crowded_buckets_lose_no_link(spark, monkeypatch, limit):
    monkeypatch.setattr(simhash, "BUCKET", limit)
    value = clustered(random.Random(8), 300)
    prints = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in value], "fp long")
    roots = {r["node"] % (1 << 64): r["root"] for r in components(simhash.linked(prints, 4)).collect()}
    label = groups(value, 4)
    ours = [roots.get(v, f"alone {v}") for v in value]
    assert len({*zip(ours, label)}) == len({*ours}) == len({*label})


def test_components(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100 + rng.randrange(40), 100 + rng.randrange(40)) for _ in range(60)]
    frame = spark.createDataFrame(edges, "a long, b long")
    found = dict((r["node"], r["root"]) for r in components(frame).collect())
    nodes = sorted({x for a, b in edges if a != b for x in (a, b)})
    label = {x: x for x in nodes}
    for _ in nodes:
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    assert found == label
    assert components(frame.limit(0)).count() == 0


@pytest.mark.parametrize("crowd", [2, exact_dedup.CROWD])
@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact(docs, rows, keep, crowd):
    by = defaultdict(list)
    for doc, text, *_ in rows:
        by[text or ""].append(doc)
    found = exact_dedup.decisions(docs, keep=keep, crowd=crowd).collect()
    assert len(found) == len(rows)
    stay = defaultdict(int)
    for r in found:
        stay[r["text_sha256"]] += r["kept"]
    assert set(stay.values()) == {1}
    expected = []
    for doc, text, *_ in rows:
        ids = [i for i in by[text or ""] if i is not None]
        best = (max if keep == "largest" else min)(ids, default=None)
        expected.append((doc, best, len(by[text or ""]), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in found), key=repr) == sorted(expected, key=repr)
    assert all(r["doc_id"] == r["keep_id"] for r in found if r["kept"])


@pytest.mark.parametrize("crowd", [2, exact_dedup.CROWD])
def test_exact_rows(docs, rows, crowd):
    kept = exact_dedup.deduplicated(docs, keep="largest", crowd=crowd)
    assert kept.dtypes == docs.dtypes
    best = {}
    for doc, text, *_ in rows:
        best[text or ""] = max(best.get(text or "", -1), -1 if doc is None else doc)
    found = {(-1 if r["doc_id"] is None else r["doc_id"], r["text"] or "") for r in kept.collect()}
    assert found == {(doc, text) for text, doc in best.items()} and kept.count() == len(best)


def test_copies_meet_as_neighbours(spark):
    """Texts that begin alike and have up to four copies each, and one with 300: only that one is dealt out."""
    texts = [f"{'same beginning ' * 9}{i}" for i in range(200) for _ in range(1 + i % 4)] + ["crowd"] * 300
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    runs = exact_dedup._sorted_runs(docs, [], "none", "largest", exact_dedup.CROWD).filter("_place = 1").collect()
    sizes = defaultdict(list)
    for r in runs:
        sizes[r["_text"]].append(r["_rows"])
    dealt = sizes.pop("crowd")
    assert len(dealt) > 30 and sum(dealt) == 300
    assert {t: n for t, (n,) in sizes.items()} == {t: texts.count(t) for t in sizes} and len(sizes) == 200


def test_few_texts_are_dealt_out(spark):
    most = 4 * exact_dedup.partitions(spark)
    docs = spark.createDataFrame([(i * 10 + j, f"t{i}") for i in range(most + 5) for j in range(1 + (i < most))], "doc_id long, text string")
    runs = exact_dedup._sorted_runs(docs, [], "none", "smallest", 1)
    assert runs.filter("_salt IS NOT NULL").select("_text").distinct().count() == most
    assert exact_dedup.decisions(docs, crowd=0).filter("kept").count() == most + 5


def test_normalised(spark):
    frame = spark.createDataFrame([(1, "A  b"), (2, "a b"), (3, "A b ")], "doc_id long, text string")
    assert exact_dedup.decisions(frame, "lower").filter("kept").count() == 3
    assert exact_dedup.decisions(frame, "spaces").filter("kept").count() == 2


def test_no_rows(empty):
    assert exact_dedup.decisions(empty).count() == exact_dedup.deduplicated(empty).count() == 0
    assert simhash.near_groups(empty).count() == simhash.deduplicated(empty).count() == 0
