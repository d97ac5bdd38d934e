"""Operator 13 against the same rounds in plain Python."""

from __future__ import annotations

import hashlib
import math
import os
import random

import compare
import pytest
from balcao.llm import lloyd, queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k, rounds, dims, scale, salt):
    kept = []
    for ident, x in rows:
        if x is not None and len(x) == dims and all(e is not None and math.isfinite(e) for e in x):
            kept.append((ident, [math.floor(scale * e) for e in x]))
    named = lambda r: (hashlib.sha256(f"{salt}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted(kept, key=named)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centroids))

    for _ in range(rounds):
        own = [[] for _ in centroids]
        for _, v in kept:
            own[nearest(v)[1]].append(v)
        centroids = [[sum(x) // len(vs) for x in zip(*vs)] if vs else c for vs, c in zip(own, centroids)]
    out = [(ident, *reversed(nearest(v))) for ident, v in kept]
    per = [sum(r[2] for r in out if r[1] == i) for i in range(len(centroids))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, per[c], sum(per), digest[c]) for i, c, d in out), key=repr)


@pytest.fixture(scope="module")
def rows():
    """Floats that are exact in binary, so that ties occur; copies, repeated and null ids, vectors that do not count."""
    rng = random.Random(3)
    point = lambda dims=6: [rng.randrange(-8, 8) / 4 for _ in range(dims)]
    out = [(i, point()) for i in range(150)]
    out += [(200 + i, out[0][1]) for i in range(80)]
    out += [(7, out[7][1]), (7, point()), (None, point()), (None, None), (300, None), (301, []), (302, point(5)), (303, point(7))]
    out += [(304, [None, *point(5)]), (305, [float("nan"), *point(5)]), (306, [float("inf"), *point(5)]), (307, [float("-inf"), *point(5)])]
    return out


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("block, chunk", [(2, 16), (4, 1000), (6, 7)])
def test_rounds_equal_brute_force(spark, rows, monkeypatch, block, chunk):
    from pyspark.sql import functions as F

    monkeypatch.setattr(lloyd, "CHUNK", chunk)
    frame = spark.createDataFrame([(i, x, 1) for i, x in rows], SCHEMA).repartition(3)
    frame = frame.withColumns({n: F.lit(n) for n in ("v", "x", "h", "cluster", "chunk", "distance")})
    result = lloyd.clustered(frame, k=5, rounds=4, dims=6, scale=8, salt="3", block=block)
    assert found(result) == brute(rows, 5, 4, 6, 8, "3")


def test_few_or_no_vectors(spark, rows):
    few = spark.createDataFrame([(i, x, 1) for i, x in rows[:3]], SCHEMA)
    assert found(lloyd.clustered(few, k=8, rounds=3, dims=6, scale=8)) == brute(rows[:3], 8, 3, 6, 8, "3")
    none = lloyd.clustered(few.filter("false"), k=8, rounds=3, dims=6, scale=8)
    assert none.count() == 0 and [f.simpleString() for f in none.schema] == [f.simpleString() for f in lloyd.clustered(few, dims=6).schema]


def test_an_empty_cluster_keeps_its_centroid(spark):
    vectors = [(i, [0.0] * 6) for i in range(20)]  # all seeds are equal: the first takes every vector
    frame = spark.createDataFrame([(i, x, 1) for i, x in vectors], SCHEMA)
    assert found(lloyd.clustered(frame, k=3, rounds=3, dims=6, scale=8)) == brute(vectors, 3, 3, 6, 8, "3")


def test_wide_numbers_stay_exact(spark):
    rng = random.Random(1)
    vectors = [(i, [float(rng.randrange(-(1 << 23), 1 << 23)) for _ in range(6)]) for i in range(60)]
    frame = spark.createDataFrame([(i, x, 1) for i, x in vectors], SCHEMA)
    assert found(lloyd.clustered(frame, k=4, rounds=3, dims=6, scale=15, block=4)) == brute(vectors, 4, 3, 6, 15, "3")
    with pytest.raises(Exception, match="64 bits"):
        lloyd.clustered(frame, k=4, rounds=1, dims=6, scale=1024)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test data")
def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.001"
    name = "op13_centroid_clustering"
    assert compare.differences(queries.QUERIES[name](spark, folder), compare.connect(folder), queries.ORACLES[name]) == []


def test_a_round_on_few_vectors_runs_few_tasks(spark):
    rng = random.Random(5)
    frame = spark.createDataFrame([(i, [rng.randrange(-64, 64) / 8 for _ in range(6)], 1) for i in range(400)], SCHEMA)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    context, ran = spark.sparkContext, []
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "90")
        for rounds in (1, 3):
            context.setJobGroup(f"lloyd-{rounds}", "")
            lloyd.lloyd(lloyd.whole_vectors(frame, 6, 8), [[0] * 6, [9] * 6, [-9] * 6], rounds, block=2)
            tracker = context.statusTracker()
            stages = {s for j in tracker.getJobIdsForGroup(f"lloyd-{rounds}") for s in tracker.getJobInfo(j).stageIds}
            ran.append(sum(i.numTasks for s in stages if (i := tracker.getStageInfo(s)) and i.numCompletedTasks))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        context.setLocalProperty("spark.jobGroup.id", None)
    # Two more rounds of five stages, each with a task a core; over all 90 partitions they were more than 400 a round.
    assert 0 < ran[1] - ran[0] <= 2 * (5 * context.defaultParallelism + 6)
