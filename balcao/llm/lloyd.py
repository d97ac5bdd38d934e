"""Centroid clustering on integer vectors, cut by columns: each shard of columns keeps its slice of the centroids."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from balcao.llm.frames import checkpointed, partitions, stored

#: Vectors of a chunk at most; the blocks of a chunk travel and are added as a whole.
CHUNK = 2048
#: Columns of a shard.
BLOCK = 32
#: Chunks of a task at least, where there are more tasks than cores.
DEALT = 16
#: Integer components below this size keep squared distances of up to 64 of them within 64 bits.
LARGEST = 1 << 27


def whole_vectors(rows: DataFrame, dims: int, scale: int, vector: str = "embedding", ident: str = "vec_id") -> DataFrame:
    """(vec_id, v): the rows whose vector has `dims` components, none null or non-finite, as floor(scale * x)."""
    x = F.col("x").cast("array<double>")
    good = (F.size("x") == dims) & F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
    limited = F.transform(x, lambda e: F.floor(e * F.lit(float(scale))).cast("long"))
    return (
        rows.select(F.col(ident).cast("long").alias("vec_id"), F.col(vector).alias("x"))
        .filter(F.col("x").isNotNull() & good)
        .select("vec_id", limited.alias("v"))
    )


def _small(values: np.ndarray) -> np.ndarray:
    """The same numbers in the narrowest type that holds them."""
    low, high = int(values.min(initial=0)), int(values.max(initial=0))
    for kind in (np.int16, np.int32):
        if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max:
            return values.astype(kind)
    return values.astype(np.int64)


def _blocks(vectors: DataFrame, dims: int, block: int) -> DataFrame:
    """(chunk, block, n, ids, width, data): each chunk of vectors once per shard of columns; block -1 has the ids."""
    names = ["chunk", "block", "n", "ids", "width", "data"]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.int32(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                values = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
                if len(values) and max(abs(int(values.min())), abs(int(values.max()))) >= LARGEST:
                    raise ValueError(f"a component of {LARGEST} or more would not keep distances within 64 bits")
                n = len(values)
                rows = [(chunk, -1, n, part.column(0).to_pylist(), 0, b"")]
                for b in range(-(-dims // block)):
                    own = _small(values[:, b * block : (b + 1) * block])
                    rows.append((chunk, b, n, None, own.itemsize, own.tobytes()))
                chunk += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return vectors.mapInArrow(run, "chunk long, block int, n int, ids array<long>, width int, data binary")


def _partial(values: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distance of each vector to each centroid over the columns of a shard, exact."""
    wide = values.astype(np.int64)
    out = np.empty((len(wide), len(centroids)), dtype=np.int64)
    for k, centroid in enumerate(centroids):
        apart = wide - centroid
        out[:, k] = np.einsum("ij,ij->i", apart, apart)
    return _small(out)


def _added(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _small(a.astype(np.int64) + b)


def _sums(values: np.ndarray, cluster: np.ndarray, k: int) -> np.ndarray:
    """Per cluster the sum of its vectors' columns, and behind them their number; Python's whole numbers."""
    out = np.zeros((k, values.shape[1] + 1), dtype=np.int64)
    np.add.at(out[:, :-1], cluster, values)
    out[:, -1] = np.bincount(cluster, minlength=k)
    return out.astype(object)


def _gathered(pairs: RDD, tasks: int) -> RDD:
    """The pairs dealt by key and read by `tasks` tasks, also where the shuffle has more partitions than that."""
    return pairs.partitionBy(tasks, hash).coalesce(tasks)


def _folded(pairs: Iterator[tuple], add: Callable) -> Iterator[tuple]:
    """The values of each key added up; a task holds one value for each of its keys."""
    out: dict = {}
    for key, value in pairs:
        out[key] = add(out[key], value) if key in out else value
    return iter(out.items())


def _moves(pairs: Iterator[tuple], k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(block, sums): the columns of a chunk, an array of rows, meet the choice of its vectors, one number each."""
    waiting: dict = {}
    for key, value in pairs:
        if key not in waiting:
            waiting[key] = value
            continue
        other = waiting.pop(key)
        values, cluster = (value, other) if value.ndim == 2 else (other, value)
        yield key[1], _sums(values, cluster, k)


@dataclass(frozen=True)
class Clusters:
    """`rows` has vec_id, cluster, distance; `centroids` the final components; `inertia` the sum of distances by cluster."""

    rows: DataFrame
    centroids: list[list[int]]
    inertia: list[int]


def lloyd(vectors: DataFrame, seeds: list[list[int]], rounds: int, block: int = BLOCK) -> Clusters:
    """Lloyd's rounds on (vec_id, v) from the given centroids, in whole numbers.

    The vectors are cut into shards of `block` columns, written once to the shared folder, and dealt once by chunk and
    shard. In a round a task of a shard takes exact partial distances of its columns to its slice of the centroids;
    the partial distances of a chunk are added by key and the nearest centroid is taken, the smaller number where
    two are as near; the choice goes back to the shards, one small number a vector, where it meets the columns in a
    shuffle by chunk and shard; and the sums of each cluster, folded in every task first, move that shard's slice. A
    centroid is the floor of the mean of its vectors; without vectors it stays. After the last round vectors are
    assigned once more. There are as many tasks as the vectors call for, at least one a core and at most one for each
    partition of the cluster's shuffles: a round has five stages, and small tasks would take longer to start than to run.

    The driver holds the centroids and, once a round, the sums of each shard: both are as many numbers as centroids times
    columns. A round reads nothing of the one before but the centroids, so lost executors cost their own tasks.

    Rows are vectors: repeated rows count as often as they occur, and null ids are kept. Without vectors, or without
    seeds, there are no rows. Components must be smaller than LARGEST; others raise.
    """
    spark = vectors.sparkSession
    empty = "vec_id long, cluster int, distance long"
    if not seeds:
        return Clusters(spark.createDataFrame([], empty), [], [])
    dims, k = len(seeds[0]), len(seeds)
    shards = -(-dims // block)
    cut = stored(_blocks(vectors, dims, block))
    kinds = {w: np.dtype(f"i{w}") for w in (2, 4, 8)}
    blocks = cut.filter("block >= 0")
    cells = blocks.agg(F.sum("n")).first()[0] or 0
    tasks = max(1, min(partitions(spark), max(spark.sparkContext.defaultParallelism, cells // (DEALT * CHUNK))))
    dealt = _gathered(
        blocks.select("chunk", "block", "n", "width", "data").rdd.map(
            lambda r: ((r[0], r[1]), np.frombuffer(r[4], kinds[r[3]]).reshape(r[2], -1))
        ),
        tasks,
    )

    def distances(centroids: np.ndarray) -> RDD:
        slices = [centroids[:, b * block : (b + 1) * block] for b in range(shards)]
        partial = dealt.map(lambda x: (x[0][0], _partial(x[1], slices[x[0][1]])))
        return _gathered(partial, tasks).mapPartitions(lambda pairs: _folded(pairs, _added))

    label = np.uint8 if k <= 256 else np.uint32
    centroids = np.array(seeds, dtype=np.int64)
    for _ in range(rounds):
        nearest = distances(centroids).mapValues(lambda d: d.argmin(axis=1).astype(label))
        back = nearest.flatMap(lambda x: [((x[0], b), x[1]) for b in range(shards)])
        met = _gathered(dealt.union(back), tasks).mapPartitions(lambda pairs: _folded(_moves(pairs, k), np.add))
        moved = centroids.copy()
        for b, sums in _gathered(met, shards).mapPartitions(lambda pairs: _folded(pairs, np.add)).collect():
            for c in range(k):
                if sums[c, -1]:
                    moved[c, b * block : (b + 1) * block] = sums[c, :-1] // sums[c, -1]
        if (moved == centroids).all():  # no further round would change anything
            break
        centroids = moved

    def chosen(d: np.ndarray) -> tuple[list[int], list[int]]:
        return d.argmin(axis=1).tolist(), d.min(axis=1).tolist()

    final = spark.createDataFrame(
        distances(centroids).map(lambda x: (x[0], *chosen(x[1]))), "chunk long, cluster array<int>, distance array<long>"
    )
    ids = cut.filter("block = -1").select("chunk", "ids")
    each = F.explode(F.arrays_zip("ids", "cluster", "distance")).alias("x")
    rows = checkpointed(
        ids.join(final, "chunk").select(each).select(F.col("x.ids").alias("vec_id"), F.col("x.cluster").alias("cluster"), F.col("x.distance").alias("distance"))
    )
    totals = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect()
    inertia = {r[0]: int(r[1]) for r in totals}
    return Clusters(rows, centroids.tolist(), [inertia.get(c, 0) for c in range(k)])


def first_by_hash(vectors: DataFrame, k: int, salt: str) -> list[list[int]]:
    """The `k` vectors whose `<salt>:<vec_id>` have the smallest SHA-256; a null id is an empty one, ties go by components."""
    named = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    chosen = vectors.select(named.alias("h"), "v").orderBy("h", "v").limit(k)
    return [r["v"] for r in chosen.collect()]


def clustered(rows: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, salt: str = "3", block: int = BLOCK) -> DataFrame:
    """One row per kept vector of `rows`: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Kept are vectors with `dims` components, none null or non-finite; all other rows, null and empty vectors too, are
    left out. With fewer vectors than `k` there are as many centroids as vectors. Other columns are not read.
    """
    vectors = whole_vectors(rows, dims, scale)
    found = lloyd(vectors, first_by_hash(vectors, k, salt), rounds, block)
    spark = rows.sparkSession
    table = [
        (c, inertia, sum(found.inertia), ",".join(map(str, centroid)))
        for c, (inertia, centroid) in enumerate(zip(found.inertia, found.centroids))
    ]
    # One row per centroid.
    per = spark.createDataFrame(table, "cluster int, cluster_inertia long, inertia long, components string")
    per = per.select("cluster", "cluster_inertia", "inertia", F.sha2(F.col("components").cast("binary"), 256).alias("centroid_sha256"))
    return found.rows.join(F.broadcast(per), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
