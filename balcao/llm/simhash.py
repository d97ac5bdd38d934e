"""SimHash fingerprints, linked through Gray-order hierarchical indexes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from balcao.llm.components import components
from balcao.llm.frames import checkpointed, joined_words, pieces

SEED = 42
BITS = 64
FAN = 8
#: Fingerprints of a bucket beyond which it is cut again by further bits.
BUCKET = 2048
#: Queries that search at one time.
BLOCK = 2048

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def fingerprints(data: np.ndarray, bounds: np.ndarray, shingle: int) -> np.ndarray:
    """One 64-bit fingerprint per text: the majority of each bit over the hashes of all its shingles."""
    text, begin, end, first = joined_words(_LOWER[data], bounds)
    out = np.zeros(len(bounds) - 1, dtype=np.uint64)
    if not len(begin):
        return out
    count = np.diff(first)
    shingles = np.where(count >= shingle, count - shingle + 1, np.minimum(count, 1))
    starts = np.concatenate(([0], np.cumsum(shingles)))
    own = np.repeat(np.arange(len(count)), shingles)
    at = np.arange(starts[-1]) - starts[own] + first[own]
    last = np.minimum(at + shingle, first[own + 1]) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(text[a:b], SEED) for a, b in zip(begin[at].tolist(), end[last].tolist())], dtype="<u8")
    some = np.flatnonzero(shingles)
    # A slab of hashes at a time: one bit of a hash takes a byte here.
    ones = np.zeros((len(count), BITS), dtype=np.int64)
    slab = 1 << 16
    for low in range(0, len(hashes), slab):
        bits = np.unpackbits(hashes[low : low + slab].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        texts, heads = np.unique(own[low : low + slab], return_index=True)
        ones[texts] += np.add.reduceat(bits, heads, axis=0, dtype=np.int32)
    major = ones[some] * 2 > shingles[some, None]
    out[some] = np.packbits(major, axis=1, bitorder="little").view("<u8").ravel()
    return out


def gray_rank(values: np.ndarray) -> np.ndarray:
    """Position of each value in the reflected Gray sequence."""
    out = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(shift)
    return out


class GrayIndex:
    """Hierarchical index over the fingerprints of some buckets, each sorted by Gray rank.

    In Gray order neighbours differ in few bits. FAN neighbours form a node, FAN nodes one above them, up to a root
    for each bucket. A node holds the bits that all below it share, as mask and pattern. The differences of a query
    within the masks only grow on the way down, so a node whose pattern differs too often is dropped with all below.
    """

    def __init__(self, bucket: np.ndarray, value: np.ndarray):
        self.order = np.lexsort((gray_rank(value), bucket))
        self.value, bucket = value[self.order], bucket[self.order]
        self.levels = []  # from the leaves up: mask, pattern, first child, child after the last, last member
        low = high = self.value
        first, last = np.arange(len(value)), np.arange(1, len(value) + 1)
        group = np.unique(bucket, return_inverse=True)[1]
        while True:
            head = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            place = np.arange(len(group)) - np.repeat(head, np.diff(np.append(head, len(group))))
            start = np.flatnonzero(place % FAN == 0)
            low, high = np.bitwise_and.reduceat(low, start), np.bitwise_or.reduceat(high, start)
            mask = ~(low ^ high)
            stop = np.append(start[1:], len(group))
            last = last[stop - 1]
            self.levels.append((mask, low & mask, start, stop, last))
            group = group[start]
            if len(np.unique(group)) == len(group):
                break
        self.root = np.searchsorted(group, np.unique(bucket, return_inverse=True)[1])

    def links(self, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of positions in the order given, each once, within the distance; a block of queries at a time."""
        n = len(self.value)
        for at in range(0, n, BLOCK):
            query = np.arange(at, min(at + BLOCK, n))
            node = self.root[query]
            for mask, pattern, start, stop, last in reversed(self.levels):
                # Nodes that end before the query were searched by their own members.
                near = (last[node] > query + 1) & (np.bitwise_count((self.value[query] ^ pattern[node]) & mask[node]) <= distance)
                query, node = query[near], node[near]
                width = stop[node] - start[node]
                query = np.repeat(query, width)
                node = np.repeat(start[node], width) + np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
            near = (node > query) & (np.bitwise_count(self.value[query] ^ self.value[node]) <= distance)
            yield self.order[query[near]], self.order[node[near]]


def _joined(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after the groups of a and b are one, the least label for each group."""
    while True:
        x, y = labels[a], labels[b]
        apart = x != y
        if not apart.any():
            return labels
        np.minimum.at(labels, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while (labels[labels] != labels).any():
            labels = labels[labels]


def _segments(mask: int, parts: int) -> list[int]:
    """The bits outside `mask` cut into `parts` masks of nearly equal width, none of them empty."""
    free = [i for i in range(BITS) if not mask >> i & 1]
    cuts = np.array_split(np.array(free), parts)
    return [sum(1 << int(i) for i in cut) for cut in cuts if len(cut)]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> BITS - 1 else value


def _buckets(prints: DataFrame, distance: int) -> DataFrame:
    """(mask, bits, fp): each fingerprint in distance + 1 buckets, one of which any near one shares.

    Of distance + 1 groups of bits one has no difference. A bucket with too many members is cut again the same way by
    its other bits; when few bits are left it cannot have many members.
    """
    masks = {0}
    full = (1 << BITS) - 1
    rows = prints.select(F.lit(0).cast("long").alias("mask"), "fp")
    done = None
    while True:
        table = {m: [m | s for s in _segments(m, distance + 1)] for m in masks if m != full}
        finer = None
        for m, subs in table.items():
            choices = F.array(*[F.lit(_signed(s)).cast("long") for s in subs])
            finer = F.when(F.col("mask") == _signed(m), choices) if finer is None else finer.when(F.col("mask") == _signed(m), choices)
        rows = rows.select(F.explode(finer).alias("mask"), "fp").withColumn("bits", F.col("fp").bitwiseAND(F.col("mask"))).distinct()
        crowded = checkpointed(rows.groupBy("mask", "bits").count().filter(F.col("count") > BUCKET).select("mask", "bits"))
        if crowded.isEmpty():
            return rows if done is None else done.union(rows)
        cold = rows.join(crowded, ["mask", "bits"], "left_anti").select("mask", "fp", "bits")
        done = cold if done is None else done.union(cold)
        rows = checkpointed(rows.join(crowded, ["mask", "bits"], "left_semi").select("mask", "fp"))
        masks = {m % (1 << BITS) for m in (s for subs in table.values() for s in subs)}


def linked(prints: DataFrame, distance: int) -> DataFrame:
    """Edges (a, b) of fingerprints that connect the same ones as all links within `distance` do.

    A task searches whole buckets and hands on a tree for each group it finds, never all pairs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edges(key: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
            index = GrayIndex(key, value)
            labels = np.arange(len(value))
            for a, b in index.links(distance):
                labels = _joined(labels, a, b)
            far = np.flatnonzero(labels != np.arange(len(labels)))
            columns = [pa.array(value[far].view(np.int64)), pa.array(value[labels[far]].view(np.int64))]
            return pa.RecordBatch.from_arrays(columns, names=["a", "b"])

        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            held.append(np.column_stack([batch.column(i).to_numpy() for i in range(3)]))
            size += batch.num_rows
            if size >= 1 << 15:
                rows = np.concatenate(held)
                # The last bucket may go on in the next batch.
                new = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
                cut = int(np.flatnonzero(new)[-1]) + 1 if new.any() else 0
                if cut:
                    yield edges(_numbered(rows[:cut]), rows[:cut, 2].copy().view(np.uint64))
                held, size = [rows[cut:]], len(rows) - cut
        rows = np.concatenate(held) if held else np.zeros((0, 3), dtype=np.int64)
        if len(rows):
            yield edges(_numbered(rows), rows[:, 2].copy().view(np.uint64))

    buckets = _buckets(prints, distance).select("mask", "bits", "fp")
    return buckets.repartition("mask", "bits").sortWithinPartitions("mask", "bits").mapInArrow(run, "a long, b long").distinct()


def _numbered(rows: np.ndarray) -> np.ndarray:
    return np.cumsum(np.append(0, (rows[1:, :2] != rows[:-1, :2]).any(axis=1)))


def fingerprinted(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, h, fp) of each row; h is the hash of the whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, bounds in pieces(batches):
            fp = pa.array(fingerprints(data, bounds, shingle).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), fp], names=["doc_id", "h", "fp"])

    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text"))
    return rows.mapInArrow(run, "doc_id long, h long, fp long")


def near_groups(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """One row per row of `docs`: doc_id, fingerprint, component_id, and h, the hash of the text.

    Texts are lower-cased in A-Z; shingles are `shingle` words joined by blanks, repeats included, or all words of a
    shorter text. Fingerprints within `distance` bits are linked, and component_id is the smallest doc_id that a row
    reaches over links. Equal fingerprints are one node, so a group of copies of any size is searched once.

    Null, empty and blank texts have fingerprint zero and are linked like any other. Repeated rows are handed out one
    by one. Null ids never become a component_id unless the whole component has null ids. Other columns are not read.
    """
    rows = checkpointed(fingerprinted(docs, shingle))
    prints = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(linked(prints.select("fp"), distance))
    named = prints.join(roots, prints["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = checkpointed(named)
    # As in `components`: the join is on another form of the root, so a large component can be split.
    names = named.groupBy(F.bitwise_not("root").alias("turned")).agg(F.min("least").alias("component_id"))
    names = names.select(F.bitwise_not("turned").alias("root"), "component_id")
    component = named.select("fp", "root").join(names, "root").select("fp", "component_id")
    return rows.join(component, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "h"
    )


def deduplicated(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """One row of `docs` for each component, with all its columns: the smallest id, of equal ids the least text hash.

    Where all ids of a component are null, a row with a null id stays. Of rows that repeat each other one stays.
    """
    key = [F.coalesce("doc_id", F.lit(0)).cast("long").alias("_id"), F.col("doc_id").isNull().alias("_none")]
    groups = near_groups(docs, shingle, distance)
    # Components with null ids only have no name; their fingerprint stands in for it.
    name = F.when(F.col("component_id").isNull(), F.col("fingerprint"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), "h")
    stay = groups.groupBy("component_id", name.alias("name")).agg(F.min(order).alias("s"))
    stay = stay.select(F.col("s.id").alias("_id"), F.col("s.none").alias("_none"), F.col("s.h").alias("_h"))
    rows = docs.select(*key, F.xxhash64(F.coalesce("text", F.lit(""))).alias("_h"), F.struct("*").alias("_row"))
    same = ["_id", "_none", "_h"]
    return rows.join(stay, same, "left_semi").dropDuplicates(same).select("_row.*")
