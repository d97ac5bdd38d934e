"""Shards of nearly equal bytes by histogram sort."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from balcao.llm.frames import checkpointed

#: Bits of the key that one round of counting refines, for each open boundary.
STEP = 10
KEY_BITS = 64
_SIGN = 1 << KEY_BITS - 1


def splitters(rows: DataFrame, targets: list[int], tolerance: int) -> list[int]:
    """Key boundaries with `targets` bytes below them, as near as `tolerance` or as one key allows.

    Every round counts the exact bytes below 2**STEP candidate boundaries in each interval that still holds a target,
    in one aggregation over all partitions; an interval whose best candidate is near enough is closed.
    """
    place = F.col("key").bitwiseXOR(F.lit(-_SIGN))  # unsigned order of this is the order of the key
    found: dict[int, int] = {}
    # Each open boundary: the bits of the interval that holds it, and the bytes below that interval.
    open_ = {i: (0, 0) for i in range(len(targets))}
    bits = KEY_BITS
    while open_:
        finer = max(0, bits - STEP)
        inside = rows if bits == KEY_BITS else rows.filter(F.shiftrightunsigned(place, bits).isin([_signed(p) for p, _ in open_.values()]))
        counted = inside.groupBy(F.shiftrightunsigned(place, finer).alias("cell")).agg(F.sum("size").alias("size")).collect()
        cells = sorted((r["cell"] % (1 << KEY_BITS), r["size"]) for r in counted)
        still = {}
        for i, (interval, below) in open_.items():
            own = [(c, s) for c, s in cells if c >> bits - finer == interval]
            for cell, size in own:
                if below + size >= targets[i]:
                    break
                below += size
            else:  # no bytes reach the target: everything lies below
                found[i] = (interval + 1) << bits
                continue
            near, far = targets[i] - below, below + size - targets[i]
            if min(near, far) <= tolerance or finer == 0:
                found[i] = (cell + (far < near)) << finer
            else:
                still[i] = (cell, below)
        open_, bits = still, finer
    return [found[i] for i in range(len(targets))]


def _signed(value: int) -> int:
    return value - (1 << KEY_BITS) if value >= _SIGN else value


def _levels(heavy: list[tuple[int, int]], light: int, shards: int) -> tuple[dict[int, int], list[int]]:
    """Shard of each heavy key, and the bytes of other keys that even the shards out."""
    load, home = [0] * shards, {}
    for key, size in sorted(heavy, key=lambda h: (-h[1], h[0])):
        home[key] = min(range(shards), key=lambda s: (load[s], s))
        load[home[key]] += size
    order = sorted(range(shards), key=lambda s: load[s])
    for count in range(shards, 0, -1):
        level = (light + sum(load[s] for s in order[:count])) / count
        if level >= load[order[count - 1]]:
            break
    room = [max(0.0, level - l) for l in load]
    return home, [round(x) for x in accumulate(room)][:-1]


def shard(docs: DataFrame, shards: int = 8, columns: tuple[str, ...] = (), tolerance: float = 1e-4) -> DataFrame:
    """Rows with doc_id, size, text_crc32, law, shard, slot, grown_shard, and `columns` of `docs` beside them.

    The law is `bytes`: shards hold nearly equal sums of size, the text's UTF-8 bytes and 1. The key is the text's
    hash, so equal texts share a shard. Keys that alone hold a quarter of a shard or more (at most four times as many
    as shards) are dealt out first; the boundaries between the other keys fill the shards up evenly. Then the rows are
    exchanged once, in order of shard, key and id, and numbered within their shard by the offsets of the partitions.

    Null text counts as empty, with size 1. Repeated rows and null ids get slots of their own. An empty table gives
    no rows. `columns` may not have the names above; other columns are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = checkpointed(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("key"),
            F.monotonically_increasing_id().alias("tie"),
            *columns,
        )
    )
    total = rows.agg(F.sum("size")).first()[0] or 0
    weighty = rows.groupBy("key").agg(F.sum("size").alias("size")).filter(F.col("size") * (4 * shards) >= total)
    heavy = [(r["key"], r["size"]) for r in weighty.collect()] if total else []
    home, targets = _levels(heavy, total - sum(s for _, s in heavy), shards)
    light = rows.filter(~F.col("key").isin(list(home))) if home else rows
    bounds = splitters(light.select("key", "size"), targets, int(total / shards * tolerance)) if total else []

    own = F.lit(0)
    for bound in bounds:
        if bound < 1 << KEY_BITS:
            own = own + (F.col("key") >= F.lit(bound - _SIGN)).cast("int")
    for key, at in home.items():
        own = F.when(F.col("key") == key, F.lit(at)).otherwise(own)
    order = ["shard", "key", "doc_id", "tie"]
    dealt = checkpointed(
        rows.withColumn("shard", own)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id())
        .withColumn("at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    # One row per partition and shard that meet: partitions and shards at most.
    spans = dealt.groupBy("part", "shard").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = spans.select("part", "shard", (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return dealt.join(offsets, ["part", "shard"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("at") + F.col("shift")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        *columns,
    )
