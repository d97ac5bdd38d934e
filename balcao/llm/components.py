"""Connected components of an edge list, by Spark joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from balcao.llm.frames import checkpointed


def _starred(edges: DataFrame, larger: bool) -> DataFrame:
    """Hang the neighbours of each node on the least of them: the larger neighbours, or the others and the node."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not larger:
        both = both.filter("b < a")
    least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
    # The join is on another form of the node, so both sides are shuffled for it and a large star can be split.
    least = least.select(F.bitwise_not("a").alias("turned"), "m")
    both = both.withColumn("turned", F.bitwise_not("a"))
    if larger:
        moved = both.filter("b > a").join(least, "turned").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = both.join(least, "turned").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
    return moved.filter("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b), its root being the least node that it reaches.

    Large-star and small-star rounds until nothing changes. A node's least neighbour is an aggregate that combines
    before the shuffle and meets the edges in a plain join, which Spark may split where one node has most of them.
    Each round is written to the shared checkpoint folder.
    """
    mark = (F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
    current = checkpointed(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct())
    state = tuple(current.agg(*mark).first())
    while state[0]:
        current = checkpointed(_starred(_starred(current, larger=True), larger=False))
        before, state = state, tuple(current.agg(*mark).first())
        if state == before:
            break
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(current.select(F.col("b"), F.col("b")).distinct())
