"""Exact duplicates by a sort on content: equal texts become neighbours, which are compared in full."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from balcao.llm.frames import checkpointed, partitions

#: Characters of a text that choose its range; the sort and the comparison read the whole text.
HEAD = 64
#: Copies up to which a text is never dealt over several runs.
CROWD = 256

NORMALISE = {
    "none": lambda text: text,
    "lower": F.lower,
    "spaces": lambda text: F.trim(F.regexp_replace(text, r"\s+", " ")),
}


def _crowded(rows: DataFrame, crowd: int) -> DataFrame:
    """Hashes of the texts that are dealt over several runs: those with most copies, if more than `crowd`.

    At most four a shuffle partition are named, so any other text has at most a quarter of a partition's mean rows, or
    `crowd` of them. The list has a bound that does not depend on the data, and is broadcast.
    """
    most = 4 * partitions(rows.sparkSession)
    counts = rows.groupBy("_hash").agg(F.count(F.lit(1)).alias("_copies")).filter(F.col("_copies") > crowd)
    return checkpointed(counts.orderBy(F.col("_copies").desc(), "_hash").limit(most).select("_hash", F.lit(True).alias("_hot")))


def _sorted_runs(docs: DataFrame, carried: list[Column], normalise: str, keep: str, crowd: int) -> DataFrame:
    """Rows in content order with the place of each in its run of equal texts.

    Sampled splitters range-partition the rows by the head of the normalised text and then its hash, Spark's external
    sort puts equal texts side by side, and the window compares each text in full with its neighbour. Only heads reach
    the driver as samples, HEAD characters each; the hash spreads texts that begin alike. A text has one run, with null
    as its salt, unless it is crowded: its rows then get a salt from the id and make one run a salt.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep is smallest or largest, not {keep}")
    salts = max(64, partitions(docs.sparkSession))
    order = F.col("_id").asc_nulls_last() if keep == "smallest" else F.col("_id").desc_nulls_last()
    text = NORMALISE[normalise](F.coalesce(F.col("text"), F.lit("")))
    hot = _crowded(docs.select(F.xxhash64(text).alias("_hash")), crowd)
    rows = docs.select(F.col("doc_id").alias("_id"), text.alias("_text"), *carried).withColumn("_hash", F.xxhash64("_text"))
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64("_id"), F.lit(salts)).cast("int"))
    rows = rows.join(F.broadcast(hot), "_hash", "left").withColumn("_salt", salt).drop("_hot")
    rows = rows.withColumn("_head", F.substring("_text", 1, HEAD)).repartitionByRange("_head", "_hash", "_salt")
    run = Window.partitionBy("_head", "_hash", "_salt", "_text")
    return rows.withColumns(
        {
            "_place": F.row_number().over(run.orderBy(order)),
            "_rows": F.count(F.lit(1)).over(run),
            "_best": (F.min if keep == "smallest" else F.max)("_id").over(run),
            "_sha": F.sha2(F.col("_text").cast("binary"), 256),
        }
    ).drop("_head", "_hash")


def decisions(docs: DataFrame, normalise: str = "none", keep: str = "smallest", crowd: int = CROWD) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty, so null and empty texts are one group. Of rows that repeat an id with the same text
    exactly one is kept. A null id is kept only where its whole group has null ids; keep_id is null then. Other
    columns are not read. The run of a text decides on its rows; only the runs of texts with more than `crowd` copies,
    and not all of these, meet again as small digests, at most one per salt.
    """
    rows = checkpointed(
        _sorted_runs(docs, [], normalise, keep, crowd).select("_id", "_salt", "_sha", "_place", "_rows", "_best")
    )
    columns = [F.col("_id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("_sha").alias("text_sha256")]
    whole = rows.filter("_salt IS NULL").withColumns(
        {"keep_id": F.col("_best"), "group_size": F.col("_rows"), "kept": F.col("_place") == 1}
    )
    # One key for text and salt: the rows of a large group are shuffled run by run.
    dealt = rows.filter("_salt IS NOT NULL").withColumn("_run", F.concat_ws("/", "_sha", "_salt"))
    text = Window.partitionBy("_sha")
    best = F.col("_best").asc_nulls_last() if keep == "smallest" else F.col("_best").desc_nulls_last()
    runs = dealt.filter("_place = 1").select(
        F.col("_run").alias("run"),
        (F.min if keep == "smallest" else F.max)("_best").over(text).alias("keep_id"),
        F.sum("_rows").over(text).alias("group_size"),
        (F.row_number().over(text.orderBy(best, "_salt")) == 1).alias("first"),
    )
    dealt = dealt.join(runs, dealt["_run"] == runs["run"]).withColumn("kept", F.col("first") & (F.col("_place") == 1))
    return whole.select(*columns).unionByName(dealt.select(*columns))


def deduplicated(docs: DataFrame, normalise: str = "none", keep: str = "smallest", crowd: int = CROWD) -> DataFrame:
    """The kept rows of `docs` with all their columns.

    The whole row travels once with its text, which is carried once where it is not normalised. The first row of a run
    is kept; of a text that is dealt over several runs the first rows meet again. Columns of any name may be present.
    """
    quoted = {c: F.col(f"`{c.replace('`', '``')}`") for c in docs.columns}
    own = normalise == "none"
    carried = F.struct(*(v for c, v in quoted.items() if not (own and c == "text"))).alias("_row")
    missing = F.col("text").isNull().alias("_missing")
    heads = _sorted_runs(docs, [carried, missing], normalise, keep, crowd).filter("_place = 1")
    order = F.col("_id").asc_nulls_last() if keep == "smallest" else F.col("_id").desc_nulls_last()
    first = F.row_number().over(Window.partitionBy("_sha").orderBy(order, "_salt"))
    text = F.when(~F.col("_missing"), F.col("_text"))
    columns = [(text if own and c == "text" else F.col("_row").getField(c)).alias(c) for c in docs.columns]
    dealt = heads.filter("_salt IS NOT NULL").withColumn("_first", first).filter("_first = 1")
    return heads.filter("_salt IS NULL").select(*columns).unionAll(dealt.select(*columns))
