"""Session settings. Cluster values always win; only what is unset is filled in."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators rely on.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A split of a skewed join may cost one more shuffle; a third of the rows
    # on a single key costs far more.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM leaves larger methods uncompiled; wide projections then run far
    # faster split into small ones than fused into one.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
INITIAL, OWN = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.balcao.initialPartitionNum"


def small_tasks(spark: SparkSession) -> SparkSession:
    """Tasks of a quarter of Spark's size, for tables whose rows unfold behind a shuffle.

    Spark joins small partitions by the bytes it shuffled, which are few where a row holds many. There are four times as
    many to join, so that large tables are still dealt finely. What the cluster sets for either stays.
    """
    if spark.conf.get(ADVISORY, None) is None:
        spark.conf.set(ADVISORY, "16m")
    # The number follows the cluster's, which may change between two queries.
    if spark.conf.get(INITIAL, None) == spark.conf.get(OWN, None):
        number = str(4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
        spark.conf.set(INITIAL, number)
        spark.conf.set(OWN, number)
    return spark


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Threads that are inside `shuffles_dropped` now, and the sessions they changed.
_inside, _changed, _counting = [], [], Lock()


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a write inside go when that write ends, not when the driver happens to collect its garbage.

    For writes whose rows are read again from the written files. Threads may overlap; what the cluster sets stays.
    """
    with _counting:
        _inside.append(spark)
        if spark.conf.get(CLEANUP, None) is None:
            spark.conf.set(CLEANUP, "true")
            _changed.append(spark)
    try:
        yield
    finally:
        with _counting:
            _inside.remove(spark)
            while _changed and not _inside:
                _changed.pop().conf.unset(CLEANUP)


def local_session(cpus: int | str = "*", app: str = "balcao", **extra: str) -> SparkSession:
    """Session of one machine, for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", os.environ.get("BALCAO_DRIVER_MEMORY", "12g"))
    )
    for key, value in {**RUNTIME, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, local_fallback=True)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, local_fallback: bool = False, folder: str | None = None) -> None:
    """Use the shared folder named by the cluster, or `folder` where it names none.

    A machine-local folder is only taken for a local master, where every task
    runs on that machine.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None) or folder
    if shared:
        sc.setCheckpointDir(shared)
    elif local_fallback and sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    else:
        raise RuntimeError("spark.checkpoint.dir names no shared folder for checkpoints")


def stored(df: DataFrame) -> DataFrame:
    """Computed now, written as Parquet to a folder of its own below the shared folder, and read from there.

    A query that goes on from a table much smaller than what it was made of holds the files of one half at a time.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark, local_fallback=True)
    path = f"{spark.sparkContext.getCheckpointDir()}/guardado-{uuid4().hex}"
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
