"""Writing layer tables, replacing one month, publishing to consumers."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

from balcao.operators.quality import require
from balcao.session import ensure_checkpoint_dir
from balcao.sources import readers
from balcao.sources.schemas import GOLD, KEYS


def _ordered(df: DataFrame, table: str | None) -> DataFrame:
    """Rows sorted by key inside each file: tight min/max statistics without a global sort."""
    key = [c for c in KEYS.get(table, []) if c in df.columns]
    return df.sortWithinPartitions(*key) if key else df


def replace_table(df: DataFrame, path: str, table: str | None = None) -> None:
    """Replace a whole table."""
    _ordered(df, table).write.mode("overwrite").parquet(path)


def replace_months(df: DataFrame, path: str, table: str | None = None, months: list[str] | None = None) -> None:
    """Replace only the months present in `df`; other months keep their files.

    `months` names the months that are being replaced: one of them without rows becomes empty. Rows are brought
    together by month, and a large month is split by the rebalance.
    """
    spread = df.hint("rebalance", "ano_mes")
    (
        _ordered(spread, table)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ano_mes")
        .parquet(path)
    )
    if months:
        found = {r["ano_mes"] for r in df.filter(df.ano_mes.isin(months)).select("ano_mes").distinct().collect()}
        for month in set(months) - found:
            df.filter("false").drop("ano_mes").write.mode("overwrite").parquet(f"{path}/ano_mes={month}")


def save_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int, path: str | None = None) -> None:
    """Table bucketed by its join key, in the warehouse or at `path`: joins on that key need no shuffle.

    Rows are brought together by bucket before the write, so each bucket is one sorted file.
    """
    writer = df.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def write_checked(
    df: DataFrame,
    rules: Callable[[DataFrame], DataFrame],
    write: Callable[[DataFrame], None],
) -> dict[str, int]:
    """Compute once, check, and only then write.

    The finished rows wait in a folder of their own below the cluster's shared folder, so that the rules and the write
    read them and a lost executor costs nothing but its running tasks. The folder goes when the write is done, or fails.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/checked-{uuid4().hex}"
    waiting = spark._jvm.org.apache.hadoop.fs.Path(folder)
    try:
        df.write.parquet(folder)
        done = spark.read.schema(df.schema).parquet(folder)
        counts = require(rules(done))
        write(done)
    finally:
        waiting.getFileSystem(spark._jsc.hadoopConfiguration()).delete(waiting, True)
    return counts


# ── publishing ────────────────────────────────────────────────


def _to_table(writer: DataFrameWriter, table: str, options: dict) -> None:
    writer.saveAsTable(table)


def _to_jdbc(writer: DataFrameWriter, table: str, options: dict) -> None:
    """Every partition writes over its own connection, nothing passes the driver."""
    writer.format("jdbc").option("dbtable", table).options(**options).save()


def _to_files(writer: DataFrameWriter, table: str, options: dict) -> None:
    extra = {k: v for k, v in options.items() if k not in ("folder", "format")}
    writer.format(options.get("format", "parquet")).options(**extra).save(f"{options['folder']}/{table}")


TARGETS: dict[str, Callable[[DataFrameWriter, str, dict], None]] = {
    "table": _to_table,
    "jdbc": _to_jdbc,
    "files": _to_files,
}


def find_layout(spark: SparkSession, root: str, table: str) -> str:
    """Path pattern of a table: one file set, older monthly files, or a catalogue error."""
    base = f"{root.rstrip('/')}/{table}"
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(path(f"{base}/{table}.parquet")):
        return f"{base}/{table}.parquet"
    if fs.globStatus(path(f"{base}/{table}-*.parquet")):
        return f"{base}/{table}-*.parquet"
    if fs.exists(path(base)):
        return base
    known = sorted(s.getPath().getName() for s in fs.listStatus(path(root))) if fs.exists(path(root)) else []
    raise FileNotFoundError(f"tabela '{table}' nao existe em {root}; disponiveis: {known}")


def publish(
    spark: SparkSession, root: str, table: str, target: str = "table", name: str | None = None, **options: str
) -> None:
    """Replace a consumer table by the stored one, all months together."""
    if target not in TARGETS:
        raise ValueError(f"destino '{target}' desconhecido; disponiveis: {sorted(TARGETS)}")
    layout = find_layout(spark, root, table)
    df = readers.read_months(spark, layout, schema=GOLD.get(table))
    TARGETS[target](df.write.mode("overwrite"), name or table, options)
