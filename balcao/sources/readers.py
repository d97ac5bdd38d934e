"""Reading raw files, layer tables and monthly tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from balcao.sources.schemas import BRONZE, SILVER, raw_schema


def read_raw(spark: SparkSession, table: str, path: str) -> DataFrame:
    """Delimited text with a header row."""
    return (
        spark.read.schema(raw_schema(table))
        .option("header", True)
        .option("sep", ";")
        .option("enforceSchema", False)
        .csv(path)
    )


BROKEN = "linha_quebrada"


def read_raw_split(spark: SparkSession, table: str, path: str, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """The lines that fit, typed, and a quarantine of the others: (motivo, linha).

    A line fits when it has as many fields as the table and every field that is not blank can be read as its declared
    type; blank fields are NULL. `motivo` is `campos` for a wrong number of fields, else the columns that cannot be
    read, joined by commas. Each line is in exactly one of the two.
    """
    text = raw_schema(table)
    # With `header` the first line of each file is skipped; the schema, not the header, names the columns.
    raw = (
        spark.read.schema(text.add(BROKEN, "string"))
        .options(header=header, sep=";", enforceSchema=True, mode="PERMISSIVE", columnNameOfCorruptRecord=BROKEN)
        .csv(path)
    )
    kinds = {c: SILVER.get(table, {}).get(c, "text") for c in BRONZE[table]}
    names = {c: "string" if kind in ("text", "string") else kind for c, kind in kinds.items()}
    value = {c: F.nullif(F.btrim(F.col(c)), F.lit("")) for c in BRONZE[table]}
    typed = {c: value[c] if kind == "string" else value[c].try_cast(kind) for c, kind in names.items()}
    unread = F.array(*(F.when(value[c].isNotNull() & typed[c].isNull(), F.lit(c)) for c in BRONZE[table]))
    reason = F.when(F.col(BROKEN).isNotNull(), F.lit("campos")).otherwise(F.array_join(unread, ","))
    judged = raw.withColumn("motivo", reason)
    good = judged.filter("motivo = ''").select(*(x.alias(c) for c, x in typed.items()))
    line = F.coalesce(BROKEN, F.concat_ws(";", *(F.coalesce(F.col(c), F.lit("")) for c in BRONZE[table])))
    return good, judged.filter("motivo != ''").select("motivo", line.alias("linha"))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_months(
    spark: SparkSession, path: str, months: list[str] | None = None, schema: str | StructType | None = None
) -> DataFrame:
    """A table partitioned by `ano_mes`, or older single-month files matching a glob.

    With a schema no file is opened to learn it, and a month list then leaves the other months' files closed; without
    one the columns of all files are merged, which reads every footer.
    """
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", True)
    df = reader.parquet(path)
    return df if months is None else df.filter(df.ano_mes.isin(months))


def read_optional(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None when it has not been written yet."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return spark.read.parquet(path) if fs.exists(jvm_path) else None


def query(spark: SparkSession, sql: str, args: dict | None = None, **tables: DataFrame) -> DataFrame:
    """SQL with `:name` parameters over DataFrames referred to as `{table}`."""
    return spark.sql(sql, args=args or {}, **tables)
