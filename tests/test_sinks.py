"""Writing, replacing one month, checked writes and publishing."""

from __future__ import annotations

import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from balcao.operators import quality
from balcao.sources import readers, sinks


def _months(spark, *months, value=1):
    return spark.createDataFrame([(m, c, value) for m in months for c in ("A", "B")], "ano_mes string, cliente_id string, n int")


def _hashes(folder: Path) -> dict:
    return {str(p): hashlib.md5(p.read_bytes()).hexdigest() for p in folder.rglob("*.parquet")}


def test_replacing_a_month_leaves_the_others(spark, tmp_path):
    path = tmp_path / "metricas"
    sinks.replace_months(_months(spark, "1997-04", "1997-05"), str(path), "historico_cliente_metricas")
    before = _hashes(path / "ano_mes=1997-05")
    for _ in range(2):
        sinks.replace_months(_months(spark, "1997-04", value=2), str(path), "historico_cliente_metricas")
    assert _hashes(path / "ano_mes=1997-05") == before
    table = readers.read_months(spark, str(path))
    assert dict(table.schema.fields[-1].jsonValue())["type"] == "string"
    assert {(r.ano_mes, r.n) for r in table.collect()} == {("1997-04", 2), ("1997-05", 1)} and table.count() == 4
    pruned = readers.read_months(spark, str(path), ["1997-04"])
    assert "PartitionFilters: [isnotnull(ano_mes" in pruned._jdf.queryExecution().toString() and pruned.count() == 2


def test_a_replaced_month_may_become_empty(spark, tmp_path):
    path = str(tmp_path / "m")
    sinks.replace_months(_months(spark, "1997-04", "1997-05"), path)
    sinks.replace_months(_months(spark, "1997-04").limit(0), path, months=["1997-04"])
    schema = "cliente_id string, n int, ano_mes string"
    assert {r.ano_mes for r in readers.read_months(spark, path, schema=schema).collect()} == {"1997-05"}


def test_a_declared_schema_leaves_other_months_closed(spark, tmp_path):
    path = tmp_path / "m"
    sinks.replace_months(_months(spark, "1997-04", "1997-05"), str(path))
    for file in (path / "ano_mes=1997-05").glob("*.parquet"):
        file.write_bytes(b"broken")
    schema = "cliente_id string, n int, ano_mes string"
    assert readers.read_months(spark, str(path), ["1997-04"], schema).count() == 2


def test_replace_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace_table(_months(spark, "1997-04"), path, "historico_cliente_volume")
    sinks.replace_table(_months(spark, "1997-05"), path)
    assert {r.ano_mes for r in readers.read_table(spark, path).collect()} == {"1997-05"}


def test_broken_tables_are_not_written(spark, tmp_path):
    path = str(tmp_path / "clientes")
    rows = spark.createDataFrame([("A", "x"), ("A", "y")], "customer_id string, company_name string")
    with pytest.raises(quality.QualityError):
        sinks.write_checked(rows, quality.customers, lambda df: sinks.replace_table(df, path))
    assert readers.read_optional(spark, path) is None
    counts = sinks.write_checked(rows.limit(1), quality.customers, lambda df: sinks.replace_table(df, path))
    assert set(counts.values()) == {0} and readers.read_table(spark, path).count() == 1


def test_publish_finds_both_layouts(spark, tmp_path):
    root = tmp_path / "gold"
    sinks.replace_table(_months(spark, "1997-04"), str(root / "ticket" / "ticket.parquet"))
    for m in ("1997-04", "1997-05"):
        sinks.replace_table(_months(spark, m), str(root / "retratos" / f"retratos-{m}.parquet"))
    sinks.replace_months(_months(spark, "1997-01", "1997-02", "1997-03"), str(root / "meses"))
    for table, rows in [("ticket", 2), ("retratos", 4), ("meses", 6)]:
        sinks.publish(spark, str(root), table, name=f"pub_{table}")
        sinks.publish(spark, str(root), table, name=f"pub_{table}")  # replaces, does not append
        assert spark.table(f"pub_{table}").count() == rows
        sinks.publish(spark, str(root), table, target="files", folder=str(tmp_path / "out"), format="orc")
        assert spark.read.orc(str(tmp_path / "out" / table)).count() == rows
    with pytest.raises(FileNotFoundError, match="ticket"):
        sinks.publish(spark, str(root), "nada")
    with pytest.raises(ValueError, match="jdbc"):
        sinks.publish(spark, str(root), "ticket", target="fita")


def test_bucketed_tables_join_without_shuffle(spark):
    left = spark.range(1000).select(F.col("id").alias("order_id"), F.lit(1).alias("a"))
    sinks.save_bucketed(left, "orders_bucketed", ["order_id"], 4)
    sinks.save_bucketed(left.withColumnRenamed("a", "b"), "items_bucketed", ["order_id"], 4)
    joined = spark.table("orders_bucketed").hint("merge").join(spark.table("items_bucketed"), "order_id")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan and joined.count() == 1000
