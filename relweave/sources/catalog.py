"""Schemas of tables as rows."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = "table string, constrained_columns array<string>, referred_table string, referred_columns array<string>"
PRIMARY = "table string, primary_key array<string>"


def columns_of(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """(table, name, type, nullable, comment, position) of DataFrames' columns."""
    rows = [(t, f.name, f.dataType.simpleString(), f.nullable, (f.metadata or {}).get("comment"), i) for t, df in tables.items() for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "table string, name string, type string, nullable boolean, comment string, position int")


def catalog(spark: SparkSession, database: str | None = None) -> DataFrame:
    """The same of the tables in Spark's catalog."""
    return columns_of(spark, {t.name: spark.table(f"{t.namespace[0]}.{t.name}" if t.namespace else t.name) for t in spark.catalog.listTables(database) if not t.isTemporary})


def filtered(tables: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None, column: str = "table") -> DataFrame:
    """Rows of the tables to include (all if none is named), less those to exclude; exact names."""
    out = tables.where(F.col(column).isin(include)) if include else tables
    return out.where(~F.col(column).isin(exclude)) if exclude else out


def usable_keys(keys: DataFrame) -> DataFrame:
    """Foreign keys that name a referred table."""
    return keys.where(F.coalesce(F.trim("referred_table"), F.lit("")) != "")


def declared(spark: SparkSession, path: str | None) -> tuple[DataFrame, DataFrame]:
    """Foreign keys (table, constrained_columns, referred_table, referred_columns) and primary keys (table, primary_key) of a YAML file: lists `keys` of {table, columns, referred_table, referred_columns}, and a mapping `primary_keys`. Spark's catalog doesn't keep either for the tables that it reads. Keys without a referred table are left out; a file that isn't there gives none."""
    import yaml

    data = (yaml.safe_load(Path(path).read_text(encoding="utf-8")) if path and Path(path).exists() else None) or {}
    keys = [(k["table"], list(k.get("columns") or []), k.get("referred_table"), list(k.get("referred_columns") or [])) for k in data.get("keys") or []]
    primary = [(t, list(c or [])) for t, c in (data.get("primary_keys") or {}).items()]
    return usable_keys(spark.createDataFrame(keys, KEYS)), spark.createDataFrame(primary, PRIMARY)


def pairs(keys: DataFrame) -> DataFrame:
    """Declared keys column by column: (table, from_column, to_table, to_column, confidence, evidence)."""
    both = keys.select("table", "referred_table", F.explode(F.arrays_zip(F.col("constrained_columns").alias("c"), F.col("referred_columns").alias("r"))).alias("p"))
    return both.select("table", F.col("p.c").alias("from_column"), F.col("referred_table").alias("to_table"), F.col("p.r").alias("to_column"), F.lit(1.0).alias("confidence"), F.lit("declared").alias("evidence"))
