"""SQL worksheets as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan(spark: SparkSession, folder: str) -> DataFrame:
    """(path, sql) of every *.sql below folder, in path order. A folder that doesn't exist raises."""
    rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.sql").text(folder, wholetext=True)
    return rows.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("sql")).orderBy("path")


def content_hash(worksheets: DataFrame) -> DataFrame:
    """One row: sha256: and 16 hex digits over all texts in path order. Text joined in one row: worksheets are analysts' files."""
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("path", "sql"))), lambda x: x.sql), "")
    return worksheets.agg(F.concat(F.lit("sha256:"), F.substring(F.sha2(whole.cast("binary"), 256), 1, 16)).alias("worksheets_hash"))
