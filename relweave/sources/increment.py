"""Profiles that are kept up to date: value counts of each file are state, and only files that are new or changed are read."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relweave.functions import expr as X
from relweave.session import filesystem


@dataclass(frozen=True)
class Delta:
    """A refreshed profile: COLUMN_PROFILE figures by column, and how many files were read and how many have gone."""

    profile: DataFrame
    read: int
    gone: int


def fingerprint() -> Column:
    """A file's name, size and time as one value, alike whatever reads the file."""
    m = F.col("_metadata")
    return F.substring(F.sha2(F.concat_ws("|", m.file_path, m.file_size.cast("string"), F.unix_micros(m.file_modification_time).cast("string")), 256), 1, 32)


def files(spark: SparkSession, folder: str) -> DataFrame:
    """(fp, path) of the Parquet files below a folder; their bytes are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(folder)
    return found.select(fingerprint().alias("fp"), F.col("path"))


def known(spark: SparkSession, state: str) -> DataFrame:
    """(fp) of the files that the state has counts of: the names of its partitions."""
    fs, p = filesystem(spark, state)
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return spark.createDataFrame([(n.removeprefix("fp="),) for n in names if n.startswith("fp=")], "fp string")


STATE = "column_name string, v string, n bigint, fp string"


def refreshed(spark: SparkSession, folder: str, columns: Iterable[str], state: str) -> Delta:
    """The profile of the Parquet files below folder now, from the counts in `state` (a folder in a shared store) and those of files that it doesn't know.

    The state has a partition for each file, named by its fingerprint, with the number of rows of each value of each column (values as text) and one row without a column, so that files without rows are known too. Partitions are written whole or not at all and written again if a run is repeated; a file that was changed is a new one; a file that has gone is left out of the profile, and its partition stays until forget(). So partial runs, repeated runs and files that come back all give the profile of the files there are.
    - no files: counts 0, null rate 1, no values; columns must be in all files, in types that Spark reads as the first file's"""
    names = list(columns)
    now = files(spark, folder)
    fresh = [(r.fp, r.path) for r in now.join(known(spark, state), "fp", "left_anti").collect()]  # a row a file
    gone = known(spark, state).join(now, "fp", "left_anti").count()
    paths = [r.path for r in now.limit(1).collect()]
    kinds = {f.name: f.dataType for f in spark.read.parquet(*paths).schema} if paths else {}
    if fresh:
        rows = spark.read.schema(spark.read.parquet(*paths).schema).parquet(*[p for _, p in fresh])
        values = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("v")) for c in names]))
        counts = rows.select(fingerprint().alias("fp"), values.alias("x")).groupBy("fp", "x.column_name", "x.v").agg(F.count("*").alias("n"))
        marks = spark.createDataFrame([(None, None, 0, fp) for fp, _ in fresh], STATE)
        made = marks.unionByName(counts)
        # By file, so that each partition is a few files, and one large file's counts still lie in many tasks.
        made.repartition("fp", F.pmod(F.xxhash64("v"), F.lit(16))).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("fp").parquet(state)
    return Delta(profile_of(spark, now, state, names, kinds), len(fresh), gone)


def profile_of(spark: SparkSession, now: DataFrame, state: str, names: list[str], kinds: dict) -> DataFrame:
    """(column_name, total_rows, non_null_count, null_rate, distinct_count, cardinality_ratio, min_val, max_val) from the state's counts of the files `now` (fp): one scan of them, an exchange by value, and one aggregate for all columns."""
    fs, p = filesystem(spark, state)
    held = spark.read.schema(STATE).parquet(state) if fs.exists(p) else spark.createDataFrame([], STATE)
    counts = held.where("column_name is not null").join(now.select("fp"), "fp", "left_semi").groupBy("column_name", "v").agg(F.sum("n").alias("n"))
    figures = []
    for i, c in enumerate(names):
        mine = F.col("column_name") == c
        typed = F.col("v").cast(kinds[c]) if c in kinds else F.col("v")
        figures += [F.sum(F.when(mine, F.col("n"))).alias(f"n{i}"), F.sum(F.when(mine & F.col("v").isNotNull(), F.col("n"))).alias(f"k{i}"), F.count(F.when(mine, F.col("v"))).alias(f"d{i}"), F.min(F.when(mine, typed)).cast("string").alias(f"a{i}"), F.max(F.when(mine, typed)).cast("string").alias(f"z{i}")]
    zero = lambda x: F.coalesce(F.col(x), F.lit(0)).cast("bigint")
    rows = [F.struct(F.lit(c).alias("column_name"), zero(f"n{i}").alias("total_rows"), zero(f"k{i}").alias("non_null_count"), zero(f"d{i}").alias("distinct_count"), F.col(f"a{i}").alias("min_val"), F.col(f"z{i}").alias("max_val")) for i, c in enumerate(names)]
    out = counts.agg(*figures).select(F.inline(F.array(*rows)))
    null_rate = F.when(F.col("total_rows") > 0, 1 - F.col("non_null_count") / F.col("total_rows")).otherwise(1.0)
    return out.select("column_name", "total_rows", "non_null_count", null_rate.alias("null_rate"), "distinct_count", X.ratio(F.col("distinct_count"), F.col("non_null_count")).alias("cardinality_ratio"), "min_val", "max_val")


def forget(spark: SparkSession, folder: str, state: str) -> int:
    """Remove the counts of files that are no longer below folder; how many files that were."""
    gone = [r.fp for r in known(spark, state).join(files(spark, folder), "fp", "left_anti").collect()]
    for fp in gone:
        fs, p = filesystem(spark, f"{state}/fp={fp}")
        fs.delete(p, True)
    return len(gone)
