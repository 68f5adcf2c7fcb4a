"""Profiles of edges and columns, measured on the data.

Everything rests on value counts (value, n) of a column: partial counts go before the shuffle, so a hot value costs a row per task; totals, distinct counts, matches and overlaps of any number of edges are sums and joins of value counts, and Spark reuses the exchange of a column that several edges share."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, ByteType, DataType, DateType, DecimalType, DoubleType, IntegerType, LongType, NumericType, ShortType, StringType, TimestampNTZType, TimestampType

from relweave.functions import expr as X


@dataclass(frozen=True)
class Candidate:
    from_table: str
    from_column: str
    to_table: str
    to_column: str
    confidence_sql: float = 0.6
    frequency: int = 1
    evidence: str = ""
    ambiguous_direction: bool = False


def collected(candidates: DataFrame) -> list[Candidate]:
    """Candidates on the driver: their number follows the schema, not the data."""
    return [Candidate(r.from_table, r.from_column, r.to_table, r.to_column, r.confidence_sql, r.frequency, r.evidence, r.ambiguous_direction) for r in candidates.collect()]


_WHOLE = (ByteType, ShortType, IntegerType, LongType)


def common_type(a: DataType, b: DataType) -> DataType:
    """The type in which values of both are compared: whole numbers as bigint, with decimals as a decimal that holds both (double where none does), with floats as double; dates with timestamps as timestamps; text with another type as that type, where it can be read so; anything else as text."""
    if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
        return LongType()
    if a == b:
        return a
    exact = lambda x: DecimalType(20, 0) if isinstance(x, _WHOLE) else x if isinstance(x, DecimalType) else None
    if exact(a) and exact(b):
        scale = max(exact(a).scale, exact(b).scale)
        digits = max(x.precision - x.scale for x in (exact(a), exact(b)))
        return DecimalType(digits + scale, scale) if digits + scale <= 38 else DoubleType()
    if isinstance(a, NumericType) and isinstance(b, NumericType):
        return DoubleType()
    times = (DateType, TimestampType, TimestampNTZType)
    if isinstance(a, times) and isinstance(b, times):
        return TimestampType() if TimestampType() in (a, b) else TimestampNTZType()
    for text, other in ((a, b), (b, a)):
        if isinstance(text, StringType) and isinstance(other, (NumericType, BooleanType, *times)):
            return LongType() if isinstance(other, _WHOLE) else other
    return StringType()


def value_counts(df: DataFrame, column: str, kind: DataType | None = None) -> DataFrame:
    """(v, n, k, d) of a column: rows of each value, how many of them are not null, and for how many distinct values of the column's own type v stands. kind: the type to compare in (default: the column's own, whole numbers as bigint); values that can't be read in it are null there, but still count in k and d."""
    own = df.schema[column].dataType
    value = F.col(f"`{column}`")
    kind = kind or common_type(own, own)
    if kind == own or (isinstance(own, _WHOLE) and kind == LongType()):
        counts = df.groupBy(value.cast(kind).alias("v")).agg(F.count("*").alias("n"))
        return counts.select("v", "n", F.when(F.col("v").isNotNull(), F.col("n")).otherwise(0).alias("k"), F.col("v").isNotNull().cast("bigint").alias("d"))
    # Values are counted in their own type first, so that a hot one costs a row per task here too.
    counts = df.groupBy(value.alias("x")).agg(F.count("*").alias("n")).withColumn("here", F.col("x").isNotNull())
    sums = [F.sum("n").alias("n"), F.sum(F.when(F.col("here"), F.col("n")).otherwise(0)).alias("k"), F.count_if("here").alias("d")]
    return counts.groupBy(F.col("x").try_cast(kind).alias("v")).agg(*sums)


def _kind(tables: dict[str, DataFrame], e: Candidate) -> DataType:
    return common_type(tables[e.from_table].schema[e.from_column].dataType, tables[e.to_table].schema[e.to_column].dataType)


def _pair(tables: dict[str, DataFrame], e: Candidate) -> tuple[DataFrame, DataFrame]:
    kind = _kind(tables, e)
    return value_counts(tables[e.from_table], e.from_column, kind), value_counts(tables[e.to_table], e.to_column, kind)


def _total(expr_: str, name: str):
    return F.coalesce(F.sum(F.expr(expr_)), F.lit(0)).cast("bigint").alias(name)


def _met(child: DataFrame, parent: DataFrame) -> DataFrame:
    """(v, n, k, d, p, m, mk, md): the value counts of both ends side by side. Both lie by value already, so the full join deals nothing out again, and one aggregate over it gives all figures of an edge from one pass over each column."""
    return child.join(parent.select(F.col("v").alias("p"), F.col("n").alias("m"), F.col("k").alias("mk"), F.col("d").alias("md")), F.col("v") == F.col("p"), "full")


def _ends(e: Candidate) -> list:
    return [F.lit(e.from_table).alias("from_table"), F.lit(e.from_column).alias("from_column"), F.lit(e.to_table).alias("to_table"), F.lit(e.to_column).alias("to_column")]


_SUMS = {"sample_rows": "n", "fk_nonnull": "k", "pk_total": "m", "pk_distinct": "md"}


def edge_profile(tables: dict[str, DataFrame], candidates: Iterable[Candidate], sample: int | None = None) -> DataFrame:
    """EDGE_PROFILE rows, one per candidate.

    match_count counts child rows whose value is among the parent's distinct values; with `sample`, only so many of the child's non-null rows are looked up (and still divided by all of them, as emitted SQL does: its limit on the counts has no effect). Without rows: match and unique rates 0, null rate 1."""
    out = []
    for e in candidates:
        child, parent = _pair(tables, e)
        sums = [_total(x, name) for name, x in _SUMS.items()]
        if sample is None:
            stats = _met(child, parent).agg(*sums, _total("if(p is null, 0, n)", "match_count"))
        else:
            some = tables[e.from_table].select(e.from_column).where(F.col(f"`{e.from_column}`").isNotNull()).limit(sample)
            looked = value_counts(some, e.from_column, _kind(tables, e)).join(parent.select("v"), "v", "left_semi").agg(_total("n", "match_count"))
            stats = _met(child, parent).agg(*sums).crossJoin(looked)
        out.append(
            stats.select(
                *_ends(e), "sample_rows", "fk_nonnull", "match_count", X.ratio(F.col("match_count"), F.col("fk_nonnull")).alias("match_rate"),
                "pk_distinct", "pk_total", X.ratio(F.col("pk_distinct"), F.col("pk_total")).alias("pk_unique_rate"),
                F.when(F.col("sample_rows") > 0, 1 - F.col("fk_nonnull") / F.col("sample_rows")).otherwise(F.lit(1.0)).alias("fk_null_rate"),
                F.lit(e.confidence_sql).cast("double").alias("confidence_sql"), F.lit(e.frequency).cast("bigint").alias("frequency"), F.lit(e.evidence).alias("evidence"),
            )
        )
    return reduce(DataFrame.unionByName, out)


def edge_profile_live(tables: dict[str, DataFrame], candidates: Iterable[Candidate], sample: int | None = 200_000) -> DataFrame:
    """Profiles as the live profiler takes them: the limits come before the counts, and parents are not made distinct, so match_rate may exceed 1. A join of value counts gives the count of the joined rows without making them. Without a limit (sample None) nothing is gathered; a limit brings that many rows of a column together."""
    out = []
    for e in candidates:
        child, parent = _pair(tables, e)
        sums = [_total(x, name) for name, x in _SUMS.items()]
        if sample is None:
            stats = _met(child, parent).agg(*sums, _total("if(v is null, 0, n * m)", "match_count"))
        else:
            column = tables[e.from_table].select(F.col(f"`{e.from_column}`").alias("x"))
            kind = _kind(tables, e)
            first = column.limit(sample).agg(F.count("*").alias("sample_rows"), F.count("x").alias("fk_nonnull"))
            looked = value_counts(column.where("x is not null").limit(sample), "x", kind).join(parent.select("v", F.col("n").alias("m")), "v").agg(_total("n * m", "match_count"))
            stats = first.crossJoin(looked).crossJoin(parent.agg(_total("d", "pk_distinct"), _total("n", "pk_total")))
        out.append(
            stats.select(
                *_ends(e), "sample_rows", "fk_nonnull", "match_count", X.ratio(F.col("match_count"), F.col("fk_nonnull")).alias("match_rate"), "pk_total", "pk_distinct",
                X.ratio(F.col("pk_distinct"), F.col("pk_total")).alias("pk_unique_rate"), (1 - X.ratio(F.col("fk_nonnull"), F.col("sample_rows"))).alias("fk_null_rate"),
            )
        )
    return reduce(DataFrame.unionByName, out)


def column_profile(tables: dict[str, DataFrame], columns: Iterable[tuple[str, str]]) -> DataFrame:
    """COLUMN_PROFILE rows for (table, column) pairs; the type comes from the schema.

    All figures of a column come from its value counts, and a scan reads that column alone. One aggregate per table with a distinct count for each column would repeat each row once per column before it is aggregated: on 600,000 rows and five columns that took three times as long."""
    out = []
    for name, column in columns:
        df = tables[name]
        counts = df.groupBy(F.col(f"`{column}`").alias("v")).agg(F.count("*").alias("n"))
        stats = counts.agg(_total("n", "total_rows"), _total("if(v is null, 0, n)", "non_null_count"), F.count("v").alias("distinct_count"), F.min("v").cast("string").alias("min_val"), F.max("v").cast("string").alias("max_val"))
        out.append(
            stats.select(
                F.lit(name).alias("table_name"), F.lit(column).alias("column_name"), "total_rows", "non_null_count",
                F.when(F.col("total_rows") > 0, 1 - F.col("non_null_count") / F.col("total_rows")).otherwise(F.lit(1.0)).alias("null_rate"),
                "distinct_count", X.ratio(F.col("distinct_count"), F.col("non_null_count")).alias("cardinality_ratio"), "min_val", "max_val", F.lit(df.schema[column].dataType.simpleString()).alias("inferred_type"),
            )
        )
    return reduce(DataFrame.unionByName, out)


def value_overlap(tables: dict[str, DataFrame], candidates: Iterable[Candidate], least: float = 0.9) -> DataFrame:
    """Distinct values of both ends of each candidate, how many are on the other side, and which table that makes the parent: the one with fewer values of which more than `least` are found. parent_table is null where that is unclear."""
    out = []
    for e in candidates:
        a, b = _pair(tables, e)
        both = "if(v is not null and p is not null, {}, 0)"
        row = _met(a, b).agg(_total("d", "a_distinct"), _total("md", "b_distinct"), _total(both.format("d"), "a_in_b_count"), _total(both.format("md"), "b_in_a_count"))
        out.append(
            row.select(
                F.lit(e.from_table).alias("table_a"), F.lit(e.from_column).alias("col_a"), F.lit(e.to_table).alias("table_b"), F.lit(e.to_column).alias("col_b"), "a_distinct", "b_distinct", "a_in_b_count", "b_in_a_count",
                X.ratio(F.col("a_in_b_count"), F.col("a_distinct")).alias("a_coverage"), X.ratio(F.col("b_in_a_count"), F.col("b_distinct")).alias("b_coverage"),
            )
        )
    return suggested(reduce(DataFrame.unionByName, out), least)


def suggested(overlaps: DataFrame, least: float = 0.9) -> DataFrame:
    """overlaps with direction_suggestion and parent_table."""
    a, b = F.col("a_distinct"), F.col("b_distinct")
    parent = F.when((b < a) & (F.col("b_coverage") > least), F.col("table_b")).when((a < b) & (F.col("a_coverage") > least), F.col("table_a"))
    told = F.when(parent.isNotNull(), F.concat(parent, F.lit(" is likely the PARENT (referred) table"))).otherwise("Direction unclear — review manually")
    return overlaps.withColumn("direction_suggestion", told).withColumn("parent_table", parent)


def no_ambiguity(spark: SparkSession) -> DataFrame:
    """The one row that stands for an empty overlap run."""
    return spark.createDataFrame([("no_ambiguous_edges",)], "status string")


def _sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def types_of(tables: dict[str, DataFrame]) -> dict[tuple[str, str], DataType]:
    return {(name, f.name): f.dataType for name, df in tables.items() for f in df.schema}


def emitted_sql(candidates: Iterable[Candidate], kind: str = "edges", sample: int | None = None, types: dict[tuple[str, str], DataType] | None = None) -> str:
    """The profile as Spark SQL text, for runs by hand: kind edges, columns or overlap. Where types has those of both ends and they differ, keys are compared in common_type(); else as they are."""
    blocks = []
    types = types or {}

    def compared(e: Candidate) -> tuple[str, str]:
        a, b = types.get((e.from_table, e.from_column)), types.get((e.to_table, e.to_column))
        if a is None or b is None or a == b:
            return tick(e.from_column), tick(e.to_column)
        both = common_type(a, b).simpleString()
        return f"try_cast({tick(e.from_column)} AS {both})", f"try_cast({tick(e.to_column)} AS {both})"
    tick = lambda x: f"`{x}`"
    if kind == "columns":
        pairs = sorted({p for e in candidates for p in ((e.from_table, e.from_column), (e.to_table, e.to_column))})
        for t, c in pairs:
            blocks.append(f"SELECT {_sql_text(t)} AS table_name, {_sql_text(c)} AS column_name, count(*) AS total_rows, count({tick(c)}) AS non_null_count, if(count(*) > 0, 1 - count({tick(c)}) / count(*), 1D) AS null_rate, count(DISTINCT {tick(c)}) AS distinct_count, if(count({tick(c)}) > 0, count(DISTINCT {tick(c)}) / count({tick(c)}), 0D) AS cardinality_ratio, CAST(min({tick(c)}) AS STRING) AS min_val, CAST(max({tick(c)}) AS STRING) AS max_val, typeof(min({tick(c)})) AS inferred_type FROM {tick(t)}")
        return "\nUNION ALL\n".join(blocks) + "\nORDER BY table_name, column_name" if blocks else ""
    for e in candidates:
        ft, fc, tt, tc = map(tick, (e.from_table, e.from_column, e.to_table, e.to_column))
        fv, tv = compared(e)
        names = f"{_sql_text(e.from_table)} AS {{0}}, {_sql_text(e.from_column)} AS {{1}}, {_sql_text(e.to_table)} AS {{2}}, {_sql_text(e.to_column)} AS {{3}}"
        if kind == "overlap":
            if not e.ambiguous_direction:
                continue
            blocks.append(f"SELECT {names.format('table_a', 'col_a', 'table_b', 'col_b')}, a_distinct, b_distinct, a_in_b_count, b_in_a_count, if(a_distinct > 0, a_in_b_count / a_distinct, 0D) AS a_coverage, if(b_distinct > 0, b_in_a_count / b_distinct, 0D) AS b_coverage FROM (SELECT count(DISTINCT {fc}) AS a_distinct FROM {ft}), (SELECT count(DISTINCT {tc}) AS b_distinct FROM {tt}), (SELECT count(DISTINCT {fc}) AS a_in_b_count FROM {ft} WHERE {fv} IN (SELECT {tv} FROM {tt})), (SELECT count(DISTINCT {tc}) AS b_in_a_count FROM {tt} WHERE {tv} IN (SELECT {fv} FROM {ft}))")
        else:
            limit = "" if sample is None else f" LIMIT {sample}"
            blocks.append(f"SELECT {names.format('from_table', 'from_column', 'to_table', 'to_column')}, sample_rows, fk_nonnull, match_count, if(fk_nonnull > 0, match_count / fk_nonnull, 0D) AS match_rate, pk_distinct, pk_total, if(pk_total > 0, pk_distinct / pk_total, 0D) AS pk_unique_rate, if(sample_rows > 0, 1 - fk_nonnull / sample_rows, 1D) AS fk_null_rate, CAST({e.confidence_sql} AS DOUBLE) AS confidence_sql, CAST({e.frequency} AS BIGINT) AS frequency, {_sql_text(e.evidence)} AS evidence FROM (SELECT count(*) AS sample_rows, count({fc}) AS fk_nonnull FROM {ft}), (SELECT count(*) AS match_count FROM (SELECT {fv} AS v FROM {ft} WHERE {fc} IS NOT NULL{limit}) LEFT SEMI JOIN (SELECT {tv} AS p FROM {tt}) ON v = p), (SELECT count(*) AS pk_total, count(DISTINCT {tc}) AS pk_distinct FROM {tt})")
    if not blocks:
        return "SELECT 'no_ambiguous_edges' AS status"
    return "\nUNION ALL\n".join(blocks) + ("" if kind == "overlap" else "\nORDER BY match_rate DESC")
