"""Merging of profiles, direction hints and overrides into relationships; gates; data quality."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relweave.functions import expr as X
from relweave.schemas import RELATIONSHIP, conform

ENDS = ("from_table", "from_column", "to_table", "to_column")


def keyed(rows: DataFrame, ends: tuple[str, ...] = ENDS, name: str = "k") -> DataFrame:
    """rows with their ends in upper case as one struct."""
    return rows.withColumn(name, F.struct(*(F.upper(F.col(c)).alias(x) for c, x in zip(ends, "abcd", strict=True))))


def merge_profiles(relationships: DataFrame, profiles: DataFrame) -> DataFrame:
    """Relationships with rates, frequency and confidence of their profile: that of the same ends in any case, or else of the reverse; data_quality_flag `not_profiled` without one.

    Profiles are put under both orientations, so one join finds either; the forward one wins."""
    stats = ["match_rate", "pk_unique_rate", "fk_null_rate", "frequency", "confidence_sql"]
    p = keyed(profiles).select("k", F.struct(*stats).alias("v"))
    turned = F.struct(F.col("k.c").alias("a"), F.col("k.d").alias("b"), F.col("k.a").alias("c"), F.col("k.b").alias("d"))
    both = p.select("k", "v", F.lit(0).alias("turn")).unionByName(p.select(turned.alias("k"), "v", F.lit(1).alias("turn")))
    best = both.groupBy("k").agg(F.min_by("v", "turn").alias("v"))
    rows = conform(relationships, RELATIONSHIP, {"from_columns": "", "to_columns": "", "data_quality_flag": "", "frequency": 0, "parser_dialect": "", "predicate_type": "", "confidence_reason": "", "ast_path": "", "source_query_block": ""})
    out = keyed(rows).join(best, "k", "left")
    flag = F.when(F.col("v").isNull(), "not_profiled").otherwise(F.col("data_quality_flag"))
    return out.select(*(F.when(F.col("v").isNotNull(), F.col(f"v.{c}")).otherwise(F.col(c)).cast(RELATIONSHIP[c].dataType).alias(c) if c in stats else flag.alias(c) if c == "data_quality_flag" else F.col(c) for c in RELATIONSHIP.names))


def correct_directions(relationships: DataFrame, hints: DataFrame) -> DataFrame:
    """Relationships turned around where a hint names the present from_table as the parent. Rates stay as they are, and nothing is deduplicated.

    A hint's text is matched by its table's name in lower case, at the to side first; a parent_table column, where there is one, is used instead."""
    h = keyed(hints, ("table_a", "col_a", "table_b", "col_b")).select("k", F.lower("direction_suggestion").alias("says"), (F.upper("parent_table") if "parent_table" in hints.columns else F.lit(None).cast("string")).alias("parent"))
    turned = F.struct(F.col("k.c").alias("a"), F.col("k.d").alias("b"), F.col("k.a").alias("c"), F.col("k.b").alias("d"))
    both = h.unionByName(h.select(turned.alias("k"), "says", "parent")).groupBy("k").agg(F.max_by(F.struct("says", "parent"), F.struct("says", "parent")).alias("h"))
    out = keyed(relationships).join(both, "k", "left")
    named = lambda c: F.when(F.col("h.parent").isNotNull(), F.col("h.parent") == F.upper(F.col(c))).otherwise(F.contains(F.col("h.says"), F.concat(F.lower(F.col(c)), F.lit(" is likely the parent"))))
    turn = F.coalesce(~F.coalesce(named("to_table"), F.lit(False)) & named("from_table"), F.lit(False))
    other = {"from_table": "to_table", "to_table": "from_table", "from_column": "to_column", "to_column": "from_column"}
    flag = F.concat_ws(";", F.nullif(F.col("data_quality_flag"), F.lit("")), F.lit("direction_corrected"))
    return out.select(*(F.when(turn, F.col(other[c])).otherwise(F.col(c)).alias(c) if c in other else F.when(turn, flag).otherwise(F.col(c)).alias(c) if c == "data_quality_flag" else F.col(c) for c in relationships.columns))


def apply_overrides(relationships: DataFrame, overrides: DataFrame) -> DataFrame:
    """Relationships with the status of people's overrides (kind, from_table, from_columns, to_table, to_columns): tables and, where given, columns match in any case; a rejection wins over an approval.

    Overrides are aggregated to a row per pair of tables before the join, so no relationship is multiplied."""
    up = lambda c: F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), F.upper)
    per = overrides.select(F.upper("from_table").alias("f"), F.upper("to_table").alias("t"), F.struct("kind", up("from_columns").alias("fc"), up("to_columns").alias("tc")).alias("o")).groupBy("f", "t").agg(F.collect_set("o").alias("os"))
    fits = lambda kind: F.exists("os", lambda o: (o.kind == kind) & ((F.size(o.fc) == 0) | F.array_contains(o.fc, F.upper(F.col("from_column")))) & ((F.size(o.tc) == 0) | F.array_contains(o.tc, F.upper(F.col("to_column")))))
    out = relationships.join(per, (F.upper("from_table") == F.col("f")) & (F.upper("to_table") == F.col("t")), "left")
    status = F.when(fits("reject"), "rejected").when(fits("approve"), "approved").otherwise(F.col("status"))
    return out.select(*(status.alias(c) if c == "status" else F.col(c) for c in relationships.columns))


def contract(relationships: DataFrame) -> DataFrame:
    """The 19 columns in their order; blank column lists are filled from the single columns."""
    out = conform(relationships, RELATIONSHIP, {"parser_dialect": "", "predicate_type": "", "confidence_reason": "", "ast_path": "", "source_query_block": "", "data_quality_flag": "", "evidence": "", "frequency": 0})
    for many, one in (("from_columns", "from_column"), ("to_columns", "to_column")):
        out = out.withColumn(many, F.when(F.coalesce(F.trim(many), F.lit("")) == "", F.col(one)).otherwise(F.col(many)))
    return out


def auto_approve(relationships: DataFrame, match: float = 0.95, confidence: float = 0.80) -> DataFrame:
    """Proposed relationships that reach both thresholds become approved, and their evidence says so; a threshold of 0 turns this off."""
    if match <= 0 or confidence <= 0:
        return relationships
    yes = (X.number(F.col("match_rate")) >= match) & (X.number(F.col("confidence_sql")) >= confidence) & (F.col("status") == "proposed")
    return relationships.withColumn("evidence", F.when(yes, F.concat(F.coalesce("evidence", F.lit("")), F.lit(" [auto-approved]"))).otherwise(F.col("evidence"))).withColumn("status", F.when(yes, "approved").otherwise(F.col("status")))


def generation_edges(relationships: DataFrame, match: float = 0.95) -> DataFrame:
    """What generation uses: approved, or proposed with match_rate at the threshold."""
    return relationships.where((F.col("status") == "approved") | ((F.col("status") == "proposed") & (X.number(F.col("match_rate")) >= match)))


def inject_keys(tables: DataFrame, relationships: DataFrame, missing: float = 0.7) -> DataFrame:
    """Per table (name) its foreign keys as an ordered array; tables match in any case, a missing confidence is `missing`. Tables without keys stay."""
    key = F.struct("to_table", "from_column", "to_column", F.coalesce(F.col("confidence_sql"), F.lit(missing)).alias("confidence"))
    keys = relationships.groupBy(F.upper("from_table").alias("t")).agg(F.array_sort(F.collect_list(key)).alias("foreign_keys"))
    return tables.join(keys, F.upper("name") == F.col("t"), "left").drop("t")


def dq_issues(column_profiles: DataFrame, edge_profiles: DataFrame, null_warning: float = 0.20, null_error: float = 0.50, least_match: float = 0.50) -> DataFrame:
    """Issues: join columns with many nulls (above the warning; an error from the error rate on), edges that match little, and edges that were not profiled (where a `profiled` column says so)."""
    text = lambda c: F.col(c) if isinstance(c, str) else c
    none = F.lit(None).cast("string")

    def rows(df: DataFrame, kind: str, severity: Column, value: Column, **names: Column | str) -> DataFrame:
        return df.select(F.lit(kind).alias("type"), *(text(names.get(c, none)).alias(c) for c in ("table", "column", *ENDS)), value.cast("double").alias("value"), severity.alias("severity"))

    ends = dict(zip(ENDS, ENDS, strict=True))
    parts = [
        rows(column_profiles.where(F.col("null_rate") > null_warning), "high_null_rate", F.when(F.col("null_rate") < null_error, "warning").otherwise("error"), F.col("null_rate"), table="table_name", column="column_name"),
        rows(edge_profiles.where(F.col("match_rate") < least_match), "low_match_rate", F.lit("warning"), F.col("match_rate"), **ends),
    ]
    if "profiled" in edge_profiles.columns:
        parts.append(rows(edge_profiles.where("not profiled"), "not_profiled", F.lit("info"), F.lit(None), **ends))
    return reduce(DataFrame.unionByName, parts)


def dq_summary(issues: DataFrame) -> DataFrame:
    return issues.agg(F.count("*").alias("total_issues"), F.count_if(F.col("severity") == "warning").alias("warnings"), F.count_if(F.col("severity") == "error").alias("errors"))


def run_summary(edge_profiles: DataFrame, column_profiles: DataFrame, hints: DataFrame) -> DataFrame:
    """Counts of what a run loaded."""
    return edge_profiles.agg(F.count("*").alias("edge_profiles")).crossJoin(column_profiles.agg(F.count("*").alias("column_profiles"))).crossJoin(hints.agg(F.count("*").alias("direction_hints")))
