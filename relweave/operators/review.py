"""Review: override edits, filters, degrees and progress."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relweave.functions import expr as X

OVERRIDE_KEY = ("from_table", "from_columns", "to_table", "to_columns")
EDGE_KEY = ("from_table", "from_columns", "to_table", "to_columns")
EDITED = ("status", "evidence", "confidence_sql", "match_rate", "pk_unique_rate", "fk_null_rate")


def upsert(overrides: DataFrame, edges: DataFrame) -> DataFrame:
    """Overrides (kind and OVERRIDE_KEY, relation) in which each of the edges stands once, as given now: the same edge goes from both kinds first."""
    same = None
    for c in OVERRIDE_KEY:
        same = (overrides[c].eqNullSafe(edges[c])) if same is None else same & overrides[c].eqNullSafe(edges[c])
    return overrides.join(edges, same, "left_anti").unionByName(edges.select(*overrides.columns))


def membership(edges: DataFrame, overrides: DataFrame) -> DataFrame:
    """edges (ends) with is_approved and is_rejected: whether an override of that kind names exactly these tables and single columns."""
    one = overrides.where((F.size("from_columns") == 1) & (F.size("to_columns") == 1)).groupBy(F.col("from_table").alias("f"), F.col("from_columns")[0].alias("fc"), F.col("to_table").alias("t"), F.col("to_columns")[0].alias("tc"))
    flags = one.agg(F.bool_or(F.col("kind") == "approve").alias("a"), F.bool_or(F.col("kind") == "reject").alias("r"))
    on = (F.col("from_table") == F.col("f")) & (F.col("from_column") == F.col("fc")) & (F.col("to_table") == F.col("t")) & (F.col("to_column") == F.col("tc"))
    return edges.join(flags, on, "left").select(*(edges[c] for c in edges.columns), F.coalesce("a", F.lit(False)).alias("is_approved"), F.coalesce("r", F.lit(False)).alias("is_rejected"))


def review_filter(rows: DataFrame, statuses: list[str] | None = None, confidence: float = 0.0, match: float = 0.0, search: str = "") -> DataFrame:
    """Rows of these statuses, at or above both bounds, in which the search, a regular expression in upper case, is found in either table, either column list or the evidence."""
    out = rows.where(F.col("status").isin(statuses)) if statuses else rows
    out = out.where((X.number(F.col("confidence_sql")) >= confidence) & (X.number(F.col("match_rate")) >= match))
    if search.strip():
        found = F.lit(False)
        for c in ("from_table", "to_table", "from_columns", "to_columns", "evidence"):
            found = found | F.coalesce(F.upper(c).rlike(search.strip().upper()), F.lit(False))
        out = out.where(found)
    return out


def flagged(rows: DataFrame) -> DataFrame:
    return rows.withColumn("quality_flag", X.quality_flag(F.col("match_rate"), F.col("pk_unique_rate"), F.col("fk_null_rate"))).withColumn("auto_approved", X.auto_approved(F.col("evidence")))


def status_summary(rows: DataFrame) -> DataFrame:
    """Rows per status; null is proposed, in lower case."""
    return rows.groupBy(F.lower(F.coalesce("status", F.lit("proposed"))).alias("status")).agg(F.count("*").alias("n"))


def degrees(rows: DataFrame) -> DataFrame:
    """Per table its outgoing, incoming and all edges, and bridge_score: the lesser share of the two (0 without edges). One pass: both ends of a row are counted in one aggregate."""
    ends = F.explode(F.array(F.struct(F.col("from_table").alias("table"), F.lit(1).alias("o"), F.lit(0).alias("i")), F.struct(F.col("to_table").alias("table"), F.lit(0).alias("o"), F.lit(1).alias("i"))))
    d = rows.select(ends.alias("e")).groupBy(F.col("e.table").alias("table")).agg(F.sum("e.o").alias("out_edges"), F.sum("e.i").alias("in_edges")).withColumn("total_edges", F.col("out_edges") + F.col("in_edges"))
    return d.withColumn("bridge_score", F.least("in_edges", "out_edges") / F.when(F.col("total_edges") == 0, 1).otherwise(F.col("total_edges")))


def suggestions(degree_rows: DataFrame) -> DataFrame:
    return degree_rows.withColumn("suggested_class", X.suggested_class(F.col("in_edges"), F.col("out_edges"), F.col("total_edges"), F.col("bridge_score")))


def classification_progress(rows: DataFrame) -> DataFrame:
    """total, classified and unclassified tables (current_class blank or null: unclassified) and their mix as a map in text order."""
    named = F.trim(F.coalesce("current_class", F.lit("")))
    mix = rows.groupBy(named.alias("c")).agg(F.count("*").alias("n"))
    return mix.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.coalesce(F.sum(F.when(F.col("c") != "", F.col("n"))), F.lit(0)).alias("classified"), F.coalesce(F.sum(F.when(F.col("c") == "", F.col("n"))), F.lit(0)).alias("unclassified"),
        F.array_join(F.sort_array(F.collect_list(F.when(F.col("c") != "", F.concat_ws("=", "c", F.col("n").cast("string"))))), ",").alias("class_mix"),
    )


def flip(rows: DataFrame, visible: DataFrame) -> DataFrame:
    """rows and, turned around and proposed again, the visible ones; of equal edges the last stays (rows by `ordinal`, the turned ones after all of them)."""
    turned = visible.select(
        *(F.col({"from_table": "to_table", "to_table": "from_table", "from_columns": "to_columns", "to_columns": "from_columns", "from_column": "to_column", "to_column": "from_column"}.get(c, c)).alias(c) if c != "status" else F.lit("proposed").alias(c) for c in rows.columns)
    )
    both = rows.withColumn("_late", F.lit(0)).unionByName(turned.withColumn("_late", F.lit(1)))
    rest = [c for c in rows.columns if c not in EDGE_KEY]
    return both.groupBy(*EDGE_KEY).agg(F.max_by(F.struct(*rest), F.struct("_late", "ordinal")).alias("r")).select(*(F.col(c) if c in EDGE_KEY else F.col(f"r.{c}").alias(c) for c in rows.columns))


def merge_edits(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """rows with the edited values of the same edge; the single columns are the first of the column lists."""
    e = edits.groupBy(*EDGE_KEY).agg(F.max_by(F.struct(*(c for c in EDITED if c in edits.columns)), "ordinal" if "ordinal" in edits.columns else F.lit(0)).alias("e"))
    first = {"from_column": "from_columns", "to_column": "to_columns"}
    out = rows.join(e, list(EDGE_KEY), "left")
    return out.select(*(F.coalesce(F.split(first[c], ";")[0], F.lit("")).alias(c) if c in first else F.when(F.col("e").isNotNull(), F.col(f"e.{c}")).otherwise(F.col(c)).alias(c) if c in EDITED and c in edits.columns else F.col(c) for c in rows.columns))


def enrich(columns: DataFrame, comments: DataFrame) -> DataFrame:
    """columns (table, column, comment) with the comments that (table, column) have elsewhere; exact case, blanks change nothing."""
    c = comments.where(F.trim("comment") != "").groupBy(F.col("table").alias("t"), F.col("column").alias("c")).agg(F.max("comment").alias("new"))
    return columns.join(c, (F.col("table") == F.col("t")) & (F.col("column") == F.col("c")), "left").select(*(F.coalesce("new", "comment").alias("comment") if x == "comment" else F.col(x) for x in columns.columns))
