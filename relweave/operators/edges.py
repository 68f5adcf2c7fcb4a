"""Join edges: grouping, frequency, direction, foreign keys, raw relationships.

Edges are EDGE rows with `confidence`; `ordinal` carries the order of reading, on which first-wins and last-wins rules rest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from relweave.functions import expr as X

LEFT = ("left_table", "left_column")
RIGHT = ("right_table", "right_column")


def _end(table: Column, column: Column) -> Column:
    return F.struct(table.alias("t"), column.alias("c"))


def groups(edges: DataFrame, boosts: tuple[tuple[int, float], ...] = ((10, 0.10), (5, 0.05))) -> DataFrame:
    """One row per unordered pair of columns: its most confident edge (the first on ties), frequency (edges, not files), boosted confidence_sql and evidence (distinct files, sorted).

    Aggregates only: partial sums go before the one shuffle, on the pair."""
    left, right = _end(F.col("left_table"), F.col("left_column")), _end(F.col("right_table"), F.col("right_column"))
    best = F.max_by(F.struct(*LEFT, *RIGHT, "confidence", "ordinal"), F.struct("confidence", (-F.col("ordinal")).alias("o")))
    out = edges.groupBy(F.least(left, right).alias("a"), F.greatest(left, right).alias("b")).agg(
        best.alias("rep"),
        F.count("*").alias("frequency"),
        F.array_join(F.sort_array(F.collect_set(F.split_part("evidence", F.lit(" | "), F.lit(1)))), "; ").alias("evidence"),
        F.min("ordinal").alias("ordinal"),
    )
    return out.select("a", "b", "rep.left_table", "rep.left_column", "rep.right_table", "rep.right_column", "rep.confidence", "frequency", X.frequency_boosted(F.col("rep.confidence"), F.col("frequency"), boosts).alias("confidence_sql"), "evidence", "ordinal")


def directed(edges: DataFrame) -> DataFrame:
    """CANDIDATE rows: *_ID points to ID, anything else to ID; else left to right, flagged ambiguous. Most frequent, then most confident, then by table."""
    lc, rc = F.col("left_column"), F.col("right_column")
    forward = (X.is_key_like(lc) & X.is_id(rc)) | (X.is_id(rc) & ~X.is_id(lc))
    backward = ~forward & ((X.is_key_like(rc) & X.is_id(lc)) | (X.is_id(lc) & ~X.is_id(rc)))
    turn = lambda a, b: F.when(backward, F.col(b)).otherwise(F.col(a))
    out = groups(edges).select(
        turn("left_table", "right_table").alias("from_table"), turn("left_column", "right_column").alias("from_column"),
        turn("right_table", "left_table").alias("to_table"), turn("right_column", "left_column").alias("to_column"),
        "confidence_sql", "frequency", "evidence", (~forward & ~backward).alias("ambiguous_direction"),
    )
    return out


def ordered(candidates: DataFrame) -> DataFrame:
    return candidates.orderBy(F.desc("frequency"), F.desc("confidence_sql"), "from_table", "from_column", "to_table", "to_column")


def top(candidates: DataFrame, k: int = 5) -> DataFrame:
    return ordered(candidates).limit(k)


def inferred_keys(edges: DataFrame, penalty: float = 0.15, floor: float = 0.40) -> DataFrame:
    """Foreign keys of each edge: *_ID to ID one way; any other edge both ways, less sure. `ordinal` and `turn` keep the order."""
    lc, rc = F.col("left_column"), F.col("right_column")
    sure, back = X.is_key_like(lc) & X.is_id(rc), X.is_key_like(rc) & X.is_id(lc)
    less = F.round(F.greatest(F.lit(floor), F.col("confidence") - penalty), 6)
    row = lambda a, b, conf, turn: F.struct(F.col(a[0]).alias("from_table"), F.col(a[1]).alias("from_column"), F.col(b[0]).alias("to_table"), F.col(b[1]).alias("to_column"), conf.alias("confidence"), F.lit(turn).alias("turn"))
    both = F.array(row(LEFT, RIGHT, less, 0), row(RIGHT, LEFT, less, 1))
    conf = F.col("confidence")
    chosen = F.when(sure, F.array(row(LEFT, RIGHT, conf, 0))).when(back, F.array(row(RIGHT, LEFT, conf, 0))).otherwise(both)
    return edges.select(F.explode(chosen).alias("k"), "evidence", "ordinal").select("k.*", "evidence", "ordinal")


def deduplicated_keys(keys: DataFrame) -> DataFrame:
    """The first key of each pair of ends. An aggregate rather than a window: hot pairs shrink before the shuffle."""
    at = F.struct("ordinal", "turn")
    return keys.groupBy("from_table", "from_column", "to_table", "to_column").agg(F.min_by(F.struct("confidence", "evidence", "ordinal", "turn"), at).alias("k")).select("from_table", "from_column", "to_table", "to_column", "k.confidence", "k.evidence", "k.ordinal", "k.turn")


def raw_relationships(edges: DataFrame) -> DataFrame:
    """Proposed relationships: keys with confidence and evidence of their first edge, and the parser's facts of the last edge of the same orientation (blank for the reverse)."""
    facts = ["parser_dialect", "predicate_type", "confidence_reason", "ast_path", "source_query_block"]
    with_reason = edges.withColumn("confidence_reason", F.concat("predicate_type", F.lit(":heuristic"))) if "confidence_reason" not in edges.columns else edges
    last = with_reason.groupBy(F.col("left_table").alias("from_table"), F.col("left_column").alias("from_column"), F.col("right_table").alias("to_table"), F.col("right_column").alias("to_column")).agg(F.max_by(F.struct(*facts), "ordinal").alias("m"))
    keys = deduplicated_keys(inferred_keys(edges))
    null = F.lit(None).cast("double")
    return keys.join(last, ["from_table", "from_column", "to_table", "to_column"], "left").select(
        "from_table", "from_column", "to_table", "to_column", F.col("confidence").alias("confidence_sql"), "evidence",
        *(F.coalesce(F.col(f"m.{c}"), F.lit("")).alias(c) for c in facts), F.lit("proposed").alias("status"), null.alias("match_rate"), null.alias("pk_unique_rate"), null.alias("fk_null_rate"),
    )


def join_columns(candidates: DataFrame) -> DataFrame:
    """Distinct (table, column) of all candidates' ends."""
    ends = F.explode(F.array(F.struct(F.col("from_table").alias("table_name"), F.col("from_column").alias("column_name")), F.struct(F.col("to_table").alias("table_name"), F.col("to_column").alias("column_name"))))
    return candidates.select(ends.alias("e")).select("e.*").distinct()
