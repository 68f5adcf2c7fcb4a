"""The phases as lazy plans from worksheets to gates; only their results are written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relweave.config import Config
from relweave.functions import sqltext
from relweave.operators import edges as E
from relweave.operators import graph as G
from relweave.operators import merge as M
from relweave.operators import profile as P
from relweave.operators import rdf as R
from relweave.operators import review as V


def candidates(worksheets: DataFrame) -> DataFrame:
    return E.ordered(E.directed(sqltext.join_edges(worksheets)))


def resolved(spark: SparkSession, found: list[P.Candidate], tables: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], list[P.Candidate]]:
    """Candidates whose tables and columns exist, in any case, with names as they are."""
    by = {t.upper(): t for t in tables}
    out = []
    for c in found:
        ends = []
        for t, col in ((c.from_table, c.from_column), (c.to_table, c.to_column)):
            names = {x.upper(): x for x in tables[by[t]].columns} if t in by else {}
            ends += [by.get(t), names.get(col)]
        if None not in ends:
            out.append(P.Candidate(*ends, c.confidence_sql, c.frequency, c.evidence, c.ambiguous_direction))
    return tables, out


def profiled(spark: SparkSession, worksheets: DataFrame, tables: dict[str, DataFrame], config: Config | None = None) -> tuple[DataFrame | None, DataFrame | None, DataFrame | None]:
    """Edge profiles, column profiles and, of ambiguous edges, overlaps (None without any): what others would run by hand between two phases."""
    config = config or Config()
    tables, found = resolved(spark, P.collected(candidates(worksheets)), tables)
    if not found:
        return None, None, None
    unclear = [c for c in found if c.ambiguous_direction]
    columns = sorted({p for c in found for p in ((c.from_table, c.from_column), (c.to_table, c.to_column))})
    return P.edge_profile(tables, found, config.profiling.sample_limit), P.column_profile(tables, columns), P.value_overlap(tables, unclear) if unclear else None


def inferred(worksheets: DataFrame, profiles: DataFrame | None, hints: DataFrame | None, overrides: DataFrame | None, config: Config | None = None) -> DataFrame:
    """Relationships: raw ones with profiles, directions, overrides and then automatic approval."""
    config = config or Config()
    rel = E.raw_relationships(sqltext.join_edges(worksheets))
    rel = M.merge_profiles(rel, profiles) if profiles is not None else M.contract(rel)
    if hints is not None:
        rel = M.correct_directions(rel, hints)
    if overrides is not None:
        rel = M.apply_overrides(rel, overrides)
    return M.auto_approve(M.contract(rel), config.review.auto_approve_threshold, config.review.auto_approve_confidence)


def used_keys(relationships: DataFrame, relations: DataFrame, declared: DataFrame | None = None, config: Config | None = None) -> DataFrame:
    """(from_table, to_table, relation) of the relationships that generation uses and of declared keys (see catalog.pairs); relations (from_table, to_table, relation) name the properties that people named."""
    config = config or Config()
    used = M.generation_edges(relationships, config.profiling.match_rate_threshold).select("from_table", "to_table")
    if declared is not None:
        used = used.unionByName(declared.select(F.upper("table").alias("from_table"), F.upper("to_table").alias("to_table")))
    named = relations.where(F.coalesce("relation", F.lit("")) != "").select(F.upper("from_table").alias("f"), F.upper("to_table").alias("t"), "relation")
    return used.distinct().join(named, (F.upper("from_table") == F.col("f")) & (F.upper("to_table") == F.col("t")), "left").select("from_table", "to_table", "relation")


def generated(tables: DataFrame, columns: DataFrame, keys: DataFrame, config: Config | None = None) -> DataFrame:
    """Triples by fixed rules from tables (name, classification), columns (table, name) and keys (see used_keys), each with the table that it is of."""
    return R.fragments(tables, columns, keys, (config or Config()).ontology.base_iri)


def prints(tables: DataFrame, columns: DataFrame, keys: DataFrame, primary: DataFrame) -> DataFrame:
    """Fingerprints of tables (name, classification), with their classification: what a generated fragment depends on."""
    known = tables.join(primary.select(F.upper("table").alias("k"), "primary_key"), F.upper("name") == F.col("k"), "left").select(F.upper("name").alias("name"), F.lit("").alias("comment"), "primary_key")
    cols = columns.select(F.upper("table").alias("table"), "name", "type", "nullable", "comment")
    fks = keys.select(F.upper("from_table").alias("table"), F.array(F.coalesce("relation", F.lit(""))).alias("constrained_columns"), F.upper("to_table").alias("referred_table"), F.array().cast("array<string>").alias("referred_columns"))
    return G.fingerprints(cols, fks, known).join(tables.select(F.upper("name").alias("table"), "classification"), "table")


def validated(triples: DataFrame, relationships: DataFrame, relations: DataFrame, config: Config | None = None) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The gates' row, and the tables that a report consists of."""
    v = (config or Config()).validation
    o = R.Ontology(triples, (config or Config()).ontology.base_iri)
    approved = relationships.where("status = 'approved'").select("from_table", "to_table")
    gates = o.gates(approved, v.coverage_warn_threshold, v.coverage_pass_threshold, v.allow_duplicate_iris)
    names = o.relation_names(relations.where(F.coalesce("relation", F.lit("")) != ""))
    return gates, {"coverage": o.edge_coverage(approved), "missing_edges": o.missing_edges(approved), "duplicates": o.duplicate_iris(), "relation_names": names, "unclassified": o.unclassified(), "bridge_issues": o.bridge_issues()}


def progress(relationships: DataFrame) -> DataFrame:
    return V.status_summary(relationships)
