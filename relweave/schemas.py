"""Row types of the engine's tables, and conforming of looser input to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructType

_TYPES = {"string": StringType, "bigint": LongType, "double": DoubleType, "boolean": BooleanType}


def _struct(fields: str) -> StructType:
    """A type from "name type, ..."; unlike DDL parsing it needs no session."""
    out = StructType()
    for f in fields.split(","):
        name, kind = f.split()
        out.add(name, _TYPES[kind]())
    return out


EDGE = _struct(
    "left_table string, left_column string, right_table string, right_column string, predicate_type string, predicate string, "
    "parser_dialect string, ast_path string, source_query_block string, evidence string, ordinal bigint"
)
CANDIDATE = _struct("from_table string, from_column string, to_table string, to_column string, confidence_sql double, frequency bigint, evidence string, ambiguous_direction boolean")
EDGE_PROFILE = _struct(
    "from_table string, from_column string, to_table string, to_column string, sample_rows bigint, fk_nonnull bigint, match_count bigint, match_rate double, "
    "pk_distinct bigint, pk_total bigint, pk_unique_rate double, fk_null_rate double, confidence_sql double, frequency bigint, evidence string"
)
COLUMN_PROFILE = _struct(
    "table_name string, column_name string, total_rows bigint, non_null_count bigint, null_rate double, distinct_count bigint, cardinality_ratio double, min_val string, max_val string, inferred_type string"
)
DIRECTION_HINT = _struct("table_a string, col_a string, table_b string, col_b string, a_coverage double, b_coverage double, direction_suggestion string")
RELATIONSHIP = _struct(
    "from_table string, from_columns string, from_column string, to_table string, to_columns string, to_column string, confidence_sql double, frequency bigint, "
    "parser_dialect string, predicate_type string, confidence_reason string, ast_path string, source_query_block string, match_rate double, pk_unique_rate double, fk_null_rate double, "
    "status string, evidence string, data_quality_flag string"
)
TRIPLE = _struct("s string, p string, o string, o_kind string, datatype string, lang string")

RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
OWL = "http://www.w3.org/2002/07/owl#"
XSD = "http://www.w3.org/2001/XMLSchema#"
BASE_IRI = "http://example.org/ontology#"


def conform(df: DataFrame, schema: StructType, blank: dict[str, object] | None = None) -> DataFrame:
    """df with the schema's columns, in its order: names match in any case, missing columns get their blank (default null), values that don't cast become null."""
    have = {c.lower(): c for c in df.columns}
    blank = blank or {}
    out = []
    for f in schema.fields:
        if f.name.lower() in have:
            kind = f.dataType.simpleString()
            out.append(F.expr(f"try_cast(`{have[f.name.lower()]}` as {kind})").alias(f.name))
        else:
            out.append(F.lit(blank.get(f.name)).cast(f.dataType).alias(f.name))
    return df.select(*out)
