"""The registered queries, each with SQL for DuckDB that computes the same another way."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relweave.functions import expr as X
from relweave.functions import sqltext
from relweave.operators import edges as E
from relweave.operators import graph as G
from relweave.operators import inclusion as I
from relweave.operators import levels
from relweave.operators import merge as M
from relweave.operators import profile as P
from relweave.operators import rdf as R
from relweave.operators import review as V
from relweave.plans.inputs import DERIVED, KEYS, READ_AS, TABLES, WORKSHEETS, derived, edges, oracle, relationships
from relweave.schemas import BASE_IRI, OWL, RDF_TYPE, RDFS
from relweave.session import filesystem, put, scratch, table
from relweave.sources import artifacts, catalog, graphsource, increment, rdf, results, snapshots, worksheets
from relweave.sources.cache import Cache

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return f

    return add


# --- profiles ---------------------------------------------------------------------------------------------------


def _tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {t: derived(spark, d, t) for k in KEYS for t in (k[0], k[2])}


def _candidates() -> list[P.Candidate]:
    return [P.Candidate(*k, 0.6, i + 1, f"it's {i}") for i, k in enumerate(KEYS)]


def _read(name: str, column: str) -> str:
    return READ_AS.get((name, column), "{}").format(column)


def _profile_sql(distinct: bool) -> str:
    parent = "(SELECT DISTINCT {tc} AS p FROM {{{tt}}})" if distinct else "(SELECT {tc} AS p FROM {{{tt}}})"
    block = (
        "SELECT '{ft}' AS from_table, '{fc}' AS from_column, '{tt}' AS to_table, '{tc}' AS to_column, (SELECT count(*) FROM {{{ft}}}) AS sample_rows, (SELECT count({fc}) FROM {{{ft}}}) AS fk_nonnull, "
        "(SELECT count(*) FROM {{{ft}}} a JOIN " + parent + " b ON {fv} = b.p) AS match_count, (SELECT count(DISTINCT {tc}) FROM {{{tt}}}) AS pk_distinct, (SELECT count(*) FROM {{{tt}}}) AS pk_total, {n} AS n"
    )
    return " UNION ALL ".join(block.format(ft=k[0], fc=k[1], fv=_read(*k[:2]), tt=k[2], tc=k[3], n=i) for i, k in enumerate(KEYS))


_RATES = "CASE WHEN fk_nonnull > 0 THEN match_count / fk_nonnull ELSE 0 END AS match_rate, CASE WHEN pk_total > 0 THEN pk_distinct / pk_total ELSE 0 END AS pk_unique_rate"


@query("edge_profile", f"SELECT * EXCLUDE (n), {_RATES}, CASE WHEN sample_rows > 0 THEN 1 - fk_nonnull / sample_rows ELSE 1 END AS fk_null_rate, CAST(0.6 AS DOUBLE) AS confidence_sql, CAST(n + 1 AS BIGINT) AS frequency, 'it''s ' || n AS evidence FROM ({_profile_sql(True)})")
def edge_profile(spark, d):
    return P.edge_profile(_tables(spark, d), _candidates())


@query("edge_profile_live", f"SELECT * EXCLUDE (n), {_RATES}, 1 - CASE WHEN sample_rows > 0 THEN fk_nonnull / sample_rows ELSE 0 END AS fk_null_rate FROM ({_profile_sql(False)})")
def edge_profile_live(spark, d):
    return P.edge_profile_live(_tables(spark, d), _candidates(), sample=None)


_COLUMNS = sorted({p for k in KEYS for p in ((k[0], k[1]), (k[2], k[3]))} | {("part", "p_brand"), ("lineitem", "l_returnflag")})
_TYPE = {"p_brand": "string", "l_returnflag": "string", "c_nationkey": "int", "n_nationkey": "int", "s_nationkey": "int", "n_regionkey": "int", "r_regionkey": "int", "as_decimal": "decimal(12,2)", "as_double": "double", "as_text": "string", "as_date": "date", "as_time": "timestamp"}


@query(
    "column_profile",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS total_rows, count({c}) AS non_null_count, CASE WHEN count(*) > 0 THEN 1 - count({c}) / count(*) ELSE 1 END AS null_rate, count(DISTINCT {c}) AS distinct_count, CASE WHEN count({c}) > 0 THEN count(DISTINCT {c}) / count({c}) ELSE 0 END AS cardinality_ratio, CAST(min({c}) AS VARCHAR) AS min_val, CAST(max({c}) AS VARCHAR) AS max_val, '{_TYPE.get(c, 'bigint')}' AS inferred_type FROM {{{t}}}"
        for t, c in _COLUMNS
    ),
)
def column_profile(spark, d):
    return P.column_profile({t: derived(spark, d, t) for t, _ in _COLUMNS}, _COLUMNS)


_OVERLAP = " UNION ALL ".join(
    f"SELECT '{k[0]}' AS table_a, '{k[1]}' AS col_a, '{k[2]}' AS table_b, '{k[3]}' AS col_b, (SELECT count(DISTINCT {k[1]}) FROM {{{k[0]}}}) AS a_distinct, (SELECT count(DISTINCT {k[3]}) FROM {{{k[2]}}}) AS b_distinct, (SELECT count(DISTINCT {k[1]}) FROM {{{k[0]}}} WHERE {_read(*k[:2])} IN (SELECT {k[3]} FROM {{{k[2]}}})) AS a_in_b_count, (SELECT count(DISTINCT {k[3]}) FROM {{{k[2]}}} WHERE {k[3]} IN (SELECT {_read(*k[:2])} FROM {{{k[0]}}})) AS b_in_a_count"
    for k in KEYS
)
_SUGGEST = "CASE WHEN b_distinct < a_distinct AND b_coverage > 0.9 THEN table_b WHEN a_distinct < b_distinct AND a_coverage > 0.9 THEN table_a END"


@query("value_overlap", f"SELECT *, coalesce(parent_table || ' is likely the PARENT (referred) table', 'Direction unclear — review manually') AS direction_suggestion FROM (SELECT *, {_SUGGEST} AS parent_table FROM (SELECT *, a_in_b_count / a_distinct AS a_coverage, b_in_a_count / b_distinct AS b_coverage FROM ({_OVERLAP})))")
def value_overlap(spark, d):
    return P.value_overlap(_tables(spark, d), _candidates())


# Columns whose pairs compare alike in both engines: those of text are left to edges that say how they are read.
_KEY_COLUMNS = sorted({p for k in KEYS for p in ((k[0], k[1]), (k[2], k[3]))} | {("part", "p_brand"), ("part", "p_name"), ("customer", "c_name"), ("lineitem", "l_quantity")})
_FAMILY = {"as_text": "t", "p_brand": "t", "p_name": "t", "c_name": "t", "as_date": "d", "as_time": "d"}
_VALUES = " UNION ALL ".join(f"SELECT '{_FAMILY.get(c, 'n')}' AS family, '{t}' AS t, '{c}' AS c, CAST({c} AS {dict(t='VARCHAR', d='TIMESTAMP', n='DOUBLE')[_FAMILY.get(c, 'n')]}) AS v{_FAMILY.get(c, 'n')} FROM {{{t}}} WHERE {c} IS NOT NULL" for t, c in _KEY_COLUMNS)


def _pairs_sql() -> str:
    value = lambda kind: f"(SELECT DISTINCT family, t, c, v FROM ({' UNION ALL '.join(x.replace(f'AS v{kind}', 'AS v') for x in _VALUES.split(' UNION ALL ') if f'AS v{kind} ' in x)}))"
    blocks = [f"SELECT a.t AS table_a, a.c AS col_a, b.t AS table_b, b.c AS col_b, count(*) AS common FROM {value(k)} a JOIN {value(k)} b ON a.v = b.v AND (a.t, a.c) <> (b.t, b.c) GROUP BY ALL" for k in "ntd"]
    own = " UNION ALL ".join(f"SELECT '{t}' AS t, '{c}' AS c, count(DISTINCT {c}) AS n FROM {{{t}}}" for t, c in _KEY_COLUMNS)
    return f"SELECT p.*, x.n AS a_distinct, y.n AS b_distinct, p.common / x.n AS a_in_b FROM ({' UNION ALL '.join(blocks)}) p JOIN ({own}) x ON x.t = table_a AND x.c = col_a JOIN ({own}) y ON y.t = table_b AND y.c = col_b"


@query("inclusion_matrix", _pairs_sql())
def inclusion_matrix(spark, d):
    return I.inclusion_matrix({t: derived(spark, d, t) for t, _ in _KEY_COLUMNS}, _KEY_COLUMNS)


_SKETCHED = [k for k in KEYS if k[1] != "as_text"]


@query("sketch_profile", " UNION ALL ".join(f"SELECT '{k[0]}' AS from_table, '{k[1]}' AS from_column, '{k[2]}' AS to_table, '{k[3]}' AS to_column, true AS within" for k in _SKETCHED))
def sketch_profile(spark, d):
    """Sketches of two halves of each table, merged; their figures beside the exact ones, and whether they are within the stated bounds."""
    tables = {t: derived(spark, d, t) for k in _SKETCHED for t in (k[0], k[2])}
    columns = [p for k in _SKETCHED for p in ((k[0], k[1]), (k[2], k[3]))]
    half = lambda odd: {t: df.where((F.pmod(F.xxhash64(*df.columns), F.lit(2)) == 1) == odd) for t, df in tables.items()}
    found = [P.Candidate(*k) for k in _SKETCHED]
    about = I.sketch_profile(tables, I.merged(I.column_sketches(half(True), columns).unionByName(I.column_sketches(half(False), columns))), found)
    exact = P.value_overlap(tables, found).select(F.col("table_a").alias("from_table"), F.col("col_a").alias("from_column"), F.col("table_b").alias("to_table"), F.col("col_b").alias("to_column"), F.col("a_distinct").alias("a"), F.col("b_distinct").alias("b"), F.col("a_in_b_count").alias("c"))
    ends = ["from_table", "from_column", "to_table", "to_column"]
    bound = I.ERRORS * 1.04 / 2 ** (I.LG_ENTRIES / 2)
    near = lambda x, y: F.abs(F.col(x) - F.col(y)) <= F.col(y) * bound
    return about.join(exact, ends).select(*ends, (near("a_distinct", "a") & near("b_distinct", "b") & (F.abs(F.col("common") - F.col("c")) <= F.col("common_error"))).alias("within"))


_SAMPLE = 300


def _sampled_sql() -> str:
    blocks = []
    for t, c, pt, pc in _SKETCHED:
        kind = "DECIMAL(22,2)" if "as_decimal" in (c, pc) else "DOUBLE" if "as_double" in (c, pc) else "TIMESTAMP" if "as_time" in (c, pc) else "BIGINT"
        # The text that Spark gives a value of the type.
        text = lambda x: {"DOUBLE": f"CASE WHEN {x} = floor({x}) THEN CAST({x} AS BIGINT) || '.0' ELSE CAST({x} AS VARCHAR) END"}.get(kind, f"CAST(CAST({x} AS {kind}) AS VARCHAR)")
        side = lambda t, c: f"(SELECT md5({text(c)}) AS h FROM {{{t}}} WHERE {c} IS NOT NULL)"
        cut = f"(SELECT max(h) FROM (SELECT DISTINCT h FROM {side(t, c)} ORDER BY h LIMIT {_SAMPLE}))"
        blocks.append(f"SELECT '{t}' AS from_table, '{c}' AS from_column, '{pt}' AS to_table, '{pc}' AS to_column, (SELECT count(DISTINCT h) FROM {side(t, c)} WHERE h <= {cut}) AS sample_values, (SELECT count(*) FROM {side(t, c)} WHERE h <= {cut}) AS sample_rows, (SELECT count(*) FROM {side(t, c)} WHERE h <= {cut} AND h IN (SELECT h FROM {side(pt, pc)})) AS match_count, (SELECT count(DISTINCT h) FROM {side(pt, pc)} WHERE h <= {cut}) AS pk_distinct, (SELECT count(*) FROM {side(pt, pc)} WHERE h <= {cut}) AS pk_total, (SELECT 1 - count({c}) / count(*) FROM {{{t}}}) AS fk_null_rate")
    return f"SELECT *, match_count / sample_rows AS match_rate, CASE WHEN pk_total > 0 THEN pk_distinct / pk_total ELSE 0 END AS pk_unique_rate FROM ({' UNION ALL '.join(blocks)})"


@query("edge_profile_sampled", _sampled_sql())
def edge_profile_sampled(spark, d):
    tables = {t: derived(spark, d, t) for k in _SKETCHED for t in (k[0], k[2])}
    return I.edge_profile_sampled(tables, [P.Candidate(*k) for k in _SKETCHED], _SAMPLE)


@query("direction_suggestion", "SELECT parent, count(*) AS n FROM (SELECT CASE WHEN b < a AND bc > 0.9 THEN 'b' WHEN a < b AND ac > 0.9 THEN 'a' ELSE 'unclear' END AS parent FROM (SELECT event_id % 50 AS a, event_id % 47 AS b, (event_id % 101) / 100.0 AS ac, (event_id % 89) / 88.0 AS bc FROM {events})) GROUP BY parent")
def direction_suggestion(spark, d):
    rows = table(spark, d, "events").select(F.lit("a").alias("table_a"), F.lit("b").alias("table_b"), (F.col("event_id") % 50).alias("a_distinct"), (F.col("event_id") % 47).alias("b_distinct"), (F.col("event_id") % 101 / 100.0).alias("a_coverage"), (F.col("event_id") % 89 / 88.0).alias("b_coverage"))
    return P.suggested(rows).groupBy(F.coalesce("parent_table", F.lit("unclear")).alias("parent")).agg(F.count("*").alias("n"))


@query("emitted_sql", ORACLES["edge_profile"])
def emitted_sql(spark, d):
    """Runs the emitted text."""
    import re

    tables = _tables(spark, d)
    text = P.emitted_sql(_candidates(), types=P.types_of(tables)).rsplit("\nORDER BY", 1)[0]
    return spark.sql(re.sub(r"FROM `(\w+)`", r"FROM {\1}", text), **tables)


# --- SQL text ---------------------------------------------------------------------------------------------------


def _worksheets(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(WORKSHEETS, "path string, sql string")


def _folder(spark: SparkSession) -> str:
    """WORKSHEETS as files, some below a folder of their own, beside one that is no worksheet."""
    at = scratch(spark, "worksheets")
    for k, (path, sql) in enumerate(WORKSHEETS):
        put(spark, f"{at}/{'' if k % 2 else 'more/'}{path}", sql)
    put(spark, f"{at}/notes.txt", "SELECT * FROM A a JOIN B b ON a.x = b.x")
    return at


def _values(names: str, rows: list[tuple]) -> str:
    text = lambda v: "NULL" if v is None else f"{v}::BIGINT" if isinstance(v, int) else f"{v}::DOUBLE" if isinstance(v, float) else "'" + v.replace("'", "''") + "'"
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(text, r)) + ')' for r in rows)}) AS t({names})"


#: Edges of WORKSHEETS by hand: path, left, right, type, confidence.
_EDGES = [
    ("a.sql", "ORDERS.CUSTOMER_ID", "CUSTOMERS.ID", "eq_column_column", 0.95),
    ("b.sql", "ORDER_ITEMS.ORDER_ID", "ORDERS.ID", "eq_column_column", 0.95),
    ("b.sql", "ORDER_ITEMS.REGION", "ORDERS.REGION", "eq_column_column", 0.6),
    ("b.sql", "ORDER_ITEMS.PRODUCT_ID", "PRODUCTS.ID", "eq_column_column", 0.95),
    ("c.sql", "TABLE_A.REF_CODE", "TABLE_B.REF_CODE", "eq_column_column", 0.6),
    ("d.sql", "ACCOUNTS.BRANCH_ID", "BRANCHES.ID", "eq_column_column", 0.95),
    ("d.sql", "ORDERS.CUSTOMER_ID", "ACCOUNTS.ID", "eq_column_column", 0.95),
    ("d.sql", "ACCOUNTS.REGION_ID", "REGIONS.ID", "eq_column_column", 0.95),
    ("e.sql", "EVENTS.EVENT_TS", "WINDOWS.START_TS", "range_or_inequality", 0.55),
    ("e.sql", "EVENTS.EVENT_TS", "WINDOWS.END_TS", "range_or_inequality", 0.55),
    ("e.sql", "EVENTS.MAIL", "USERS.MAIL", "function_based", 0.5),
    ("e.sql", "EVENTS.ORDER_ID", "ORDERS.ID", "casted_eq", 0.75),
    ("f.sql", "X.Y_ID", "Y.ID", "eq_column_column", 0.95),
    ("g.sql", "QUOTED.ID", "S.Q_ID", "eq_column_column", 0.95),
    ("h.sql", "GRÖSSEN.MASS_ID", "MASSE.ID", "eq_column_column", 0.95),
    ("h.sql", "GRÖSSEN.ART", "MASSE.ART", "composite_predicate", 0.65),
    ("i.sql", "STOCK.BIN_ID", "BINS.ID", "eq_column_column", 0.95),
    ("i.sql", "BROKEN.A", "ONES.B", "eq_column_column", 0.6),
]
#: Edges of the derived worksheets.
_SHEETS = """SELECT 'p' || p_partkey || '.sql' AS path, 'T' || (p_partkey % 23) || '.K' || (p_partkey % 11) || '_ID' AS l, 'A' || (p_partkey % 7) || '.ID' AS r, 'eq_column_column' AS kind, 0.95::DOUBLE AS confidence FROM {part}
  UNION ALL SELECT 'p' || p_partkey || '.sql', 'T' || (p_partkey % 23) || '.D', 'A' || (p_partkey % 7) || '.D', CASE p_partkey % 4 WHEN 0 THEN 'range_or_inequality' WHEN 1 THEN 'casted_eq' ELSE 'function_based' END, CASE p_partkey % 4 WHEN 0 THEN 0.55 WHEN 1 THEN 0.75 ELSE 0.5 END FROM {part} WHERE p_partkey % 4 <> 2"""


def _sheets(spark: SparkSession, d: str) -> DataFrame:
    return _worksheets(spark).unionByName(derived(spark, d, "sheets"))


def _told(e: DataFrame) -> DataFrame:
    end = lambda t: F.concat_ws(".", f"{t}_table", f"{t}_column")
    return e.select(F.split_part("evidence", F.lit(" | "), F.lit(1)).alias("path"), end("left").alias("l"), end("right").alias("r"), F.col("predicate_type").alias("kind"), F.col("confidence").cast("double"))


@query("join_edges", _values("path, l, r, kind, confidence", _EDGES) + " UNION ALL " + _SHEETS)
def join_edges(spark, d):
    return _told(sqltext.join_edges(_sheets(spark, d)))


@query("join_edges_by_statement", _values("path, l, r, kind, confidence", [e for e in _EDGES if e[1] != "BROKEN.A"]))
def join_edges_by_statement(spark, d):
    """A bad statement costs itself alone."""
    return _told(sqltext.join_edges(_worksheets(spark), by_statement=True))


@query("join_edges_multi", _values("path, l, r, kind, confidence", [e for e in _EDGES if e[0] == "b.sql"]))
def join_edges_multi(spark, d):
    return _told(sqltext.join_edges(_worksheets(spark).where("path = 'b.sql'")))


@query("cte_lineage", _values("path, l, r, kind, confidence", [e for e in _EDGES if e[0] == "d.sql"]))
def cte_lineage(spark, d):
    return _told(sqltext.join_edges(_worksheets(spark).where("path = 'd.sql'")))


@query("predicate_types", f"SELECT kind, count(*) AS n FROM ({_values('path, l, r, kind, confidence', _EDGES)} UNION ALL {_SHEETS}) GROUP BY kind")
def predicate_types(spark, d):
    return sqltext.join_edges(_sheets(spark, d)).groupBy(F.col("predicate_type").alias("kind")).agg(F.count("*").alias("n"))


@query("skipped_predicates", _values("path, skipped, unresolved", [("a.sql", 0, 0), ("b.sql", 1, 0), ("c.sql", 0, 0), ("d.sql", 0, 0), ("e.sql", 1, 0), ("f.sql", 0, 0), ("g.sql", 0, 0), ("h.sql", 0, 0), ("i.sql", 0, 0)]) + " UNION ALL SELECT 'p' || p_partkey || '.sql', CASE WHEN p_partkey % 4 = 2 THEN 1 ELSE 0 END, 0 FROM {part}")
def skipped_predicates(spark, d):
    return sqltext.diagnostics(_sheets(spark, d)).select("path", F.col("skipped_predicate_count").cast("bigint").alias("skipped"), F.col("unresolved_alias_count").cast("bigint").alias("unresolved"))


@query("fallback_edges", _values("path, l, r, kind, confidence", [e for e in _EDGES if e[0] in ("f.sql", "i.sql")]))
def fallback_edges(spark, d):
    return _told(sqltext.join_edges(_worksheets(spark)).where("parser_dialect = 'fallback_regex'"))


@query("ingest_diagnostics", """SELECT 9 + n AS files, 11 + n AS statement_count, 8 + n AS parsed_statement_count, 3::BIGINT AS failed_statement_count, 2 + n2 AS skipped_predicate_count, 0::BIGINT AS unresolved_alias_count, 2::BIGINT AS fallback_files,
  'casted_eq=' || (1 + n1) || ',composite_predicate=2,eq_column_column=' || (10 + n) || ',eq_expression=' || (1 + n2) || ',function_based=' || (1 + n3) || ',range_or_inequality=' || (2 + n0) AS predicate_types
  FROM (SELECT count(*) AS n, count(*) FILTER (p_partkey % 4 = 0) AS n0, count(*) FILTER (p_partkey % 4 = 1) AS n1, count(*) FILTER (p_partkey % 4 = 2) AS n2, count(*) FILTER (p_partkey % 4 = 3) AS n3 FROM {part})""")
def ingest_diagnostics(spark, d):
    return sqltext.rolled_up(sqltext.diagnostics(_sheets(spark, d)))


_CONF = """least(0.95, CASE predicate_type WHEN 'eq_column_column' THEN 0.60 WHEN 'casted_eq' THEN 0.75 WHEN 'eq_expression' THEN 0.70 WHEN 'range_or_inequality' THEN 0.55 WHEN 'function_based' THEN 0.50 WHEN 'composite_predicate' THEN 0.65 ELSE 0.45 END
 + CASE WHEN predicate_type = 'eq_column_column' THEN (CASE WHEN left_column = 'ID' OR left_column LIKE '%\\_ID' ESCAPE '\\' THEN 0.10 ELSE 0 END) + (CASE WHEN right_column = 'ID' OR right_column LIKE '%\\_ID' ESCAPE '\\' THEN 0.10 ELSE 0 END)
 + (CASE WHEN (left_column = 'ID' AND right_column LIKE '%\\_ID' ESCAPE '\\') OR (right_column = 'ID' AND left_column LIKE '%\\_ID' ESCAPE '\\') THEN 0.15 ELSE 0 END) ELSE 0 END)"""
_EDGE_SQL = f"(SELECT *, CAST({_CONF} AS DOUBLE) AS confidence FROM {{edges}})"


@query("edge_confidence", f"SELECT ordinal, round(confidence, 6) AS confidence FROM {_EDGE_SQL}")
def edge_confidence(spark, d):
    return edges(spark, d).select("ordinal", "confidence")


@query("edge_evidence", "SELECT ordinal, CASE WHEN ordinal % 2 = 0 THEN 'f.sql | ' ELSE '' END || source_query_block || ' | ' || predicate_type || ' | ' || substr(trim(regexp_replace(repeat(predicate || chr(10), 20), '\\s+', ' ', 'g')), 1, 220) AS evidence FROM {edges}")
def edge_evidence(spark, d):
    return edges(spark, d).select("ordinal", X.evidence(F.when(F.col("ordinal") % 2 == 0, "f.sql").otherwise(""), F.col("source_query_block"), F.col("predicate_type"), F.repeat(F.concat("predicate", F.lit("\n")), 20)).alias("evidence"))


@query("strip_comments", "SELECT event_id, 'SELECT ' || event_id || ' ' || chr(10) || ' FROM ' || event_type || ' ' AS sql FROM {events}")
def strip_comments(spark, d):
    text = F.concat(F.lit("SELECT "), F.col("event_id").cast("string"), F.lit(" -- a note /* inside\n FROM "), "event_type", F.lit(" /* two\nlines */"))
    return table(spark, d, "events").select("event_id", X.strip_comments(F.regexp_replace(text, r" -- a note /\* inside", " -- a note")).alias("sql"))


@query("normalize_ident", "SELECT event_id, 'X' || upper(event_type) AS ident, CASE event_id % 3 WHEN 0 THEN 'UNKNOWN' WHEN 1 THEN upper(event_type) ELSE upper(event_type) END AS tab FROM {events}")
def normalize_ident(spark, d):
    name = F.when(F.col("event_id") % 3 == 0, F.lit(" . ")).when(F.col("event_id") % 3 == 1, F.concat(F.lit('db.public."'), "event_type", F.lit('"'))).otherwise(F.col("event_type"))
    return table(spark, d, "events").select("event_id", X.ident(F.concat(F.lit(' "x'), "event_type", F.lit('" '))).alias("ident"), X.table_ident(name).alias("tab"))


# --- edges ------------------------------------------------------------------------------------------------------

_GROUPS = f"""(SELECT a, b, count(*) AS frequency, min(ordinal) AS ordinal, string_agg(DISTINCT split_part(evidence, ' | ', 1), '; ' ORDER BY split_part(evidence, ' | ', 1)) AS evidence,
  arg_max(e, (confidence, -ordinal)) AS rep FROM (SELECT *, {{{{'t': left_table, 'c': left_column, 'rt': right_table, 'rc': right_column, 'conf': confidence}}}} AS e,
  least(left_table || '.' || left_column, right_table || '.' || right_column) AS a, greatest(left_table || '.' || left_column, right_table || '.' || right_column) AS b FROM {_EDGE_SQL}) GROUP BY a, b)""".replace("{{", "{").replace("}}", "}").replace("{'t'", "{'t'")
_BOOSTED = "round(least(rep.conf + CASE WHEN frequency >= 10 THEN 0.10 WHEN frequency >= 5 THEN 0.05 ELSE 0 END, 0.95), 4)"


@query("edge_groups", f"SELECT a, b, frequency FROM {_GROUPS}")
def edge_groups(spark, d):
    dotted = lambda c: F.concat_ws(".", f"{c}.t", f"{c}.c")
    g = E.groups(edges(spark, d))
    return g.select(F.least(dotted("a"), dotted("b")).alias("a"), F.greatest(dotted("a"), dotted("b")).alias("b"), "frequency")


@query("edge_frequency", f"SELECT rep.t AS left_table, rep.c AS left_column, rep.rt AS right_table, rep.rc AS right_column, round(rep.conf, 6) AS confidence, frequency FROM {_GROUPS}")
def edge_frequency(spark, d):
    return E.groups(edges(spark, d)).select("left_table", "left_column", "right_table", "right_column", "confidence", "frequency")


@query("frequency_boost", f"SELECT ordinal, frequency, {_BOOSTED} AS confidence_sql FROM {_GROUPS}")
def frequency_boost(spark, d):
    return E.groups(edges(spark, d)).select("ordinal", "frequency", "confidence_sql")


_DIRECTED = f"""(SELECT CASE WHEN back THEN rep.rt ELSE rep.t END AS from_table, CASE WHEN back THEN rep.rc ELSE rep.c END AS from_column, CASE WHEN back THEN rep.t ELSE rep.rt END AS to_table, CASE WHEN back THEN rep.c ELSE rep.rc END AS to_column,
  confidence_sql, frequency, evidence, NOT (rep.c = 'ID') AND NOT (rep.rc = 'ID') OR (rep.c = 'ID' AND rep.rc = 'ID') AS ambiguous_direction
  FROM (SELECT *, {_BOOSTED} AS confidence_sql, rep.c = 'ID' AND rep.rc <> 'ID' AS back FROM {_GROUPS}))"""


@query("directed_edges", f"SELECT * FROM {_DIRECTED}")
def directed_edges(spark, d):
    return E.directed(edges(spark, d))


@query("top_edges", f"SELECT * FROM {_DIRECTED} ORDER BY frequency DESC, confidence_sql DESC, from_table, from_column, to_table, to_column LIMIT 5")
def top_edges(spark, d):
    return E.top(E.directed(edges(spark, d)), 5)


@query("evidence_rollup", f"SELECT a, b, evidence FROM {_GROUPS}")
def evidence_rollup(spark, d):
    dotted = lambda c: F.concat_ws(".", f"{c}.t", f"{c}.c")
    return E.groups(edges(spark, d)).select(F.least(dotted("a"), dotted("b")).alias("a"), F.greatest(dotted("a"), dotted("b")).alias("b"), "evidence")


_FK_ONE = "left_column LIKE '%\\_ID' ESCAPE '\\' AND right_column = 'ID'"
_FK_TWO = "right_column LIKE '%\\_ID' ESCAPE '\\' AND left_column = 'ID'"
_KEYS = f"""(SELECT left_table AS from_table, left_column AS from_column, right_table AS to_table, right_column AS to_column, round(CASE WHEN {_FK_ONE} THEN confidence ELSE greatest(0.4, confidence - 0.15) END, 6) AS confidence, evidence, ordinal, 0 AS turn FROM {_EDGE_SQL} WHERE NOT ({_FK_TWO})
  UNION ALL SELECT right_table, right_column, left_table, left_column, round(CASE WHEN {_FK_TWO} THEN confidence ELSE greatest(0.4, confidence - 0.15) END, 6), evidence, ordinal, CASE WHEN {_FK_TWO} THEN 0 ELSE 1 END FROM {_EDGE_SQL} WHERE NOT ({_FK_ONE}))"""


@query("inferred_fks", f"SELECT * FROM {_KEYS}")
def inferred_fks(spark, d):
    return E.inferred_keys(edges(spark, d))


_DEDUP = f"(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY from_table, from_column, to_table, to_column ORDER BY ordinal, turn) AS rn FROM {_KEYS}) WHERE rn = 1)"


@query("inferred_fks_dedup", f"SELECT * FROM {_DEDUP}")
def inferred_fks_dedup(spark, d):
    return E.deduplicated_keys(E.inferred_keys(edges(spark, d)))


@query(
    "raw_relationships",
    f"""SELECT k.from_table, k.from_column, k.to_table, k.to_column, k.confidence AS confidence_sql, k.evidence, coalesce(m.parser_dialect, '') AS parser_dialect, coalesce(m.predicate_type, '') AS predicate_type, coalesce(m.predicate_type || ':heuristic', '') AS confidence_reason, coalesce(m.ast_path, '') AS ast_path, coalesce(m.source_query_block, '') AS source_query_block,
  'proposed' AS status, CAST(NULL AS DOUBLE) AS match_rate, CAST(NULL AS DOUBLE) AS pk_unique_rate, CAST(NULL AS DOUBLE) AS fk_null_rate
  FROM {_DEDUP} k LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY left_table, left_column, right_table, right_column ORDER BY ordinal DESC) AS rn FROM {{edges}}) m
  ON m.rn = 1 AND k.from_table = m.left_table AND k.from_column = m.left_column AND k.to_table = m.right_table AND k.to_column = m.right_column""",
)
def raw_relationships(spark, d):
    return E.raw_relationships(edges(spark, d))


@query("join_columns", f"SELECT from_table AS table_name, from_column AS column_name FROM {_DIRECTED} UNION SELECT to_table, to_column FROM {_DIRECTED}")
def join_columns(spark, d):
    return E.join_columns(E.directed(edges(spark, d)))


# --- merge and gates --------------------------------------------------------------------------------------------

_RELS = "(SELECT * REPLACE (CAST(confidence_sql AS DOUBLE) AS confidence_sql, CAST(match_rate AS DOUBLE) AS match_rate, CAST(pk_unique_rate AS DOUBLE) AS pk_unique_rate, CAST(fk_null_rate AS DOUBLE) AS fk_null_rate) FROM {rels})"
# Of equal profiles the last counts, by k.
_PROF = "(SELECT upper(from_table) AS a, upper(from_column) AS b, upper(to_table) AS c, upper(to_column) AS d, arg_max({'m': match_rate, 'u': pk_unique_rate, 'n': fk_null_rate, 'f': frequency, 'cs': confidence_sql}, k) AS v FROM {profiles} GROUP BY ALL)"


def _last_profiles(spark: SparkSession, d: str) -> DataFrame:
    return results.last_rows(derived(spark, d, "profiles"), results.EDGE_PROFILE, ["from_table", "from_column", "to_table", "to_column"], "k")


_MERGED = f"""SELECT ordinal_key.*, CASE WHEN f.v IS NOT NULL THEN f.v.m WHEN r.v IS NOT NULL THEN r.v.m ELSE match_rate END AS x_match, CASE WHEN f.v IS NOT NULL THEN f.v.f WHEN r.v IS NOT NULL THEN r.v.f ELSE frequency END AS x_freq,
  CASE WHEN f.v IS NULL AND r.v IS NULL THEN 'not_profiled' ELSE '' END AS flag FROM {_RELS} ordinal_key LEFT JOIN {_PROF} f ON f.a = upper(from_table) AND f.b = upper(from_column) AND f.c = upper(to_table) AND f.d = upper(to_column)
  LEFT JOIN {_PROF} r ON r.c = upper(from_table) AND r.d = upper(from_column) AND r.a = upper(to_table) AND r.b = upper(to_column)"""


@query("merge_profiles", f"SELECT from_table, from_column, to_table, to_column, evidence, flag AS data_quality_flag, count(*) AS n, round(sum(x_match), 6) AS matches, CAST(sum(x_freq) AS BIGINT) AS frequency FROM ({_MERGED}) GROUP BY ALL")
def merge_profiles(spark, d):
    out = M.merge_profiles(relationships(spark, d), _last_profiles(spark, d))
    return out.groupBy("from_table", "from_column", "to_table", "to_column", "evidence", "data_quality_flag").agg(F.count("*").alias("n"), F.round(F.sum("match_rate"), 6).alias("matches"), F.sum("frequency").alias("frequency"))


@query(
    "direction_correction",
    """SELECT CASE WHEN turn THEN to_table ELSE from_table END AS from_table, CASE WHEN turn THEN to_column ELSE from_column END AS from_column, CASE WHEN turn THEN from_table ELSE to_table END AS to_table, CASE WHEN turn THEN from_column ELSE to_column END AS to_column,
  CASE WHEN turn THEN 'direction_corrected' ELSE '' END AS data_quality_flag, count(*) AS n FROM (
  SELECT r.*, coalesce(NOT contains(h.says, lower(to_table) || ' is likely the parent') AND contains(h.says, lower(from_table) || ' is likely the parent'), false) AS turn
  FROM {rels} r LEFT JOIN (SELECT a, b, c, d, max(says) AS says FROM (SELECT table_a AS a, col_a AS b, table_b AS c, col_b AS d, lower(direction_suggestion) AS says FROM {hints} UNION ALL SELECT table_b, col_b, table_a, col_a, lower(direction_suggestion) FROM {hints}) GROUP BY ALL) h
  ON h.a = from_table AND h.b = from_column AND h.c = to_table AND h.d = to_column) GROUP BY ALL""",
)
def direction_correction(spark, d):
    rows = relationships(spark, d).withColumn("data_quality_flag", F.lit(""))
    ends = ["from_table", "from_column", "to_table", "to_column", "data_quality_flag"]
    return M.correct_directions(rows, derived(spark, d, "hints")).groupBy(*ends).agg(F.count("*").alias("n"))


_OVERRIDES = [("approve", "t1", ["c1", "c2"], "T2", ["ID"], None), ("approve", "T3", [], "t4", [], "hasT4"), ("reject", "T1", ["C1"], "T2", [], None), ("reject", "T5", [], "T6", ["OTHER"], None), ("approve", "T5", [], "T6", [], None)]
OVERRIDE_FIELDS = "kind string, from_table string, from_columns array<string>, to_table string, to_columns array<string>, relation string"


@query(
    "override_status",
    "SELECT ordinal, CASE WHEN from_table = 'T1' AND to_table = 'T2' AND from_column = 'C1' THEN 'rejected' WHEN from_table = 'T1' AND to_table = 'T2' AND from_column = 'C2' THEN 'approved' WHEN from_table = 'T3' AND to_table = 'T4' THEN 'approved' WHEN from_table = 'T5' AND to_table = 'T6' THEN 'approved' ELSE status END AS status FROM {rels}",
)
def override_status(spark, d):
    return M.apply_overrides(relationships(spark, d), spark.createDataFrame(_OVERRIDES, OVERRIDE_FIELDS)).select("ordinal", "status")


_CONTRACT = "from_table, from_columns, from_column, to_table, to_columns, to_column, confidence_sql, frequency, '' AS parser_dialect, '' AS predicate_type, '' AS confidence_reason, '' AS ast_path, '' AS source_query_block, match_rate, pk_unique_rate, fk_null_rate, status, evidence, '' AS data_quality_flag"


@query("relationship_contract", f"SELECT {_CONTRACT} FROM (SELECT * REPLACE (from_column AS from_columns, CAST(confidence_sql AS DOUBLE) AS confidence_sql, CAST(match_rate AS DOUBLE) AS match_rate, CAST(pk_unique_rate AS DOUBLE) AS pk_unique_rate, CAST(fk_null_rate AS DOUBLE) AS fk_null_rate) FROM {{rels}})")
def relationship_contract(spark, d):
    return M.contract(relationships(spark, d).withColumn("from_columns", F.lit(" ")).drop("to_columns"))


@query("auto_approve", "SELECT ordinal, CASE WHEN yes THEN 'approved' ELSE status END AS status, CASE WHEN yes THEN evidence || ' [auto-approved]' ELSE evidence END AS evidence FROM (SELECT *, coalesce(match_rate, 0) >= 0.95 AND confidence_sql >= 0.8 AND status IS NOT DISTINCT FROM 'proposed' AS yes FROM {rels})")
def auto_approve(spark, d):
    return M.auto_approve(relationships(spark, d)).select("ordinal", "status", "evidence")


@query("generation_edges", "SELECT ordinal FROM {rels} WHERE status = 'approved' OR (status = 'proposed' AND match_rate >= 0.95)")
def generation_edges(spark, d):
    return M.generation_edges(relationships(spark, d)).select("ordinal")


@query("fk_injection", "SELECT name, CAST(coalesce(n, 0) AS BIGINT) AS n_keys, round(coalesce(c, 0), 6) AS confidence FROM (SELECT DISTINCT 't' || (s_suppkey % 30) AS name FROM {supplier}) LEFT JOIN (SELECT from_table, count(*) AS n, sum(coalesce(CASE WHEN ordinal % 2 = 0 THEN NULL ELSE confidence_sql END, 0.7)) AS c FROM {rels} GROUP BY 1) ON upper(name) = from_table")
def fk_injection(spark, d):
    names = table(spark, d, "supplier").select(F.concat(F.lit("t"), (F.col("s_suppkey") % 30).cast("string")).alias("name")).distinct()
    rels = relationships(spark, d).withColumn("confidence_sql", F.when(F.col("ordinal") % 2 == 1, F.col("confidence_sql")))
    out = M.inject_keys(names, rels)
    total = F.aggregate("foreign_keys", F.lit(0.0), lambda a, k: a + k.confidence)
    return out.select("name", F.coalesce(F.size("foreign_keys"), F.lit(0)).cast("bigint").alias("n_keys"), F.round(F.coalesce(total, F.lit(0.0)), 6).alias("confidence"))


_ISSUES = """(SELECT 'high_null_rate' AS type, table_name AS "table", column_name AS "column", NULL AS from_table, NULL AS from_column, NULL AS to_table, NULL AS to_column, CAST(null_rate AS DOUBLE) AS value, CASE WHEN null_rate < 0.5 THEN 'warning' ELSE 'error' END AS severity FROM {column_profiles} WHERE null_rate > 0.2
  UNION ALL SELECT 'low_match_rate', NULL, NULL, from_table, from_column, to_table, to_column, CAST(match_rate AS DOUBLE), 'warning' FROM {profiles} WHERE match_rate < 0.5
  UNION ALL SELECT 'not_profiled', NULL, NULL, from_table, from_column, to_table, to_column, NULL, 'info' FROM {profiles} WHERE NOT profiled)"""


def _issues(spark: SparkSession, d: str) -> DataFrame:
    return M.dq_issues(derived(spark, d, "column_profiles"), derived(spark, d, "profiles"))


@query("dq_issues", f"SELECT * FROM {_ISSUES}")
def dq_issues(spark, d):
    return _issues(spark, d)


@query("dq_summary", f"SELECT count(*) AS total_issues, count(*) FILTER (severity = 'warning') AS warnings, count(*) FILTER (severity = 'error') AS errors FROM {_ISSUES}")
def dq_summary(spark, d):
    return M.dq_summary(_issues(spark, d))


@query("run_summary", "SELECT (SELECT count(*) FROM {profiles}) AS edge_profiles, (SELECT count(*) FROM {column_profiles}) AS column_profiles, (SELECT count(*) FROM {hints}) AS direction_hints")
def run_summary(spark, d):
    return M.run_summary(*(derived(spark, d, x) for x in ("profiles", "column_profiles", "hints")))


# --- review -----------------------------------------------------------------------------------------------------


def _all_overrides(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    return table(spark, d, "supplier").select(F.when(k % 3 == 0, "reject").otherwise("approve").alias("kind"), F.concat(F.lit("T"), (k % 23).cast("string")).alias("from_table"), F.array(F.concat(F.lit("C"), (k % 9).cast("string"))).alias("from_columns"), F.concat(F.lit("T"), (k % 19).cast("string")).alias("to_table"), F.array(F.lit("ID")).alias("to_columns"), F.lit(None).cast("string").alias("relation"))


_OVER = "(SELECT CASE WHEN s_suppkey % 3 = 0 THEN 'reject' ELSE 'approve' END AS kind, 'T' || (s_suppkey % 23) AS ft, 'C' || (s_suppkey % 9) AS fc, 'T' || (s_suppkey % 19) AS tt, 'ID' AS tc FROM {supplier})"


@query("override_upsert", f"SELECT kind, ft, fc, tt, tc FROM {_OVER} WHERE NOT (ft = 'T2' OR (ft = 'T3' AND fc = 'C3' AND tt = 'T3')) OR (ft = 'T2' AND NOT (fc = 'C2' AND tt = 'T2')) UNION ALL SELECT * FROM (VALUES ('approve', 'T2', 'C2', 'T2', 'ID'), ('reject', 'T3', 'C3', 'T3', 'ID'))")
def override_upsert(spark, d):
    new = spark.createDataFrame([("approve", "T2", ["C2"], "T2", ["ID"], None), ("reject", "T3", ["C3"], "T3", ["ID"], None)], OVERRIDE_FIELDS)
    return V.upsert(_all_overrides(spark, d), new).select("kind", F.col("from_table").alias("ft"), F.col("from_columns")[0].alias("fc"), F.col("to_table").alias("tt"), F.col("to_columns")[0].alias("tc"))


@query("override_membership", f"SELECT ordinal, EXISTS (SELECT 1 FROM {_OVER} o WHERE o.kind = 'approve' AND ft = from_table AND fc = from_column AND tt = to_table AND tc = to_column) AS is_approved, EXISTS (SELECT 1 FROM {_OVER} o WHERE o.kind = 'reject' AND ft = from_table AND fc = from_column AND tt = to_table AND tc = to_column) AS is_rejected FROM {{rels}}")
def override_membership(spark, d):
    return V.membership(relationships(spark, d), _all_overrides(spark, d)).select("ordinal", "is_approved", "is_rejected")


@query("review_filter", "SELECT ordinal FROM {rels} WHERE status IN ('approved', 'proposed') AND confidence_sql >= 0.25 AND coalesce(match_rate, 0) >= 0.1 AND (regexp_matches(upper(from_table), 'T1\\d|CLICK') OR regexp_matches(upper(to_table), 'T1\\d|CLICK') OR regexp_matches(upper(from_columns), 'T1\\d|CLICK') OR regexp_matches(upper(to_columns), 'T1\\d|CLICK') OR regexp_matches(upper(evidence), 'T1\\d|CLICK'))")
def review_filter(spark, d):
    return V.review_filter(relationships(spark, d), ["approved", "proposed"], 0.25, 0.1, "t1[0-9]|click").select("ordinal")


@query("quality_flag", "SELECT ordinal, CASE WHEN coalesce(match_rate, 0) < 0.5 OR coalesce(fk_null_rate, 1) > 0.5 THEN 'critical' WHEN coalesce(match_rate, 0) < 0.9 OR coalesce(pk_unique_rate, 0) < 0.9 OR coalesce(fk_null_rate, 1) > 0.2 THEN 'warning' ELSE 'ok' END AS quality_flag, contains(lower(evidence), '[auto-approved]') AS auto_approved FROM {rels}")
def quality_flag(spark, d):
    return V.flagged(relationships(spark, d)).select("ordinal", "quality_flag", "auto_approved")


@query("status_summary", "SELECT lower(coalesce(status, 'proposed')) AS status, count(*) AS n FROM {rels} GROUP BY 1")
def status_summary(spark, d):
    return V.status_summary(relationships(spark, d))


_DEGREES = """(SELECT coalesce(o.t, i.t) AS "table", CAST(coalesce(o.n, 0) AS BIGINT) AS out_edges, CAST(coalesce(i.n, 0) AS BIGINT) AS in_edges FROM (SELECT from_table AS t, count(*) AS n FROM {few} GROUP BY 1) o FULL JOIN (SELECT to_table AS t, count(*) AS n FROM {few} GROUP BY 1) i ON o.t = i.t)"""
_FEW = "(SELECT 'T' || (p_partkey * p_partkey % 1009) AS from_table, 'T' || (p_partkey * 31 % 2003) AS to_table FROM {part})"
_SCORED = f"(SELECT *, out_edges + in_edges AS total_edges, least(in_edges, out_edges) / CASE WHEN out_edges + in_edges = 0 THEN 1 ELSE out_edges + in_edges END AS bridge_score FROM {_DEGREES.replace('{few}', _FEW)})"


def _degrees(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    few = table(spark, d, "part").select(F.concat(F.lit("T"), (k * k % 1009).cast("string")).alias("from_table"), F.concat(F.lit("T"), (k * 31 % 2003).cast("string")).alias("to_table"))
    return V.degrees(few)


@query("table_degree", f"SELECT * FROM {_SCORED}")
def table_degree(spark, d):
    return _degrees(spark, d)


@query("suggest_classification", f"""SELECT "table", CASE WHEN total_edges = 0 THEN '' WHEN total_edges >= 4 AND bridge_score >= 0.45 AND in_edges >= 2 AND out_edges >= 2 THEN 'bridge' WHEN in_edges >= 3 AND out_edges <= 1 THEN 'fact' WHEN out_edges >= 3 AND in_edges <= 1 THEN 'dimension' WHEN total_edges <= 2 THEN 'entity' ELSE '' END AS suggested_class FROM {_SCORED}""")
def suggest_classification(spark, d):
    return V.suggestions(_degrees(spark, d)).select("table", "suggested_class")


@query("classification_progress", "SELECT count(*) AS total, CAST(count(*) FILTER (c <> '') AS BIGINT) AS classified, CAST(count(*) FILTER (c = '') AS BIGINT) AS unclassified, (SELECT string_agg(c || '=' || n, ',' ORDER BY c) FROM (SELECT trim(coalesce(x, '')) AS c, count(*) AS n FROM (SELECT CASE p_size % 4 WHEN 0 THEN 'fact' WHEN 1 THEN ' dimension ' WHEN 2 THEN NULL ELSE '  ' END AS x FROM {part}) GROUP BY 1) WHERE c <> '') AS class_mix FROM (SELECT trim(coalesce(CASE p_size % 4 WHEN 0 THEN 'fact' WHEN 1 THEN ' dimension ' WHEN 2 THEN NULL ELSE '  ' END, '')) AS c FROM {part})")
def classification_progress(spark, d):
    k = F.col("p_size") % 4
    return V.classification_progress(table(spark, d, "part").select(F.when(k == 0, "fact").when(k == 1, " dimension ").when(k == 2, F.lit(None)).otherwise("  ").alias("current_class")))


_FLIP_KEY = "from_table, from_columns, to_table, to_columns"


@query("flip_direction", f"SELECT from_table, from_columns, from_column, to_table, to_columns, to_column, status, ordinal FROM (SELECT *, row_number() OVER (PARTITION BY {_FLIP_KEY} ORDER BY late DESC, ordinal DESC) AS rn FROM (SELECT {_FLIP_KEY}, from_column, to_column, status, ordinal, 0 AS late FROM {{rels}} UNION ALL SELECT to_table, to_columns, from_table, from_columns, to_column, from_column, 'proposed', ordinal, 1 FROM {{rels}} WHERE status = 'rejected')) WHERE rn = 1")
def flip_direction(spark, d):
    rows = relationships(spark, d).select("from_table", "from_columns", "from_column", "to_table", "to_columns", "to_column", "status", "ordinal")
    return V.flip(rows, rows.where("status = 'rejected'"))


@query("merge_edits", f"SELECT ordinal, split_part(from_columns, ';', 1) AS from_column, CASE WHEN e THEN 'approved' ELSE status END AS status, CASE WHEN e THEN 'edited' ELSE evidence END AS evidence FROM (SELECT *, ({_FLIP_KEY}) IN (SELECT ({_FLIP_KEY}) FROM {{rels}} WHERE ordinal % 50 = 0) AS e FROM {{rels}})")
def merge_edits(spark, d):
    rows = relationships(spark, d)
    edits = rows.where("ordinal % 50 = 0").select("from_table", "from_columns", "to_table", "to_columns", F.lit("approved").alias("status"), F.lit("edited").alias("evidence"), "ordinal")
    return V.merge_edits(rows, edits).select("ordinal", "from_column", "status", "evidence")


@query("comment_enrichment", "SELECT 'T' || (p_partkey % 300) AS \"table\", 'C' || p_partkey AS \"column\", CASE WHEN p_partkey % 3 = 0 THEN 'new ' || p_partkey ELSE p_brand END AS comment FROM {part}")
def comment_enrichment(spark, d):
    k = F.col("p_partkey")
    ends = [F.concat(F.lit("T"), (k % 300).cast("string")).alias("table"), F.concat(F.lit("C"), k.cast("string")).alias("column")]
    part = table(spark, d, "part")
    comments = part.where(k % 3 != 2).select(*ends, F.when(k % 3 == 0, F.concat(F.lit("new "), k.cast("string"))).otherwise("  ").alias("comment"))
    return V.enrich(part.select(*ends, F.col("p_brand").alias("comment")), comments)


# --- graph, fingerprints, text ----------------------------------------------------------------------------------

_GRAPH = [("orders", "customer"), ("lineitem", "orders"), ("lineitem", "part"), ("lineitem", "supplier"), ("customer", "nation"), ("supplier", "nation"), ("nation", "region"), ("events", "elsewhere"), ("a", "b"), ("b", "a"), ("c", "a"), ("self", "self")]
_NAMES = ["lineitem", "orders", "customer", "supplier", "nation", "region", "part", "events", "a", "b", "c", "self"]


@query("topo_levels", _values("name, level", [("region", 0), ("part", 0), ("events", 0), ("nation", 1), ("customer", 2), ("supplier", 2), ("orders", 3), ("lineitem", 4), ("a", None), ("b", None), ("c", None), ("self", None)]) + " UNION ALL SELECT 'S' || s_suppkey, CAST(floor(log2(s_suppkey)) AS BIGINT) FROM {supplier} WHERE s_suppkey > 0")
def topo_levels(spark, d):
    """A schema with cycles, and a tree of tables that each refer to the one of half their number."""
    k = F.col("s_suppkey")
    tree = table(spark, d, "supplier").where(k > 0)
    name = lambda c: F.concat(F.lit("S"), c.cast("bigint").cast("string"))
    names = spark.createDataFrame([(n,) for n in _NAMES], "name string").unionByName(tree.select(name(k).alias("name")))
    return G.topological_levels(names, spark.createDataFrame(_GRAPH, "table string, referred string").unionByName(tree.where(k > 1).select(name(k).alias("table"), name(F.floor(k / 2)).alias("referred"))))


_LEVELS = "SELECT 'P' || p_partkey AS name, CAST(floor(log2(p_partkey // 3 + 1)) AS BIGINT) AS level, members FROM {part} JOIN (SELECT p_partkey // 3 AS g, count(*) AS members FROM {part} GROUP BY 1) ON g = p_partkey // 3"


@query("dependency_levels", f"{_LEVELS} UNION ALL SELECT 'S' || s_suppkey, CAST(floor(log2(s_suppkey // 3 + 1)) + 1 AS BIGINT), 1 FROM {{supplier}}")
def dependency_levels(spark, d):
    """Parts by threes refer to each other round a cycle, each three to the one of half their number; suppliers stand behind parts."""
    part, supplier = table(spark, d, "part").select(F.col("p_partkey").alias("k")), table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"))
    named = lambda letter, k: F.concat(F.lit(letter), k.cast("bigint").cast("string"))
    group = F.floor(F.col("k") / 3)
    rings = part.groupBy(group.alias("g")).agg(F.min("k").alias("a"), F.max("k").alias("z"))
    pairs = [
        part.join(part.select((F.col("k") - 1).alias("k")), "k").where(F.col("k") % 3 < 2).select(named("P", F.col("k")), named("P", F.col("k") + 1)),
        rings.select(named("P", F.col("z")), named("P", F.col("a"))),
        rings.where("g > 0").select(named("P", F.col("a")), named("P", (F.floor((F.col("g") + 1) / 2) - 1) * 3)),
        supplier.select(named("S", F.col("k")), named("P", F.col("k"))),
    ]
    keys = pairs[0].toDF("table", "referred")
    for more in pairs[1:]:
        keys = keys.unionByName(more.toDF("table", "referred"))
    names = part.select(named("P", F.col("k")).alias("name")).unionByName(supplier.select(named("S", F.col("k")).alias("name")))
    return levels.dependency_levels(names, keys).select("name", "level", "members")


@query("topo_order", _values("position, name", [(0, "region"), (1, "part"), (2, "events"), (3, "nation"), (4, "customer"), (5, "supplier"), (6, "orders"), (7, "lineitem"), (8, "a"), (9, "b"), (10, "c"), (11, "self")]))
def topo_order(spark, d):
    return spark.createDataFrame(list(enumerate(G.topological_order(_NAMES, _GRAPH))), "position bigint, name string")


def _schema(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    k = F.col("p_partkey")
    cols = table(spark, d, "part").select(F.concat(F.lit("T"), (k % 97).cast("string")).alias("table"), F.concat(F.lit("c"), k.cast("string")).alias("name"), F.lit("int").alias("type"), (F.col("p_size") % 2 == 0).alias("nullable"), F.when(F.col("p_size") % 3 == 0, F.col("p_brand")).alias("comment"))
    keys = table(spark, d, "supplier").select(F.concat(F.lit("T"), (F.col("s_suppkey") % 90).cast("string")).alias("table"), F.array(F.col("s_name")).alias("constrained_columns"), F.concat(F.lit("T"), (F.col("s_suppkey") % 7).cast("string")).alias("referred_table"), F.array(F.lit("ID")).alias("referred_columns"))
    tables = cols.select(F.col("table").alias("name")).distinct().select("name", F.lit("note").alias("comment"), F.array(F.lit("b"), F.lit("a")).alias("primary_key"))
    return cols, keys, tables


@query("schema_fingerprint", "SELECT 'T' || k AS \"table\", 16 AS l1, 16 AS l2, 16 AS l3, true AS same, k % 2 = 0 AS schema_changed, k % 3 = 0 AS fk_changed, k % 5 = 0 AS comment_changed FROM (SELECT DISTINCT p_partkey % 97 AS k FROM {part})")
def schema_fingerprint(spark, d):
    """Hashes of the same schema in another order are the same; a column's type, a further key and a comment each change their own hash alone."""
    cols, keys, tables = _schema(spark, d)
    hashes = ["schema_hash", "fk_hash", "comment_hash"]
    number = lambda c: F.substring(c, 2, 9).cast("int")
    a = G.fingerprints(cols, keys, tables)
    b = G.fingerprints(cols.orderBy(F.desc("name")), keys.orderBy(F.desc("constrained_columns")), tables.withColumn("primary_key", F.reverse("primary_key"))).select("table", F.struct(*hashes).alias("other"))
    more = tables.where(number("name") % 3 == 0).select(F.col("name").alias("table"), F.array(F.lit("x")).alias("constrained_columns"), F.lit("NEW").alias("referred_table"), F.array(F.lit("ID")).alias("referred_columns"))
    c = G.fingerprints(
        cols.withColumn("type", F.when(number("table") % 2 == 0, "bigint").otherwise(F.col("type"))), keys.unionByName(more), tables.withColumn("comment", F.when(number("name") % 5 == 0, "another note").otherwise(F.col("comment")))
    ).select("table", *(F.col(h).alias(f"new_{h}") for h in hashes))
    return a.join(b, "table").join(c, "table").select(
        "table", F.length("schema_hash").alias("l1"), F.length("fk_hash").alias("l2"), F.length("comment_hash").alias("l3"), (F.struct(*hashes) == F.col("other")).alias("same"),
        *((F.col(h) != F.col(f"new_{h}")).alias(h.replace("hash", "changed")) for h in hashes),
    )


@query("cache_roundtrip", "SELECT 'T' || k AS \"table\", CASE WHEN k % 4 = 1 THEN 'fact' END AS classification, 'body ' || k AS content FROM (SELECT DISTINCT p_partkey % 97 AS k FROM {part}) WHERE k % 3 <> 0 AND k % 2 = 1")
def cache_roundtrip(spark, d):
    """What a cache gives back after it is written and read: all tables are put, some invalidated, some put again without a class."""
    names = sorted(r.k for r in table(spark, d, "part").select((F.col("p_partkey") % 97).alias("k")).distinct().collect())
    with tempfile.TemporaryDirectory() as at:  # the driver's own file
        made = Cache(spark, f"{at}/cache.json")
        for k in names:
            made.put(f"t{k}", {"schema_hash": f"s{k}", "fk_hash": "f", "comment_hash": "c", "classification": "fact"}, f"body {k}")
        for k in names:
            if k % 3 == 0:
                made.invalidate(f"T{k}")
            elif k % 4 != 1:
                made.put(f"T{k}", {"schema_hash": f"s{k}", "fk_hash": "f", "comment_hash": "c", "classification": None}, f"body {k}")
        made.save()
        return Cache(spark, f"{at}/cache.json").frame().where(F.substring("table", 2, 9).cast("int") % 2 == 1).select("table", "classification", "content")


@query("stale_tables", "SELECT 't' || k AS \"table\" FROM (SELECT DISTINCT p_partkey % 97 AS k FROM {part}) WHERE k % 4 = 0 OR k % 10 = 3 OR k % 7 = 5 OR k = 1")
def stale_tables(spark, d):
    k = F.col("k")
    now = table(spark, d, "part").select((F.col("p_partkey") % 97).alias("k")).distinct()
    cols = lambda s, c: [s.alias("schema_hash"), F.lit("f").alias("fk_hash"), F.lit("m").alias("comment_hash"), c.alias("classification")]
    none = F.lit(None).cast("string")
    current = now.select(F.concat(F.lit("t"), k.cast("string")).alias("table"), *cols(F.lit("s"), F.when(k % 2 == 0, "fact")))
    cache = now.where(k % 4 != 0).select(F.concat(F.lit("T"), k.cast("string")).alias("table"), *cols(F.when(k % 10 == 3, "old").otherwise("s"), F.when(k % 7 == 5, "bridge").when(k % 2 == 0, "fact").otherwise(none)))
    return G.stale_tables(current, cache, spark.createDataFrame([("T1",)], "table string"))


@query("schema_context", "SELECT 'T' || k AS name, 'TABLE T' || k || chr(10) || 'TABLE_CLASSIFICATION: fact' || chr(10) || 'COLUMNS:' || chr(10) || string_agg('- c' || p_partkey || ' : int' || CASE WHEN p_size % 2 = 0 THEN ' NULL' ELSE ' NOT NULL' END || CASE WHEN p_size % 3 = 0 THEN '  // ' || p_brand ELSE '' END, chr(10) ORDER BY p_partkey) || chr(10) || 'PRIMARY_KEY: [''b'', ''a'']' || CASE WHEN k = 5 THEN chr(10) || 'FOREIGN_KEYS (declared or inferred):' || chr(10) || '- [''X_ID''] -> X([''ID''])  [conf=0.70]  // seen' ELSE '' END AS text FROM (SELECT *, p_partkey % 97 AS k FROM {part}) GROUP BY k")
def schema_context(spark, d):
    cols, _, tables = _schema(spark, d)
    cols = cols.withColumn("position", F.substring("name", 2, 20).cast("bigint"))
    keys = spark.createDataFrame([("T5", "X_ID", "X", "ID", 0.7, "seen")], "table string, from_column string, to_table string, to_column string, confidence double, evidence string")
    return G.schema_context(tables.withColumn("comment", F.lit("")).withColumn("classification", F.lit("fact")), cols, keys)


@query("core_snippets", "SELECT p_partkey AS ordinal, p_name AS line FROM {part} WHERE regexp_matches(p_name, '(?i)\\b(bolt|hot ring)\\b') ORDER BY 1 LIMIT 10")
def core_snippets(spark, d):
    return G.core_snippets(table(spark, d, "part").select(F.col("p_partkey").alias("ordinal"), F.col("p_name").alias("line")), ["BOLT", "", "hot Ring", "bol"])


_ASKED = "(SELECT DISTINCT 'T' || (p_partkey % 7) AS t, CASE WHEN p_partkey % 5 = 0 THEN p_name ELSE split_part(p_name, ' ', 1) END AS term FROM {part} WHERE p_partkey % 3 = 0 OR p_partkey < 20)"


@query("snippets_by_table", f"SELECT t AS \"table\", ordinal, line FROM (SELECT *, row_number() OVER (PARTITION BY t ORDER BY ordinal) AS r FROM (SELECT DISTINCT t, p_partkey AS ordinal, upper(p_name) AS line FROM {{part}} JOIN {_ASKED} a ON contains(' ' || p_name || ' ', ' ' || term || ' '))) WHERE r <= 10")
def snippets_by_table(spark, d):
    k = F.col("p_partkey")
    part = table(spark, d, "part")
    terms = part.where((k % 3 == 0) | (k < 20)).select(F.concat(F.lit("T"), (k % 7).cast("string")).alias("table"), F.when(k % 5 == 0, F.col("p_name")).otherwise(F.split_part("p_name", F.lit(" "), F.lit(1))).alias("term"))
    return G.snippets_by_table(part.select(k.alias("ordinal"), F.upper("p_name").alias("line")), terms, 10)


# --- ontology ---------------------------------------------------------------------------------------------------

_T = "{triples}"
_IN = f"s LIKE '{BASE_IRI}%'"


def _typed(*kinds: str) -> str:
    return f"(SELECT s, o AS kind FROM {_T} WHERE p = '{RDF_TYPE}' AND o IN ({', '.join(repr(OWL + k) for k in kinds)}) AND {_IN})"


def _with(p: str) -> str:
    return f"(SELECT s, o FROM {_T} WHERE p = '{RDFS}{p}')"


_ALL3 = _typed("Class", "ObjectProperty", "DatatypeProperty")
_PROPS = f"(SELECT replace(t.s, '{BASE_IRI}', '') AS prop, replace(a.o, '{BASE_IRI}', '') AS domain, replace(b.o, '{BASE_IRI}', '') AS range FROM {_typed('ObjectProperty')} t JOIN {_with('domain')} a ON a.s = t.s JOIN {_with('range')} b ON b.s = t.s)"
_GIVEN = f"(SELECT s, o FROM {_T} WHERE p = '{BASE_IRI}classification')"


def _ontology(spark: SparkSession, d: str) -> R.Ontology:
    return R.Ontology(derived(spark, d, "triples"))


@query("merge_triples", f"SELECT s, p, o FROM {_T}")
def merge_triples(spark, d):
    t = derived(spark, d, "triples")
    return R.merged(t, t.where(F.col("p") == RDF_TYPE), t.limit(0))


@query("table_coverage", f"SELECT count(DISTINCT s) AS covered, CAST(250 AS BIGINT) AS total, count(DISTINCT s) / 250 AS coverage FROM {_typed('Class')} WHERE s IN (SELECT s FROM {_with('label')})")
def table_coverage(spark, d):
    return _ontology(spark, d).table_coverage(250)


@query("column_coverage", f"SELECT count(DISTINCT s) AS covered, CAST(0 AS BIGINT) AS total, CAST(0 AS DOUBLE) AS coverage FROM {_typed('ObjectProperty', 'DatatypeProperty')} WHERE s IN (SELECT s FROM {_with('label')})")
def column_coverage(spark, d):
    return _ontology(spark, d).column_coverage(0)


@query("relationship_coverage", f"SELECT count(DISTINCT s) AS relationships FROM {_typed('ObjectProperty')} WHERE s IN (SELECT s FROM {_with('domain')}) AND s IN (SELECT s FROM {_with('range')})")
def relationship_coverage(spark, d):
    return _ontology(spark, d).relationship_count()


_ORPHANS = f"(SELECT s FROM {_typed('Class')} WHERE s NOT IN (SELECT o FROM {_with('domain')}) AND s NOT IN (SELECT o FROM {_with('range')}) AND s NOT IN (SELECT s FROM {_with('subClassOf')}))"
_DUPS = f"(SELECT s, count(*) AS n FROM {_ALL3} GROUP BY s HAVING count(*) > 1)"
_UNLABELLED = f"(SELECT s FROM {_ALL3} WHERE s NOT IN (SELECT s FROM {_with('label')}))"
_BAD_DOMAINS = f"(SELECT s, o FROM {_with('domain')} WHERE {_IN} AND o NOT IN (SELECT s FROM {_T} WHERE p = '{RDF_TYPE}' AND o = '{OWL}Class'))"


@query("orphan_classes", f"SELECT s AS class FROM {_ORPHANS}")
def orphan_classes(spark, d):
    return _ontology(spark, d).orphan_classes()


@query("duplicate_iris", f"SELECT s AS iri, n AS count FROM {_DUPS}")
def duplicate_iris(spark, d):
    return _ontology(spark, d).duplicate_iris()


@query("missing_labels", f"SELECT s AS entity FROM {_UNLABELLED}")
def missing_labels(spark, d):
    return _ontology(spark, d).missing_labels()


@query("invalid_domains", f"SELECT s AS prop, o AS domain FROM {_BAD_DOMAINS}")
def invalid_domains(spark, d):
    return _ontology(spark, d).invalid_domains()


@query("object_properties", f"SELECT * FROM {_PROPS}")
def object_properties(spark, d):
    return _ontology(spark, d).object_properties()


@query("all_classes", f"SELECT replace(s, '{BASE_IRI}', '') AS class FROM {_typed('Class')}")
def all_classes(spark, d):
    return _ontology(spark, d).all_classes()


@query("classified_classes", f"SELECT replace(t.s, '{BASE_IRI}', '') AS class, max(g.o) AS classification FROM {_typed('Class')} t JOIN {_GIVEN} g ON g.s = t.s GROUP BY 1")
def classified_classes(spark, d):
    return _ontology(spark, d).classified_classes()


@query("unclassified", f"SELECT replace(s, '{BASE_IRI}', '') AS class FROM {_typed('Class')} WHERE s NOT IN (SELECT s FROM {_GIVEN})")
def unclassified(spark, d):
    return _ontology(spark, d).unclassified()


_BRIDGES = f"(SELECT replace(c.s, '{BASE_IRI}', '') AS class, count(DISTINCT x.s) AS prop_count FROM {_typed('Class')} c JOIN {_GIVEN} g ON g.s = c.s AND g.o = 'bridge' LEFT JOIN (SELECT a.s, a.o FROM {_with('domain')} a WHERE a.s IN (SELECT s FROM {_T} WHERE p = '{RDF_TYPE}' AND o = '{OWL}ObjectProperty')) x ON x.o = c.s GROUP BY 1)"


@query("bridge_counts", f"SELECT * FROM {_BRIDGES}")
def bridge_counts(spark, d):
    return _ontology(spark, d).bridge_counts()


@query("bridge_issues", f"SELECT class, CAST(2 AS BIGINT) AS expected, prop_count AS actual, CASE WHEN prop_count < 2 THEN 'Too few ObjectProperties' ELSE 'Too many ObjectProperties' END AS reason FROM {_BRIDGES} WHERE prop_count <> 2")
def bridge_issues(spark, d):
    return _ontology(spark, d).bridge_issues()


@query(
    "class_names",
    """SELECT k, array_to_string(list_transform(string_split(name, '_'), lambda p: (CASE WHEN length(q(p)) > 0 THEN upper(q(p)[1]) || lower(q(p)[2:]) ELSE '' END)), '') AS class_name FROM {names}""".replace(
        "q(p)", "(CASE WHEN p LIKE '%IES' THEN p[:-4] || 'Y' WHEN p LIKE '%SSES' OR p LIKE '%XES' OR p LIKE '%CHES' OR p LIKE '%SHES' THEN p[:-3] WHEN p LIKE '%S' AND p NOT LIKE '%SS' THEN p[:-2] ELSE p END)"
    ),
)
def class_names(spark, d):
    return derived(spark, d, "names").select("k", X.class_name(F.col("name")).alias("class_name"))


_FOUND = f"(SELECT e.*, (upper(from_table), upper(to_table)) IN (SELECT (upper(domain), upper(range)) FROM {_PROPS}) AS found FROM {{approved_edges}} e)"


@query("edge_coverage", f"SELECT count(*) AS approved_edges, count(*) FILTER (found) AS covered_edges, round(count(*) FILTER (found) / count(*), 3) AS coverage_rate FROM {_FOUND}")
def edge_coverage(spark, d):
    return _ontology(spark, d).edge_coverage(derived(spark, d, "approved_edges"))


@query("missing_edges", f"SELECT from_table, to_table, 'ObjectProperty not found' AS reason FROM {_FOUND} WHERE NOT found")
def missing_edges(spark, d):
    return _ontology(spark, d).missing_edges(derived(spark, d, "approved_edges"))


@query("relation_names", f"SELECT from_table, to_table, relation, actual, CASE WHEN actual IS NULL THEN 'absent' WHEN lower(actual) = lower(relation) THEN 'matched' ELSE 'mismatch' END AS outcome FROM {{approved_edges}} e LEFT JOIN (SELECT upper(domain) AS d, upper(range) AS r, max(prop) AS actual FROM {_PROPS} GROUP BY 1, 2) ON d = upper(from_table) AND r = upper(to_table)")
def relation_names(spark, d):
    return _ontology(spark, d).relation_names(derived(spark, d, "approved_edges"))


@query("fragment_mismatches", f"SELECT dl || '→' || rl AS edge, e.relation AS expected, actual FROM (SELECT replace(t.s, '{BASE_IRI}', '') AS actual, replace((SELECT max(o) FROM {_with('domain')} a WHERE a.s = t.s), '{BASE_IRI}', '') AS dl, replace((SELECT max(o) FROM {_with('range')} b WHERE b.s = t.s), '{BASE_IRI}', '') AS rl FROM {_typed('ObjectProperty')} t) JOIN {{approved_edges}} e ON upper(dl) = upper(from_table) AND upper(rl) = upper(to_table) WHERE lower(actual) <> lower(e.relation)")
def fragment_mismatches(spark, d):
    return _ontology(spark, d).fragment_mismatches(derived(spark, d, "approved_edges"))


@query("validation_gates", f"SELECT 'pass' AS parse, dup AS duplicates, cov AS coverage, CASE WHEN dup = 'fail' OR cov = 'fail' THEN 'fail' ELSE 'pass' END AS overall FROM (SELECT CASE WHEN (SELECT count(*) FROM {_DUPS}) = 0 THEN 'pass' ELSE 'fail' END AS dup, (SELECT CASE WHEN round(count(*) FILTER (found) / count(*), 3) >= 0.9 THEN 'pass' WHEN round(count(*) FILTER (found) / count(*), 3) >= 0.5 THEN 'warn' ELSE 'fail' END FROM {_FOUND}) AS cov)")
def validation_gates(spark, d):
    return _ontology(spark, d).gates(derived(spark, d, "approved_edges"))


@query(
    "validation_issues",
    f"""SELECT 'warning' AS severity, 'coverage' AS category, 'Table coverage ' || printf('%.1f', c * 100) || '% below warning threshold 50.0%' AS message, NULL AS entity FROM (SELECT count(DISTINCT s) / 1000000 AS c FROM {_typed('Class')} WHERE s IN (SELECT s FROM {_with('label')})) WHERE c < 0.5
  UNION ALL SELECT 'error', 'coverage', 'Table coverage ' || printf('%.1f', c * 100) || '% below pass threshold 90.0%', NULL FROM (SELECT count(DISTINCT s) / 1000000 AS c FROM {_typed('Class')} WHERE s IN (SELECT s FROM {_with('label')})) WHERE c < 0.9
  UNION ALL SELECT 'error', 'duplicate_iri', 'Duplicate IRI found ' || n || ' times', s FROM {_DUPS}
  UNION ALL SELECT 'warning', 'orphan_class', 'Class has no properties or parent', s FROM {_ORPHANS}
  UNION ALL SELECT 'warning', 'missing_label', 'Entity missing rdfs:label', s FROM {_UNLABELLED}
  UNION ALL SELECT 'error', 'invalid_domain', 'Property domain ' || o || ' is not a declared class', s FROM {_BAD_DOMAINS}""",
)
def validation_issues(spark, d):
    return _ontology(spark, d).issues(1_000_000)


@query("emit_triples", f"SELECT p, count(*) AS n FROM (SELECT '{RDF_TYPE}' AS p, 'C' || p_partkey AS s FROM {{part}} UNION ALL SELECT '{RDFS}label', 'C' || p_partkey FROM {{part}} UNION ALL SELECT '{BASE_IRI}classification', 'C' || p_partkey FROM {{part}} WHERE p_size % 2 = 0 UNION ALL SELECT unnest(['{RDF_TYPE}', '{RDFS}label', '{RDFS}domain']), 'c' || p_partkey FROM {{part}} UNION ALL SELECT unnest(['{RDF_TYPE}', '{RDFS}label', '{RDFS}domain', '{RDFS}range']), 'r' || s_suppkey FROM {{supplier}}) GROUP BY p")
def emit_triples(spark, d):
    k = F.col("p_partkey").cast("string")
    tables = table(spark, d, "part").select(F.concat(F.lit("C"), k).alias("name"), F.when(F.col("p_size") % 2 == 0, "fact").alias("classification"))
    columns = table(spark, d, "part").select(F.concat(F.lit("C"), k).alias("table"), F.lit("x").alias("name"))
    keys = table(spark, d, "supplier").select(F.lit("C1").alias("from_table"), F.lit("C2").alias("to_table"), F.concat(F.lit("r"), F.col("s_suppkey").cast("string")).alias("relation"))
    return R.emitted(tables, columns, keys).groupBy("p").agg(F.count("*").alias("n"))


_TURTLE = f'''@prefix owl: <{OWL}> .
@prefix rdfs: <{RDFS}> .
@prefix : <{BASE_IRI}> .
# classes
:Customer a owl:Class ; rdfs:label "Customer"@en , "Kunde \\"K\\""@de .
:hasOrder a owl:ObjectProperty ; rdfs:domain :Customer ; rdfs:range :Order .
:Order a owl:Class ; :rows 12 ; :rows 12 .'''
_RDFXML = f'''<?xml version="1.0"?><rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:owl="{OWL}" xmlns:rdfs="{RDFS}" xml:base="{BASE_IRI}">
<owl:Class rdf:about="{BASE_IRI}Item"><rdfs:label xml:lang="en">Item</rdfs:label></owl:Class><owl:DatatypeProperty rdf:ID="price"><rdfs:domain rdf:resource="#Item"/></owl:DatatypeProperty></rdf:RDF>'''


@query(
    "rdf_triples",
    _values(
        "s, p, o, o_kind, datatype, lang",
        [
            (f"{BASE_IRI}Customer", RDF_TYPE, f"{OWL}Class", "iri", None, None), (f"{BASE_IRI}Customer", f"{RDFS}label", "Customer", "literal", None, "en"), (f"{BASE_IRI}Customer", f"{RDFS}label", 'Kunde "K"', "literal", None, "de"),
            (f"{BASE_IRI}hasOrder", RDF_TYPE, f"{OWL}ObjectProperty", "iri", None, None), (f"{BASE_IRI}hasOrder", f"{RDFS}domain", f"{BASE_IRI}Customer", "iri", None, None), (f"{BASE_IRI}hasOrder", f"{RDFS}range", f"{BASE_IRI}Order", "iri", None, None),
            (f"{BASE_IRI}Order", RDF_TYPE, f"{OWL}Class", "iri", None, None), (f"{BASE_IRI}Order", f"{BASE_IRI}rows", "12", "literal", "http://www.w3.org/2001/XMLSchema#integer", None),
            (f"{BASE_IRI}Item", RDF_TYPE, f"{OWL}Class", "iri", None, None), (f"{BASE_IRI}Item", f"{RDFS}label", "Item", "literal", None, "en"), (f"{BASE_IRI}price", RDF_TYPE, f"{OWL}DatatypeProperty", "iri", None, None), (f"{BASE_IRI}price", f"{RDFS}domain", f"{BASE_IRI}Item", "iri", None, None),
        ],
    ),
)
def rdf_triples(spark, d):
    return rdf.triples_of(spark.createDataFrame([("a.ttl", _TURTLE), ("b.owl", _RDFXML)], "path string, text string"))


@query("canonical_triples", "SELECT p, CAST(n AS BIGINT) AS n, CAST(nodes AS BIGINT) AS nodes FROM (VALUES ('name', (SELECT count(*) FROM {nation}), (SELECT count(*) FROM {nation})), ('in', (SELECT count(*) FROM {nation}), (SELECT count(*) FROM {nation})), ('called', (SELECT count(*) FROM {region}), (SELECT count(*) FROM {region})), ('next', (SELECT count(*) FROM {supplier}), (SELECT count(*) FROM {supplier})), ('is', (SELECT count(*) FROM {supplier}), (SELECT count(*) FROM {supplier}))) v(p, n, nodes)")
def canonical_triples(spark, d):
    """The same blank nodes in two files, under other names: nations that refer to regions, and suppliers on one ring."""
    nation, region, supplier = (table(spark, d, x) for x in ("nation", "region", "supplier"))
    suppliers = supplier.count()

    def in_file(file: str, named) -> DataFrame:
        node = lambda kind, k: F.concat(F.lit(f"_:{kind}"), named(k.cast("bigint")).cast("string"), F.lit(f"@{file}"))
        row = lambda s, p, o, kind: (s.alias("s"), F.lit(p).alias("p"), o.alias("o"), F.lit(kind).alias("o_kind"), F.lit(None).cast("string").alias("datatype"), F.lit(None).cast("string").alias("lang"))
        k = F.col("s_suppkey")
        parts = [
            nation.select(*row(node("n", F.col("n_nationkey")), "name", F.col("n_name"), "literal")), nation.select(*row(node("n", F.col("n_nationkey")), "in", node("r", F.col("n_regionkey")), "blank")),
            region.select(*row(node("r", F.col("r_regionkey")), "called", F.col("r_name"), "literal")), supplier.select(*row(node("s", k), "next", node("s", (k + 1) % suppliers), "blank")), supplier.select(*row(node("s", k), "is", F.col("s_name"), "literal")),
        ]
        return R.merged(*parts)

    both = R.canonical(R.merged(in_file("a.ttl", lambda k: k), in_file("b.ttl", lambda k: 1_000_000 - k)))
    return both.groupBy("p").agg(F.count("*").alias("n"), F.count_distinct("s").alias("nodes"))


# --- sources ----------------------------------------------------------------------------------------------------


@query("scan_worksheets", _values("path, length", [(p, len(x)) for p, x in WORKSHEETS]))
def scan_worksheets(spark, d):
    """Of a folder of files, the worksheets at any depth."""
    return worksheets.scan(spark, _folder(spark)).select(F.substring_index("path", "/", -1).alias("path"), F.length("sql").cast("bigint").alias("length"))


@query("worksheets_hash", "SELECT 'sha256:' || substr(sha256(string_agg(sql, '' ORDER BY path)), 1, 16) AS worksheets_hash FROM (" + _values("path, sql", [(f"{'' if k % 2 else 'more/'}{p}", x) for k, (p, x) in enumerate(WORKSHEETS)]) + ")")
def worksheets_hash(spark, d):
    return worksheets.content_hash(worksheets.scan(spark, _folder(spark)))


def _csv(spark: SparkSession, df: DataFrame, order: str | None = None) -> str:
    """df as CSV files; if asked, in the order of a column, which they don't hold: ranges of it are files whose names follow each other."""
    path = f"{scratch(spark, 'results')}/rows.csv"
    if order:
        df = df.repartitionByRange(order).sortWithinPartitions(order).drop(order)
    df.write.option("header", True).option("escape", '"').csv(path)
    return path


@query("load_edge_profiles", "SELECT from_table, from_column, to_table, to_column, match_rate, frequency, CAST(0 AS BIGINT) AS sample_rows FROM (SELECT *, row_number() OVER (PARTITION BY upper(from_table), upper(from_column), upper(to_table), upper(to_column) ORDER BY k DESC) AS rn FROM (SELECT * REPLACE (CAST(match_rate AS DOUBLE) AS match_rate) FROM {profiles})) WHERE rn = 1")
def load_edge_profiles(spark, d):
    df = derived(spark, d, "profiles")
    return results.edge_profiles(spark, _csv(spark, df.toDF(*(c.upper() if c != "k" else c for c in df.columns)), "k")).select("from_table", "from_column", "to_table", "to_column", "match_rate", "frequency", "sample_rows")


@query("load_column_profiles", "SELECT table_name, column_name, CAST(null_rate AS DOUBLE) AS null_rate, CAST(0 AS BIGINT) AS total_rows FROM {column_profiles}")
def load_column_profiles(spark, d):
    return results.column_profiles(spark, _csv(spark, derived(spark, d, "column_profiles"), "k")).select("table_name", "column_name", "null_rate", "total_rows")


@query("load_direction_hints", "SELECT table_a, col_a, table_b, col_b, direction_suggestion FROM {hints} UNION ALL SELECT table_b, col_b, table_a, col_a, direction_suggestion FROM {hints}")
def load_direction_hints(spark, d):
    return results.direction_hints(spark, _csv(spark, derived(spark, d, "hints"))).select("table_a", "col_a", "table_b", "col_b", "direction_suggestion")


@query("load_comments", "SELECT 'T' || (p_partkey % 50) AS \"table\", arg_max(p_brand, p_partkey) AS comment FROM {part} WHERE p_size % 2 = 0 GROUP BY 1")
def load_comments(spark, d):
    rows = table(spark, d, "part").select(F.concat(F.lit(" T"), (F.col("p_partkey") % 50).cast("string")).alias("table"), F.when(F.col("p_size") % 2 == 0, F.concat("p_brand", F.lit(" "))).otherwise(" ").alias("comment"), "p_partkey")
    return results.comments(spark, _csv(spark, rows, "p_partkey"), ["table"])


@query("schema_catalog", " UNION ALL ".join(f"SELECT '{t}' AS \"table\", column_name AS name, CASE column_type WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(column_type) END AS type, row_number() OVER () - 1 AS position FROM (DESCRIBE SELECT * FROM {t})" for t in TABLES))
def schema_catalog(spark, d):
    return catalog.columns_of(spark, {t: table(spark, d, t) for t in TABLES}).select("table", "name", "type", F.col("position").cast("bigint").alias("position"))


_DECLARED = """keys:
- {table: orders, columns: [o_custkey], referred_table: customer, referred_columns: [c_custkey]}
- {table: lineitem, columns: [l_orderkey, l_linenumber], referred_table: orders, referred_columns: [o_orderkey, o_line]}
- {table: nation, columns: [n_regionkey], referred_table: " "}
primary_keys: {orders: [o_orderkey], Region: [r_regionkey]}
"""


@query("declared_keys", _values('"table", from_column, to_table, to_column, confidence, evidence', [("orders", "o_custkey", "customer", "c_custkey", 1.0, "declared"), ("lineitem", "l_orderkey", "orders", "o_orderkey", 1.0, "declared"), ("lineitem", "l_linenumber", "orders", "o_line", 1.0, "declared")]))
def declared_keys(spark, d):
    """Foreign keys that a file declares, column by column; those without a referred table are left out."""
    with tempfile.TemporaryDirectory() as at:  # the driver's own file
        (Path(at) / "keys.yaml").write_text(_DECLARED)
        return catalog.pairs(catalog.declared(spark, f"{at}/keys.yaml")[0])


@query("schema_filter", "SELECT p_brand AS \"table\", count(*) AS n FROM {part} WHERE p_brand IN ('Brand#11', 'Brand#12', 'Brand#13') AND p_brand <> 'Brand#12' GROUP BY 1")
def schema_filter(spark, d):
    rows = table(spark, d, "part").select(F.col("p_brand").alias("table"))
    return catalog.filtered(rows, ["Brand#11", "Brand#12", "Brand#13"], ["Brand#12"]).groupBy("table").agg(F.count("*").alias("n"))


@query("latest_version", "SELECT 'core_2026-03-02T10-00-00.owl' AS path, '2026-03-02T10-00-00' AS stamp")
def latest_version(spark, d):
    at = scratch(spark, "versions")
    for stamp in ("2026-03-01T23-59-59", "2026-03-02T10-00-00", "2025-12-31T00-00-00", "draft"):
        put(spark, f"{at}/core_{stamp}.owl", stamp)
    return artifacts.latest(artifacts.listed(spark, at)).select(F.substring_index("path", "/", -1).alias("path"), "stamp")


@query("graph_source", f"SELECT p, count(*) AS n, min(s) AS first_s, max(o) AS last_o FROM {{triples}} WHERE p IN ('{RDFS}label', '{RDFS}domain') GROUP BY p")
def graph_source(spark, d):
    """Triples of the test tables, written and read by the source; two predicates of them are asked for."""
    at = f"{scratch(spark, 'graph')}/triples"
    triples = derived(spark, d, "triples").withColumns({"o_kind": F.when(F.col("p") == f"{RDFS}label", "literal").otherwise("iri"), "datatype": F.lit(None).cast("string"), "lang": F.lit(None).cast("string")})
    graphsource.write_graph(triples, at)
    return graphsource.read_graph(spark, at, 64 << 10).where(F.col("p").isin(f"{RDFS}label", f"{RDFS}domain")).groupBy("p").agg(F.count("*").alias("n"), F.min("s").alias("first_s"), F.max("o").alias("last_o"))


@query("observed_counts", "SELECT count(*) AS rows, count(*) FILTER (status = 'approved') AS approved, count(*) FILTER (match_rate IS NULL) AS not_profiled, count(*) FILTER (match_rate < 0.5) AS low_match, max(frequency) AS most FROM {rels}")
def observed_counts(spark, d):
    """Figures of relationships, taken while they are written."""
    rels = relationships(spark, d)
    got = artifacts.write_observed(rels, f"{scratch(spark, 'observed')}/rels", approved=F.count_if(F.col("status") == "approved"), not_profiled=F.count_if(F.col("match_rate").isNull()), low_match=F.count_if(F.col("match_rate") < 0.5), most=F.max("frequency"))
    return spark.createDataFrame([tuple(got[k] for k in ("rows", "approved", "not_profiled", "low_match", "most"))], "rows bigint, approved bigint, not_profiled bigint, low_match bigint, most bigint")


@query("snapshot_as_of", "SELECT o_orderkey, o_custkey, o_orderpriority FROM {orders} WHERE o_orderkey % 3 <> 2")
def snapshot_as_of(spark, d):
    """Three writes of growing parts of a table, read as of a time between the second and the third."""
    orders, at = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority"), scratch(spark, "snapshots")
    day = lambda n: datetime(2026, 3, n, tzinfo=timezone.utc)
    for n, rows in ((1, orders.where("o_orderkey % 3 = 0")), (2, orders.where("o_orderkey % 3 <> 2")), (3, orders)):
        snapshots.write_snapshot(rows, at, day(n))
    return snapshots.as_of(spark, at, day(2).replace(hour=9))


_DELTA = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"]


@query(
    "profile_delta",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS total_rows, count({c}) AS non_null_count, CASE WHEN count(*) > 0 THEN 1 - count({c}) / count(*) ELSE 1 END AS null_rate, count(DISTINCT {c}) AS distinct_count, CASE WHEN count({c}) > 0 THEN count(DISTINCT {c}) / count({c}) ELSE 0 END AS cardinality_ratio, {'CAST(min(o_custkey) AS VARCHAR)' if c == 'o_custkey' else 'NULL'} AS min_custkey, true AS only_changed FROM {{orders}} WHERE o_orderkey % 4 <> 0"
        for c in _DELTA
    ),
)
def profile_delta(spark, d):
    """A state of three quarters of a table; then one quarter goes and another comes: the profile is that of what is there, and only the files that came are read."""
    orders, at = table(spark, d, "orders").select(*_DELTA), scratch(spark, "increment")
    part = lambda k: orders.where(F.col("o_orderkey") % 4 == k).write.parquet(f"{at}/files/part{k}")
    for k in (0, 1, 2):
        part(k)
    first = increment.refreshed(spark, f"{at}/files", _DELTA, f"{at}/state")
    part(3)
    fs, gone = filesystem(spark, f"{at}/files/part0")
    fs.delete(gone, True)
    delta = increment.refreshed(spark, f"{at}/files", _DELTA, f"{at}/state")
    changed = delta.read == increment.files(spark, f"{at}/files/part3").count() and first.gone == 0 < delta.gone
    return delta.profile.select("column_name", "total_rows", "non_null_count", "null_rate", "distinct_count", "cardinality_ratio", F.when(F.col("column_name") == "o_custkey", F.col("min_val")).alias("min_custkey"), F.lit(changed).alias("only_changed"))


@query("parse_metadata_json", "SELECT 'T' || event_id AS \"table\", event_type AS comment FROM {events} UNION ALL SELECT 'second', NULL FROM {events}")
def parse_metadata_json(spark, d):
    text = F.concat(F.lit('Sure: {"tables": [{"name": "T'), F.col("event_id").cast("string"), F.lit('", "comment": "'), "event_type", F.lit('"}, {"name": "second"}]} done'))
    return artifacts.metadata_tables(table(spark, d, "events").select(text.alias("answer")), "answer")


@query("extract_content", "SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'a' || event_id WHEN 1 THEN 'b' || event_id ELSE 'nothing' END AS content FROM {events}")
def extract_content(spark, d):
    n = F.col("event_id").cast("string")
    text = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit('x { no object, {"result": {"content": "a'), n, F.lit('"}} y'))).when(F.col("event_id") % 3 == 1, F.concat(F.lit('{"result": {"content": " "}, "text": "b'), n, F.lit('"} } {"text": "later"}'))).otherwise(" nothing ")
    return artifacts.extracted(table(spark, d, "events").select("event_id", text.alias("answer")), "answer", "$.result.content", "$.text").select("event_id", "content")


def entry(spark: SparkSession) -> DataFrame:
    """The flagship query: profiles of all natural keys."""
    return edge_profile(spark, "/root/testdata/sf0.001")


__all__ = ["DERIVED", "ORACLES", "QUERIES", "entry"]
