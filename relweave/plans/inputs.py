"""Inputs of the registered queries: the test tables, and tables derived from them by SQL that Spark and DuckDB both run, so that every branch of the rules is met and inputs grow with the data."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relweave.functions import expr as X
from relweave.schemas import BASE_IRI, OWL, RDF_TYPE, RDFS
from relweave.session import table

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

#: Natural keys of the test tables; frequency and confidence are as a parser would have found them.
KEYS = [
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ("nation", "n_regionkey", "region", "r_regionkey"),
    ("events", "user_id", "customer", "c_custkey"),
    ("orders_gaps", "customer_id", "customer_some", "id"),
    ("orders", "o_custkey", "customer_twice", "c_custkey"),
    # Keys of different types: bigint and decimal, double and int, date and timestamp, text and bigint.
    ("orders", "o_custkey", "customer_typed", "as_decimal"),
    ("customer_typed", "as_double", "nation", "n_nationkey"),
    ("orders_typed", "as_date", "orders_typed", "as_time"),
    ("customer_typed", "as_text", "customer", "c_custkey"),
]

#: How DuckDB is to read a key that it would not compare with the other end by itself.
READ_AS = {("customer_typed", "as_text"): "TRY_CAST({} AS BIGINT)"}

DERIVED = {
    # Keys with nulls, parents that lack some keys, parents that have each key twice.
    "orders_gaps": "SELECT nullif(o_custkey, o_custkey - o_orderkey % 5) AS customer_id FROM {orders}",
    "customer_some": "SELECT c_custkey AS id FROM {customer} WHERE c_custkey % 10 <> 0",
    "customer_twice": "SELECT c_custkey FROM {customer} UNION ALL SELECT c_custkey FROM {customer}",
    "customer_typed": "SELECT CAST(c_custkey * 2 AS DECIMAL(12, 2)) AS as_decimal, c_nationkey + CASE WHEN c_custkey % 4 = 0 THEN 0.5e0 ELSE 0e0 END AS as_double, CASE WHEN c_custkey % 5 = 0 THEN 'no ' || c_custkey WHEN c_custkey % 7 = 0 THEN '0' || c_custkey WHEN c_custkey % 11 <> 0 THEN CAST(c_custkey * 2 AS VARCHAR(20)) END AS as_text FROM {customer}",
    "orders_typed": "SELECT CAST(o_orderdate AS DATE) AS as_date, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + CASE WHEN o_custkey % 3 = 0 THEN INTERVAL '1' HOUR ELSE INTERVAL '0' HOUR END AS as_time FROM {orders}",
    # An edge per event, with identifiers of all sorts.
    "edges": """SELECT 'T' || (user_id % 23) AS left_table,
  CASE event_id % 5 WHEN 0 THEN 'ID' WHEN 1 THEN 'CUSTOMER_ID' WHEN 2 THEN 'ORDER_ID' WHEN 3 THEN 'CODE' ELSE 'REF' END AS left_column,
  'T' || ((user_id * 7 + event_id) % 19) AS right_table,
  CASE (event_id + user_id) % 4 WHEN 0 THEN 'ID' WHEN 1 THEN 'CUSTOMER_ID' WHEN 2 THEN 'CODE' ELSE 'REF' END AS right_column,
  CASE event_id % 11 WHEN 0 THEN 'casted_eq' WHEN 1 THEN 'eq_expression' WHEN 2 THEN 'range_or_inequality' WHEN 3 THEN 'function_based' WHEN 4 THEN 'composite_predicate' WHEN 5 THEN 'other' ELSE 'eq_column_column' END AS predicate_type,
  'a.x  =   b.' || event_type AS predicate, 'relweave' AS parser_dialect, 'eq' AS ast_path, 'statement_' || (event_id % 3 + 1) AS source_query_block,
  'f' || (event_id % 7) || '.sql | statement_1 | eq | a.x = b.y' AS evidence, event_id AS ordinal FROM {events}""",
    # A relationship per event, with rates of all sizes.
    "rels": """SELECT 'T' || (user_id % 23) AS from_table, CASE WHEN event_id % 6 = 0 THEN 'A;B' ELSE 'C' || (event_id % 9) END AS from_columns, CASE WHEN event_id % 6 = 0 THEN 'A' ELSE 'C' || (event_id % 9) END AS from_column,
  'T' || ((user_id * 7 + event_id) % 19) AS to_table, 'ID' AS to_columns, 'ID' AS to_column,
  (event_id % 97) / 96e0 AS confidence_sql, event_id % 12 AS frequency, CASE WHEN event_id % 13 = 0 THEN NULL ELSE (event_id % 101) / 100e0 END AS match_rate,
  (event_id % 37) / 36e0 AS pk_unique_rate, CASE WHEN event_id % 17 = 0 THEN NULL ELSE (event_id % 11) / 10e0 END AS fk_null_rate,
  CASE event_id % 5 WHEN 0 THEN 'approved' WHEN 1 THEN 'rejected' WHEN 2 THEN NULL ELSE 'proposed' END AS status,
  event_type || CASE WHEN event_id % 10 = 0 THEN ' [Auto-Approved]' ELSE '' END AS evidence, event_id AS ordinal FROM {events}""",
    # Profiles of some of the relationships, in lower case and partly the other way round.
    "profiles": """SELECT lower('T' || k % 23) AS from_table, 'C' || (k % 9) AS from_column, 'T' || (k % 19) AS to_table, 'id' AS to_column, (k % 89) / 88e0 AS match_rate, (k % 7) / 6e0 AS pk_unique_rate, (k % 5) / 4e0 AS fk_null_rate,
  k % 15 AS frequency, (k % 31) / 30e0 AS confidence_sql, k % 4 <> 0 AS profiled, k FROM (SELECT p_partkey AS k FROM {part})
  UNION ALL SELECT 'T' || (k % 19), 'ID', 'T' || (k % 23), 'C' || (k % 9), 0.5, 0.5, 0.5, 3, 0.5, true, k + 1000000000 FROM (SELECT p_partkey AS k FROM {part})""",
    "column_profiles": "SELECT 'T' || s_suppkey AS table_name, 'C' || (s_suppkey % 5) AS column_name, (s_suppkey % 10) / 10e0 AS null_rate, s_suppkey AS k FROM {supplier}",
    "hints": """SELECT 'T' || (k % 23) AS table_a, 'C' || (k % 9) AS col_a, 'T' || (k % 19) AS table_b, 'ID' AS col_b, 0.5 AS a_coverage, 0.5 AS b_coverage,
  CASE k % 3 WHEN 0 THEN 'T' || (k % 23) || ' is likely the PARENT (referred) table' WHEN 1 THEN 'T' || (k % 19) || ' is likely the PARENT (referred) table' ELSE 'Direction unclear' END AS direction_suggestion FROM (SELECT p_partkey AS k FROM {part})""",
    "triples": """SELECT DISTINCT s, p, o FROM (
  SELECT CASE WHEN p_size % 13 = 0 THEN 'http://other#C' ELSE '{base}C' END || p_partkey AS s, '{type}' AS p, '{owl}Class' AS o FROM {part}
  UNION ALL SELECT '{base}C' || p_partkey, '{rdfs}label', p_name FROM {part} WHERE p_size % 5 <> 0
  UNION ALL SELECT '{base}C' || p_partkey, '{rdfs}subClassOf', '{base}C1' FROM {part} WHERE p_size % 7 = 0
  UNION ALL SELECT '{base}C' || p_partkey, '{base}classification', CASE p_size % 4 WHEN 0 THEN 'bridge' WHEN 1 THEN 'fact' ELSE 'entity' END FROM {part} WHERE p_size % 4 <> 3
  UNION ALL SELECT '{base}op' || s_suppkey, '{type}', '{owl}ObjectProperty' FROM {supplier}
  UNION ALL SELECT '{base}op' || s_suppkey, '{type}', '{owl}DatatypeProperty' FROM {supplier} WHERE s_suppkey % 10 = 0
  UNION ALL SELECT '{base}op' || s_suppkey, '{rdfs}label', s_name FROM {supplier} WHERE s_suppkey % 4 <> 0
  UNION ALL SELECT '{base}op' || s_suppkey, '{rdfs}domain', '{base}C' || (s_suppkey * 3 % 250 + 1) FROM {supplier} WHERE s_suppkey % 6 <> 0
  UNION ALL SELECT '{base}op' || s_suppkey, '{rdfs}domain', '{base}C' || (s_suppkey * 5 % 250 + 1) FROM {supplier} WHERE s_suppkey % 9 = 0
  UNION ALL SELECT '{base}op' || s_suppkey, '{rdfs}range', '{base}C' || (s_suppkey % 50 + 1) FROM {supplier} WHERE s_suppkey % 8 <> 0
  UNION ALL SELECT '{base}dp' || c_custkey, '{type}', '{owl}DatatypeProperty' FROM {customer}
  UNION ALL SELECT '{base}dp' || c_custkey, '{rdfs}label', c_name FROM {customer} WHERE c_custkey % 3 <> 0
  UNION ALL SELECT '{base}dp' || c_custkey, '{rdfs}domain', '{base}C' || (c_custkey * 17 % 2500) FROM {customer})""".replace("{base}", BASE_IRI).replace("{type}", RDF_TYPE).replace("{owl}", OWL).replace("{rdfs}", RDFS),
    "approved_edges": "SELECT 'c' || (s_suppkey * 3 % 250 + 1) AS from_table, 'C' || (s_suppkey % 50 + 1) AS to_table, CASE WHEN s_suppkey % 5 = 0 THEN 'other' ELSE 'OP' END || s_suppkey AS relation FROM {supplier}",
    # A worksheet per part, of joins of all sorts.
    "sheets": """SELECT 'p' || p_partkey || '.sql' AS path, 'WITH c' || p_partkey || ' AS (SELECT * FROM db.A' || (p_partkey % 7) || ' t) SELECT * FROM T' || (p_partkey % 23) || ' x ' || CASE p_partkey % 3 WHEN 0 THEN 'LEFT' WHEN 1 THEN 'INNER' ELSE 'FULL OUTER' END
  || ' JOIN c' || p_partkey || ' y ON x.K' || (p_partkey % 11) || '_ID = y.ID AND ' || CASE p_partkey % 4 WHEN 0 THEN 'x.D >= y.D' WHEN 1 THEN 'CAST(x.D AS DATE) = y.D' WHEN 2 THEN 'x.D = 5' ELSE 'lower(x.D) = y.D' END || ' WHERE x.S > 1' AS sql FROM {part}""",
    # Names with endings of all sorts.
    "names": """SELECT p_partkey AS k, upper(replace(p_type, ' ', '_')) || CASE p_partkey % 9 WHEN 0 THEN 'IES' WHEN 1 THEN 'SSES' WHEN 2 THEN 'XES' WHEN 3 THEN 'CHES' WHEN 4 THEN 'SHES' WHEN 5 THEN 'S_ITEMS' WHEN 6 THEN 'SS' WHEN 7 THEN '_S' ELSE '' END AS name FROM {part}""",
}


def sql(text: str) -> str:
    """A derived table's SQL for DuckDB: the names of tables as they are."""
    return re.sub(r"\{(\w+)\}", lambda m: f"({sql(DERIVED[m[1]])})" if m[1] in DERIVED else m[1], text)


def oracle(text: str) -> str:
    """SQL in which {name} is a table or derived table, for DuckDB."""
    return sql(text)


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table, or one derived from them."""
    if name not in DERIVED:
        return table(spark, sf_dir, name)
    text = DERIVED[name]
    return spark.sql(text, **{n: derived(spark, sf_dir, n) for n in set(re.findall(r"\{(\w+)\}", text))})


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived edges with their confidence."""
    return derived(spark, sf_dir, "edges").withColumn("confidence", X.confidence(F.col("predicate_type"), F.col("left_column"), F.col("right_column"))).withColumn("confidence_reason", F.concat("predicate_type", F.lit(":heuristic")))


def relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = derived(spark, sf_dir, "rels")
    return df.select(*(F.col(c).cast("double").alias(c) if c.endswith("_rate") or c == "confidence_sql" else F.col(c) for c in df.columns))


# Worksheets whose edges are known.
WORKSHEETS = [
    ("a.sql", "-- orders\nSELECT c.name FROM CUSTOMERS c JOIN ORDERS o ON o.CUSTOMER_ID = c.ID WHERE o.total > 5;\nSELECT 1"),
    ("b.sql", "SELECT * FROM ORDER_ITEMS oi JOIN ORDERS o ON oi.ORDER_ID = o.ID AND (oi.REGION = o.REGION) JOIN PRODUCTS p ON oi.PRODUCT_ID = p.ID AND p.KIND = 'x' /* literal */"),
    ("c.sql", "SELECT a.v FROM TABLE_A a LEFT JOIN TABLE_B b ON a.REF_CODE = b.REF_CODE"),
    ("d.sql", "WITH ob AS (SELECT o.id, o.customer_id FROM SALES.PUBLIC.ORDERS o), both AS (SELECT * FROM ACCOUNTS x JOIN BRANCHES y ON x.branch_id = y.id) SELECT * FROM ob JOIN both bb ON ob.customer_id = bb.id JOIN (SELECT * FROM REGIONS) r ON bb.region_id = r.id"),
    ("e.sql", "SELECT * FROM app.events e JOIN app.windows w ON e.event_ts >= w.start_ts AND e.event_ts < w.end_ts JOIN app.users u ON LOWER(e.mail) = LOWER(u.mail) JOIN app.orders o ON CAST(e.order_id AS VARCHAR) = o.id JOIN app.tags t ON e.tag::string = t.name OR t.any = 1"),
    ("f.sql", "THIS ( IS BROKEN SELECT FROM X x JOIN Y y ON x.Y_ID = y.ID"),
    ("h.sql", "SELECT * FROM Größen g JOIN Maße m ON g.maß_id = m.id AND g.art IS NOT DISTINCT FROM m.art WHERE EXTRACT(YEAR FROM m.tag) IS DISTINCT FROM 2020"),
    ("i.sql", "SELECT * FROM STOCK s JOIN BINS b ON s.BIN_ID = b.ID; SELECT ( FROM BROKEN x JOIN ONES y ON x.A = y.B"),
    ("g.sql", "SELECT * FROM \"Quoted\" q JOIN T$1 t USING (id) JOIN S s ON q.id = s.q_id"),
]
