"""Dependency order, fingerprints, cache validity, context text."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def topological_order(tables: list[str], keys: Iterable[tuple[str, str]]) -> list[str]:
    """Tables so that referred ones come first, by Kahn's method with a queue in input order; keys (table, referred) to tables that aren't listed are ignored, and tables on or behind a cycle follow in input order. For the hundreds of names that a schema has, on the driver."""
    listed = set(tables)
    children: dict[str, list[str]] = {t: [] for t in tables}
    waiting = dict.fromkeys(tables, 0)
    for table, referred in keys:
        if table in listed and referred in listed:
            children[referred].append(table)
            waiting[table] += 1
    queue, out = deque(t for t in tables if not waiting[t]), []
    while queue:
        t = queue.popleft()
        out.append(t)
        for c in children[t]:
            waiting[c] -= 1
            if not waiting[c]:
                queue.append(c)
    done = set(out)
    return out + [t for t in tables if t not in done]


def topological_levels(tables: DataFrame, keys: DataFrame) -> DataFrame:
    """(name, level): 0 for tables that refer to none of the others, else one more than the highest level referred to; null on or behind a cycle.

    The names and keys of a schema, some hundreds, come to the driver, which takes off one level after another; data never does."""
    spark: SparkSession = tables.sparkSession
    names = tables.select("name").distinct()
    left = keys.select("table", "referred").distinct().join(names.select(F.col("name").alias("table")), "table", "left_semi").join(names.select(F.col("name").alias("referred")), "referred", "left_semi").select("table", "referred")
    todo, edges = [r.name for r in names.collect()], [(r.table, r.referred) for r in left.collect()]
    level, at = {}, 0
    while todo:
        blocked = {t for t, _ in edges}
        free = [t for t in todo if t not in blocked]
        if not free:
            break
        level |= dict.fromkeys(free, at)
        gone = set(free)
        todo = [t for t in todo if t not in gone]
        edges = [(t, r) for t, r in edges if r not in gone]
        at += 1
    return spark.createDataFrame([(t, at_) for t, at_ in level.items()] + [(t, None) for t in todo], "name string, level bigint")


def _short_hash(value: Column) -> Column:
    return F.substring(F.sha2(value.cast("binary"), 256), 1, 16)


def fingerprints(columns: DataFrame, keys: DataFrame, tables: DataFrame) -> DataFrame:
    """(table, schema_hash, fk_hash, comment_hash) of tables (name, comment, primary_key array): 16 hex digits of SHA-256 over what is sorted, so order plays no part. columns (table, name, type, nullable, comment), keys (table, constrained_columns, referred_table, referred_columns)."""
    cols = columns.groupBy("table").agg(
        F.array_sort(F.collect_list(F.struct("name", "type", "nullable"))).alias("cols"),
        F.array_sort(F.collect_list(F.struct("name", F.coalesce("comment", F.lit("")).alias("comment")))).alias("notes"),
    )
    fks = keys.groupBy("table").agg(F.array_sort(F.collect_list(F.struct("referred_table", F.sort_array("constrained_columns").alias("c"), F.sort_array("referred_columns").alias("r")))).alias("fks"))
    told = lambda c, kind: F.coalesce(F.to_json(F.struct(F.coalesce(F.col(c), F.from_json(F.lit("[]"), kind)).alias("x"))), F.lit(""))
    t = tables.select(F.col("name").alias("table"), "comment", F.sort_array(F.coalesce("primary_key", F.array().cast("array<string>"))).alias("pk"))
    out = t.join(cols, "table", "left").join(fks, "table", "left")
    schema = F.concat_ws("|", "table", told("cols", "array<struct<name:string,type:string,nullable:boolean>>"), F.to_json(F.struct("pk")))
    comment = F.concat_ws("|", F.coalesce("comment", F.lit("")), told("notes", "array<struct<name:string,comment:string>>"))
    return out.select("table", _short_hash(schema).alias("schema_hash"), _short_hash(told("fks", "array<struct<referred_table:string,c:array<string>,r:array<string>>>")).alias("fk_hash"), _short_hash(comment).alias("comment_hash"))


def stale_tables(now: DataFrame, cache: DataFrame, force: DataFrame | None = None) -> DataFrame:
    """Tables of `now` (table, schema_hash, fk_hash, comment_hash, classification) that the cache doesn't hold alike: names match in any case, all four values must be equal (null equals null); those in force (table) are stale anyway."""
    held = cache.groupBy(F.upper("table").alias("k")).agg(F.max_by(F.struct("schema_hash", "fk_hash", "comment_hash", "classification"), F.lit(0)).alias("c")) if "ordinal" not in cache.columns else cache.groupBy(F.upper("table").alias("k")).agg(F.max_by(F.struct("schema_hash", "fk_hash", "comment_hash", "classification"), "ordinal").alias("c"))
    same = F.lit(True)
    for c in ("schema_hash", "fk_hash", "comment_hash", "classification"):
        same = same & F.col(c).eqNullSafe(F.col(f"c.{c}"))
    out = now.join(held, F.upper("table") == F.col("k"), "left").withColumn("valid", F.col("c").isNotNull() & same)
    if force is not None:
        out = out.join(force.select(F.upper("table").alias("f")).distinct(), F.upper("table") == F.col("f"), "left").withColumn("valid", F.col("valid") & F.col("f").isNull())
    return out.where("not valid").select("table")


def schema_context(tables: DataFrame, columns: DataFrame, keys: DataFrame) -> DataFrame:
    """(name, text): a table's description for a prompt. columns need `position`; keys (table, from_column, to_table, to_column, confidence, evidence)."""
    line = F.concat(F.lit("- "), "name", F.lit(" : "), "type", F.when(F.col("nullable"), " NULL").otherwise(" NOT NULL"), F.when(F.coalesce("comment", F.lit("")) != "", F.concat(F.lit("  // "), "comment")).otherwise(""))
    cols = columns.groupBy(F.col("table").alias("t")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", line.alias("l")))), lambda x: x.l), "\n").alias("cols"))
    key = F.concat(F.lit("- ['"), "from_column", F.lit("'] -> "), "to_table", F.lit("(['"), "to_column", F.lit("'])  [conf="), F.format_string("%.2f", F.col("confidence")), F.lit("]"), F.when(F.coalesce("evidence", F.lit("")) != "", F.concat(F.lit("  // "), "evidence")).otherwise(""))
    fks = keys.groupBy(F.col("table").alias("k")).agg(F.array_join(F.array_sort(F.collect_list(key)), "\n").alias("fks"))
    out = tables.join(cols, F.col("name") == F.col("t"), "left").join(fks, F.col("name") == F.col("k"), "left")
    lines = [
        F.concat(F.lit("TABLE "), "name"),
        F.when(F.coalesce("classification", F.lit("")) != "", F.concat(F.lit("TABLE_CLASSIFICATION: "), "classification")),
        F.when(F.coalesce("comment", F.lit("")) != "", F.concat(F.lit("TABLE_COMMENT: "), "comment")),
        F.lit("COLUMNS:"),
        F.col("cols"),
        F.when(F.size(F.coalesce("primary_key", F.array().cast("array<string>"))) > 0, F.concat(F.lit("PRIMARY_KEY: ['"), F.array_join("primary_key", "', '"), F.lit("']"))),
        F.when(F.col("fks").isNotNull(), F.concat(F.lit("FOREIGN_KEYS (declared or inferred):\n"), "fks")),
    ]
    return out.select("name", F.concat_ws("\n", *lines).alias("text"))


def core_snippets(lines: DataFrame, terms: list[str], k: int = 10) -> DataFrame:
    """The first k lines (ordinal, line) that hold one of the terms as a word, in any case."""
    found = F.lit(False)
    for t in terms:
        if t:
            found = found | F.col("line").rlike(r"(?i)\b\Q" + t.replace(r"\E", r"\E\\E\Q") + r"\E\b")
    return lines.where(found).orderBy("ordinal").limit(k)


#: What separates words: everything but letters, digits and the underscore.
_GAP = r"[^\p{L}\p{N}_]+"


def snippets_by_table(lines: DataFrame, terms: DataFrame, k: int = 10) -> DataFrame:
    """(table, ordinal, line): for each table of terms (table, term) the first k lines (ordinal, line) that hold one of its terms: the term's words side by side, in any case and whatever stands between them.

    Lines are dealt out, and their runs of as many words as some term has are looked up among the distinct terms, whichever tables ask for them. Of each term, and then of each table, only the first k ordinals are kept, in each task before they are dealt out, so frequent terms cost a look-up a line and no more.
    - null or blank terms, lines without words and lines without ordinal find nothing; repeated terms and several terms in a line give it once; ordinals that several lines have give each line; no lines or terms: no rows"""
    words = lambda c: F.filter(F.split(F.lower(c), _GAP), lambda w: w != "")
    asked = terms.select("table", words("term").alias("words")).where(F.size("words") > 0).select("table", F.array_join("words", " ").alias("term"), F.size("words").alias("n")).distinct()
    runs = F.transform(F.sequence(F.lit(1), F.size("words") - F.col("n") + 1), lambda i: F.array_join(F.slice("words", i, F.col("n")), " "))
    dealt = lines.where("ordinal is not null").repartition("ordinal").select("ordinal", words("line").alias("words"))
    found = dealt.join(F.broadcast(asked.select("n").distinct()), F.size("words") >= F.col("n")).select("ordinal", F.explode(F.array_distinct(runs)).alias("term"))
    first = lambda key: F.dense_rank().over(W.partitionBy(key).orderBy("ordinal"))
    met = found.join(asked.select("term").distinct(), "term").withColumn("r", first("term")).where(F.col("r") <= k).select("term", "ordinal").distinct()
    kept = met.join(asked.select("table", "term"), "term").withColumn("r", first("table")).where(F.col("r") <= k).select("table", "ordinal").distinct()
    return kept.join(lines.select("ordinal", "line"), "ordinal").select("table", "ordinal", "line")
