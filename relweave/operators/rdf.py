"""Ontology checks over TRIPLES (s, p, o, o_kind, datatype, lang): joins and aggregates over a set of triples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from relweave.functions import expr as X
from relweave.schemas import BASE_IRI, OWL, RDF_TYPE, RDFS
from relweave.session import stored

CLASS, OBJECT_PROPERTY, DATATYPE_PROPERTY = (f"{OWL}{x}" for x in ("Class", "ObjectProperty", "DatatypeProperty"))
LABEL, DOMAIN, RANGE, SUBCLASS = (f"{RDFS}{x}" for x in ("label", "domain", "range", "subClassOf"))


def merged(*fragments: DataFrame) -> DataFrame:
    """The union of triples as a set."""
    return reduce(DataFrame.unionByName, fragments).distinct()


def canonical(triples: DataFrame) -> DataFrame:
    """TRIPLE rows, distinct, in which blank nodes (`_:name@file`, as rdf.read names them) are named by what is said of them, so that the same fragment read from two files comes once.

    Each round gives a node a hash of its last one and of its triples, in which blank neighbours stand by their last hashes; rounds go on until they tell no more nodes apart, or as many as there are. The hash over a node's triples is summed without regard to order, so a node with very many is no more than a row a task.
    - nodes of one file that are alike in every round, as on a ring, can't be told apart: they keep apart by their names' order within the file. Rings whose nodes say nothing of their own may then be matched crosswise with another file's and come twice; they never merge with each other
    - triples without blank nodes stay as they are; no triples: no rows; the names hold for one result, not from one to the next"""
    rows = stored(triples.distinct(), "triples")
    blank_s, blank_o = F.col("s").startswith("_:"), F.col("o_kind") == "blank"
    nodes = rows.where(blank_s).select(F.col("s").alias("node")).unionByName(rows.where(blank_o).select(F.col("o").alias("node"))).distinct()
    now = stored(nodes.withColumn("hash", F.lit("")), "nodes")
    count = 0
    while True:
        of = lambda x: now.select(F.col("node").alias(x), F.col("hash").alias(f"{x}_hash"))
        met = rows.where(blank_s | blank_o).join(of("s"), "s", "left").join(of("o"), "o", "left")
        told = lambda side, other: F.struct(F.lit(side).alias("way"), "p", F.coalesce(f"{other}_hash", other).alias("other"), F.col(f"{other}_hash").isNull().alias("named"), "o_kind", "datatype", "lang")
        ends = F.filter(F.array(F.when(blank_s, F.struct(F.col("s").alias("node"), told("out", "o").alias("x"))), F.when(blank_o, F.struct(F.col("o").alias("node"), told("in", "s").alias("x")))), lambda e: e.isNotNull())
        parts = met.select(F.explode(ends).alias("e")).select("e.node", F.to_json("e.x").alias("x"))
        summed = parts.groupBy("node").agg(F.concat_ws(":", F.count("*").cast("string"), *[F.bit_xor(F.xxhash64(F.lit(k), F.col("x"))).cast("string") for k in (1, 2)]).alias("sum"))
        now = stored(now.join(summed, "node").select("node", F.sha2(F.concat_ws(":", "hash", "sum"), 256).alias("hash")), "nodes")
        groups = now.agg(F.count_distinct("hash")).first()[0]
        if groups <= count:
            break
        count = groups
    alike = W.partitionBy(F.substring_index("node", "@", -1), "hash").orderBy("node")
    rank = F.row_number().over(alike)
    names = stored(now.select("node", F.concat(F.lit("_:"), F.substring("hash", 1, 32), F.when(rank > 1, F.concat(F.lit("-"), rank.cast("string"))).otherwise("")).alias("name")), "names")
    of = lambda x: names.select(F.col("node").alias(x), F.col("name").alias(f"{x}_name"))
    out = rows.join(of("s"), "s", "left").join(of("o"), "o", "left")
    return out.select(F.coalesce("s_name", "s").alias("s"), "p", F.when(blank_o, F.coalesce("o_name", "o")).otherwise(F.col("o")).alias("o"), "o_kind", "datatype", "lang").distinct()


def emitted(tables: DataFrame, columns: DataFrame, keys: DataFrame, base: str = BASE_IRI) -> DataFrame:
    """Triples of a schema by fixed rules: a class per table (name, classification), a datatype property per column (table, name), an object property per key (from_table, to_table, relation); each with its label."""
    return merged(*(part.drop("table") for part in _emitted(tables, columns, keys, base)))


def fragments(tables: DataFrame, columns: DataFrame, keys: DataFrame, base: str = BASE_IRI) -> DataFrame:
    """The same, with `table`: the table in upper case that each triple is of, which for a key is the one that refers."""
    return merged(*_emitted(tables, columns, keys, base))


def _emitted(tables: DataFrame, columns: DataFrame, keys: DataFrame, base: str) -> list[DataFrame]:
    """Triples with `table` of tables, columns and keys, repeated ones too. Rows are dealt out before they become triples: a schema is small in bytes, and a task or two would hold all of its triples to tell them apart."""
    iri = lambda c: F.concat(F.lit(base), c)

    def rows(df: DataFrame, table: str, used: list[str], parts: list[tuple[Column, str, Column, str]]) -> DataFrame:
        arr = F.array(*(F.struct(s.alias("s"), F.lit(p).alias("p"), o.alias("o"), F.lit(kind).alias("o_kind")) for s, p, o, kind in parts))
        dealt = df.select(*used).repartition(4 * df.sparkSession.sparkContext.defaultParallelism, *used)
        return dealt.select(F.upper(table).alias("table"), F.explode(arr).alias("t")).select("table", "t.*", F.lit(None).cast("string").alias("datatype"), F.lit(None).cast("string").alias("lang")).where("o is not null")

    c = iri(X.class_name(F.col("name")))
    a = rows(tables, "name", ["name", "classification"], [(c, RDF_TYPE, F.lit(CLASS), "iri"), (c, LABEL, X.class_name(F.col("name")), "literal"), (c, f"{base}classification", F.col("classification"), "literal")])
    name = F.concat(F.lower("table"), F.lit("_"), F.lower("name"))
    b = rows(columns, "table", ["table", "name"], [(iri(name), RDF_TYPE, F.lit(DATATYPE_PROPERTY), "iri"), (iri(name), LABEL, F.col("name"), "literal"), (iri(name), DOMAIN, iri(X.class_name(F.col("table"))), "iri")])
    rel = iri(F.coalesce("relation", F.concat(F.lit("has"), X.class_name(F.col("to_table")))))
    d = rows(keys, "from_table", ["from_table", "to_table", "relation"], [(rel, RDF_TYPE, F.lit(OBJECT_PROPERTY), "iri"), (rel, LABEL, F.coalesce("relation", F.col("to_table")), "literal"), (rel, DOMAIN, iri(X.class_name(F.col("from_table"))), "iri"), (rel, RANGE, iri(X.class_name(F.col("to_table"))), "iri")])
    return [a, b, d]


class Ontology:
    """Questions about a triple table; `base` marks the entities that count."""

    def __init__(self, triples: DataFrame, base: str = BASE_IRI) -> None:
        self.triples, self.base = triples, base

    def _in(self, c: str) -> Column:
        return F.col(c).startswith(self.base)

    def local(self, c: str) -> Column:
        return F.replace(F.col(c), F.lit(self.base), F.lit(""))

    def typed(self, *kinds: str) -> DataFrame:
        """(s, kind) of in-base entities of these types, a row per type."""
        return self.triples.where((F.col("p") == RDF_TYPE) & F.col("o").isin(*kinds) & self._in("s")).select("s", F.col("o").alias("kind"))

    def having(self, p: str) -> DataFrame:
        return self.triples.where(F.col("p") == p).select("s")

    def labelled(self, *kinds: str) -> DataFrame:
        return self.typed(*kinds).join(self.having(LABEL), "s", "left_semi")

    def table_coverage(self, tables: int) -> DataFrame:
        return self.labelled(CLASS).agg(F.count_distinct("s").alias("covered")).withColumn("total", F.lit(tables).cast("bigint")).withColumn("coverage", X.ratio(F.col("covered"), F.col("total")))

    def column_coverage(self, columns: int) -> DataFrame:
        return self.labelled(DATATYPE_PROPERTY, OBJECT_PROPERTY).agg(F.count_distinct("s").alias("covered")).withColumn("total", F.lit(columns).cast("bigint")).withColumn("coverage", X.ratio(F.col("covered"), F.col("total")))

    def relationship_count(self) -> DataFrame:
        return self.typed(OBJECT_PROPERTY).join(self.having(DOMAIN), "s", "left_semi").join(self.having(RANGE), "s", "left_semi").agg(F.count_distinct("s").alias("relationships"))

    def orphan_classes(self) -> DataFrame:
        """Classes that are no property's domain or range and have no parent."""
        used = self.triples.where(F.col("p").isin(DOMAIN, RANGE)).select(F.col("o").alias("s")).union(self.having(SUBCLASS))
        return self.typed(CLASS).select("s").join(used, "s", "left_anti").select(F.col("s").alias("class"))

    def duplicate_iris(self) -> DataFrame:
        """IRIs of more than one type."""
        return self.typed(CLASS, DATATYPE_PROPERTY, OBJECT_PROPERTY).groupBy(F.col("s").alias("iri")).agg(F.count("*").alias("count")).where("count > 1")

    def missing_labels(self) -> DataFrame:
        """Entities without a label, a row per type."""
        return self.typed(CLASS, DATATYPE_PROPERTY, OBJECT_PROPERTY).join(self.having(LABEL), "s", "left_anti").select(F.col("s").alias("entity"))

    def invalid_domains(self) -> DataFrame:
        classes = self.triples.where((F.col("p") == RDF_TYPE) & (F.col("o") == CLASS)).select(F.col("s").alias("domain"))
        return self.triples.where((F.col("p") == DOMAIN) & self._in("s")).select(F.col("s").alias("prop"), F.col("o").alias("domain")).join(classes, "domain", "left_anti").select("prop", "domain")

    def object_properties(self) -> DataFrame:
        """(prop, domain, range) by local names: every domain with every range of a property."""
        part = lambda p, name: self.triples.where(F.col("p") == p).select("s", F.col("o").alias(name))
        return self.typed(OBJECT_PROPERTY).join(part(DOMAIN, "d"), "s").join(part(RANGE, "r"), "s").select(self.local("s").alias("prop"), self.local("d").alias("domain"), self.local("r").alias("range"))

    def all_classes(self) -> DataFrame:
        return self.typed(CLASS).select(self.local("s").alias("class"))

    def classified_classes(self) -> DataFrame:
        """(class, classification), one per class: the last one in order."""
        given = self.triples.where(F.col("p") == f"{self.base}classification").select("s", F.col("o").alias("c"))
        return self.typed(CLASS).join(given, "s").groupBy(self.local("s").alias("class")).agg(F.max("c").alias("classification"))

    def unclassified(self) -> DataFrame:
        return self.all_classes().join(self.classified_classes(), "class", "left_anti")

    def bridge_counts(self) -> DataFrame:
        """(class, prop_count): distinct object properties of each bridge class, 0 without any."""
        bridges = self.typed(CLASS).join(self.triples.where((F.col("p") == f"{self.base}classification") & (F.col("o") == "bridge")).select("s"), "s", "left_semi")
        props = self.triples.where((F.col("p") == RDF_TYPE) & (F.col("o") == OBJECT_PROPERTY)).select(F.col("s").alias("prop"))
        domains = self.triples.where(F.col("p") == DOMAIN).select(F.col("s").alias("prop"), F.col("o").alias("s")).join(props, "prop", "left_semi")
        return bridges.join(domains, "s", "left").groupBy(self.local("s").alias("class")).agg(F.count_distinct("prop").alias("prop_count"))

    def bridge_issues(self) -> DataFrame:
        return self.bridge_counts().where("prop_count <> 2").select("class", F.lit(2).cast("bigint").alias("expected"), F.col("prop_count").alias("actual"), F.when(F.col("prop_count") < 2, "Too few ObjectProperties").otherwise("Too many ObjectProperties").alias("reason"))

    def covered_edges(self, edges: DataFrame) -> DataFrame:
        """edges (from_table, to_table) with `found`: whether an object property connects their classes, in any case. An equality join on distinct pairs."""
        pairs = self.object_properties().select(F.upper("domain").alias("f"), F.upper("range").alias("t")).distinct().withColumn("hit", F.lit(True))
        e = edges.withColumn("f", F.upper(X.class_name(F.col("from_table")))).withColumn("t", F.upper(X.class_name(F.col("to_table"))))
        return e.join(pairs, ["f", "t"], "left").select("from_table", "to_table", F.coalesce("hit", F.lit(False)).alias("found"))

    def edge_coverage(self, edges: DataFrame) -> DataFrame:
        """approved_edges (duplicates count), covered_edges and their rate to three places; 1 without edges."""
        return self.covered_edges(edges).agg(F.count("*").alias("approved_edges"), F.count_if("found").alias("covered_edges")).withColumn("coverage_rate", F.round(X.ratio(F.col("covered_edges"), F.col("approved_edges"), 1.0), 3))

    def missing_edges(self, edges: DataFrame) -> DataFrame:
        return self.covered_edges(edges).where("not found").select("from_table", "to_table", F.lit("ObjectProperty not found").alias("reason"))

    def relation_names(self, expected: DataFrame) -> DataFrame:
        """expected (from_table, to_table, relation) with the property that connects the classes (the last in order; null if none) and outcome: matched, mismatch, or absent."""
        known = self.object_properties().select(F.upper(X.class_name(F.col("domain"))).alias("f"), F.upper(X.class_name(F.col("range"))).alias("t"), "prop").groupBy("f", "t").agg(F.max("prop").alias("actual"))
        e = expected.withColumn("f", F.upper(X.class_name(F.col("from_table")))).withColumn("t", F.upper(X.class_name(F.col("to_table"))))
        outcome = F.when(F.col("actual").isNull(), "absent").when(F.lower("actual") == F.lower("relation"), "matched").otherwise("mismatch")
        return e.join(known, ["f", "t"], "left").select("from_table", "to_table", "relation", "actual", outcome.alias("outcome"))

    def fragment_mismatches(self, expected: DataFrame) -> DataFrame:
        """Object properties of this fragment whose classes, as raw upper-case names, have another relation expected."""
        last = lambda p, n: self.triples.where(F.col("p") == p).groupBy("s").agg(F.max("o").alias(n))
        props = self.typed(OBJECT_PROPERTY).select("s").join(last(DOMAIN, "d"), "s").join(last(RANGE, "r"), "s").select(self.local("s").alias("actual"), self.local("d").alias("domain"), self.local("r").alias("range"))
        e = expected.select(F.upper("from_table").alias("f"), F.upper("to_table").alias("t"), "relation")
        hit = props.join(e, (F.upper("domain") == F.col("f")) & (F.upper("range") == F.col("t")))
        return hit.where(F.lower("actual") != F.lower("relation")).select(F.concat("domain", F.lit("→"), "range").alias("edge"), F.col("relation").alias("expected"), "actual")

    def gates(self, edges: DataFrame, warn: float = 0.50, ok: float = 0.90, allow_duplicates: bool = False) -> DataFrame:
        """One row: parse, duplicates, coverage and overall, each pass, warn or fail."""
        row = self.edge_coverage(edges).crossJoin(self.duplicate_iris().agg(F.count("*").alias("dups")))
        dup = F.when((F.col("dups") == 0) | F.lit(allow_duplicates), "pass").otherwise("fail")
        cov = F.when(F.col("coverage_rate") >= ok, "pass").when(F.col("coverage_rate") >= warn, "warn").otherwise("fail")
        return row.select(F.lit("pass").alias("parse"), dup.alias("duplicates"), cov.alias("coverage"), F.when((dup == "fail") | (cov == "fail"), "fail").otherwise("pass").alias("overall"))

    def issues(self, tables: int, warn: float = 0.50, ok: float = 0.90, allow_duplicates: bool = False) -> DataFrame:
        """severity, category, message, entity of everything that is wrong; coverage below both bounds is told twice."""
        cov = self.table_coverage(tables)
        percent = lambda c: F.format_string("%.1f%%", c * 100)
        told = lambda bound, name, severity: cov.where(F.col("coverage") < bound).select(F.lit(severity).alias("severity"), F.lit("coverage").alias("category"), F.concat(F.lit("Table coverage "), percent(F.col("coverage")), F.lit(f" below {name} threshold {bound:.1%}")).alias("message"), F.lit(None).cast("string").alias("entity"))

        def rows(df: DataFrame, severity: str, category: str, message: Column, entity: str) -> DataFrame:
            return df.select(F.lit(severity).alias("severity"), F.lit(category).alias("category"), message.alias("message"), F.col(entity).alias("entity"))

        return reduce(
            DataFrame.unionByName,
            [
                told(warn, "warning", "warning"), told(ok, "pass", "error"),
                rows(self.duplicate_iris(), "warning" if allow_duplicates else "error", "duplicate_iri", F.concat(F.lit("Duplicate IRI found "), F.col("count").cast("string"), F.lit(" times")), "iri"),
                rows(self.orphan_classes(), "warning", "orphan_class", F.lit("Class has no properties or parent"), "class"),
                rows(self.missing_labels(), "warning", "missing_label", F.lit("Entity missing rdfs:label"), "entity"),
                rows(self.invalid_domains(), "error", "invalid_domain", F.concat(F.lit("Property domain "), F.col("domain"), F.lit(" is not a declared class")), "prop"),
            ],
        )
