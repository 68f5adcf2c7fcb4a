from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from relweave.functions import expr as X
from relweave.operators import graph, merge, profile, rdf, review
from relweave.schemas import BASE_IRI, OWL, RDF_TYPE, RDFS, RELATIONSHIP, conform


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(("table", "name"), [("CUSTOMERS", "Customer"), ("CATEGORIES", "Category"), ("BOXES", "Box"), ("ADDRESS", "Address"), ("ORDER_ITEMS", "OrderItem"), ("customer_addresses", "CustomerAddress"), ("DISHES", "Dish"), ("a__b", "AB"), ("S", "")])
def test_class_name(spark, table, name):
    assert one(spark, X.class_name(F.lit(table))) == name


@pytest.mark.parametrize(("match", "conf", "status", "out"), [(0.95, 0.8, "proposed", "approved"), (0.95, 0.79999, "proposed", "proposed"), (0.94999, 0.9, "proposed", "proposed"), (1.0, 1.0, "rejected", "rejected"), (None, 1.0, "proposed", "proposed")])
def test_auto_approve_bounds(spark, match, conf, status, out):
    df = spark.createDataFrame([(match, conf, status, None)], "match_rate double, confidence_sql double, status string, evidence string")
    r = merge.auto_approve(df).first()
    assert r.status == out and (r.evidence == " [auto-approved]") == (out == "approved")
    assert merge.auto_approve(df, 0.0).first().status == status


def test_rates_without_rows(spark):
    t = {"a": spark.createDataFrame([], "k int"), "b": spark.createDataFrame([], "id bigint"), "c": spark.createDataFrame([(None,), (1,)], "id bigint")}
    r = profile.edge_profile(t, [profile.Candidate("a", "k", "b", "id"), profile.Candidate("c", "id", "c", "id")]).orderBy("from_table").collect()
    assert (r[0].match_rate, r[0].pk_unique_rate, r[0].fk_null_rate) == (0.0, 0.0, 1.0)
    assert (r[1].match_count, r[1].fk_null_rate, r[1].pk_unique_rate) == (1, 0.5, 0.5)
    live = profile.edge_profile_live({"a": spark.createDataFrame([(1,), (1,)], "k int"), "b": spark.createDataFrame([(1,), (1,), (1,)], "id int")}, [profile.Candidate("a", "k", "b", "id")]).first()
    assert live.match_count == 6 and live.match_rate == 3.0


def test_profile_of_text_against_numbers(spark):
    t = {"a": spark.createDataFrame([("1",), ("x",)], "k string"), "b": spark.createDataFrame([(1,), (2,)], "id int")}
    assert profile.edge_profile(t, [profile.Candidate("a", "k", "b", "id")]).first().match_count == 1


def test_sampled_matches_over_all_rows(spark):
    t = {"a": spark.range(100).select(F.col("id").alias("k")), "b": spark.range(100)}
    r = profile.edge_profile(t, [profile.Candidate("a", "k", "b", "id")], sample=10).first()
    assert r.match_count == 10 and r.fk_nonnull == 100 and r.match_rate == 0.1


def test_emitted_sql_escapes(spark):
    text = profile.emitted_sql([profile.Candidate("a", "k", "b", "id", evidence="o'brien \\ x", ambiguous_direction=True)])
    spark.range(1).select(F.col("id").alias("k")).createOrReplaceTempView("a")
    spark.range(1).createOrReplaceTempView("b")
    assert spark.sql(text).first().evidence == "o'brien \\ x"
    assert spark.sql(profile.emitted_sql([profile.Candidate("a", "k", "b", "id")], "overlap")).first().status == "no_ambiguous_edges"
    assert spark.sql(profile.emitted_sql([profile.Candidate("a", "k", "b", "id")], "columns")).count() == 2


def test_reject_wins_and_corrects(spark):
    rel = conform(spark.createDataFrame([("Orders", "CUSTOMER_ID", "Customers", "ID", "proposed", "")], "from_table string, from_column string, to_table string, to_column string, status string, data_quality_flag string"), RELATIONSHIP)
    over = spark.createDataFrame([("approve", "ORDERS", ["customer_id"], "customers", [], None), ("reject", "orders", [], "CUSTOMERS", ["id"], None)], "kind string, from_table string, from_columns array<string>, to_table string, to_columns array<string>, relation string")
    assert merge.apply_overrides(rel, over).first().status == "rejected"
    hint = spark.createDataFrame([("CUSTOMERS", "ID", "ORDERS", "CUSTOMER_ID", 1.0, 1.0, "ORDERS is likely the PARENT (referred) table")], "table_a string, col_a string, table_b string, col_b string, a_coverage double, b_coverage double, direction_suggestion string")
    r = merge.correct_directions(rel, hint).first()
    assert (r.from_table, r.to_column, r.data_quality_flag) == ("Customers", "CUSTOMER_ID", "direction_corrected")
    # A structural parent isn't fooled by a name that ends alike.
    wide = hint.withColumn("direction_suggestion", F.lit("BIG_ORDERS is likely the PARENT (referred) table")).withColumn("parent_table", F.lit("BIG_ORDERS"))
    assert merge.correct_directions(rel, wide).first().from_table == "Orders"


def test_topological_order():
    assert graph.topological_order(["c", "b", "a"], [("b", "a"), ("c", "b"), ("c", "x")]) == ["a", "b", "c"]
    assert graph.topological_order(["a", "b", "c", "d"], [("a", "b"), ("b", "c"), ("c", "a")]) == ["d", "a", "b", "c"]
    rng = random.Random(1)
    names = [f"t{i}" for i in range(50)]
    keys = [(names[b], names[a]) for a in range(50) for b in range(a + 1, 50) if rng.random() < 0.1]
    rng.shuffle(names)
    order = graph.topological_order(names, keys)
    assert all(order.index(r) < order.index(t) for t, r in keys)


def test_levels_agree_with_order(spark):
    keys = [("b", "a"), ("c", "b"), ("d", "d"), ("e", "d"), ("c", "gone")]
    levels = {r.name: r.level for r in graph.topological_levels(spark.createDataFrame([(x,) for x in "abcde"], "name string"), spark.createDataFrame(keys, "table string, referred string")).collect()}
    assert levels == {"a": 0, "b": 1, "c": 2, "d": None, "e": None}


def test_bridges(spark):
    def t(*rows):
        return spark.createDataFrame([(BASE_IRI + s, p, o, "iri", None, None) for s, p, o in rows], "s string, p string, o string, o_kind string, datatype string, lang string")

    def prop(n):
        return [(f"p{n}", RDF_TYPE, OWL + "ObjectProperty"), (f"p{n}", RDFS + "domain", BASE_IRI + "B"), (f"p{n}", RDFS + "range", BASE_IRI + f"X{n}")]

    bridge = [("B", RDF_TYPE, OWL + "Class"), ("B", BASE_IRI + "classification", "bridge")]
    for n, reason in ((0, "Too few ObjectProperties"), (1, "Too few ObjectProperties"), (2, None), (3, "Too many ObjectProperties")):
        rows = rdf.Ontology(t(*bridge, *(x for k in range(n) for x in prop(k)))).bridge_issues().collect()
        assert [r.reason for r in rows] == ([reason] if reason else [])
    o = rdf.Ontology(t(*bridge))
    empty = spark.createDataFrame([], "from_table string, to_table string, relation string")
    assert o.edge_coverage(empty).first().coverage_rate == 1.0 and o.gates(empty).first().overall == "pass"


def test_review(spark):
    rows = spark.createDataFrame([("A", "x;y", "B", "z", "proposed", "e", 0.5, None, 1)], "from_table string, from_columns string, to_table string, to_columns string, status string, evidence string, confidence_sql double, match_rate double, ordinal int")
    assert review.review_filter(rows, search=" ^a$ ").count() == 1 and review.review_filter(rows, match=0.1).count() == 0 and review.review_filter(rows, ["approved"]).count() == 0
    assert {r["table"]: r.bridge_score for r in review.degrees(rows).collect()} == {"A": 0.0, "B": 0.0}
    flipped = review.flip(rows.withColumn("from_column", F.lit("x")).withColumn("to_column", F.lit("z")), rows.withColumn("from_column", F.lit("x")).withColumn("to_column", F.lit("z")))
    assert {(r.from_table, r.from_columns, r.status) for r in flipped.collect()} == {("A", "x;y", "proposed"), ("B", "z", "proposed")}


def test_stays_native(spark, sf_dir):
    """Profiles read only the columns they need, and run no Python."""
    from relweave.plans.queries import QUERIES

    for name in ("edge_profile", "directed_edges", "merge_profiles", "validation_issues"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan
    assert "ReadSchema: struct<o_custkey:bigint>" in QUERIES["edge_profile"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


def test_nothing_else_imports_llm():
    from pathlib import Path

    root = Path(__file__).resolve().parents[1] / "relweave"
    for p in root.rglob("*.py"):
        if "llm" not in p.relative_to(root).parts:
            assert "relweave.llm" not in p.read_text()


def test_edge_profiles_read_each_column_once(spark):
    """Both ends' value counts are dealt out once and joined as they lie: two scans and two deals an edge, and one more for the sums."""
    import re

    from relweave.operators import profile as P

    child = spark.createDataFrame([(1,), (1,), (2,), (None,), (9,)], "k int")
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id bigint")
    tables, edge = {"c": child, "p": parent}, P.Candidate("c", "k", "p", "id")
    for f, match in ((P.edge_profile, 3), (lambda t, e: P.edge_profile_live(t, e, None), 4)):
        df = f(tables, [edge])
        r = df.first()
        assert (r.sample_rows, r.fk_nonnull, r.match_count, r.pk_distinct, r.pk_total) == (5, 4, match, 2, 4)
        plan = df._jdf.queryExecution().sparkPlan().toString()
        assert len(re.findall(r"Scan ExistingRDD", plan)) == 2 and "Limit" not in plan
        assert len(re.findall(r"\bExchange\b", df._jdf.queryExecution().executedPlan().toString())) == 3
    r = P.value_overlap(tables, [edge]).first()
    assert (r.a_distinct, r.b_distinct, r.a_in_b_count, r.b_in_a_count) == (3, 2, 2, 2)
    none = P.edge_profile({"c": child.limit(0), "p": parent.limit(0)}, [edge]).first()
    assert (none.sample_rows, none.match_rate, none.pk_unique_rate, none.fk_null_rate) == (0, 0.0, 0.0, 1.0)


def test_n_triples_lines(spark, tmp_path):
    """What is written as N-Triples is read back line by line, odd texts too; a line of another kind is an error."""
    import pytest as pt

    from relweave.schemas import TRIPLE
    from relweave.sources import rdf

    rows = [("http://x#a", "http://x#p", o, "literal", d, lang) for o, d, lang in [("plain", None, None), ('a "b" \\ c\\n', None, "en"), ("two\nlines\r", None, None), ("", None, "de-AT"), ("5", "http://www.w3.org/2001/XMLSchema#integer", None), ("\\\\n . # no", None, None)]]
    rows += [("_:b1", "http://x#p", "http://x#o", "iri", None, None), ("http://x#a", "http://x#p", "_:b1", "blank", None, None)]
    df = spark.createDataFrame(rows, TRIPLE)
    rdf.write(df, f"{tmp_path}/t")
    assert sorted(map(str, rdf.read_lines(spark, f"{tmp_path}/t").collect())) == sorted(map(str, df.collect()))
    (tmp_path / "u.nt").write_text("# a note\n\n<a> <b> <c> . # end\nnonsense\n")
    with pt.raises(Exception, match="no N-Triples line"):
        rdf.read_lines(spark, f"{tmp_path}/u.nt").collect()
