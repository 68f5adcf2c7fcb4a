from __future__ import annotations

import json
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from relweave.schemas import BASE_IRI, OWL, RDF_TYPE, RELATIONSHIP, XSD
from relweave.sources import artifacts, catalog, overrides, rdf, results, worksheets

NOW = datetime(2026, 3, 2, 10, 0, 5, tzinfo=timezone.utc)


def test_worksheets(spark, tmp_path):
    (tmp_path / "b").mkdir()
    (tmp_path / "b/x.sql").write_text("SELECT 2;\n")
    (tmp_path / "a.sql").write_text("SELECT 1")
    (tmp_path / "note.txt").write_text("no")
    got = worksheets.scan(spark, str(tmp_path)).collect()
    assert [Path(r.path).name for r in got] == ["a.sql", "x.sql"] and got[1].sql == "SELECT 2;\n"
    h = worksheets.content_hash(worksheets.scan(spark, str(tmp_path))).first()[0]
    assert h.startswith("sha256:") and len(h) == 23
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        worksheets.scan(spark, str(tmp_path / "none")).collect()


def test_edge_profiles(spark, tmp_path):
    p = tmp_path / "e.csv"
    p.write_text("FROM_TABLE,from_column,to_table,to_column,match_rate,frequency,sample_rows,evidence\nA,x,B,y,0.5,,7,old\na,X,b,Y,0.9,3,,\"new, quoted\"\nC,z,D,w,bad,1,2,\n")
    got = {r.from_table.upper(): r for r in results.edge_profiles(spark, str(p)).collect()}
    assert got["A"].match_rate == 0.9 and got["A"].sample_rows == 0 and got["A"].evidence == "new, quoted" and got["C"].match_rate is None
    with pytest.warns(UserWarning, match="no edge profiles"):
        assert results.edge_profiles(spark, str(tmp_path / "none.csv")).count() == 0
    assert results.direction_hints(spark, str(tmp_path / "none.csv")).count() == 0


def test_hints_and_comments(spark, tmp_path):
    (tmp_path / "h.csv").write_text("table_a,col_a,table_b,col_b,a_coverage,b_coverage,direction_suggestion\na,x,b,y,1,0.5,B is likely the PARENT\n")
    assert {(r.table_a, r.table_b) for r in results.direction_hints(spark, str(tmp_path / "h.csv")).collect()} == {("A", "B"), ("B", "A")}
    (tmp_path / "c.csv").write_text("table,comment\n T , first\nT,second\nU,\n,x\n")
    assert [(r.table, r.comment) for r in results.comments(spark, str(tmp_path / "c.csv"), ["table"]).collect()] == [("T", "second")]


def test_hints_told_twice(spark, tmp_path):
    """All rows of a pair come from the loader; for corrections the last one."""
    (tmp_path / "h.csv").write_text("table_a,col_a,table_b,col_b,a_coverage,b_coverage,direction_suggestion\na,x,b,y,1,0.5,A is likely the PARENT\na,x,b,y,1,0.5,unclear\nA,x,b,y,1,0.5,B is likely the PARENT\n")
    got = sorted((r.table_a, r.direction_suggestion) for r in results.direction_hints(spark, str(tmp_path / "h.csv")).collect())
    assert got == [(t, x) for t in "AB" for x in ("A is likely the PARENT", "B is likely the PARENT", "unclear")]
    last = sorted((r.table_a, r.direction_suggestion) for r in results.last_direction_hints(spark, str(tmp_path / "h.csv")).collect())
    assert last == [("A", "B is likely the PARENT"), ("B", "B is likely the PARENT")]


def test_ordered_files_in_pieces(spark, tmp_path, monkeypatch):
    """A result table is written in several tasks, and the last row by the order still wins, though its files are several."""
    from relweave.plans import queries

    rows = spark.range(4000).select(F.concat(F.lit("T"), (F.col("id") % 3).cast("string")).alias("from_table"), F.lit("a").alias("from_column"), F.lit("U").alias("to_table"), F.lit("b").alias("to_column"), F.col("id").alias("frequency"), (F.lit(4000) - F.col("id")).alias("k"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        path = queries._csv(spark, rows, "k")
        assert spark.read.option("header", True).csv(path).select(F.input_file_name()).distinct().count() > 1
        assert sorted((r.from_table, r.frequency) for r in results.edge_profiles(spark, path).collect()) == [("T0", 0), ("T1", 1), ("T2", 2)]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_relationships_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("A", "x", "x", "B", "y", "y", 0.9, 1, "", "", "", "", "", None, 0.5, 0.0, "proposed", 'say "hi", you', "")], RELATIONSHIP)
    results.write_relationships(df, str(tmp_path / "r"))
    r = results.read_relationships(spark, str(tmp_path / "r")).first()
    assert r.evidence == 'say "hi", you' and r.match_rate is None and r.confidence_sql == 0.9


def test_overrides(spark, tmp_path):
    p = str(tmp_path / "o.yaml")
    assert overrides.load(p) == {"approve": [], "reject": [], "rename": [], "table_classification": {}}
    overrides.save(p, {"approve": [{"from": {"table": "A", "columns": ["x", "y"]}, "to": {"table": "B", "column": "z"}, "relation": "r"}], "reject": [], "table_classification": {"A": "fact"}})
    r = overrides.frame(spark, overrides.load(p)).first()
    assert r.from_columns == ["x", "y"] and r.to_columns == ["z"] and r.relation == "r"
    assert overrides.classification(spark, overrides.load(p)).first().asDict() == {"table": "A", "class": "fact"}


def test_turtle():
    t = rdf.parse('@prefix : <http://e#> . PREFIX x: <http://x/>\n:a a x:C ; :p "l\\n\\u00e9"@en , "5"^^x:i , -1.5 , true , """long "q" text""" ; . :b :q [ :r ( :s 7 ) ] , _:n .', "turtle")
    assert ("http://e#a", RDF_TYPE, "http://x/C", "iri", None, None) in t and ("http://e#a", "http://e#p", "l\né", "literal", None, "en") in t
    assert ("http://e#a", "http://e#p", "-1.5", "literal", XSD + "decimal", None) in t and ("http://e#a", "http://e#p", 'long "q" text', "literal", None, None) in t
    assert len(t) == 6 + 1 + 1 + 4 + 1
    for bad in (":a :b :c .", "<http://a> <http://b>", "<http://a> 'x' <http://c> .", "<http://a> <http://b> <http://c>"):
        with pytest.raises(ValueError):
            rdf.parse(bad, "turtle")


def test_rdf_xml():
    head = f'<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:owl="{OWL}" xmlns:b="{BASE_IRI}" xml:base="http://e">'
    t = rdf.parse(head + f'<rdf:Description rdf:about="#s"><b:p rdf:datatype="{XSD}int">5</b:p><b:q><owl:Class rdf:nodeID="n"/></b:q><b:l rdf:parseType="Collection"><owl:Class rdf:about="http://z"/></b:l></rdf:Description></rdf:RDF>')
    assert ("http://e#s", BASE_IRI + "p", "5", "literal", XSD + "int", None) in t and ("_:n", RDF_TYPE, OWL + "Class", "iri", None, None) in t and len(t) == 7
    with pytest.raises(ValueError):
        rdf.parse("<not closed", "xml")
    with pytest.raises(ValueError):
        rdf.parse("", "json")


def test_rdf_round_trip(spark, tmp_path):
    text = '@prefix : <http://e#> . :a :p "x \\"y\\"\\n\\\\z"@en , 5 ; :q :b , _:n .'
    df = rdf.triples_of(spark.createDataFrame([("a.ttl", text)], "path string, text string"))
    rdf.write(df.where("o_kind <> 'blank'"), str(tmp_path / "out"))
    lines = "\n".join(r.value for r in spark.read.text(str(tmp_path / "out")).collect())
    assert sorted(rdf.parse(lines, "n3")) == sorted((r.s, r.p, r.o, r.o_kind, r.datatype, r.lang) for r in df.where("o_kind <> 'blank'").collect())


def test_artifacts(tmp_path):
    assert artifacts.run_id(["2026-03-02_001", "2026-03-01_001", "2026-03-02_002_x"], NOW, "lab") == "2026-03-02_003_lab"
    a = artifacts.versioned(str(tmp_path / "core.owl"), "one", NOW)
    assert (tmp_path / "core.owl").read_text() == "one" and a.endswith("core_2026-03-02T10-00-05.owl")
    artifacts.versioned(str(tmp_path / "core.owl"), "two", NOW.replace(hour=11))
    assert (tmp_path / "core.owl").read_text() == "two" and (tmp_path / "core.owl").is_symlink()
    artifacts.append_json(str(tmp_path / "l/m.jsonl"), {"a": 1}, {"b": "é"})
    assert [json.loads(x) for x in (tmp_path / "l/m.jsonl").read_text().splitlines()] == [{"a": 1}, {"b": "é"}]
    artifacts.write_report(str(tmp_path / "meta.json"), artifacts.run_meta("r", 3, 1, 1000, "h", NOW))
    artifacts.stamp_run(str(tmp_path / "meta.json"), NOW)
    meta = json.loads((tmp_path / "meta.json").read_text())
    assert meta["estimated_rows_k"] == 3 and meta["downstream_run"] == "2026-03-02T10:00:05Z"
    assert artifacts.first_json('so { x {"a": {"b": 1}} }') == {"a": {"b": 1}} and artifacts.first_json("none") is None


def test_catalog(spark):
    df = catalog.columns_of(spark, {"t": spark.createDataFrame([], "a int, b string")})
    assert [(r.name, r.type) for r in df.orderBy("position").collect()] == [("a", "int"), ("b", "string")]
    keys = spark.createDataFrame([("a", "B"), ("a", None), ("a", " ")], "table string, referred_table string")
    assert catalog.usable_keys(keys).count() == 1 and catalog.filtered(df, exclude=["t"]).count() == 0


def test_results_in_a_folder_by_file_name(spark, tmp_path):
    """Of equal keys the last row of the last file by name counts, however large the files are."""
    head = "from_table,from_column,to_table,to_column,match_rate\n"
    (tmp_path / "b.csv").write_text(head + "T,C,U,ID,0.5\n")
    (tmp_path / "a.csv").write_text(head + "T,C,U,ID,0.1\n" * 3000 + "V,C,U,ID,0.2\n")
    got = {r.from_table: r.match_rate for r in results.edge_profiles(spark, str(tmp_path)).collect()}
    assert got == {"T": 0.5, "V": 0.2}


def test_first_object_of_answers(spark):
    """Stray braces, nested objects and a later object don't matter; blank values are passed over; the text itself comes last."""
    texts = ['a { b {"content": "x"}', '{"x": {"text": "inner"}}', '{"text": " ", "content": " y "} {"text": "z"}', " raw ", None, "{", '{"a": "}{"} {"content": "no"}', "{}"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.content for r in artifacts.extracted(df, "t", "$.text", "$.content").orderBy("i").collect()]
    assert got == ["x", '{"x": {"text": "inner"}}', "y", "raw", None, "{", '{"a": "}{"} {"content": "no"}', "{}"]
