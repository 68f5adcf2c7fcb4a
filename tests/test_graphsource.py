"""The source of triples, canonical blank nodes, snippets of all tables, figures of writes."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from relweave.operators import graph, rdf
from relweave.schemas import TRIPLE
from relweave.session import scratch
from relweave.sources import artifacts, graphsource

HARD = ['a "quoted" \\ back\\nslash', "line\nbreak\r\ttab", "", "é🙂 <x> .", "\\", 'ends with "', "# no comment"]


def _triples(spark):
    rows = [(f"http://x#s{i}", f"http://x#p{i % 3}", HARD[i % len(HARD)], "literal", None if i % 2 else "http://x#t", "en-GB" if i % 4 == 1 else None) for i in range(60)]
    rows += [(f"_:b{i}", "http://x#p0", f"http://x#o{i}", "iri", None, None) for i in range(9)] + [("http://x#s", "http://x#rare", "_:b1", "blank", None, None)]
    return spark.createDataFrame(rows, TRIPLE), rows


@pytest.mark.parametrize("size", [7, 100, 1 << 20])
def test_round_trip(spark, size):
    df, rows = _triples(spark)
    at = f"{scratch(spark, 'graph')}/out"
    graphsource.write_graph(df, at)
    assert sorted(map(str, (tuple(r) for r in graphsource.read_graph(spark, at, size).collect()))) == sorted(map(str, rows))


def test_only_wanted_files_are_read(spark):
    """The predicate reaches the source: partitions of other predicates aren't even planned, and nothing is left to filter."""
    df, rows = _triples(spark)
    at = f"{scratch(spark, 'graph')}/out"
    graphsource.write_graph(df, at)
    reader = graphsource.Reader(at, 1 << 20)
    whole = reader.partitions()
    equal = graphsource.EqualTo(("p",), "http://x#rare")
    other = graphsource.EqualTo(("s",), "x")
    assert list(reader.pushFilters([equal, other])) == [other]
    wanted = reader.partitions()
    assert len(wanted) == 1 < len(whole)
    out = graphsource.read_graph(spark, at).where("p = 'http://x#rare'")
    assert out.rdd.getNumPartitions() == 1 and out.count() == 1
    assert graphsource.read_graph(spark, at).where("p in ('http://x#p1', 'http://x#none')").count() == sum(r[1] == "http://x#p1" for r in rows)
    assert graphsource.read_graph(spark, at).where("p = 'http://x#none'").count() == 0


def test_commit_and_abort(spark):
    """A write that fails leaves what was there; a second one adds, an overwrite replaces; files that no commit names aren't read."""
    df, rows = _triples(spark)
    at = f"{scratch(spark, 'graph')}/out"
    graphsource.write_graph(df, at)
    with pytest.raises(Exception, match="a triple needs"):
        graphsource.write_graph(df.withColumn("o", F.when(F.col("s") != "http://x#s", F.col("o"))), at)
    fs, path = graphsource.store(at)
    fs.create_dir(f"{path}/data/left")
    with fs.open_output_stream(f"{path}/data/left/x.nt") as f:
        f.write(b"<a> <b> <c> .\n")
    read = lambda: graphsource.read_graph(spark, at).count()
    assert read() == len(rows)
    graphsource.write_graph(df, at)
    assert read() == 2 * len(rows)
    graphsource.write_graph(df.limit(5), at, "overwrite")
    assert read() == 5
    assert graphsource.read_graph(spark, f"{at}-none").count() == 0


@pytest.mark.parametrize("size", [1, 5, 33, 1000])
def test_plain_files_by_ranges(spark, tmp_path, size):
    """Lines of any length, comments, blank lines, other line ends, and no line end at the last: each line once, however ranges cut them."""
    lines = [f"<s{i}> <p{i % 2}> \"{'x' * (i * 7 % 90)}é\"@de ." for i in range(25)]
    text = "# a comment\n\n" + "\r\n".join(lines[:10]) + "\n" + "\n".join(lines[10:]) + " # after"
    (tmp_path / "a.nt").write_bytes(text.encode())
    reader = graphsource.Reader(str(tmp_path / "a.nt"), size)
    got = sorted(s for p in reader.partitions() for b in reader.read(p) for s in b.column("s").to_pylist())
    assert got == sorted(f"s{i}" for i in range(25))
    if size > 1:
        assert graphsource.read_graph(spark, str(tmp_path), size).where("p = 'p1'").count() == 12


def test_no_triples(tmp_path, spark):
    (tmp_path / "a.nt").write_text("<a> <b> no .\n")
    with pytest.raises(Exception, match="no N-Triples line"):
        graphsource.read_graph(spark, str(tmp_path)).collect()
    at = f"{scratch(spark, 'graph')}/out"
    graphsource.write_graph(spark.createDataFrame([], TRIPLE), at)
    assert graphsource.read_graph(spark, at).count() == 0


def _t(s, p, o, kind="literal"):
    return (s, p, o, kind, None, None)


def test_canonical(spark):
    """One fragment from two files comes once; what differs in one triple stays apart; rings and nodes that are alike stay as many as they are."""

    def file(name, ids, extra=()):
        n = lambda k: f"_:{ids[k]}@{name}"
        rows = [_t("x", "has", n(0), "blank"), _t(n(0), "next", n(1), "blank"), _t(n(1), "next", n(2), "blank"), _t(n(2), "next", n(0), "blank"), _t(n(1), "is", "second"), _t(n(3), "is", "alike"), _t(n(4), "is", "alike"), _t("a", "b", "c")]
        return rows + [_t(n(k), p, o) for k, p, o in extra]

    one = file("1", "abcde")
    run = lambda rows: rdf.canonical(spark.createDataFrame(rows, TRIPLE)).collect()
    names = lambda rows: {x for r in rows for x in (r.s, r.o) if x.startswith("_:")}
    a = run(one)
    assert len(a) == len(one) and len(names(a)) == 5
    assert {tuple(r) for r in run(one + file("2", "edcba"))} == {tuple(r) for r in a}
    other = run(one + file("2", "vwxyz", [(2, "is", "third")]))
    # The ring of the second file differs in one triple, so all of its three nodes do; the two others are the same.
    assert len(names(other)) == 8 and len(other) == len(one) + 6
    assert sorted(re.sub(r"_:\\S+", "_", str(tuple(r))) for r in a) == sorted(re.sub(r"_:\\S+", "_", str(r)) for r in one) or len(a) == len(one)
    assert run([_t("a", "b", "c")])[0].s == "a" and run([]) == []


def test_canonical_ring_without_names(spark):
    ring = [_t(f"_:n{k}@1", "next", f"_:n{(k + 1) % 4}@1", "blank") for k in range(4)]
    got = rdf.canonical(spark.createDataFrame(ring, TRIPLE)).collect()
    assert len(got) == 4 and len({r.s for r in got}) == 4


def test_snippets(spark):
    rng = random.Random(5)
    words = ["order", "line", "item", "customer", "x_1", "größe"]
    lines = [(i, " ".join(rng.choice([w, w.upper(), f"{w},", f"({w})"]) for w in rng.choices(words, k=rng.randrange(0, 9)))) for i in range(80)] + [(80, None), (7, "order again")]
    terms = [("A", "order"), ("A", "ORDER"), ("A", "line item"), ("B", "Größe"), ("B", " "), ("C", None), ("D", "nothing"), ("E", "item item"), ("E", "x_1")]
    got = {(r.table, r.ordinal, r.line) for r in graph.snippets_by_table(spark.createDataFrame(lines, "ordinal int, line string"), spark.createDataFrame(terms, "table string, term string"), 4).collect()}
    split = lambda t: [w for w in re.split(r"[^\w]+", (t or "").lower()) if w]
    holds = lambda t, line: split(t) and f" {' '.join(split(t))} " in f" {' '.join(split(line))} "
    want = set()
    for table in "ABCDE":
        found = sorted({i for i, line in lines if any(t == table and holds(x, line) for t, x in terms)})[:4]
        want |= {(table, i, line) for i, line in lines if i in found}
    assert got == want and {t for t, _, _ in got} == {"A", "B", "E"}
    none = spark.createDataFrame([], "ordinal int, line string")
    assert graph.snippets_by_table(none, spark.createDataFrame(terms, "table string, term string")).count() == 0


def test_snippets_of_frequent_terms(spark):
    """Many tables ask for a word of every line: first ordinals are kept by term before tables meet lines, and lines without ordinal take no place."""
    lines = [(None if k % 2 else k, f"hot bolt {k}") for k in range(60)]
    terms = [(f"T{t}", term) for t in range(30) for term in ("bolt", "hot bolt", "hot")]
    out = graph.snippets_by_table(spark.createDataFrame(lines, "ordinal int, line string"), spark.createDataFrame(terms, "table string, term string"), 4)
    assert sorted(map(tuple, out.collect())) == sorted((f"T{t}", k, f"hot bolt {k}") for t in range(30) for k in (0, 2, 4, 6))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("WindowGroupLimit") >= 2



def test_figures_of_a_write(spark):
    """The figures come with the rows: the write has as many jobs with them as without."""
    rows = spark.range(100).select("id", F.when(F.col("id") % 4 == 0, "a").alias("k"))
    jobs = lambda group: len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    at = scratch(spark, "observed")
    spark.sparkContext.setJobGroup("plain", "")
    rows.write.parquet(f"{at}/plain")
    spark.sparkContext.setJobGroup("observed", "")
    got = artifacts.write_observed(rows, f"{at}/rows", held=F.count("k"), most=F.max("id"))
    spark.sparkContext.setJobGroup("", "")
    assert got == {"rows": 100, "held": 25, "most": 99} and jobs("observed") == jobs("plain") == 1
    assert spark.read.parquet(f"{at}/rows").count() == 100
    assert artifacts.write_observed(rows.limit(0), f"{at}/none", most=F.max("id")) == {"rows": 0, "most": None}


def test_emitted_is_dealt_out(spark):
    """Names in one piece become triples in many tasks, and triples are told apart once."""
    from relweave.operators import rdf as R

    names = spark.range(0, 300, 1, 1).select(F.concat(F.lit("T"), F.col("id").cast("string")).alias("name"), F.lit("fact").alias("classification"))
    columns, keys = names.select(F.col("name").alias("table"), F.lit("x").alias("name")), spark.createDataFrame([("T1", "T2", None)] * 3, "from_table string, to_table string, relation string")
    assert all(part.select(F.spark_partition_id()).distinct().count() > 1 for part in R._emitted(names, columns, keys, R.BASE_IRI)[:2])
    out = R.emitted(names, columns, keys)
    assert out.count() == 300 * 6 + 4 and out._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1
