"""Inclusion of all columns at once, sketches, coordinated samples, and keys of different types."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relweave.operators import inclusion, profile
from relweave.operators.profile import Candidate

DAY = dt.date(2026, 1, 2)
NOON = dt.datetime(2026, 1, 2)


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize(
    ("a", "b", "kind"),
    [
        (T.IntegerType(), T.LongType(), T.LongType()), (T.LongType(), T.DecimalType(10, 2), T.DecimalType(22, 2)), (T.DecimalType(38, 0), T.DecimalType(38, 20), T.DoubleType()), (T.IntegerType(), T.FloatType(), T.DoubleType()),
        (T.DecimalType(5, 1), T.DoubleType(), T.DoubleType()), (T.DateType(), T.TimestampType(), T.TimestampType()), (T.StringType(), T.ShortType(), T.LongType()), (T.StringType(), T.DateType(), T.DateType()), (T.BooleanType(), T.LongType(), T.StringType()),
    ],
)
def test_common_type(a, b, kind):
    assert profile.common_type(a, b) == kind == profile.common_type(b, a)


@pytest.mark.parametrize(
    ("left", "a", "right", "b", "matches"),
    [
        ("bigint", [1, 2, 2, None], "decimal(10,2)", [Decimal("1.00"), Decimal("2.50")], 1), ("int", [1, 2, 2], "double", [1.0, 2.0, float("nan")], 3), ("date", [DAY, DAY], "timestamp", [NOON, NOON.replace(hour=3)], 2),
        ("string", ["1", "x", "2", None], "bigint", [1, 3], 1), ("bigint", [1, 5], "string", ["1", "words", "05"], 2), ("decimal(10,2)", [Decimal("1.50")], "decimal(12,1)", [Decimal("1.5")], 1),
    ],
)
def test_key_types(spark, left, a, right, b, matches):
    """Whole, sampled and live profiles, overlaps and emitted SQL agree, whatever the types of the two ends."""
    t = {"a": spark.createDataFrame([(x,) for x in a], f"k {left}"), "b": spark.createDataFrame([(x,) for x in b], f"id {right}")}
    e = [Candidate("a", "k", "b", "id", ambiguous_direction=True)]
    whole = profile.edge_profile(t, e).first()
    assert (whole.match_count, whole.fk_nonnull, whole.pk_distinct) == (matches, sum(x is not None for x in a), len(set(b)))
    assert profile.edge_profile(t, e, sample=100).first() == whole
    assert profile.edge_profile_live(t, e, sample=100).first().match_count == profile.edge_profile_live(t, e, sample=None).first().match_count == matches
    for name, df in t.items():
        df.createOrReplaceTempView(name)
    assert spark.sql(profile.emitted_sql(e, types=profile.types_of(t))).first() == whole
    shown = spark.sql(profile.emitted_sql(e, "overlap", types=profile.types_of(t))).first()
    row = profile.value_overlap(t, e).first()
    assert (shown.a_in_b_count, shown.b_in_a_count, shown.a_distinct) == (row.a_in_b_count, row.b_in_a_count, row.a_distinct)


def _many(spark):
    a = spark.range(500).select(F.when(F.col("id") % 7 > 0, F.col("id")).alias("k"), (F.col("id") % 10).cast("int").alias("small"), F.col("id").cast("decimal(12,2)").alias("money"), (F.col("id") / 2).alias("half"), F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"))
    b = spark.range(300).select((F.col("id") * 2).alias("k"), F.concat(F.lit("n"), (F.col("id") % 20).cast("string")).alias("name"), F.lit(None).cast("bigint").alias("nothing"), F.lit(DAY).alias("day"))
    return {"a": a, "b": b}, [("a", c) for c in a.columns] + [("b", c) for c in b.columns]


def test_inclusion_matrix(spark):
    tables, columns = _many(spark)
    out = inclusion.inclusion_matrix(tables, columns + columns[:2])
    values = {}
    for t, c in columns:
        kind = tables[t].schema[c].dataType
        family = "n" if isinstance(kind, T.NumericType) else kind.typeName()
        values[t, c] = {(family, float(v) if family == "n" else v) for (v,) in tables[t].select(c).collect() if v is not None}
    want = {(*x, *y): (len(values[x]), len(values[y]), len(values[x] & values[y])) for x in values for y in values if x != y and values[x] & values[y]}
    got = {(r.table_a, r.col_a, r.table_b, r.col_b): (r.a_distinct, r.b_distinct, r.common) for r in out.collect()}
    assert got == want and len(got) > 20
    # However many pairs: one scan of each table, one exchange by value.
    text = out._jdf.queryExecution().optimizedPlan().toString()
    index = plan(inclusion.value_index(tables, inclusion.families(tables, columns)))
    assert index.count("Range (") == 2 and index.count("Aggregate") == 1 and "Python" not in text
    empty = {"a": tables["a"].limit(0)}
    assert inclusion.inclusion_matrix(empty, [("a", "k"), ("a", "small")]).count() == 0


def test_bitmaps_of_many_columns(spark):
    """More columns than a word of a bitmap has bits."""
    wide = spark.range(3).select(*[(F.col("id") + i % 2).alias(f"c{i}") for i in range(130)])
    got = inclusion.inclusion_matrix({"w": wide}, [("w", c) for c in wide.columns])
    assert got.count() == 130 * 129 and {(r.common, r.n) for r in got.groupBy("common").agg(F.count("*").alias("n")).collect()} == {(3, 130 * 64), (2, 130 * 65)}


def test_sketches(spark):
    """Merged halves are as good as the whole, within the bounds; small columns exact."""
    rows = spark.range(60_000)
    tables = {"a": rows.select("id", (F.col("id") % 100).alias("few")), "b": rows.select((F.col("id") * 3).alias("id"))}
    columns = [("a", "id"), ("a", "few"), ("b", "id")]
    found = [Candidate("a", "id", "b", "id"), Candidate("a", "few", "a", "id"), Candidate("a", "few", "a", "few")]
    half = lambda k: {t: df.where(F.col("id") % 2 == k) for t, df in tables.items()}
    made = inclusion.merged(inclusion.column_sketches(half(0), columns).unionByName(inclusion.column_sketches(half(1), columns)))
    assert [f.name for f in made.schema] == [x.split()[0] for x in inclusion.SKETCH.split(", ")]
    got = {(r.from_column, r.to_table, r.to_column): r for r in inclusion.sketch_profile(tables, made, found).collect()}
    r = got["id", "b", "id"]
    assert abs(r.common - 20_000) <= r.common_error < 4000 and abs(r.a_distinct - 60_000) < 60_000 * 4 * 1.04 / 64
    assert got["few", "a", "few"].common == 100 == got["few", "a", "few"].b_distinct and got["few", "a", "few"].common_error == 0 and got["few", "a", "few"].a_in_b == 1
    assert made.where("column_name = 'few'").first().total_rows == 60_000


def test_sampled(spark):
    """The same values at both ends, run for run; no exchange gathers rows of a column."""
    rows = spark.range(20_000)
    tables = {"a": rows.select(F.when(F.col("id") % 4 > 0, F.col("id") % 5000).alias("k")), "b": rows.where("id % 3 > 0").select(F.col("id").cast("int").alias("id")), "none": rows.limit(0)}
    e = [Candidate("a", "k", "b", "id"), Candidate("none", "id", "b", "id"), Candidate("b", "id", "none", "id")]
    out = inclusion.edge_profile_sampled(tables, e, 200)
    got = {(r.from_table, r.to_table): r for r in out.collect()}
    r = got["a", "b"]
    assert r.sample_values == 200 and r.fk_null_rate == 0.25 and r.pk_unique_rate == 1 and abs(r.match_rate - 2 / 3) < 0.12
    assert [tuple(x) for x in inclusion.edge_profile_sampled(tables, e, 200).orderBy("from_table").collect()] == [tuple(x) for x in out.orderBy("from_table").collect()]
    assert (got["none", "b"].sample_values, got["none", "b"].fk_null_rate, got["none", "b"].pk_total) == (0, 1.0, 0) and got["b", "none"].match_count == 0
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "GlobalLimit" not in text and "TakeOrdered" not in text


def test_sampled_after_a_bad_estimate(spark, monkeypatch):
    """Where the first look is too small, the next ones take more."""
    monkeypatch.setattr(inclusion, "SLACK", 0.1)
    tables = {"a": spark.range(9000)}
    r = inclusion.edge_profile_sampled(tables, [Candidate("a", "id", "a", "id")], 500).first()
    assert (r.sample_values, r.match_count) == (500, 500)
