"""Snapshots, profiles that are kept up to date, and levels of graphs with cycles."""

from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from relweave.operators import levels
from relweave.session import filesystem, scratch
from relweave.sources import increment, snapshots

DAY = datetime(2026, 1, 1, tzinfo=timezone.utc)


def test_snapshots(spark):
    root = scratch(spark, "history")
    frame = lambda n: spark.range(n).withColumn("a b", F.lit("x"))
    assert snapshots.snapshots(spark, root).count() == 0
    with pytest.raises(LookupError):
        snapshots.as_of(spark, root)
    for n in (3, 0, 5):
        snapshots.write_snapshot(frame(n), root, DAY + timedelta(days=n))
    at = lambda *x: snapshots.as_of(spark, root, *x)
    assert at().count() == 5 and at(DAY + timedelta(days=4)).count() == 3 and at(DAY + timedelta(days=1)).count() == 0 and at(DAY).columns == ["id", "a b"]
    with pytest.raises(LookupError):
        at(DAY - timedelta(seconds=1))
    # Time zones are the same moment; a second writer of one moment doesn't disturb the first.
    assert at((DAY + timedelta(days=4)).astimezone(timezone(timedelta(hours=9)))).count() == 3
    snapshots.write_snapshot(frame(7), root, DAY + timedelta(days=5))
    assert snapshots.snapshots(spark, root).count() == 4 and at().count() in (5, 7)
    assert {r.rows for r in snapshots.snapshots(spark, root).collect()} == {0, 3, 5, 7}


def test_a_writer_that_dies(spark):
    """Rows without an entry are no snapshot, and an entry that waits isn't either; expiry takes what is old but for the last."""
    root = scratch(spark, "history")
    snapshots.write_snapshot(spark.range(2), root, DAY)
    boom = F.when(F.col("id") == 99, F.raise_error(F.lit("died"))).otherwise(F.col("id"))
    with pytest.raises(Exception, match="died"):
        snapshots.write_snapshot(spark.range(100).select(boom.alias("id")), root, DAY + timedelta(days=1))
    spark.range(9).write.parquet(f"{root}/data/ts={snapshots.stamp_of(DAY)}-left")
    assert snapshots.as_of(spark, root).count() == 2
    snapshots.write_snapshot(spark.range(4), root, DAY + timedelta(days=2))
    snapshots.write_snapshot(spark.range(6), root, DAY + timedelta(days=3))
    assert snapshots.expire(spark, root, DAY + timedelta(days=9), keep=2) == 1
    assert snapshots.as_of(spark, root, DAY + timedelta(days=2)).count() == 4 and snapshots.as_of(spark, root).count() == 6
    with pytest.raises(LookupError):
        snapshots.as_of(spark, root, DAY)
    fs, data = filesystem(spark, f"{root}/data")
    assert len(fs.listStatus(data)) == 2


def test_profile_delta(spark, monkeypatch):
    """Only files that are new or changed are read; what has gone is left out; a repeated run reads nothing; empty files are known."""
    at = scratch(spark, "increment")
    folder, state = f"{at}/files", f"{at}/state"
    rows = spark.range(100).select("id", F.when(F.col("id") % 3 > 0, F.concat(F.lit("v"), (F.col("id") % 7).cast("string"))).alias("name"))
    put = lambda df, name: df.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}")
    run = lambda: increment.refreshed(spark, folder, ["id", "name"], state)

    def holds(delta, df):
        got = {r.column_name: r for r in delta.profile.collect()}
        for c in ("id", "name"):
            want = df.agg(F.count("*").alias("n"), F.count(c).alias("k"), F.count_distinct(c).alias("d"), F.min(c).cast("string").alias("a"), F.max(c).cast("string").alias("z")).first()
            assert (got[c].total_rows, got[c].non_null_count, got[c].distinct_count, got[c].min_val, got[c].max_val) == tuple(want)

    put(rows.where("id < 40"), "a")
    put(rows.where("id between 40 and 60"), "b")
    put(rows.limit(0), "none")
    d = run()
    assert (d.read, d.gone) == (3, 0)
    holds(d, rows.where("id <= 60"))
    d = run()
    assert (d.read, d.gone) == (0, 0)
    holds(d, rows.where("id <= 60"))
    put(rows.where("id > 90"), "c")
    put(rows.where("id = 50"), "b")
    d = run()
    assert (d.read, d.gone) == (2, 1)
    holds(d, rows.where("id < 40 or id = 50 or id > 90"))
    # What is read: the files that are new, by name.
    assert increment.forget(spark, folder, state) == 1 and run().gone == 0
    fs, p = filesystem(spark, f"{folder}/a")
    fs.delete(p, True)
    d = run()
    assert (d.read, d.gone) == (0, 1)
    holds(d, rows.where("id = 50 or id > 90"))


def test_profile_of_no_files(spark):
    at = scratch(spark, "increment")
    filesystem(spark, at)[0].mkdirs(filesystem(spark, f"{at}/files")[1])
    d = increment.refreshed(spark, f"{at}/files", ["x"], f"{at}/state")
    assert [tuple(r) for r in d.profile.collect()] == [("x", 0, 0, 1.0, 0, 0.0, None, None)] and d.read == 0


def _levels(names, keys):
    """By reachability and the longest way, in plain Python."""
    names = {n for n in names if n is not None}
    out = {n: {b for a, b in keys if a == n and b in names and b != n} for n in names}
    reach = {n: set(out[n]) for n in names}
    for _ in names:
        for n in names:
            reach[n] |= set().union(*(reach[m] for m in reach[n]))
    group = {n: min({n} | {m for m in reach[n] if n in reach[m]}) for n in names}
    level = {}

    def of(g):
        if g not in level:
            level[g] = 0
            level[g] = 1 + max((of(group[m]) for n in names if group[n] == g for m in out[n] if group[m] != g), default=-1)
        return level[g]

    members = {g: sum(x == g for x in group.values()) for g in group.values()}
    return {(n, of(group[n]), group[n], members[group[n]]) for n in names}


@pytest.mark.parametrize("seed", [1, 2])
def test_dependency_levels(spark, seed):
    rng = random.Random(seed)
    names = [f"n{i:02}" for i in range(24)]
    keys = [(rng.choice(names), rng.choice(names)) for _ in range(26)] + [("n01", "n02"), ("n02", "n01"), ("n03", "n01"), ("n00", "n00"), ("n05", "unlisted"), (None, "n01")]
    got = {tuple(r) for r in levels.dependency_levels(spark.createDataFrame([(n,) for n in [*names, "n01", None]], "name string"), spark.createDataFrame(keys, "table string, referred string")).collect()}
    assert got == _levels(names, keys)


def test_levels_of_little(spark):
    none = spark.createDataFrame([], "table string, referred string")
    assert levels.dependency_levels(spark.createDataFrame([], "name string"), none).count() == 0
    assert [tuple(r) for r in levels.dependency_levels(spark.createDataFrame([("a",)], "name string"), none).collect()] == [("a", 0, "a", 1)]


def test_levels_of_many_names(spark):
    """100,000 names: levels that follow from the numbers, a ring of 50 in front of them."""
    names = spark.range(1, 100_001).select(F.col("id").cast("string").alias("name")).unionByName(spark.range(50).select(F.concat(F.lit("r"), F.col("id").cast("string")).alias("name")))
    tree = spark.range(2, 100_001).select(F.col("id").cast("string").alias("table"), F.floor(F.col("id") / 16).cast("string").alias("referred"))
    ring = spark.range(50).select(F.concat(F.lit("r"), F.col("id").cast("string")), F.concat(F.lit("r"), ((F.col("id") + 1) % 50).cast("string"))).toDF("table", "referred")
    out = levels.dependency_levels(names, tree.unionByName(ring).unionByName(spark.createDataFrame([("r7", "99999")], "table string, referred string")))
    counts = {(r.level, r.members): r.n for r in out.groupBy("level", "members").agg(F.count("*").alias("n")).collect()}
    want = {}
    for i in range(1, 100_001):
        level, k = 0, i
        while (k := k // 16) > 0:
            level += 1
        want[level, 1] = want.get((level, 1), 0) + 1
    k, top = 99999, 1
    while (k := k // 16) > 0:
        top += 1
    assert counts == want | {(top, 50): 50}


def test_levels_in_few_rounds(spark):
    """A ring of 120, and 255 rings of three of which each refers to the one of half its number: tables are stored as the logarithm of the ring and the levels say, not for each step round."""
    rings = spark.range(120).select(F.concat(F.lit("r"), F.col("id")).alias("table"), F.concat(F.lit("r"), (F.col("id") + 1) % 120).alias("referred"))
    node = lambda g, i: F.concat(F.lit("n"), g.cast("bigint"), F.lit("-"), i.cast("string"))
    g, i = F.floor(F.col("id") / 3), F.col("id") % 3
    threes = spark.range(3, 768).select(node(g, i).alias("table"), node(g, (F.col("id") + 1) % 3).alias("referred"))
    up = spark.range(6, 768, 3).select(node(g, i), node(F.floor(g / 2), F.lit(0)))
    keys = rings.unionByName(threes).unionByName(up.toDF("table", "referred"))
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"))
    before = len(list(shared.rglob("_SUCCESS")))
    out = levels.dependency_levels(keys.select(F.col("table").alias("name")), keys)
    got = {(r.level, r.members): r.n for r in out.groupBy("level", "members").agg(F.count("*").alias("n")).collect()}
    assert got == {(k, 3): 3 * 2**k for k in range(8)} | {(0, 120): 120}
    assert len(list(shared.rglob("_SUCCESS"))) - before < 90


def test_levels_of_a_large_group(spark, monkeypatch):
    """Where references that are followed close few rings: a group that holds most of the names, with names before and behind it and small rings, some of them behind each other."""
    rng = random.Random(3)
    core = [f"c{i:03}" for i in range(200)]
    keys = [(n, m) for n in core for m in rng.sample(core, 3)]
    keys += [(f"w{i}", f"w{i + 1}") for i in range(4)] + [("c007", "w0"), ("v1", "c003"), ("v2", "v1"), ("x1", "x2"), ("x2", "x1"), ("x2", "v2"), ("y1", "y2"), ("y2", "y3"), ("y3", "y1"), ("y3", "x1"), ("w4", "z1"), ("z1", "z2"), ("z2", "z1")]
    names = sorted({n for k in keys for n in k})
    called, real = [], levels._coloured
    monkeypatch.setattr(levels, "_coloured", lambda *a: called.append(1) or real(*a))
    got = {tuple(r) for r in levels.dependency_levels(spark.createDataFrame([(n,) for n in names], "name string"), spark.createDataFrame(keys, "table string, referred string")).collect()}
    assert got == _levels(names, keys) and called
