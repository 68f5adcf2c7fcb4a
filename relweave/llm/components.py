"""Connected components of link tables, without ever holding them on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relweave.llm.common import dropped, stored


def _with_minima(links: DataFrame) -> DataFrame:
    """links (a, b) with m, the least b of each a.

    The minima are a row per id, aggregated before the shuffle. They are joined by the complement of a, so that the planner deals both sides out anew: adaptive execution then can divide a hub's links among tasks, which it could not if one side were an aggregate that lies by a already."""
    least = links.groupBy("a").agg(F.min("b").alias("m")).select(F.bitwise_not("a").alias("k"), "m")
    return links.join(least, F.bitwise_not(links["a"]) == least["k"]).drop("k")


def components(edges: DataFrame) -> DataFrame:
    """(id, root): root is the smallest id that id reaches, for every id in edges (a, b).

    Alternating large-star and small-star rounds until nothing changes: each round that changes something lowers an id's link, so the rounds end; their number grows as the logarithm of the ids. Minima are aggregated before the shuffle. Each round is written to the shared folder, and the one before it deleted. Null ends and loops add nothing; an empty table gives an empty one. Repeated links count once."""
    now = stored(edges.selectExpr("cast(greatest(a, b) as bigint) a", "cast(least(a, b) as bigint) b").where("a is not null and b is not null and a <> b").distinct(), "links")
    sign = None
    while True:
        both = now.union(now.select("b", "a"))
        large = _with_minima(both).where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).where("a <> b").distinct()
        small = _with_minima(large).select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x")).select("x.a", "x.b").where("a <> b").distinct()
        after = stored(small, "links")
        dropped(now)
        now = after
        mark = now.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long")), F.sum(F.xxhash64("a", "b") % 1000003)).first()
        if mark == sign:
            return now.select(F.col("a").alias("id"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
        sign = mark


def with_more(roots: DataFrame, edges: DataFrame) -> DataFrame:
    """components() of links whose roots are known and of further edges (a, b): only the roots that the edges touch go through rounds again. Ids of edges that roots doesn't have stand for themselves."""
    a, b = (roots.select(F.col("id").alias(x), F.col("root").alias(f"r{x}")) for x in "ab")
    touched = edges.select("a", "b").join(a, "a", "left").join(b, "b", "left").select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    again = components(touched).select(F.col("id").alias("root"), F.col("root").alias("top"))
    old = roots.join(again, "root", "left").select("id", F.coalesce("top", "root").alias("root"))
    new = again.select(F.col("root").alias("id"), F.col("top").alias("root")).join(roots.select("id"), "id", "left_anti")
    return old.unionByName(new)
