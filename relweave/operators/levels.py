"""Levels of a graph of references, cycles included, as rounds over stored tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relweave.session import scratch, stored
from relweave.sources.artifacts import write_observed

#: `tried` of an edge that lies on no cycle, or more.
_CUT = 1 << 40


def _kept(df: DataFrame, path: str, **figures: Column) -> tuple[DataFrame, dict]:
    """df, written to path and read again, and aggregates of its rows from the pass that writes them."""
    seen = write_observed(df, path, **figures)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen


def _peeled(nodes: DataFrame, edges: DataFrame, count: int) -> tuple[DataFrame | None, DataFrame, DataFrame, int]:
    """(done, nodes, edges, count) of count nodes (id, best) and distinct edges (a, b, tried) between them: done (id, level) are those from which no cycle can be reached, None if there are none; the others stay with their edges and with the highest level that they refer to.

    A round takes the nodes that refer to none that is left: their level is one more than the highest one that they refer to. There are as many rounds as levels. A round writes only nodes that refer to what has been taken, with how many of their references are met; the edges are stored once."""
    spark, at = nodes.sparkSession, scratch(nodes.sparkSession, "levels")
    free, seen = _kept(nodes.join(edges.select(F.col("a").alias("id")), "id", "left_anti").select("id", F.lit(0).cast("bigint").alias("met"), F.lit(0).cast("bigint").alias("refers"), F.col("best").alias("top")), f"{at}/0")
    taken, rounds = seen["rows"], 1
    if not taken:
        return None, nodes, edges, count
    part = free.limit(0)
    if taken < count:
        refers = edges.groupBy("a").agg(F.count("*").alias("refers")).join(nodes.select(F.col("id").alias("a"), "best"), "a")
        graph = stored(edges.select("a", "b").join(refers, "a"), "edges")
    while taken < count:
        come = graph.join(free.select(F.col("id").alias("b"), (F.col("top") + 1).alias("level")), "b").select(F.col("a").alias("id"), F.lit(1).cast("bigint").alias("met"), "refers", F.greatest("best", "level").alias("top"))
        told, seen = _kept(part.unionByName(come).groupBy("id").agg(F.sum("met").alias("met"), F.max("refers").alias("refers"), F.max("top").alias("top")), f"{at}/{rounds}", free=F.count_if(F.col("met") == F.col("refers")))
        free, part = told.where("met = refers"), told.where("met < refers")
        if not seen["free"]:
            break
        taken, rounds = taken + seen["free"], rounds + 1
    done = spark.read.schema(free.schema).parquet(*[f"{at}/{i}" for i in range(rounds)]).where("met = refers").select("id", (F.col("top") + 1).alias("level"))
    if taken == count:
        return done, nodes, edges, 0
    nodes = stored(nodes.join(done, "id", "left_anti").join(part.select("id", "top"), "id", "left").select("id", F.greatest("best", "top").alias("best")), "left")
    # What a node refers to is done before the node, so the end that is referred to decides.
    edges = stored(edges.join(done.select(F.col("id").alias("b")), "b", "left_anti").select("a", "b", "tried"), "left")
    return done, nodes, edges, count - taken


def _rings(edges: DataFrame, turn: int) -> tuple[DataFrame, DataFrame, bool]:
    """(into, edges, few) of edges (a, b, tried): each node follows one of its references, and into (id, into) leads from nodes that come round again to the least one of their ring. The edges come back with those counted that were followed; few: hardly any node was on a ring.

    A reference that was followed is taken again only after the node's others. Each round doubles the ways and leaves the nodes that no way leads to, until only rings remain, so the rounds grow as the logarithm of the longest way."""
    spark, at = edges.sparkSession, scratch(edges.sparkSession, "ways")
    chosen, seen = _kept(edges.where(F.col("tried") < _CUT).groupBy(F.col("a").alias("id")).agg(F.min_by("b", F.struct("tried", F.xxhash64("a", "b", F.lit(turn)))).alias("to")), f"{at}/0")
    now, rows, rounds, behind, on = chosen.select("id", "to", F.least("id", "to").alias("least")), seen["rows"], 0, 0, 0
    while rows:
        rounds += 1
        ahead = now.select(F.col("id").alias("to"), F.col("to").alias("then"), F.col("least").alias("further"))
        met = now.join(now.select(F.col("to").alias("id")), "id", "left_semi").join(ahead, "to")
        now, seen = _kept(met.select("id", F.col("then").alias("to"), F.least("least", "further").alias("least"), (F.col("further") < F.col("least")).alias("lower")), f"{at}/{rounds}", lower=F.count_if("lower"), on=F.count_if(F.col("least") < F.col("id")))
        same, rows = seen["rows"] == rows, seen["rows"]
        # Nodes with ways of three references or more to them: all that are on rings, and few of the others.
        behind = rows if rounds == 2 else behind
        if same and not seen["lower"]:
            on = seen["on"]
            break
    into = now.where("least < id").select("id", F.col("least").alias("into"))
    edges = edges.join(chosen.select(F.col("id").alias("a"), "to"), "a", "left").select("a", "b", (F.col("tried") + F.when(F.col("b") == F.col("to"), 1).otherwise(0)).alias("tried"))
    return into, edges, on * 10 <= behind


def _spread(marks: DataFrame, edges: DataFrame) -> DataFrame:
    """marks (id, mark) after each node has the least mark of all from which edges (a, b) lead to it; null marks are none. Rounds go on until nothing changes; their number is that of the longest way a mark goes, and only marks that have changed go on."""
    at, rounds = scratch(marks.sparkSession, "marks"), 0
    now, seen = _kept(marks.select("id", "mark", F.col("mark").isNotNull().alias("new")), f"{at}/0", new=F.count_if("new"))
    while seen["new"]:
        rounds += 1
        come = edges.join(now.where("new").select(F.col("id").alias("a"), "mark"), "a").groupBy(F.col("b").alias("id")).agg(F.min("mark").alias("come"))
        now, seen = _kept(now.join(come, "id", "left").select("id", F.least("mark", "come").alias("mark"), F.expr("come IS NOT NULL AND (mark IS NULL OR come < mark)").alias("new")), f"{at}/{rounds}", new=F.count_if("new"))
    return now.select("id", "mark")


def _coloured(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(into, edges) of edges (a, b, tried): into (id, into) leads from nodes that reach each other to the least of them, for some such groups and then all of each. The edges come back with those marked that are now known to lie on no cycle.

    The least node that reaches a node is its colour. What a colour's own node can be reached from, within the colour, is that node's group. Edges between colours lie on no cycle, nor do those that leave or enter a whole group."""
    ways = stored(edges.where(F.col("tried") < _CUT).select("a", "b"), "ways")
    colours = _spread(ways.select(F.explode(F.array("a", "b")).alias("id")).distinct().select("id", F.col("id").alias("mark")), ways)
    side = lambda x: colours.select(F.col("id").alias(x), F.col("mark").alias(f"of_{x}"))
    inside = stored(ways.join(side("a"), "a").join(side("b"), "b").where("of_a = of_b").select(F.col("b").alias("a"), F.col("a").alias("b")), "inside")
    back = _spread(colours.select("id", F.when(F.col("id") == F.col("mark"), F.col("id")).alias("mark")), inside)
    open_ = lambda x: colours.join(back.where("mark IS NULL").select("id"), "id", "left_semi").select(F.col("id").alias(x), F.col("mark").alias(f"of_{x}"))
    marked = edges.join(open_("a"), "a", "left").join(open_("b"), "b", "left").select("a", "b", F.when(F.col("of_a") == F.col("of_b"), F.col("tried")).otherwise(F.lit(_CUT)).alias("tried"))
    return back.where("mark < id").select("id", F.col("mark").alias("into")), marked


def _merged(nodes: DataFrame, edges: DataFrame, into: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(nodes, edges, count) after the nodes of into (id, into) have become one with those that they lead to."""
    to = lambda x: into.select(F.col("id").alias(x), F.col("into").alias(f"into_{x}"))
    nodes, seen = _kept(nodes.join(into, "id", "left").groupBy(F.coalesce("into", "id").alias("id")).agg(F.max("best").alias("best")), f"{scratch(nodes.sparkSession, 'merged')}/rows")
    ends = edges.join(to("a"), "a", "left").join(to("b"), "b", "left").select(F.coalesce("into_a", "a").alias("a"), F.coalesce("into_b", "b").alias("b"), "tried")
    # Of two references between the same nodes, if one lies on no cycle the other doesn't either.
    return nodes, stored(ends.where("a <> b").groupBy("a", "b").agg(F.max("tried").alias("tried")), "merged"), seen["rows"]


def dependency_levels(names: DataFrame, keys: DataFrame) -> DataFrame:
    """(name, level, group, members): a row for each distinct name of names (name); keys (table, referred) are the references between them.

    Names that refer to each other round a cycle are a group with one level; others are groups of their own. level: 0 for groups that refer to no other, else one more than the highest level of those. group: the least name of the group; members: how many it has.
    - null names, references to or from names that aren't listed, and references of a name to itself are left out; repeated ones count once; no names: no rows
    Level after level is taken off. When what is left all stands on or behind cycles, each node follows one reference and the rings that this closes become one node each; where that finds hardly any, the least names spread instead, which finds groups of any size. All rounds are tables in the shared folder; the driver holds no names."""
    numbered, seen = _kept(names.where("name is not null").select("name").distinct().select("name", F.monotonically_increasing_id().alias("id")), f"{scratch(names.sparkSession, 'names')}/rows")
    side = lambda x: numbered.select(F.col("name").alias(f"name_{x}"), F.col("id").alias(x))
    ends = keys.select(F.col("table").alias("name_a"), F.col("referred").alias("name_b")).where("name_a <> name_b").join(side("a"), "name_a").join(side("b"), "name_b")
    edges = stored(ends.select("a", "b").distinct().withColumn("tried", F.lit(0).cast("bigint")), "edges")
    done, nodes, edges, left = _peeled(numbered.select("id", F.lit(-1).cast("bigint").alias("best")), edges, seen["rows"])
    levels, inside, turn, few = [done], None, 0, False
    while left:
        if few:
            into, edges = _coloured(edges)
            few = False
        else:
            into, edges, few = _rings(edges, turn)
        nodes, edges, left = _merged(nodes, edges, into)
        inside = into if inside is None else stored(inside.join(into.select(F.col("id").alias("into"), F.col("into").alias("top")), "into", "left").select("id", F.coalesce("top", "into").alias("into")).unionByName(into), "inside")
        done, nodes, edges, left = _peeled(nodes, edges, left)
        levels, turn = [*levels, done], turn + 1
    levels = [d for d in levels if d is not None]
    if not levels:
        return names.select("name", F.lit(0).cast("bigint").alias("level"), F.col("name").alias("group"), F.lit(1).cast("bigint").alias("members")).limit(0)
    level = reduce(DataFrame.unionByName, levels)
    if inside is None:
        return numbered.join(level, "id").select("name", "level", F.col("name").alias("group"), F.lit(1).cast("bigint").alias("members"))
    of = numbered.join(inside, "id", "left").select("name", F.coalesce("into", "id").alias("id"))
    return of.join(of.groupBy("id").agg(F.min("name").alias("group"), F.count("*").alias("members")), "id").join(level, "id").select("name", "level", "group", "members")
